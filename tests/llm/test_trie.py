from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import oracle
import pytest

from tidemark.llm import trie

ROWS = "conv_id long, turn long, role string, text string, depth int, part string, words string, d0 long"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", *trie.SUMS, "ends_sha256"]


def plain(rows, rebuilt: bool) -> list[tuple]:
    """Every prefix as a tuple of turns."""
    convs = {}
    for r in rows:
        if r["conv_id"] is not None:
            convs.setdefault(r["conv_id"], []).append(r)
    for c, turns in convs.items():
        pairs = [(r["turn"] is not None, r["turn"] or 0, r["role"] or "", r["text"] or "") for r in turns]
        sha = lambda p: hashlib.sha256(f"{len(p[2].encode())}:{p[2]}{p[3]}".encode()).hexdigest()
        convs[c] = [p[2:] for p in sorted(pairs, key=lambda p: (p[0], p[1], sha(p)))]
    whole = dict(convs)
    for c in convs if rebuilt else ():
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = convs.get(c - c % 20, [])[:h] + convs[c][h:]
    members = {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), set()).add(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        words = len(node[-1][1].replace("\t", " ").split()) if node else 0
        leaves[node] = sum(leaves[b] for b in below) or 1
        saved[node] = (len(members[node]) - 1) * words + sum(saved[b] for b in below)
    out = []
    for node, own in members.items():
        ends = sorted(c for c in own if len(whole[c]) == len(node))
        out.append(
            (min(own), len(node), min(members[node[:-1]]) if node else None, len(own), len(children.get(node, [])),
             leaves[node], saved[node], hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest())
        )
    return sorted(out, key=str)


def ours(df) -> list[tuple]:
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=str)


def talk(n: int, seed: int):
    rng = random.Random(seed)
    out = []
    for c in rng.sample(range(3 * n), n):
        turns = rng.randrange(0, 6)
        for t in range(turns):
            turn = None if rng.random() < 0.05 else t
            out.append((c, turn, rng.choice(["user", "user", None, ""]), rng.choice(["hi there", "a\tb c", "", None]), 0, "p", "w", 1))
    return [*out, (None, 0, "user", "nobody", 0, "p", "w", 1), *out[:2]]


@pytest.mark.parametrize("rebuilt", [False, True])
@pytest.mark.parametrize("shard, band", [(trie.SHARD, trie.BAND), (10, 2), (1, 1)])
def test_against_whole_prefixes(spark, rebuilt, shard, band):
    rows = spark.createDataFrame(talk(80, 3), ROWS)
    assert ours(trie.trie(rows, rebuilt, shard, band)) == plain([r.asDict() for r in rows.collect()], rebuilt)


def test_one_long_conversation_and_many_equal_ones(spark):
    """A conversation that spans tasks, its copy but for the end, and a list of ends that does."""
    rows = [(1, t, "user", f"turn {t}", 0, "p", "w", 1) for t in range(900)]
    rows += [(2, t, "user", f"turn {t}" if t < 700 else f"other {t}", 0, "p", "w", 1) for t in range(800)]
    rows += [(c, t, "user", "same", 0, "p", "w", 1) for c in range(1000, 3000) for t in range(2)]
    rows = spark.createDataFrame(rows, ROWS).repartition(6)
    got = ours(trie.trie(rows, shard=200, band=64))
    assert got == plain([r.asDict() for r in rows.collect()], False)


def test_empty_table_and_query(spark, sf_dir, tmp_path):
    assert ours(trie.trie(spark.createDataFrame([], ROWS))) == []
    spark.createDataFrame(talk(60, 5), ROWS).write.parquet(f"{tmp_path}/conversations.parquet")
    con = oracle.connect(sf_dir)
    con.execute(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    problem, rows = oracle.compare(con, trie.op12_prefix_trie(spark, str(tmp_path)), trie.OP12_SQL)
    assert problem is None and rows > 40, problem


def test_node_table_is_minimal_and_knows_strangers():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 1 << 63, (2, 5000), dtype=np.uint64)
    made = trie.NodeTable(*keys)
    assert sorted(made.slots(*keys)) == list(range(5000))
    assert (made.slots(keys[0], keys[1] + np.uint64(1)) == -1).all()


def test_powers_may_be_negative():
    base = trie.bases(0)[0]
    e = np.array([-3, -1, 0, 1, 17])
    assert [int(x) for x in trie.power(base, e)] == [pow(base, int(k), 1 << 64) for k in e]
