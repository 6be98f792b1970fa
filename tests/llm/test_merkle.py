from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import merkle, sha256
from tidemark.llm.common import table

DOCS = "doc_id long, text string, lang string, source string, n_chars long, tree string, pos long, n string, _row int"


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text) -> str:
    out = []
    for value in (row["doc_id"], row["source"], row["lang"], row["n_chars"], text):
        out.append("-" if value is None else f"{len(str(value).encode())}:{value}")
    return digest(*out)


def levels_of(nodes: list[str]) -> list[list[str]]:
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][i : i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def plain(rows) -> list[tuple]:
    """The manifest by whole trees, each fold by hashing the run anew."""
    trees = {}
    for r in rows:
        trees.setdefault(r["source"], []).append(r)
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        trees[s].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r, r["text"])))
    sub = {s: levels_of([leaf_of(r, r["text"]) for r in trees[s]]) for s in order}
    top = levels_of([sub[s][-1][0] for s in order])
    root, out = top[-1][0], []
    for k, s in enumerate(order):
        for i, r in enumerate(trees[s]):
            text = r["text"]
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0 and text is not None:
                text = text.replace("\n", "")
            now, proof = leaf_of(r, text), []
            for levels, at in ((sub[s], i), (top, k)):
                for level in levels[:-1]:
                    run = level[at - at % 3 : at - at % 3 + 3]
                    proof += run[: at % 3] + run[at % 3 + 1 :]
                    now = digest(*run[: at % 3], now, *run[at % 3 + 1 :])
                    at //= 3
            out.append((r["doc_id"], leaf_of(r, r["text"]), sub[s][-1][0], root, digest(*proof), now, now == root))
    return sorted(out, key=str)


def query(spark, docs, tmp_path, **options) -> list[tuple]:
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = merkle.op11_merkle_manifest(spark, str(tmp_path), **options)
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert got.columns == names
    return sorted((tuple(r) for r in got.collect()), key=str)


def test_hashes_are_those_of_the_standard():
    raws = [hashlib.sha256(str(i).encode()).digest() for i in range(50)]
    state = np.broadcast_to(sha256.START, (8, 50)).copy()
    for blocks in range(1, 4):
        state = sha256.resumed(state, sha256.hex_block(sha256.from_bytes(raws)))
        want = [hashlib.sha256(r.hex().encode() * blocks).digest() for r in raws]
        assert sha256.to_bytes(sha256.closed(state, blocks)) == want


def rows_of(n: int, sources, seed: int):
    rng = random.Random(seed)
    texts = [None, "", "a\nb\n\nc", "no break", "é\n" * 50, "x" * 30_000]
    return [
        (rng.randrange(10**15) if rng.random() > 0.02 else None, rng.choice(texts), rng.choice([None, "en", "de"]),
         rng.choice(sources), rng.choice([None, 5]), "t", 1, "n", 0)
        for _ in range(n)
    ]


@pytest.mark.parametrize("n", [1, 2, 3, 4, 40])
def test_small_tables(spark, tmp_path, n):
    rows = rows_of(n, [None, "", "b", "ä", "B"], n)
    rows += rows[:3]  # rows in full again
    docs = spark.createDataFrame(rows, DOCS)
    assert query(spark, docs, tmp_path) == plain([r.asDict() for r in docs.collect()])


def test_a_source_that_holds_most_rows(spark, tmp_path):
    """Blocks of nine leaves, so that rounds follow each other; one id fills a third."""
    rows = rows_of(400, ["hot"] * 9 + [None, "a", "c"], 7) + [(5, "same\n", "en", "hot", 1, "t", 1, "n", 0)] * 200
    rows += rows_of(60, [f"s{i}" for i in range(40)], 8)
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    assert query(spark, docs, tmp_path, levels=2) == plain([r.asDict() for r in docs.collect()])


def test_empty_table(spark, tmp_path):
    assert query(spark, spark.createDataFrame([], DOCS), tmp_path) == []


def test_without_changes_every_row_folds_to_the_root(spark, sf_dir):
    got = merkle.manifest(table(spark, sf_dir, "documents"))
    assert got.where("folded_root <> root").isEmpty()
    assert got.select("root").distinct().count() == 1


def test_steps_keep_the_state_before_a_slot():
    pos, levels = np.arange(5), np.full(5, 2)
    raws = [hashlib.sha256(bytes([i])).digest() for i in range(5)]
    first = next(merkle.climb(pos, levels, sha256.from_bytes(raws)))[1]
    assert first["slot"].tolist() == [0, 1, 2, 0, 1] and first["size"].tolist() == [3, 3, 3, 2, 2]
    start = tuple(sha256.START[:, 0])
    assert tuple(first["state"][0]) == start and tuple(first["state"][3]) == start
    one = sha256.resumed(sha256.START, sha256.hex_block(sha256.from_bytes(raws[:1])))
    assert tuple(first["state"][1]) == tuple(one[:, 0])
