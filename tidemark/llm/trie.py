"""The trie of conversation prefixes, as a flat table of nodes.

A node is a distinct sequence of the first turns of a conversation. Prefixes are known by a digest:
turn number i adds its hash times the i-th power of a base, so digests of all prefixes are
running sums, which add up across tasks: a conversation may hold most of the rows. A prefix
that is moved by some places is multiplied by a power. Digests are verified: all rows of a node
must agree on its last turn and on its parent, hence, level by level, on the whole prefix; where
they do not, the table is built anew with other bases.

Counts are accumulated over subtrees in shards. A prefix is *heavy* if the turns that follow
it in all its members, a bound of its subtree, exceed ``SHARD``. Subtrees of prefixes that are not
heavy are dealt to shards whole. A shard enumerates its distinct digests in a minimal perfect
hash table, whose slots hold their digest so that collisions show, scatters the counts into
flat arrays by slot and adds every node to its parent's slot, deepest first. What reaches the
top of a subtree is summed by parent, so a prefix may have any number of children. The heavy
prefixes, few as their bounds add up to the table's size at most on each level, follow in the
same way, in bands of ``BAND`` levels from the deepest.

Ends of a prefix are sorted and hashed in order; a list that spans tasks is hashed from blocks
of text of bounded size.

Defined cases: a null role or text is empty; null turns come first, turns that are equal go by the
digest of role and text; rows with a null conversation are in no conversation; rows that repeat
are turns each; an empty table has no node. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.common import table, words_of, written
from tidemark.llm.hashing import U, mixed
from tidemark.llm.merkle import CRC32_SQL, crc32_sql

SHARD = 100_000
BAND = 10_000
HEAD = 3
CHUNK = 4096
LANES = 2


# --- prefix digests -----------------------------------------------------------------------


def bases(seed: int) -> list[int]:
    rng = np.random.default_rng([12, seed])
    return [int(b) * 8 + 5 for b in rng.integers(1 << 59, 1 << 61, LANES)]


def power(base: int, exponents: np.ndarray) -> np.ndarray:
    """Powers modulo 2**64, of exponents that may be negative."""
    out = np.ones(len(exponents), np.uint64)
    for sign in (1, -1):
        left = np.maximum(sign * exponents, 0)
        square = pow(base, sign, 1 << 64)
        while left.any():
            out[left & 1 == 1] *= U(square)
            square = square * square % (1 << 64)
            left = left >> 1
    return out


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _unsigned(column: pd.Series) -> np.ndarray:
    return column.to_numpy(np.int64).view(np.uint64)


def ordered_turns(conversations: DataFrame, seed: int) -> DataFrame:
    """``conv_id, part, idx, a, b, words, s0, s1``: turns in order, ``idx`` and the running digest
    ``s`` counted within the conversation's rows of one task, ``part``; ``a, b`` are 128 bits
    of the digest of role and text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("d"),
        F.size(words_of(text)).cast("long").alias("words"),
        F.monotonically_increasing_id().alias("_row"),
    )
    keys = ("conv_id", "turn", "d", "_row")
    parts = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = bases(seed)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        last, n, sums = None, 0, [U(0)] * LANES
        for rows in batches:
            if not len(rows):
                continue
            conv = rows["conv_id"].to_numpy(np.int64)
            new = np.r_[conv[0] != last, conv[1:] != conv[:-1]]
            first = np.maximum.accumulate(np.where(new, np.arange(len(conv)), 0))
            carried = np.cumsum(new) == 0
            idx = np.arange(len(conv)) - first + np.where(carried, n, 0)
            ab = np.frombuffer(b"".join(d[:16] for d in rows["d"]), ">u8").astype(np.uint64).reshape(-1, 2)
            out = {"conv_id": conv, "part": part, "idx": idx, "a": _signed(ab[:, 0].copy()), "b": _signed(ab[:, 1].copy()), "words": rows["words"]}
            for lane, base in enumerate(own):
                total = np.cumsum(lane_of(ab[:, 0], ab[:, 1], lane) * power(base, idx))
                before = np.where(first > 0, total[first - 1], U(0))
                total = total - before + np.where(carried, sums[lane], U(0))
                out[f"s{lane}"] = _signed(total)
                sums[lane] = total[-1]
            last, n = conv[-1], int(idx[-1]) + 1
            yield pd.DataFrame(out)

    return (
        turns.repartitionByRange(parts, *keys)
        .sortWithinPartitions(*keys)
        .select("conv_id", "d", "words")
        .mapInPandas(run, "conv_id long, part int, idx long, a long, b long, words long, s0 long, s1 long")
    )


def lane_of(a: np.ndarray, b: np.ndarray, lane: int) -> np.ndarray:
    """The hash a turn adds in a lane."""
    return mixed(a if lane == 0 else b) | U(1)


def _carried(turns: DataFrame, shares: DataFrame, seed: int) -> DataFrame:
    """``conv_id, part, before, t0, t1``: rows and digest of earlier tasks, for conversations of
    several; there are at most two such rows a task."""
    several = shares.groupBy("conv_id").agg(F.count("*").alias("_p")).where("_p > 1").select("conv_id")
    ends = shares.join(several, "conv_id").select("conv_id", "part", F.col("n").alias("idx"))
    last = turns.withColumn("idx", F.col("idx") + 1).join(ends, ["conv_id", "part", "idx"])
    own = bases(seed)

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("part", ignore_index=True)
        before = rows["idx"].cumsum() - rows["idx"]
        out = {"conv_id": rows["conv_id"], "part": rows["part"], "before": before}
        for lane, base in enumerate(own):
            terms = _unsigned(rows[f"s{lane}"]) * power(base, before.to_numpy())
            out[f"t{lane}"] = _signed(np.cumsum(terms) - terms)
        return pd.DataFrame(out)

    return (
        last.select("conv_id", "part", "idx", "s0", "s1")
        .groupBy("conv_id")
        .applyInPandas(add, "conv_id long, part int, before long, t0 long, t1 long")
    )


def _whole(rows: DataFrame, seed: int) -> DataFrame:
    """Turns with ``idx`` and ``s`` counted within the whole conversation."""
    own = bases(seed)

    def shift(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for r in batches:
            before = r["before"].to_numpy(np.int64)
            for lane, base in enumerate(own):
                total = _unsigned(r[f"t{lane}"]) + _unsigned(r[f"s{lane}"]) * power(base, before)
                r[f"s{lane}"] = _signed(total)
            r["idx"] += before
            yield r[["conv_id", "idx", "a", "b", "words", "s0", "s1"]]

    return rows.mapInPandas(shift, "conv_id long, idx long, a long, b long, words long, s0 long, s1 long")


def prefixes(conversations: DataFrame, rebuilt: bool, seed: int) -> tuple[DataFrame, DataFrame]:
    """Members and lengths: ``conv_id, depth, d0, d1, p0, p1, a, b, words, len`` for each turn of
    each conversation (digests of the prefix up to it and of the one before), and ``conv_id, len``.

    With ``rebuilt``, conversation c begins with the first h turns of conversation c - c % 20 in
    place of its own, where h is the checksum of its number modulo 4."""
    turns = written(ordered_turns(conversations, seed), "trie-turns")
    shares = written(turns.groupBy("conv_id", "part").agg(F.count("*").alias("n")), "trie-shares")
    carried = written(_carried(turns, shares, seed), "trie-carried")
    none = F.lit(0).cast("long")
    turns = _whole(
        turns.join(carried, ["conv_id", "part"], "left").select(
            "conv_id", "idx", "a", "b", "words", "s0", "s1", *(F.coalesce(c, none).alias(c) for c in ("before", "t0", "t1"))
        ),
        seed,
    )
    size = shares.groupBy("conv_id").agg(F.sum("n").alias("n"))
    if not rebuilt:
        shape = size.select("conv_id", *(none.alias(c) for c in ("h", "k", "q0", "q1", "g0", "g1")), F.col("n").alias("len"))
        heads = None
    else:
        turns = written(turns, "trie-whole-turns")
        size = written(
            size.withColumn("base", F.expr("conv_id - conv_id % 20")).withColumn(
                "h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
            ),
            "trie-sizes",
        )
        first = written(turns.where(F.col("idx") < HEAD), "trie-heads")
        from_base = size.select("conv_id", "base", "h").join(
            first.withColumnRenamed("conv_id", "base"), "base"
        ).where("idx < h")
        # Turns taken over and their digest; digest of the own turns they replace.
        taken = from_base.groupBy("conv_id").agg(
            F.count("*").alias("k"), F.max_by("s0", "idx").alias("g0"), F.max_by("s1", "idx").alias("g1")
        )
        dropped = size.join(first, "conv_id").where("idx < h").groupBy("conv_id").agg(
            F.max_by("s0", "idx").alias("q0"), F.max_by("s1", "idx").alias("q1")
        )
        shape = size.join(taken, "conv_id", "left").join(dropped, "conv_id", "left").select(
            "conv_id", "h", *(F.coalesce(c, none).alias(c) for c in ("k", "q0", "q1", "g0", "g1")), "n"
        )
        shape = shape.withColumn("len", F.col("k") + F.greatest(F.col("n") - F.col("h"), none)).drop("n")
        shape = written(shape, "trie-shapes")
        heads = from_base.join(shape.select("conv_id", "len"), "conv_id").select(
            "conv_id", "idx", "a", "b", "words", "s0", "s1", *(none.alias(c) for c in ("h", "k", "q0", "q1", "g0", "g1")), "len"
        )
    rows = turns.join(shape, "conv_id").where("idx >= h")
    rows = rows if heads is None else rows.unionByName(heads)
    own = bases(seed)

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for r in batches:
            shift = (r["k"] - r["h"]).to_numpy(np.int64)
            place = r["idx"].to_numpy(np.int64) + shift
            out = {"conv_id": r["conv_id"], "depth": place + 1}
            a, b = _unsigned(r["a"]), _unsigned(r["b"])
            for lane, base in enumerate(own):
                rest = (_unsigned(r[f"s{lane}"]) - _unsigned(r[f"q{lane}"])) * power(base, shift)
                whole = _unsigned(r[f"g{lane}"]) + rest
                out[f"d{lane}"] = _signed(whole)
                out[f"p{lane}"] = _signed(whole - lane_of(a, b, lane) * power(base, place))
            yield pd.DataFrame(out | {"a": r["a"], "b": r["b"], "words": r["words"], "len": r["len"]})

    schema = "conv_id long, depth long, d0 long, d1 long, p0 long, p1 long, a long, b long, words long, len long"
    return written(rows.mapInPandas(digest, schema), "trie-members"), shape.select("conv_id", "len")


# --- counts over subtrees -----------------------------------------------------------------


class NodeTable:
    """A minimal perfect hash of distinct pairs of 64-bit digests: in rounds, keys that are alone
    in their cell of a bit table take it, the others go on to the next; a key's slot is the
    number of taken cells before its own. Slots keep their digests, so that a lookup of a
    stranger, which has some slot too, is told apart."""

    def __init__(self, d0: np.ndarray, d1: np.ndarray):
        self.d0, self.d1 = np.empty_like(d0), np.empty_like(d1)
        self.rounds: list[np.ndarray] = []
        left, taken = np.arange(len(d0)), 0
        while len(left):
            cells = 2 * len(left)
            cell = self._cell(d0[left], d1[left], len(self.rounds), cells)
            alone = np.bincount(cell, minlength=cells) == 1
            # Slot of each taken cell, -1 elsewhere.
            self.rounds.append(np.where(alone, np.cumsum(alone) - 1 + taken, -1))
            taken += int(alone.sum())
            mine = self.rounds[-1][cell]
            won = left[mine >= 0]
            self.d0[mine[mine >= 0]], self.d1[mine[mine >= 0]] = d0[won], d1[won]
            left = left[mine < 0]
            if len(self.rounds) > 200:
                raise ValueError("digests repeat")

    @staticmethod
    def _cell(d0: np.ndarray, d1: np.ndarray, turn: int, cells: int) -> np.ndarray:
        salt = U((0x9E3779B97F4A7C15 * (turn + 1)) % (1 << 64))
        return (mixed(d0 ^ mixed(d1 + salt)) % U(cells)).astype(np.int64)

    def slots(self, d0: np.ndarray, d1: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 for one that is not in the table."""
        out = np.full(len(d0), -1)
        left = np.arange(len(d0))
        for turn, slot in enumerate(self.rounds):
            got = slot[self._cell(d0[left], d1[left], turn, len(slot))]
            out[left[got >= 0]] = got[got >= 0]
            left = left[got < 0]
        known = out >= 0
        known[known] = (self.d0[out[known]] == d0[known]) & (self.d1[out[known]] == d1[known])
        return np.where(known, out, -1)


SUMS = ("n_children", "n_leaves", "saved_tokens")
NODE = "d0 long, d1 long, depth long, p0 long, p1 long, conv_id long, parent_conv_id long, n_convs long"


def accumulated(nodes: pd.DataFrame) -> pd.DataFrame:
    """Subtree sums of the nodes of a shard. ``more_*`` are what children elsewhere add."""
    depth = nodes["depth"].to_numpy(np.int64)
    # Depth is part of a node's name, of the table's key too.
    key = lambda d0, d1, at: (_unsigned(d0), _unsigned(d1) + at.astype(np.uint64) * U(0xD6E8FEB86659FD93))
    own = key(nodes["d0"], nodes["d1"], depth)
    made = NodeTable(*own)
    slot = made.slots(*own)
    parent = made.slots(*key(nodes["p0"], nodes["p1"], depth - 1))
    parent[depth == 0] = -1
    size = len(nodes)

    def scattered(values) -> np.ndarray:
        out = np.empty(size, np.int64)
        out[slot] = values
        return out

    up, level, conv = scattered(parent), scattered(depth), scattered(nodes["conv_id"])
    children, leaves, saved = (scattered(nodes[f"more_{c}"]) for c in SUMS)
    saved += scattered((nodes["n_convs"] - 1) * nodes["words"])
    children += np.bincount(up[up >= 0], minlength=size)
    leaves[children == 0] = 1
    order = np.argsort(-level, kind="stable")
    for line in np.split(order, np.flatnonzero(np.diff(level[order])) + 1):
        inner = line[up[line] >= 0]
        np.add.at(leaves, up[inner], leaves[inner])
        np.add.at(saved, up[inner], saved[inner])
    out = nodes[["d0", "d1", "depth", "p0", "p1", "conv_id"]].copy()
    out["parent_conv_id"] = pd.array(np.where(parent >= 0, conv[parent], 0), "Int64")
    out.loc[parent < 0, "parent_conv_id"] = pd.NA
    out["n_convs"] = nodes["n_convs"]
    out["n_children"], out["n_leaves"], out["saved_tokens"] = children[slot], leaves[slot], saved[slot]
    return out


def _shard(nodes: DataFrame, by: Column) -> DataFrame:
    out = f"{NODE}, n_children long, n_leaves long, saved_tokens long"
    return nodes.withColumn("_shard", by).groupBy("_shard").applyInPandas(lambda rows: accumulated(rows), out)


def _tops(done: DataFrame) -> DataFrame:
    """What the tops among ``done`` add to their parents, by parent."""
    return done.where("parent_conv_id is null and depth > 0").groupBy(
        F.col("p0").alias("d0"), F.col("p1").alias("d1"), (F.col("depth") - 1).alias("depth")
    ).agg(
        F.count("*").alias("more_n_children"),
        F.sum("n_leaves").alias("more_n_leaves"),
        F.sum("saved_tokens").alias("more_saved_tokens"),
    )


def subtree_counts(nodes: DataFrame, members: DataFrame, shard: int, band: int) -> DataFrame:
    """``nodes`` with ``parent_conv_id, n_children, n_leaves, saved_tokens``."""
    name, none = ["d0", "d1", "depth"], F.lit(0).cast("long")
    empty = [none.alias(f"more_{c}") for c in SUMS]
    heavy = written(nodes.where(F.col("bound") > shard), "trie-heavy")
    light = nodes.where(F.col("bound") <= shard)
    # The top of a node's subtree: on the way of any member, here the node's own first, the
    # prefix one longer than the longest heavy one.
    reach = members.join(heavy.select(*name), name, "left_semi").groupBy("conv_id").agg(F.max("depth").alias("_h"))
    roots_heavy = not heavy.where("depth = 0").isEmpty()
    owners = light.select("conv_id").distinct()
    if roots_heavy:
        reach = owners.join(reach, "conv_id", "left").select("conv_id", (F.coalesce("_h", none) + 1).alias("depth"))
        tops = members.join(reach, ["conv_id", "depth"]).select("conv_id", F.xxhash64("d0", "d1").alias("_top"))
    else:
        tops = owners.select("conv_id", none.alias("_top"))
    shards = max(1, -(-nodes.count() // shard))
    done = written(
        _shard(light.select("*", *empty).join(tops, "conv_id"), F.pmod("_top", F.lit(shards))), "trie-light"
    )
    tables, more = [done], _tops(done)
    deepest = heavy.agg(F.max("depth")).first()[0]
    for b in range(-1 if deepest is None else deepest // band, -1, -1):
        here = heavy.where((F.col("depth") >= b * band) & (F.col("depth") < (b + 1) * band))
        here = here.join(more, name, "left").select(*heavy.columns, *(F.coalesce(f"more_{c}", none).alias(f"more_{c}") for c in SUMS))
        tables.append(written(_shard(here, F.lit(b)), "trie-heavy-done"))
        # Tops of light subtrees may hang on any band, tops of this band on the next only.
        more = _tops(done).unionByName(_tops(tables[-1])).groupBy(*name).agg(*(F.sum(f"more_{c}").alias(f"more_{c}") for c in SUMS))
    every = tables[0]
    for other in tables[1:]:
        every = every.unionByName(other)
    above = heavy.select(F.col("d0").alias("p0"), F.col("d1").alias("p1"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("_above"))
    return every.join(above, ["p0", "p1", "depth"], "left").select(
        *name, "conv_id", F.coalesce("parent_conv_id", "_above").alias("parent_conv_id"), "n_convs", *SUMS
    )


# --- lists of ends ------------------------------------------------------------------------


def end_digests(ends: DataFrame) -> DataFrame:
    """``d0, d1, depth, ends_sha256`` of the sorted, comma-joined ``conv_id`` of each node.

    The ids are sorted by ranges. A task hashes the lists that it holds whole and that fit one
    block of text; long lists, and its first and last, which may go on in other tasks, leave it as
    blocks in order, which one task then hashes one by one."""
    name = ["d0", "d1", "depth"]
    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = [*name, "part", "number", "block", "digest"]

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        rows, text, size, number, lists, now = [], [], 0, 0, 0, None
        for batch in batches:
            for *node, conv in zip(*(batch[c].tolist() for c in (*name, "conv_id"))):
                if node != now:
                    if now is not None:
                        joined = ",".join(text)
                        if lists > 1 and number == 0:
                            rows.append((*now, part, 0, None, hashlib.sha256(joined.encode()).hexdigest()))
                        else:
                            rows.append((*now, part, number, joined, None))
                    now, lists, text, size, number = node, lists + 1, [], 0, 0
                elif size >= CHUNK:
                    rows.append((*now, part, number, ",".join(text), None))
                    text, size, number = [], 0, number + 1
                text.append(str(conv))
                size += len(text[-1]) + 1
                if len(rows) >= CHUNK:
                    yield pd.DataFrame(rows, columns=columns)
                    rows = []
        if now is not None:
            yield pd.DataFrame([*rows, (*now, part, number, ",".join(text), None)], columns=columns)

    def joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state = None, None
        for batch in batches:
            rows = []
            for *node, block in zip(*(batch[c].tolist() for c in (*name, "block"))):
                if node != now:
                    if now is not None:
                        rows.append((*now, state.hexdigest()))
                    now, state = node, hashlib.sha256(block.encode())
                else:
                    state.update(b"," + block.encode())
            yield pd.DataFrame(rows, columns=[*name, "ends_sha256"])
        if now is not None:
            yield pd.DataFrame([(*now, state.hexdigest())], columns=[*name, "ends_sha256"])

    keys = (*name, "conv_id")
    kinds = "d0 long, d1 long, depth long"
    found = written(
        ends.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
        .mapInPandas(blocks, f"{kinds}, part int, number long, block string, digest string"),
        "trie-ends",
    )
    long = found.where("digest is null").repartition(*name).sortWithinPartitions(*name, "part", "number")
    return found.where("digest is not null").select(*name, F.col("digest").alias("ends_sha256")).unionByName(
        long.select(*name, "block").mapInPandas(joined, f"{kinds}, ends_sha256 string")
    )


# --- the trie -----------------------------------------------------------------------------


def _nodes(members: DataFrame, lengths: DataFrame) -> DataFrame:
    """A row for each distinct prefix; ``odd`` where its members disagree. ``bound`` is at least
    the number of nodes in its subtree."""
    name = ["d0", "d1", "depth"]
    same = ("p0", "p1", "a", "b")
    nodes = members.groupBy(*name).agg(
        F.count("*").alias("n_convs"),
        F.min("conv_id").alias("conv_id"),
        F.max("words").alias("words"),
        (F.sum(F.col("len") - F.col("depth")) + 1).alias("bound"),
        *(F.min(c).alias(c) for c in same),
        *(F.max(c).alias(f"{c}_max") for c in same),
    )
    odd = F.lit(False)
    for c in same:
        odd = odd | (F.col(c) != F.col(f"{c}_max"))
    kept = ("p0", "p1", "conv_id", "n_convs", "words", "bound")
    none = F.lit(0).cast("long")
    root = lengths.agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), (F.sum("len") + 1).alias("bound")
    ).where("n_convs > 0")
    root = root.select(
        *(none.alias(c) for c in (*name, "p0", "p1")), "conv_id", "n_convs", none.alias("words"), "bound", F.lit(False).alias("odd")
    )
    return nodes.select(*name, *kept, odd.alias("odd")).unionByName(root)


def trie(
    conversations: DataFrame, rebuilt: bool = False, shard: int = SHARD, band: int = BAND
) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256`` of each node; nodes go by their smallest member."""
    name = ["d0", "d1", "depth"]
    for seed in range(4):
        members, lengths = prefixes(conversations, rebuilt, seed)
        nodes = written(_nodes(members, lengths), "trie-nodes")
        if nodes.where("odd").isEmpty():
            break
    else:
        raise RuntimeError("digests of different prefixes keep colliding")
    nodes = nodes.drop("odd")
    counted = subtree_counts(nodes, members, shard, band)
    none = F.lit(0).cast("long")
    ends = members.where("depth = len").select(*name, "conv_id").unionByName(
        lengths.where("len = 0").select(*(none.alias(c) for c in name), "conv_id")
    )
    return counted.join(end_digests(ends), name, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", *SUMS,
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(table(spark, sf_dir, "conversations"), rebuilt=True)


# Prefixes as lists of turns, subtree sums over the nodes that members own.
OP12_SQL = f"""
WITH {CRC32_SQL.strip()},
turns AS (
  SELECT conv_id, row_number() OVER w - 1 AS idx, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')))),
convs AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, {crc32_sql("conv_id::VARCHAR")} % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM turns), crc_table),
parts AS (
  SELECT c.conv_id, 0 AS own, t.idx, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.idx < c.h
  UNION ALL
  SELECT c.conv_id, 1, t.idx, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.idx >= c.h),
rebuilt AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY own, idx) AS depth FROM parts),
lengths AS (SELECT conv_id, count(depth) AS len FROM convs LEFT JOIN rebuilt USING (conv_id) GROUP BY conv_id),
members AS (
  SELECT conv_id, depth, list((role, text)) OVER (PARTITION BY conv_id ORDER BY depth) AS prefix,
    len(regexp_extract_all(text, '[^ \t\n\x0B\f\r]+')) AS words
  FROM rebuilt
  UNION ALL SELECT conv_id, 0, [], 0 FROM convs),
nodes AS (
  SELECT prefix, depth, count(*) AS n_convs, min(conv_id) AS conv_id, max(words) AS words FROM members GROUP BY prefix, depth),
placed AS (
  SELECT m.conv_id AS member, n.depth, n.conv_id FROM members m JOIN nodes n ON n.prefix = m.prefix AND n.depth = m.depth),
parents AS (
  SELECT n.*, p.conv_id AS parent_conv_id FROM nodes n LEFT JOIN placed p ON p.member = n.conv_id AND p.depth = n.depth - 1),
children AS (SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM parents WHERE depth > 0 GROUP BY ALL),
counts AS (SELECT p.*, coalesce(n_children, 0) AS n_children FROM parents p LEFT JOIN children USING (conv_id, depth)),
sums AS (
  SELECT p.conv_id, p.depth, sum((n_children = 0)::BIGINT) AS n_leaves, sum((c.n_convs - 1) * c.words) AS saved_tokens
  FROM placed p JOIN counts c ON c.conv_id = p.member AND c.depth >= p.depth GROUP BY p.conv_id, p.depth),
ends AS (
  SELECT p.conv_id, p.depth, string_agg(l.conv_id::VARCHAR, ',' ORDER BY l.conv_id) AS ids
  FROM placed p JOIN lengths l ON l.conv_id = p.member AND l.len = p.depth GROUP BY p.conv_id, p.depth)
SELECT c.conv_id, c.depth, c.parent_conv_id, c.n_convs, c.n_children, s.n_leaves::BIGINT AS n_leaves,
  s.saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM counts c JOIN sums s USING (conv_id, depth) LEFT JOIN ends e USING (conv_id, depth)
"""
