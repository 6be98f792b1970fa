"""A manifest of documents as a tree of hashes that can be folded from the middle.

A row's leaf is the digest of its fields. Leaves of a source stand in order of id; runs of
``ARITY`` neighbours become their parent, the digest of their digests as text, until one is
left, and the sources' own nodes are joined likewise, by name, into the root.

A digest as text fills one block of the hash, so a parent is a chain of states with a stop
before every child. These midstates are kept. To fold a changed child into its parent, the
state before its slot is resumed with the replacement and the siblings right of it only; what
stands left of it is in the state. The same way the digest of a proof is carried from level
to level as a state.

Leaves are placed by a sort over ranges, so a source may hold most rows. Trees are climbed in
blocks of ``LEVELS`` levels, each within one task and many at once in numpy: a task folds its own
leaves to the top of their block, and only tops, one for thousands of leaves, go on to the
next round, where a block's way up is one row of records that is joined to its leaves.

Defined cases: a null field is written as ``-``, so it differs from the empty text; a null
source is a source of its own, before the others; null ids come first; rows that repeat an id go by
their leaves, and copies in full are leaves each; an empty table gives an empty manifest. Only
the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm import sha256
from tidemark.llm.common import table, written
from tidemark.llm.ranks import ranked

ARITY = 3
LEVELS = 7
GROUP_BLOCKS = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

#: One level on the way up: children of the parent, own slot, state before it, the other children.
STEP = np.dtype([("size", "u1"), ("slot", "u1"), ("state", ">u4", 8), ("others", ">u4", (ARITY - 1, 8))])


def leaf(fields: dict[str, Column]) -> Column:
    """Digest of the fields in their order."""
    parts = []
    for value in fields.values():
        text = value.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _parents(
    active: np.ndarray, pos: np.ndarray, digests: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One level up for the nodes that are ``active``, in order of segment and ``pos``: the new
    node of each, the new nodes' digests, and a STEP for each old node. Others stay."""
    slot = np.where(active, pos % ARITY, 0)
    parent = np.cumsum(~active | (slot == 0)) - 1
    size = np.bincount(parent)
    children = np.zeros((ARITY, 8, len(size)), np.uint32)
    children[slot, :, parent] = digests.T
    states = [np.broadcast_to(sha256.START, (8, len(size))).copy()]
    for k in range(ARITY):
        state = states[-1].copy()
        have = np.flatnonzero(size > k)
        state[:, have] = sha256.resumed(state[:, have], sha256.hex_block(children[k][:, have]))
        states.append(state)
    made = sha256.closed(states[ARITY], size)
    first = np.flatnonzero(slot == 0)
    made = np.where(active[first], made, digests[:, first])
    steps = np.zeros(len(pos), STEP)
    steps["size"], steps["slot"] = size[parent], slot
    for k in range(ARITY):
        mine = slot == k
        steps["state"][mine] = states[k][:, parent[mine]].T
        others = [c for c in range(ARITY) if c != k]
        for place, c in enumerate(others):
            steps["others"][mine, place] = children[c][:, parent[mine]].T
    return parent, made, steps


def climb(pos: np.ndarray, levels: np.ndarray, digests: np.ndarray) -> Iterator[tuple]:
    """Levels of many trees at once. Rows are leaves in order of tree and ``pos`` from 0, and
    ``levels`` says how far the tree of each is climbed. For each level: rows that climb, and
    their STEPs; at the end None and the digest each row's tree has come to."""
    at = np.arange(len(pos))
    level = 0
    while (levels > level).any():
        parent, made, steps = _parents(levels > level, pos, digests)
        first = np.flatnonzero(np.r_[True, parent[1:] != parent[:-1]])
        climbs = (levels > level)[at]
        yield climbs, steps[at]
        pos = np.where(levels > level, pos // ARITY, pos)[first]
        levels, digests, at = levels[first], made, parent[at]
        level += 1
    yield None, digests[:, at]


def fold(digests: np.ndarray, proof: np.ndarray, blocks: np.ndarray, steps: np.ndarray) -> None:
    """Take children one level up in place, by their STEPs, and add their siblings to the proof."""
    slot, size = steps["slot"], steps["size"].astype(np.int64)
    # The matching state, the replacement, then right siblings only.
    state = sha256.resumed(steps["state"].T.astype(np.uint32), sha256.hex_block(digests))
    for k in range(ARITY - 1):
        other = steps["others"][:, k].T.astype(np.uint32)
        there = np.flatnonzero(k < size - 1)
        if len(there):
            block = sha256.hex_block(other[:, there])
            proof[:, there] = sha256.resumed(proof[:, there], block)
            right = k >= slot[there]
            state[:, there[right]] = sha256.resumed(state[:, there[right]], block[:, right])
    blocks += size - 1
    digests[:] = sha256.closed(state, size)


def _levels(n: np.ndarray) -> np.ndarray:
    """Levels of a tree of ``n`` leaves."""
    out = np.zeros(len(n), np.int64)
    while (n > 1).any():
        out += n > 1
        n = -(-n // ARITY)
    return out


def _blocks_of(rows: pd.DataFrame, levels: int) -> tuple[pd.DataFrame, np.ndarray, np.ndarray]:
    """Rows in order with their ``block``, their place in it and the levels to climb in it."""
    rows = rows.drop(columns="_group").sort_values(["tree", "pos"], ignore_index=True)
    pos = rows["pos"].to_numpy()
    rows["block"] = pos // ARITY**levels
    return rows, pos % ARITY**levels, np.minimum(_levels(rows["n"].to_numpy()), levels)


def _grouped(nodes: DataFrame, levels: int):
    """Whole blocks, about GROUP_BLOCKS to a group."""
    size = ARITY**levels
    groups = max(1, -(-nodes.count() // (GROUP_BLOCKS * size)))
    block = F.expr(f"pos div {size}")
    return nodes.withColumn("_group", F.pmod(F.xxhash64("tree", block), F.lit(groups))).groupBy("_group")


def folded_blocks(leaves: DataFrame, block_levels: int = LEVELS) -> DataFrame:
    """Leaves (``tree, pos, n, id, leaf, changed``) with ``block``, its ``top``, the changed leaf
    ``folded`` up to it, and the ``proof`` so far as a state after ``blocks``."""

    def take(rows: pd.DataFrame) -> pd.DataFrame:
        rows, pos, levels = _blocks_of(rows, block_levels)
        given = sha256.from_bytes(list(map(bytes.fromhex, rows["leaf"])))
        now = sha256.from_bytes(list(map(bytes.fromhex, rows["changed"])))
        proof = np.broadcast_to(sha256.START, now.shape).copy()
        count = np.zeros(len(rows), np.int64)
        for climbs, steps in climb(pos, levels, given):
            if climbs is None:
                top = steps
                break
            part = np.flatnonzero(climbs)
            digests, state, blocks = now[:, part], proof[:, part], count[part]
            fold(digests, state, blocks, steps[part])
            now[:, part], proof[:, part], count[part] = digests, state, blocks
        rows["top"], rows["folded"] = sha256.to_bytes(top), sha256.to_bytes(now)
        rows["proof"], rows["blocks"] = sha256.to_bytes(proof), count
        return rows.drop(columns="changed")

    return _grouped(leaves, block_levels).applyInPandas(
        take,
        "tree string, id string, leaf string, n long, pos long, block long, top binary, "
        "folded binary, proof binary, blocks long",
    )


def _paths(nodes: DataFrame, block_levels: int) -> DataFrame:
    """Nodes (``tree, pos, n, top``) with the ``path`` to the top of their block."""

    def take(rows: pd.DataFrame) -> pd.DataFrame:
        rows, pos, levels = _blocks_of(rows, block_levels)
        paths = [b""] * len(rows)
        for climbs, steps in climb(pos, levels, sha256.from_bytes(list(rows["top"]))):
            if climbs is None:
                rows["top"] = sha256.to_bytes(steps)
                break
            for i in np.flatnonzero(climbs).tolist():
                paths[i] += steps[i].tobytes()
        rows["path"] = paths
        return rows

    return _grouped(nodes, block_levels).applyInPandas(
        take, "tree string, pos long, n long, top binary, path binary, block long"
    )


def _roots(nodes: DataFrame, levels: int) -> DataFrame:
    """``tree, pos, path, root``: the way of each node (``tree, pos, n, top``) up to the root of
    its tree, in as many rounds as there are blocks on it."""
    if nodes.where("n > 1").isEmpty():
        return nodes.select("tree", "pos", F.lit("").cast("binary").alias("path"), F.col("top").alias("root"))
    climbed = written(_paths(nodes, levels), "manifest-paths")
    rest = _roots(_tops(climbed, levels), levels).select(
        "tree", F.col("pos").alias("block"), F.col("path").alias("_further"), "root"
    )
    return climbed.join(rest, ["tree", "block"]).select(
        "tree", "pos", F.concat("path", "_further").alias("path"), "root"
    )


def _tops(climbed: DataFrame, levels: int) -> DataFrame:
    """The tops of blocks, as nodes of the next round."""
    size = ARITY**levels
    more = F.expr(f"(n + {size - 1}) div {size}")
    return climbed.where(f"pos % {size} = 0").select("tree", F.col("block").alias("pos"), more.alias("n"), "top")


def _finish(rows: pd.DataFrame) -> pd.DataFrame:
    """Fold the rows on, along their paths, and close their proofs."""
    now, proof = sha256.from_bytes(list(rows["folded"])), sha256.from_bytes(list(rows["proof"]))
    count = rows["blocks"].to_numpy().copy()
    depth = rows["path"].map(len).to_numpy() // STEP.itemsize
    for d in np.unique(depth[depth > 0]).tolist():
        part = np.flatnonzero(depth == d)
        steps = np.frombuffer(b"".join(rows["path"].iloc[part]), STEP).reshape(len(part), d)
        digests, state, blocks = now[:, part], proof[:, part], count[part]
        for level in range(d):
            fold(digests, state, blocks, steps[:, level])
        now[:, part], proof[:, part], count[part] = digests, state, blocks
    return pd.DataFrame(
        {
            "id": rows["id"],
            "leaf": rows["leaf"],
            "subroot": rows["_sub"].map(bytes.hex),
            "root": rows["_root"].map(bytes.hex),
            "folded_root": [d.hex() for d in sha256.to_bytes(now)],
            "proof_sha256": [d.hex() for d in sha256.to_bytes(sha256.closed(proof, count))],
        }
    )


def manifest(docs: DataFrame, changed: Column | None = None, levels: int = LEVELS) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root`` of each row of ``docs``, climbed in
    blocks of so many levels.

    ``changed`` is the leaf to fold in place of a row's own; where null, its own is folded."""
    # Null before every name, and the order of names kept.
    tree = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit(""))
    own = leaf({c: F.col(c) for c in FIELDS})
    new = F.lit(None) if changed is None else changed
    leaves = docs.select(tree.alias("tree"), "doc_id", own.alias("leaf"), new.alias("_new"))
    leaves = leaves.select("tree", "doc_id", "leaf", F.coalesce("_new", "leaf").alias("changed"))
    # As text, since whole numbers with nulls among them would pass through Python as floats.
    placed = ranked(leaves, "tree", "doc_id", "leaf").select(
        "tree", F.col("doc_id").cast("string").alias("id"), "leaf", "changed", "pos", "n"
    )
    folded = written(folded_blocks(placed, levels), "manifest-leaves")

    sources = written(_roots(_tops(folded, levels), levels), "manifest-sources")
    # The tree of sources, and the way of every block of leaves through it.
    names = sources.where("pos = 0").select(
        F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("root").alias("top")
    )
    names = written(ranked(names, "tree", "name"), "manifest-names")
    whole = _roots(names.select("tree", "pos", "n", "top"), levels).select(
        "pos", F.col("path").alias("_further"), F.col("root").alias("_root")
    )
    ways = sources.join(
        names.join(whole, "pos").select(F.col("name").alias("tree"), "_further", "_root"), "tree"
    ).select(
        "tree", F.col("pos").alias("block"), F.concat("path", "_further").alias("path"),
        F.col("root").alias("_sub"), "_root",
    )

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            if len(rows):
                yield _finish(rows)

    joined = folded.join(ways, ["tree", "block"]).select(
        "id", "leaf", "folded", "proof", "blocks", "path", "_sub", "_root"
    )
    done = joined.mapInPandas(
        finish, "id string, leaf string, subroot string, root string, folded_root string, proof_sha256 string"
    )
    kind = docs.schema["doc_id"].dataType
    return done.select(F.col("id").cast(kind).alias("doc_id"), *done.columns[1:])


def tampered_leaf() -> Column:
    """The leaf without the text's line breaks, where 2 divides the checksum of the id."""
    fields = {c: F.col(c) for c in FIELDS} | {"text": F.translate("text", "\n", "")}
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return F.when(tampered, leaf(fields))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str, levels: int = LEVELS) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"), tampered_leaf(), levels).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


# The trees by recursion over levels. The checksum is the public 32-bit one of zip files.
CRC32_SQL = """
crc_table AS (
  SELECT list(list_reduce([c, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b:
    CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY c) AS t
  FROM (SELECT unnest(range(256)) AS c))"""


def crc32_sql(text: str) -> str:
    """DuckDB for the unsigned checksum of ASCII text, where CRC32_SQL's table is joined."""
    return (
        f"xor(list_reduce(list_prepend(4294967295, list_transform(string_split({text}, ''), lambda c: ord(c)::BIGINT)), "
        "lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295)"
    )


def _field_sql(column: str) -> str:
    return f"coalesce(strlen(({column})::VARCHAR) || ':' || ({column})::VARCHAR, '-')"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(_field_sql(text if c == "text" else c) for c in FIELDS) + ")"


OP11_SQL = f"""
WITH RECURSIVE {CRC32_SQL.strip()},
leaves AS (
  SELECT doc_id, source, {_leaf_sql("text")} AS leaf,
    CASE WHEN {crc32_sql("doc_id::VARCHAR")} % 2 = 0 THEN {_leaf_sql("replace(text, chr(10), '')")} END AS changed
  FROM documents, crc_table),
placed AS (
  SELECT *, row_number() OVER w - 1 AS pos, count(*) OVER (PARTITION BY source) AS n
  FROM leaves WINDOW w AS (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf)),
nodes AS (
  SELECT source, 0 AS lvl, pos, n, leaf AS d FROM placed
  UNION ALL
  SELECT source, lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(d, '' ORDER BY pos))
  FROM nodes WHERE n > 1 GROUP BY source, lvl, pos // 3, n),
subroots AS (
  SELECT source, d AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
  FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS lvl, pos, n, subroot AS d FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(d, '' ORDER BY pos))
  FROM tops WHERE n > 1 GROUP BY lvl, pos // 3, n),
depths AS (SELECT source, max(lvl) AS depth FROM nodes GROUP BY source),
steps AS (
  SELECT t.source, t.lvl, t.pos, coalesce(string_agg(o.d, '' ORDER BY o.pos) FILTER (o.pos < t.pos), '') AS l,
    coalesce(string_agg(o.d, '' ORDER BY o.pos) FILTER (o.pos > t.pos), '') AS r
  FROM nodes t JOIN nodes o ON o.source IS NOT DISTINCT FROM t.source AND o.lvl = t.lvl AND o.pos // 3 = t.pos // 3
  WHERE t.n > 1 GROUP BY t.source, t.lvl, t.pos
  UNION ALL
  SELECT s.source, p.depth + t.lvl, s.pos // (3 ** t.lvl)::BIGINT, coalesce(string_agg(o.d, '' ORDER BY o.pos) FILTER (o.pos < t.pos), ''),
    coalesce(string_agg(o.d, '' ORDER BY o.pos) FILTER (o.pos > t.pos), '')
  FROM subroots s JOIN depths p ON p.source IS NOT DISTINCT FROM s.source
    JOIN tops t ON t.pos = s.pos // (3 ** t.lvl)::BIGINT AND t.n > 1 JOIN tops o ON o.lvl = t.lvl AND o.pos // 3 = t.pos // 3
  GROUP BY s.source, p.depth, s.pos, t.lvl, t.pos),
folds AS (
  SELECT p.doc_id, p.leaf, p.source, p.pos AS leaf_pos, 0 AS lvl, p.pos, d.depth, s.pos AS place,
    coalesce(p.changed, p.leaf) AS now, '' AS proof
  FROM placed p JOIN depths d ON d.source IS NOT DISTINCT FROM p.source JOIN subroots s ON s.source IS NOT DISTINCT FROM p.source
  UNION ALL
  SELECT f.doc_id, f.leaf, f.source, f.leaf_pos, f.lvl + 1,
    CASE WHEN f.lvl + 1 = f.depth THEN f.place ELSE f.pos // 3 END, f.depth, f.place,
    sha256(s.l || f.now || s.r), f.proof || s.l || s.r
  FROM (SELECT *, CASE WHEN lvl = depth THEN place ELSE pos END AS p FROM folds) f
    JOIN steps s ON s.source IS NOT DISTINCT FROM f.source AND s.lvl = f.lvl AND s.pos = f.p),
ends AS (SELECT * FROM folds QUALIFY row_number() OVER (PARTITION BY source, leaf_pos ORDER BY lvl DESC) = 1)
SELECT e.doc_id, e.leaf, s.subroot, t.d AS root, sha256(e.proof) AS proof_sha256, e.now AS folded_root, e.now = t.d AS verified
FROM ends e JOIN subroots s ON s.source IS NOT DISTINCT FROM e.source, (SELECT d FROM tops WHERE n = 1) t
"""
