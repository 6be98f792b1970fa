"""Near-duplicate vectors by spherical-cap filters.

Filters are directions of a random product code: a random rotation, then the vector cut
into two blocks, each with a code of random unit directions; a pair of block directions is
one filter direction. A vector takes the ``PER_VECTOR`` directions nearest to it, which come
from the best few of each block. Each rotation with its codes shows a pair anew, so that misses
multiply: the chance that two vectors with a cosine of ``MIN_COSINE`` share a filter of one
rotation is measured on random pairs (it falls with the size of the code, and with the
dimensions), and as many rotations are taken as bring the misses below ``MISSED``. The code
grows with the number of vectors, so that unrelated ones share next to none, but no further
than a chance of one half, which few dimensions reach early.

Vectors are reduced to distinct ones first. A vector's first filter is its cell; filters are
joined as (filter, cell) pairs, so a cluster meets itself as a few cells rather than in each of its
filters. Cells are cut into blocks of about ``BLOCK`` vectors, each pair of blocks of cells that
share a filter is compared once, in one matrix product in double precision, and gives
counts and a forest of links rather than all pairs.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components link
with nothing and are their own component; vectors of different lengths never link; equal vectors
all link; rows that repeat an id link as any others; an empty table gives an empty result. A
null id takes part, but cannot name a component. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.common import table, written
from tidemark.llm.components import connected

MIN_COSINE = 0.9
MISSED = 1e-6  # of the pairs with just that cosine
PER_VECTOR = 16  # filters of a vector in each rotation
DIRECTIONS = 256  # filter directions for each vector of the table
TRIED = 512  # pairs by which the chance of a shared filter is measured
BLOCK = 256
SEED = 20
# Stand-ins for null ids lie above all ids.
UNNAMED = 1 << 62


def _best(x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of the ``k`` greatest of each row, greatest first."""
    k = min(k, x.shape[1])
    at = np.argpartition(x, x.shape[1] - k, axis=1)[:, x.shape[1] - k :]
    value = np.take_along_axis(x, at, 1)
    order = np.argsort(-value, axis=1, kind="stable")
    return np.take_along_axis(at, order, 1), np.take_along_axis(value, order, 1)


class ProductCode:
    """One rotation and two block codes of ``each`` directions for vectors of ``dim``."""

    def __init__(self, dim: int, each: int, seed: int):
        rng = np.random.default_rng([SEED, dim, seed])
        self.rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
        self.cuts = np.array_split(np.arange(dim), min(2, dim))
        self.codes = []
        for cut in self.cuts:
            code = rng.standard_normal((each, len(cut)))
            code /= np.linalg.norm(code, axis=1, keepdims=True) * np.sqrt(len(self.cuts))
            self.codes.append(code)
        self.each = each

    def decode(self, unit: np.ndarray) -> np.ndarray:
        """For each row its filters, the best first."""
        step = max(1, (1 << 21) // self.each)
        return np.concatenate([self._decode(unit[i : i + step]) for i in range(0, len(unit), step)])

    def _decode(self, unit: np.ndarray) -> np.ndarray:
        turned = unit @ self.rotation
        parts = [turned[:, cut] @ code.T for cut, code in zip(self.cuts, self.codes)]
        i, x = _best(parts[0], PER_VECTOR)
        j, y = _best(parts[1] if len(parts) > 1 else np.zeros((len(unit), 1)), PER_VECTOR)
        # A sum with p greater ones before it in x and q in y has at least (p + 1)(q + 1) - 1 before it.
        p, q = np.nonzero(np.outer(np.arange(1, i.shape[1] + 1), np.arange(1, j.shape[1] + 1)) <= PER_VECTOR)
        at = _best(x[:, p] + y[:, q], PER_VECTOR)[0]
        return np.take_along_axis(i[:, p] * self.each + j[:, q], at, 1)


def _chance(code: ProductCode, dim: int) -> float:
    """A low estimate of the chance that a pair with MIN_COSINE shares a filter of ``code``."""
    rng = np.random.default_rng([SEED, dim])
    one, two = _unit(rng.standard_normal((TRIED, dim))), rng.standard_normal((TRIED, dim))
    two = _unit(two - (two * one).sum(axis=1, keepdims=True) * one)
    two = MIN_COSINE * one + np.sqrt(1 - MIN_COSINE**2) * two
    met = [np.isin(a, b).any() for a, b in zip(code.decode(one), code.decode(two))]
    share = min(np.mean(met), 1 - 1 / TRIED)
    return share - 2.5 * np.sqrt(share * (1 - share) / TRIED)


@lru_cache(maxsize=4)
def product_codes(dim: int, n: int) -> list[ProductCode]:
    """The codes for ``n`` vectors of ``dim``; the same in every process."""
    each = int(np.ceil(np.sqrt(max(1024, DIRECTIONS * n))))
    if dim == 1:  # two directions, and no pair between
        return [ProductCode(dim, each, 0)]
    while (chance := _chance(ProductCode(dim, each, 0), dim)) < 0.5 and each > 4:
        each = max(4, each // 2)
    return [ProductCode(dim, each, r) for r in range(int(np.ceil(np.log(MISSED) / np.log(1 - chance))))]


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64)
    # Scaled first, so that squares neither overflow nor vanish.
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def filters(distinct: DataFrame, n: int) -> DataFrame:
    """``id, dim, cell, filters`` for ``id, vec``."""

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            dims = batch["vec"].map(len)
            for dim, rows in batch.groupby(dims):
                unit = _unit(np.stack(rows["vec"].to_numpy()))
                found = [code.decode(unit) + code.each**2 * r for r, code in enumerate(product_codes(dim, n))]
                yield pd.DataFrame(
                    {
                        "id": rows["id"].to_numpy(),
                        "dim": np.int32(dim),
                        "cell": found[0][:, 0],
                        "filters": list(np.concatenate(found, axis=1)),
                    }
                )

    return distinct.select("id", "vec").mapInPandas(decode, "id long, dim int, cell long, filters array<long>")


def _forest(close: np.ndarray) -> np.ndarray:
    """Least index reachable from each row of a symmetric boolean matrix."""
    label = np.arange(len(close))
    while True:
        least = np.where(close, label[None, :], len(close)).min(axis=1)
        new = np.minimum(label, least)
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def _compare_single(pairs: pd.DataFrame, kind: str) -> Iterator[pd.DataFrame]:
    """As ``_compare``, for pairs of blocks of one vector each, all at once."""
    lengths = pairs["vecs"].map(lambda v: len(v[0]))
    for _, rows in pairs.groupby(lengths):
        sides = []
        for k in ("", "2"):
            raw = b"".join(v[0] for v in rows["vecs" + k])
            ids, copies = (np.array([v[0] for v in rows[c + k]], np.int64) for c in ("ids", "copies"))
            sides.append((_unit(np.frombuffer(raw, kind).reshape(len(rows), -1)), ids, copies))
        (u, a, n), (v, b, m) = sides
        close = np.einsum("ij,ij->i", u, v) >= MIN_COSINE
        a, b, n, m = a[close], b[close], n[close], m[close]
        root = np.minimum(a, b)
        yield pd.DataFrame({"id": np.r_[a, b], "root": np.r_[root, root], "n": np.r_[m, n]})


def _compare(batches: Iterator[pd.DataFrame], kind: str) -> Iterator[pd.DataFrame]:
    """Counts of links and a forest for each pair of blocks."""
    for batch in batches:
        single = ~batch["same"] & (batch["ids"].map(len) == 1) & (batch["ids2"].map(len) == 1)
        out = list(_compare_single(batch[single], kind))
        batch = batch[~single]
        for row in batch.itertuples(index=False):
            ids, copies, vecs = list(row.ids), list(row.copies), list(row.vecs)
            left = len(ids)
            if not row.same:
                ids, copies = ids + list(row.ids2), copies + list(row.copies2)
                vecs = vecs + list(row.vecs2)
            ids, copies = np.array(ids, np.int64), np.array(copies, np.int64)
            unit = _unit(np.stack([np.frombuffer(v, kind) for v in vecs]))
            close = unit @ unit.T >= MIN_COSINE
            np.fill_diagonal(close, False)
            if not row.same:
                # Each block against itself has a pair of its own.
                close[:left, :left] = close[left:, left:] = False
            if not close.any():
                continue
            order = np.argsort(ids, kind="stable")
            root = np.empty(len(ids), np.int64)
            root[order] = ids[order][_forest(close[np.ix_(order, order)])]
            linked = close.any(axis=1)
            out.append(
                pd.DataFrame({"id": ids[linked], "root": root[linked], "n": (close @ copies)[linked]})
            )
        yield pd.concat(out) if out else pd.DataFrame({"id": [], "root": [], "n": []}).astype("int64")


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vec_id, embedding``."""
    given = vectors.select("vec_id", "embedding")
    kind = given.schema["embedding"].dataType.elementType.simpleString()
    number = {"float": "<f4"}.get(kind, "<f8")
    limit = F.lit(float("inf"))
    fine = (
        (F.size("embedding") > 0)
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit))
        & F.exists("embedding", lambda x: x != 0)
    )
    usable = given.where(F.coalesce(fine, F.lit(False)))
    distinct = written(
        usable.groupBy(F.col("embedding").alias("vec")).agg(
            F.min("vec_id").alias("least"), F.count("*").alias("copies")
        ).withColumn("id", F.coalesce("least", F.lit(UNNAMED).bitwiseOR(F.shiftrightunsigned(F.xxhash64("vec"), 2)))),
        "vectors",
    )
    decoded = written(filters(distinct, distinct.count()), "vector-filters")
    met = decoded.select("dim", "cell", F.explode("filters").alias("filter")).distinct()
    met = written(met, "filter-cells")
    shared = written(met.groupBy("dim", "filter").count().where("count > 1").select("dim", "filter"), "filters")
    met = met.join(shared, ["dim", "filter"])
    one, two = met.alias("x"), met.alias("y")
    pairs = (
        one.join(two, ["dim", "filter"])
        .where("x.cell < y.cell")
        .select("dim", F.col("x.cell").alias("c1"), F.col("y.cell").alias("c2"))
        .distinct()
    )
    sizes = decoded.groupBy("dim", "cell").agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    blocks = written(
        decoded.select("id", "dim", "cell")
        .join(sizes, ["dim", "cell"])
        .join(distinct.select("id", "vec", "copies"), "id")
        .withColumn("block", F.pmod(F.xxhash64("id"), F.col("parts")))
        .withColumn("raw", _raw(number)(F.col("vec")))
        .groupBy("dim", "cell", "block")
        .agg(*(F.collect_list(c).alias(o) for c, o in (("id", "ids"), ("copies", "copies"), ("raw", "vecs")))),
        "vector-blocks",
    )
    left = blocks.select("dim", F.col("cell").alias("c1"), "block", "ids", "copies", "vecs")
    right = blocks.select(
        "dim", F.col("cell").alias("c2"), F.col("block").alias("block2"),
        F.col("ids").alias("ids2"), F.col("copies").alias("copies2"), F.col("vecs").alias("vecs2"),
    )
    across = pairs.join(left, ["dim", "c1"]).join(right, ["dim", "c2"])
    within = left.join(right.withColumnRenamed("dim", "_dim"), (F.col("dim") == F.col("_dim")) & (F.col("c1") == F.col("c2")))
    # Of a cell's own blocks each unordered pair once, and each block with itself.
    within = within.where("block <= block2").where("block < block2 or size(ids) > 1")
    work = across.withColumn("same", F.lit(False)).select(
        "ids", "copies", "vecs", "ids2", "copies2", "vecs2", "same"
    ).unionByName(
        within.select("ids", "copies", "vecs", "ids2", "copies2", "vecs2", (F.col("block") == F.col("block2")).alias("same"))
    )
    found = written(
        work.mapInPandas(lambda it: _compare(it, number), "id long, root long, n long"), "vector-links"
    )
    near = found.groupBy("id").agg(F.sum("n").alias("n_other"))
    roots = connected(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    known = (
        distinct.join(near, "id", "left")
        .join(roots, "id", "left")
        .select(
            "vec",
            (F.coalesce("n_other", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("root", "id").alias("component"),
        )
    )
    known = written(known, "vector-classes")
    joined = given.join(known, given["embedding"] == known["vec"], "left")
    component = F.when(F.col("component") < UNNAMED, F.col("component"))
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce(component, F.col("vec_id")).alias("component_id"),
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _raw(number: str):
    @F.pandas_udf("binary")
    def raw(vecs: pd.Series) -> pd.Series:
        return vecs.map(lambda v: np.asarray(v, number).tobytes())

    return raw


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
