"""Shards along a Hilbert curve over several metadata dimensions.

Language, source, size and position (``doc_id``) are quantised to 32 cells each; the index of
a row's cell on the Hilbert curve is its main sort key, so rows that are close in all
dimensions share a shard and a filter on any of them skips most shards. Within a cell rows
go by checksum and id, which puts equal texts of a cell side by side.

The law is ``rows``: the sorted rows are cut into runs whose counts differ by at most one.
The order is made by range partitioning on a key that ends in the unique id, so a hot cell is
split; the rank of a row is its place in its partition plus the rows of the partitions before,
of which there is one number for each partition. Texts do not take part in the sort.

Defined cases: a null text weighs 16 bytes and has the checksum of the empty text; a null
language, source or id has cell 0; rows repeated in full are ranked each; an empty table gives
an empty result; fewer rows than shards leave shards empty. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from tidemark.llm.common import table, text_or_empty, written
from tidemark.session import scratch_path

SHARDS = 40
BITS = 5
DIMENSIONS = ("lang", "source", "size", "position")


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Index on the Hilbert curve of each row of ``cells`` (rows x dimensions, each below
    ``2**bits``): the curve's Gray code is undone from the highest bit down, exchanging or
    inverting the lower bits of the axes on the way."""
    x = cells.astype(np.uint64).T.copy()
    n = len(x)
    one = np.uint64(1)
    for bit in range(bits - 1, 0, -1):
        high, low = np.uint64(1 << bit), np.uint64((1 << bit) - 1)
        for axis in range(n):
            on = (x[axis] & high) != 0
            swap = np.where(on, np.uint64(0), (x[0] ^ x[axis]) & low)
            x[0] ^= np.where(on, low, swap)
            x[axis] ^= swap
    for axis in range(1, n):
        x[axis] ^= x[axis - 1]
    turn = np.zeros(x.shape[1], np.uint64)
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where((x[n - 1] & np.uint64(1 << bit)) != 0, np.uint64((1 << bit) - 1), np.uint64(0))
    x ^= turn
    out = np.zeros(x.shape[1], np.uint64)
    for bit in range(bits - 1, -1, -1):
        for axis in range(n):
            out = (out << one) | ((x[axis] >> np.uint64(bit)) & one)
    return out.astype(np.int64)


def curve_key(cells: Column, bits: int = BITS) -> Column:
    """Hilbert index of an array column of cells."""

    @F.pandas_udf("long")
    def index(rows: pd.Series) -> pd.Series:
        if not len(rows):
            return pd.Series([], dtype="int64")
        return pd.Series(hilbert_index(np.stack(rows.to_numpy()), bits))

    return index(cells)


def quantised(docs: DataFrame) -> DataFrame:
    """``doc_id, size, text_crc32`` and ``_cells``. Names hash to a cell, sizes go by their
    logarithm, ids by their place between the least and the largest."""
    top = (1 << BITS) - 1
    named = lambda c: F.when(F.col(c).isNull(), 0).otherwise(
        F.pmod(F.xxhash64(F.col(c).cast("string")), F.lit(top)) + 1
    )
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    low, high = low or 0, high or 0
    place = F.floor((F.col("doc_id") - F.lit(low)) / F.lit(float(high - low + 1)) * (top + 1))
    rows = docs.select(
        "doc_id", "lang", "source",
        (F.octet_length(text_or_empty()) + 16).cast("long").alias("size"),
        F.crc32(text_or_empty().cast("binary")).alias("text_crc32"),
    )
    return rows.select(
        "doc_id", "size", "text_crc32",
        F.array(
            named("lang").cast("int"), named("source").cast("int"),
            F.least(F.lit(top), F.floor(2 * F.log2("size") - 8)).cast("int"),
            F.coalesce(F.least(F.lit(top), place), F.lit(0)).cast("int"),
        ).alias("_cells"),
    )


def assign(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``doc_id, size, text_crc32, curve, shard, slot``."""
    keyed = quantised(docs).withColumn("curve", curve_key(F.col("_cells"))).drop("_cells")
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = ("curve", "text_crc32", "doc_id")
    ordered = (
        keyed.repartitionByRange(parts, *keys)
        .sortWithinPartitions(*keys)
        # Partition number in the high bits, place within the partition in the low 33.
        .withColumn("_spot", F.monotonically_increasing_id())
    )
    ordered = written(ordered, "hilbert-order")
    part = F.shiftright("_spot", 33)
    # One row for each partition of the sort.
    before = (
        ordered.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
        .withColumn("_before", F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)))
        .select("_part", F.coalesce("_before", F.lit(0)).alias("_before"), F.sum("_n").over(W.partitionBy()).alias("_all"))
    )
    ranked = ordered.join(F.broadcast(before), part == F.col("_part")).withColumn(
        "_rank", F.col("_before") + F.col("_spot").bitwiseAND(F.lit((1 << 33) - 1))
    )
    # Shard s holds the ranks from ceil(s * all / shards) on.
    shard = F.expr(f"(_rank * {shards}) div _all")
    first = F.expr(f"(((_rank * {shards}) div _all) * _all + {shards - 1}) div {shards}")
    return ranked.select(
        "doc_id", "size", "text_crc32", "curve",
        shard.cast("int").alias("shard"), (F.col("_rank") - first).cast("long").alias("slot"),
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> DataFrame:
    """Write ``docs`` (with unique ids) under ``path/shard=N``, in slot order within each
    file, and return the assignment."""
    placed = written(assign(docs, shards), "hilbert-assignment")
    spots = placed.select(F.col("doc_id").alias("_id"), "shard", "slot")
    (
        docs.drop("shard", "slot").join(spots, F.col("doc_id").eqNullSafe(F.col("_id"))).drop("_id")
        .repartitionByRange(F.col("shard"), F.col("slot")).sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard").parquet(path)
    )
    return placed


def shard_path(spark: SparkSession) -> str:
    return scratch_path(spark, "shards")


def op7_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
