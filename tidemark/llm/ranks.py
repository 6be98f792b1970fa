"""Places of rows within groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from tidemark.llm.common import written

_PLACE = (1 << 33) - 1


def ranked(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """``rows`` with ``pos`` (from 0, in ``order`` within ``group``) and ``n``, the group's rows.

    Rows are sorted by ranges of group and order, so a group that holds most of them is split;
    a last key of its own for each row splits repeated rows too. What crosses tasks is one row
    for each group in a range, and a window over a group sees at most one row a range."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = (group, *order, "_row")
    sorted_ = (
        rows.withColumn("_row", F.monotonically_increasing_id())
        .repartitionByRange(parts, *keys)
        .sortWithinPartitions(*keys)
        .drop("_row")
        # Range in the high bits, place within it in the low 33.
        .withColumn("_spot", F.monotonically_increasing_id())
    )
    sorted_ = written(sorted_, "ranked-rows").withColumn("_part", F.shiftright("_spot", 33))
    within = W.partitionBy(group)
    earlier = within.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    shares = (
        sorted_.groupBy(group, "_part")
        .agg(F.count("*").alias("_n"), F.min("_spot").alias("_first"))
        .select(
            group, "_part",
            (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first").bitwiseAND(F.lit(_PLACE))).alias("_shift"),
            F.sum("_n").over(within).alias("n"),
        )
    )
    place = F.col("_spot").bitwiseAND(F.lit(_PLACE)) + F.col("_shift")
    return sorted_.join(shares, [group, "_part"]).withColumn("pos", place).drop("_spot", "_part", "_shift")
