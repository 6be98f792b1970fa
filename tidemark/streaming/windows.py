"""Event-time aggregation: one function for batch and stream input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import ratio

WATERMARK = "10 minutes"


def windowed_stats(
    df: DataFrame,
    ts: str,
    value: str,
    keys: Sequence[str] = (),
    size: str = "1 hour",
    slide: str | None = None,
    session_gap: str | None = None,
    watermark: str = WATERMARK,
) -> DataFrame:
    """Count, total and mean of ``value`` per window (and key).

    Tumbling by default, sliding with ``slide``, sessions with ``session_gap``. On a
    stream, rows later than the watermark are dropped and, in append mode, a window
    is emitted once the watermark has passed its end; sessions of a stream need a key.
    ``jobs.accumulate_windows`` drops no late row. Values are summed as exact
    two-digit amounts, so the arrival order does not matter.
    """
    if session_gap is not None and not df.isStreaming:
        return _sessions(df, ts, value, keys, session_gap)
    if df.isStreaming:
        df = df.withWatermark(ts, watermark)
    window = F.session_window(ts, session_gap) if session_gap else F.window(ts, size, slide)
    stats = df.groupBy(window.alias("w"), *keys).agg(*_partial(value))
    return _finished(stats, F.col("w.start"), F.col("w.end"), keys)


def partial_stats(df: DataFrame, ts: str, value: str, keys: Sequence[str], size: str) -> DataFrame:
    """Sums of a window that can be merged with later ones, and the newest time in them."""
    return df.groupBy(F.window(ts, size).alias("w"), *keys).agg(*_partial(value), F.max(ts).alias("last"))


def merged_stats(partials: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Windows of partial sums of any number of batches."""
    sums = partials.groupBy("w", *keys).agg(*(F.sum(c).alias(c) for c in ("events", "_total", "_n")))
    return _finished(sums, F.col("w.start"), F.col("w.end"), keys)


def _partial(value: str) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("events"),
        F.sum(F.col(value).cast("decimal(18,2)")).alias("_total"),
        F.count(value).alias("_n"),
    ]


def _finished(stats: DataFrame, start: Column, end: Column, keys: Sequence[str]) -> DataFrame:
    return stats.select(
        start.alias("window_start"),
        end.alias("window_end"),
        *keys,
        "events",
        F.col("_total").cast("double").alias("total"),
        ratio(F.col("_total"), F.col("_n")).alias("mean"),
    )


def _sessions(
    df: DataFrame, ts: str, value: str, keys: Sequence[str], gap: str
) -> DataFrame:
    """Sessions of a batch, summed before the shuffle.

    Rows of one gap-wide cell always share a session. Cells are summed map-side, so a
    key sends at most one row per cell and task however busy it is, and only the cells
    are put in order.
    """
    cells = df.where(F.col(ts).isNotNull()).groupBy(*keys, F.window(ts, gap).alias("cell")).agg(
        F.min(ts).alias("first"), F.max(ts).alias("last"), *_partial(value)
    )
    in_order = Window.partitionBy(*keys).orderBy("cell.start")
    idle = F.col("first") > F.lag("last").over(in_order) + F.expr(f"interval '{gap}'")
    marked = cells.withColumn("_new", F.when(idle, 1).otherwise(0))
    sessions = (
        marked.withColumn("_session", F.sum("_new").over(in_order))
        .groupBy(*keys, "_session")
        .agg(
            F.min("first").alias("first"),
            F.max("last").alias("last"),
            F.sum("events").alias("events"),
            F.sum("_total").alias("_total"),
            F.sum("_n").alias("_n"),
        )
    )
    return _finished(sessions, F.col("first"), F.col("last") + F.expr(f"interval '{gap}'"), keys)
