"""Streaming jobs: incremental file landing, hourly accumulation, direct event loads.

All run with ``availableNow``: they take what has arrived since the last run, in
bounded batches, and stop. Progress lives in the checkpoint, so a rerun after a
failure repeats no row: file sinks commit per batch, and batch writers replace the
partition named after the batch (or file) they were writing.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.streaming.windows import WATERMARK, merged_stats, partial_stats, windowed_stats

LANDING_MODES = ("append", "replace", "fail")


def stream_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    glob: str = "*",
    fmt: str = "csv",
    max_files: int | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """New files of a directory as a stream.

    Without ``max_files`` an ``availableNow`` run takes all of them as one batch. Under a
    watermark that matters: files come in no order of event time, so a second batch would
    find its rows late and drop them. Cap the files only of streams without event time.
    """
    reader = spark.readStream.format(fmt).schema(schema).option("pathGlobFilter", glob)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.options(**dict(options or {})).load(path)


def ingest_files(
    spark: SparkSession,
    src: str,
    sink: str,
    checkpoint: str,
    schema: T.StructType | str,
    glob: str = "*",
    mode: str = "append",
    fmt: str = "csv",
    max_files: int = 1000,
    options: Mapping[str, str] | None = None,
) -> None:
    """Land new files matching ``glob`` in a parquet directory, each one once.

    ``append`` adds their rows. ``replace`` lets a file supersede what an earlier file
    of the same name landed; ``fail`` refuses it. The last two keep the rows of a file
    under ``source_file=<name>``.
    """
    if mode not in LANDING_MODES:
        raise ValueError(f"mode must be one of {LANDING_MODES}")
    files = stream_files(spark, src, schema, glob, fmt, max_files, options)
    if mode == "append":
        query = files.writeStream.format("parquet").option("path", sink).outputMode("append")
    else:
        named = files.withColumn("source_file", F.col("_metadata.file_name"))
        query = named.writeStream.foreachBatch(_land(sink, mode))
    query.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()\
        .awaitTermination()


def _land(sink: str, mode: str):
    def land(batch: DataFrame, batch_id: int) -> None:
        parts = ["source_file"]
        if mode == "fail":
            parts.append("batch_id")
            batch = batch.withColumn("batch_id", F.lit(batch_id))
            _refuse_known(batch, sink, batch_id)
        (
            batch.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*parts)
            .parquet(sink)
        )

    return land


def _exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(jvm_path)


def _refuse_known(batch: DataFrame, sink: str, batch_id: int) -> None:
    spark = batch.sparkSession
    if not _exists(spark, sink):
        return
    # Both columns are partition columns: file names are listed, no row is read.
    landed = (
        spark.read.parquet(sink)
        .where(F.col("batch_id") != batch_id)
        .select(F.col("source_file").cast("string").alias("source_file"))
        .distinct()
    )
    known = batch.select("source_file").distinct().join(landed, "source_file", "left_semi")
    first = known.orderBy("source_file").first()
    if first is not None:
        raise FileExistsError(f"{first[0]} has already been landed")


def windows_to_parquet(
    events: DataFrame,
    sink: str,
    checkpoint: str,
    ts: str,
    value: str,
    keys: tuple[str, ...] = (),
    size: str = "1 hour",
    slide: str | None = None,
    session_gap: str | None = None,
    watermark: str = WATERMARK,
) -> None:
    """Accumulate a stream per window (tumbling, sliding or session) and append closed ones to a
    parquet directory. Open windows are state: a later run takes them up from the checkpoint."""
    stats = windowed_stats(events, ts, value, keys, size, slide, session_gap, watermark)
    (
        stats.writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def hourly_to_parquet(
    events: DataFrame,
    sink: str,
    checkpoint: str,
    ts: str,
    value: str,
    keys: tuple[str, ...] = (),
    watermark: str = WATERMARK,
) -> None:
    """Closed hours of a stream."""
    windows_to_parquet(events, sink, checkpoint, ts, value, keys, watermark=watermark)


def accumulate_windows(
    events: DataFrame,
    sink: str,
    aside: str,
    checkpoint: str,
    ts: str,
    value: str,
    keys: tuple[str, ...] = (),
    size: str = "1 hour",
    lateness: str | None = None,
) -> None:
    """Partial sums per window and batch in ``sink``, for ``accumulated`` to merge, however late
    the rows of a window come. Rows without a time, and with ``lateness`` those further behind
    the newest of earlier batches, go to ``aside`` instead; no row is lost. A repeated batch
    replaces what it wrote."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, part = batch.sparkSession, f"batch_id={batch_id}"
        fine = F.col(ts).isNotNull()
        if lateness is not None and _exists(spark, sink):
            before = spark.read.parquet(sink).where(F.col("batch_id") < batch_id)
            newest = before.agg(F.max("last")).first()[0]
            if newest is not None:
                fine = fine & (F.col(ts) >= F.lit(newest) - F.expr(f"interval '{lateness}'"))
        batch.persist()
        try:
            batch.where(~fine).write.mode("overwrite").parquet(f"{aside}/{part}")
            sums = partial_stats(batch.where(fine), ts, value, keys, size)
            sums.write.mode("overwrite").parquet(f"{sink}/{part}")
        finally:
            batch.unpersist()

    (
        events.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def accumulated(spark: SparkSession, sink: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Windows so far, of all batches."""
    return merged_stats(spark.read.parquet(sink), keys)


def append_events(
    events: DataFrame,
    sink: str,
    checkpoint: str,
    alert: Column | None = None,
    alert_sink: str | None = None,
) -> None:
    """Load events as they are; those matching ``alert`` also go to ``alert_sink``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        part = f"batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(f"{sink}/{part}")
        if alert is not None and alert_sink is not None:
            # From what was just written, so that the source is read once.
            landed = batch.sparkSession.read.schema(batch.schema).parquet(f"{sink}/{part}")
            landed.where(alert).write.mode("overwrite").parquet(f"{alert_sink}/{part}")

    (
        events.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
