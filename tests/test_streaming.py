from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark import session
from tidemark.streaming import jobs
from tidemark.streaming.windows import windowed_stats

SCHEMA = "id int, ts timestamp, v double"


def _land(tmp_path, name, *rows):
    folder = tmp_path / "in"
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(f"{a},{b},{c}\n" for a, b, c in rows))


def _dirs(tmp_path):
    return str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "progress")


def test_files_are_landed_once(spark, tmp_path):
    src, sink, progress = _dirs(tmp_path)
    _land(tmp_path, "a.csv", (1, "2024-01-01 00:00:00", 1))
    _land(tmp_path, "skip.txt", (9, "2024-01-01 00:00:00", 1))
    for _ in range(2):
        jobs.ingest_files(spark, src, sink, progress, SCHEMA, "*.csv")
    assert spark.read.parquet(sink).count() == 1
    _land(tmp_path, "b.csv", (2, "2024-01-01 00:00:00", 1))
    jobs.ingest_files(spark, src, sink, progress, SCHEMA, "*.csv")
    assert sorted(r["id"] for r in spark.read.parquet(sink).collect()) == [1, 2]


def test_landing_conflicts(spark, tmp_path):
    _, sink, progress = _dirs(tmp_path)
    for day in ("d1", "d2"):
        folder = tmp_path / day
        folder.mkdir()
        _land(folder, "same.csv", (1 if day == "d1" else 2, "2024-01-01 00:00:00", 1))
    d1, d2 = str(tmp_path / "d1" / "in"), str(tmp_path / "d2" / "in")
    jobs.ingest_files(spark, d1, f"{sink}-r", f"{progress}-1", SCHEMA, mode="replace")
    jobs.ingest_files(spark, d2, f"{sink}-r", f"{progress}-2", SCHEMA, mode="replace")
    assert [r["id"] for r in spark.read.parquet(f"{sink}-r").collect()] == [2]
    both = str(tmp_path / "*" / "in")
    _land(tmp_path / "d1", "other.csv", (3, "2024-01-01 00:00:00", 1))
    jobs.ingest_files(spark, both, f"{sink}-f", f"{progress}-3", SCHEMA, "other.csv", "fail")
    (tmp_path / "d2" / "in" / "other.csv").write_text("4,2024-01-01 00:00:00,1\n")
    with pytest.raises(Exception, match="already been landed"):
        jobs.ingest_files(spark, both, f"{sink}-f", f"{progress}-3", SCHEMA, "other.csv", "fail")
    assert [r["id"] for r in spark.read.parquet(f"{sink}-f").collect()] == [3]


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_closed_hours_equal_the_batch(spark, tmp_path):
    src, sink, progress = _dirs(tmp_path)
    _land(tmp_path, "a.csv", (1, "2024-01-01 00:05:00", 1.5), (2, "2024-01-01 00:55:00", 2),
          (3, "2024-01-01 01:30:00", 4), (4, "2024-01-01 05:00:00", 8))
    events = jobs.stream_files(spark, src, SCHEMA)
    jobs.hourly_to_parquet(events, sink, progress, "ts", "v")
    batch = windowed_stats(spark.read.schema(SCHEMA).csv(src), "ts", "v")
    closed = batch.where(F.col("window_end") <= F.lit("2024-01-01 04:50:00").cast("timestamp"))
    assert _rows(spark.read.parquet(sink)) == _rows(closed) and closed.count() == 2

    # A row older than the watermark is dropped; nothing is emitted twice.
    _land(tmp_path, "late.csv", (5, "2024-01-01 00:10:00", 100))
    jobs.hourly_to_parquet(jobs.stream_files(spark, src, SCHEMA), sink, progress, "ts", "v")
    assert _rows(spark.read.parquet(sink)) == _rows(closed)


def test_sliding_and_session_windows(spark):
    df = spark.sql(
        "select * from values (timestamp'2024-01-01 00:05:00', 1.0D),"
        " (timestamp'2024-01-01 00:20:00', 2.0D), (timestamp'2024-01-01 02:00:00', 4.0D) t(ts, v)"
    )
    assert windowed_stats(df, "ts", "v", size="1 hour", slide="30 minutes").count() == 4
    sessions = windowed_stats(df, "ts", "v", session_gap="30 minutes")
    assert sorted((r["events"], r["total"]) for r in sessions.collect()) == [(1, 4.0), (2, 3.0)]


def test_batch_sessions_equal_the_builtin(spark):
    """Random gaps, gaps of exactly the limit, ties, several keys and null times."""
    import random

    rng, rows, now = random.Random(5), [], 1704067200
    for i in range(600):
        now += rng.choice([0, 60, 1799, 1800, 1801, 4000])
        rows.append((rng.choice(["a", "a", "b", None]), now, float(i)))
    rows.append(("a", None, 1.0))
    df = spark.createDataFrame(rows, "k string, s bigint, v double").select(
        "k", F.timestamp_seconds("s").alias("ts"), "v"
    )
    for keys in (["k"], []):
        want = df.groupBy(F.session_window("ts", "30 minutes").alias("w"), *keys).agg(
            F.count(F.lit(1)), F.sum("v")
        ).select("w.start", "w.end", *keys, "count(1)", "sum(v)")
        got = windowed_stats(df, "ts", "v", keys, session_gap="30 minutes").drop("mean")
        assert _rows_text(got) == _rows_text(want)


def _rows_text(df):
    return sorted(str(tuple(r)) for r in df.collect())


def test_events_and_alerts(spark, tmp_path):
    src, sink, progress = _dirs(tmp_path)
    _land(tmp_path, "a.csv", (1, "2024-01-01 00:05:00", 1), (2, "2024-01-01 00:05:00", 99))
    alerts = str(tmp_path / "alerts")
    for _ in range(2):
        events = jobs.stream_files(spark, src, SCHEMA)
        jobs.append_events(events, sink, progress, F.col("v") > 50, alerts)
    assert spark.read.parquet(sink).count() == 2
    assert [r["id"] for r in spark.read.parquet(alerts).collect()] == [2]


def test_backfill_of_unordered_files_loses_no_hour(spark, sf_dir, tmp_path):
    """Closed hours do not depend on how the events are spread over files."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    counts = []
    for files in (1, 6):
        src = str(tmp_path / f"in{files}")
        events.repartition(files, "event_id" if "event_id" in events.columns else "ts").write.parquet(src)
        stream = jobs.stream_files(spark, src, events.schema, fmt="parquet")
        stream = stream.withColumn("ts", stream["ts"].cast("timestamp"))
        out = str(tmp_path / f"out{files}")
        jobs.hourly_to_parquet(stream, out, str(tmp_path / f"progress{files}"), "ts", "value", ("event_type",))
        counts.append(spark.read.parquet(out).selectExpr("sum(events)", "count(*)").first())
    assert counts[0] == counts[1] and counts[0][0] > 0


@pytest.mark.parametrize("runs", [1, 3, 8])
def test_accumulated_windows_do_not_depend_on_runs(spark, sf_dir, tmp_path, runs):
    """Events in any order and any number of runs: the same hours; none lost, none twice."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "event_type", "value")
    events = events.withColumn("ts", F.when(F.col("event_id") % 50 > 0, F.col("ts").cast("timestamp")))
    src, sink, aside, progress = (str(tmp_path / x) for x in ("src", "sink", "aside", "progress"))
    dealt = events.withColumn("part", F.pmod(F.xxhash64("event_id", F.lit(runs)), F.lit(runs)))
    for run in range(runs):
        dealt.where(F.col("part") == run).drop("part").coalesce(2).write.mode("append").parquet(src)
        files = jobs.stream_files(spark, src, events.schema, "*.parquet", "parquet", max_files=1)
        jobs.accumulate_windows(files, sink, aside, progress, "ts", "value", ("event_type",))
    got = jobs.accumulated(spark, sink, ("event_type",))
    want = windowed_stats(events.where("ts is not null"), "ts", "value", ["event_type"])
    assert _rows_text(got) == _rows_text(want.select(*got.columns))
    counted, late = got.agg(F.sum("events")).first()[0], spark.read.parquet(aside).count()
    assert counted + late == events.count() and late == events.where("ts is null").count() > 0


def test_rows_beyond_the_lateness_are_set_aside(spark, tmp_path):
    src, sink, progress = _dirs(tmp_path)
    aside = str(tmp_path / "aside")

    def run(name, *rows):
        _land(tmp_path, name, *rows)
        jobs.accumulate_windows(jobs.stream_files(spark, src, SCHEMA), sink, aside, progress, "ts", "v", lateness="2 hours")

    run("a.csv", (1, "2024-01-01 05:05:00", 1), (2, "2024-01-01 00:01:00", 1))
    run("b.csv", (3, "2024-01-01 03:05:00", 5), (4, "2024-01-01 03:04:59", 7))
    hours = {str(r["window_start"])[11:16]: r["total"] for r in jobs.accumulated(spark, sink).collect()}
    assert hours == {"00:00": 1.0, "03:00": 5.0, "05:00": 1.0}
    assert [r["id"] for r in spark.read.parquet(aside).collect()] == [4]


@pytest.mark.parametrize("windows", [{"session_gap": "30 minutes"}, {"slide": "10 minutes"}])
def test_open_windows_go_on_after_a_restart(spark, tmp_path, windows):
    """State on disk: a window that one run leaves open is closed by a later one, as in a batch."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, session.RECOMMENDED_CONF[key])
    try:
        src, sink, progress = _dirs(tmp_path)
        times = [("00:05", "00:20", "00:45"), ("01:10", "01:12", "03:00"), ("03:20", "09:00", "20:00")]
        number = 0
        for run, part in enumerate(times):
            rows = [(number + i, f"2024-01-01 {t}:00", i + 1) for i, t in enumerate(part)]
            number += len(rows)
            _land(tmp_path, f"{run}.csv", *rows)
            stream = jobs.stream_files(spark, src, SCHEMA).withColumn("k", F.lit("a"))
            jobs.windows_to_parquet(stream, sink, progress, "ts", "v", ("k",), **windows)
        got = spark.read.parquet(sink)
        batch = spark.read.schema(SCHEMA).csv(src).withColumn("k", F.lit("a"))
        whole = windowed_stats(batch, "ts", "v", ("k",), **windows)
        want = whole.where(F.col("window_end") <= F.lit("2024-01-01 19:50:00").cast("timestamp"))
        assert _rows_text(got) == _rows_text(want) and got.count() >= 3
    finally:
        spark.conf.set(key, before)
