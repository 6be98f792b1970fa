from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.registry import query
from tidemark.session import scratch_path
from tidemark.sources.driver_tables import SCHEMAS
from tidemark.streaming import jobs
from tidemark.streaming.windows import windowed_stats

STATS = """count(*) AS events, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total,
           CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(value) AS mean"""
HOURLY = f"""SELECT date_trunc('hour', ts) AS window_start,
                    date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, event_type, {STATS}
             FROM events GROUP BY ALL"""


def _plain_times(df):
    """Zone-free times, as the checking engine has them."""
    return df.withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")}
    )


def _table(w, name: str) -> str:
    """A pattern, since a table may be one file or a directory of files."""
    return f"{w.path}/{{{name}}}.parquet"


def _stream(w, name: str):
    return jobs.stream_files(w.spark, _table(w, name), SCHEMAS[name], fmt="parquet")


def _timed(df):
    return df.withColumn("ts", F.col("ts").cast("timestamp"))


@query("hourly_sensor_stats", HOURLY)
def _(w):
    return _plain_times(windowed_stats(w.events, "ts", "value", ["event_type"]))


@query(
    "hourly_sensor_stream",
    f"""SELECT * FROM ({HOURLY})
        WHERE window_end <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)""",
)
def _(w):
    sink, checkpoint = (scratch_path(w.spark, f"hourly-{x}") for x in ("sink", "progress"))
    events = _timed(_stream(w, "events"))
    jobs.hourly_to_parquet(events, sink, checkpoint, "ts", "value", ("event_type",))
    return _plain_times(w.spark.read.parquet(sink))


@query("hourly_accumulated_stream", HOURLY)
def _(w):
    """Events in several files, taken one file at a time and in no order of time: every hour is
    whole, as its partial sums are merged."""
    source, sink, aside, checkpoint = (
        scratch_path(w.spark, f"accumulated-{x}") for x in ("source", "sink", "aside", "progress")
    )
    w.events.repartition(4, "event_id").write.parquet(source)
    files = jobs.stream_files(w.spark, source, w.events.schema, "*.parquet", "parquet", max_files=1)
    jobs.accumulate_windows(_timed(files), sink, aside, checkpoint, "ts", "value", ("event_type",))
    return _plain_times(jobs.accumulated(w.spark, sink, ("event_type",)))


SLIDING = f"""SELECT b + n * INTERVAL 10 MINUTE AS window_start,
                      b + n * INTERVAL 10 MINUTE + INTERVAL 1 HOUR AS window_end, {STATS}
               FROM (SELECT *, time_bucket(INTERVAL 10 MINUTE, ts, TIMESTAMP '1970-01-01') AS b
                     FROM events),
                    (SELECT -generate_series AS n FROM generate_series(0, 5))
               GROUP BY ALL"""
CLOSED = "window_end <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)"


def _closed_windows(w, name, keys, **windows):
    sink, checkpoint = (scratch_path(w.spark, f"{name}-{x}") for x in ("sink", "progress"))
    jobs.windows_to_parquet(_timed(_stream(w, "events")), sink, checkpoint, "ts", "value", keys, **windows)
    return _plain_times(w.spark.read.parquet(sink))


@query("sliding_event_stream", f"SELECT * FROM ({SLIDING}) WHERE {CLOSED}")
def _(w):
    return _closed_windows(w, "sliding", (), slide="10 minutes")


@query(
    "sliding_event_stats",
    f"""SELECT b + n * INTERVAL 10 MINUTE AS window_start,
               b + n * INTERVAL 10 MINUTE + INTERVAL 1 HOUR AS window_end, {STATS}
        FROM (SELECT *, time_bucket(INTERVAL 10 MINUTE, ts, TIMESTAMP '1970-01-01') AS b
              FROM events),
             (SELECT -generate_series AS n FROM generate_series(0, 5))
        GROUP BY ALL""",
)
def _(w):
    return _plain_times(windowed_stats(w.events, "ts", "value", (), "1 hour", "10 minutes"))


SESSIONS = f"""SELECT min(ts) AS window_start, max(ts) + INTERVAL 30 MINUTE AS window_end, user_id, {STATS}
    FROM (SELECT *, count(*) FILTER (WHERE gap) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session
          FROM (SELECT *, ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) > INTERVAL 30 MINUTE AS gap
                FROM events))
    GROUP BY user_id, session"""


@query("session_event_stream", f"SELECT * FROM ({SESSIONS}) WHERE {CLOSED}")
def _(w):
    return _closed_windows(w, "sessions", ("user_id",), session_gap="30 minutes")


@query(
    "session_event_stats",
    f"""SELECT min(ts) AS window_start, max(ts) + INTERVAL 30 MINUTE AS window_end, user_id,
               {STATS}
        FROM (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session
              FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id
                                                           ORDER BY ts, event_id)
                                        <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh
                    FROM events))
        GROUP BY user_id, session""",
)
def _(w):
    return _plain_times(
        windowed_stats(w.events, "ts", "value", ["user_id"], session_gap="30 minutes")
    )


@query(
    "issue_alert_stream",
    """SELECT event_id, user_id, event_type, value FROM events
       WHERE event_type = 'error' AND value > 50""",
)
def _(w):
    paths = [scratch_path(w.spark, f"issues-{x}") for x in ("all", "alerts", "progress")]
    sink, alerts, checkpoint = paths
    alert = (F.col("event_type") == "error") & (F.col("value") > 50)
    jobs.append_events(_timed(_stream(w, "events")), sink, checkpoint, alert, alerts)
    return w.spark.read.parquet(alerts).select("event_id", "user_id", "event_type", "value")


@query("landed_orders_stream", "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders")
def _(w):
    sink, checkpoint = (scratch_path(w.spark, f"landing-{x}") for x in ("sink", "progress"))
    jobs.ingest_files(
        w.spark, _table(w, "orders"), sink, checkpoint, SCHEMAS["orders"], fmt="parquet"
    )
    return w.spark.read.schema(SCHEMAS["orders"]).parquet(sink).select(
        "o_orderkey", "o_custkey", "o_orderpriority"
    )
