from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import global_window as gw


def _frame(spark, kind, n=400):
    rng = random.Random(3)
    words = ["b", "a", None, "é", "", "zz", "Z", "c"]
    rows = []
    for i in range(n):
        if kind == "ties":
            key = rng.choice([1, 1, 1, 2, 9, None])
        elif kind == "null":
            key = None
        elif kind == "hot":
            key = 5 if i % 3 else i
        else:
            key = rng.randrange(1000)
        value = None if i % 7 == 0 else i * 10
        rows.append((i, key, words[i % len(words)], value))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "id int, k int, s string, v int").repartition(4)


def _spec(order):
    out = []
    for o in order:
        n, d = (o, "asc") if isinstance(o, str) else o
        out.append(F.col(n).desc_nulls_last() if d == "desc" else F.col(n).asc_nulls_last())
    return Window.orderBy(*out)


def _check(df, order, ranges):
    plain = df.select(
        "id",
        F.row_number().over(_spec([*order, "id"])).cast("bigint").alias("rn"),
        F.rank().over(_spec(order)).cast("bigint").alias("rk"),
        F.lag("v", 1).over(_spec([*order, "id"])).alias("lg"),
        F.lead("v", 1).over(_spec([*order, "id"])).alias("ld"),
    )
    parts = [
        gw.global_row_number(df, order, ["id"], "out", ranges),
        gw.global_rank(df, order, "out", ranges),
        gw.global_lag(df, "v", order, ["id"], "out", ranges),
        gw.global_lead(df, "v", order, ["id"], "out", ranges),
    ]
    wanted = plain.collect()
    for part, name in zip(parts, ("rn", "rk", "lg", "ld"), strict=True):
        assert {r["id"]: r["out"] for r in part.collect()} == {r["id"]: r[name] for r in wanted}


CASES = [
    ("ties", ["k"], 7),
    ("ties", [("k", "desc")], 2),
    ("null", ["k"], 7),
    ("hot", ["k"], 1),
    ("hot", [("k", "desc")], 40),
    ("plain", ["s", ("k", "desc")], 7),
    ("plain", [("s", "desc"), "k"], 40),
]


@pytest.mark.parametrize("kind,order,ranges", CASES, ids=str)
def test_matches_plain_window(spark, kind, order, ranges):
    _check(_frame(spark, kind), order, ranges)


@pytest.mark.parametrize("ranges", [None, 7])
def test_empty_and_single(spark, ranges):
    for n in (0, 1):
        df = _frame(spark, "plain", n)
        assert gw.global_row_number(df, ["k"], ["id"], "rn", ranges).count() == n
        assert gw.global_rank(df, ["k"], "rk", ranges).count() == n
        assert gw.global_lag(df, "v", ["k"], ["id"], "lg", ranges).count() == n


def test_a_sampled_cut_is_still_exact(spark, monkeypatch):
    monkeypatch.setattr(gw, "SAMPLES_PER_RANGE", 1)
    df = spark.range(5000).select(
        "id", (F.col("id") % 37).cast("int").alias("k"), F.col("id").alias("v")
    )
    _check(df, ["k"], 16)


KEY_TYPES = {
    "double": "CASE WHEN id % 50 = 0 THEN double('NaN') ELSE id / 7.0D END",
    "float": "float(id / 3.0D)",
    "decimal": "cast(id / 3 as decimal(20, 6))",
    "date": "date_add(date'1999-12-01', int(id))",
    "timestamp": "timestamp_micros(1700000000123456 + id * 1000003)",
    "ntz": "timestamp_ntz'2024-03-10 01:59:59.999' + make_interval(0, 0, 0, 0, 0, int(id), 0)",
    "text": "concat(char(34 + id % 60), '\"\\\\ é\t', id)",
    "flag": "id % 2 = 0",
}


@pytest.mark.parametrize("kind", KEY_TYPES)
def test_every_kind_of_key(spark, kind):
    df = spark.range(300).select(
        F.col("id").cast("int").alias("id"),
        F.when(F.col("id") % 11 > 0, F.expr(KEY_TYPES[kind])).alias("k"),
        F.col("id").alias("v"),
    )
    plan = gw.global_row_number(df, ["k"], ["id"], "rn", 9)._jdf.queryExecution()
    assert "from_json" not in plan.optimizedPlan().toString()
    _check(df, [("k", "desc")], 9)


def test_masses_of_exact_copies(spark):
    """Copies with nothing to tell them apart are numbered over several ranges."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, F.lit(7)).otherwise(F.col("id")).alias("k")
    )
    out = gw.global_row_number(df, ["k"], [], "rn", 8)
    assert out.columns == ["k", "rn"]
    rows = sorted(tuple(r) for r in out.collect())
    assert [r[1] for r in rows] == list(range(1, 3001))
    lagged = gw.global_lag(df, "k", ["k"], [], "prev", 8).collect()
    keys = sorted(r["k"] for r in lagged)
    assert sorted((r["k"], -1 if r["prev"] is None else r["prev"]) for r in lagged) == sorted(
        zip(keys, [-1, *keys[:-1]])
    )


def test_rows_are_never_gathered_in_one_task(spark):
    """Only summaries, a row per range, may meet in a single partition."""
    df = _frame(spark, "hot")
    out = gw.global_rank(df, ["k"], "rk", 7)
    plan = out._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "SinglePartition" in line:
            below = " ".join(lines[i : i + 3])
            assert "_rows" in below or "count(1)" in below


def test_tied_rows_need_no_window(spark):
    """Rows on a cut point, as a hot key is, are ranked without a shuffle of their own."""
    df = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k")
    )
    out = gw.global_rank(df, ["k"], "rk", 8)
    hot = out.where(F.col("k") == 7).select("rk").distinct().collect()
    assert len(hot) == 1
