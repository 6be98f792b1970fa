from __future__ import annotations

import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators import ml
from tidemark.operators import quality as q


def _sorted(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_dedup_keeps_the_first(spark):
    df = spark.sql("select * from values (1, 5), (1, 3), (2, 9), (null, 1), (null, 2) v(k, o)")
    assert _sorted(q.dedup(df, ["k"], [F.asc("o")])) == [(1, 3), (2, 9), (None, 1)]


def test_dedup_drops_copies_before_the_shuffle(spark):
    df = spark.sql("select * from values (1, 5), (1, 3) v(k, o)")
    plan = q.dedup(df, ["k"], [F.asc("o")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_missing_values(spark):
    df = spark.sql("select * from values ('a', 2), ('a', null), ('b', null) v(g, x)")
    assert _sorted(q.impute_group_mean(df, "x", "g")) == [
        ("a", 2.0), ("a", 2.0), ("b", None)]
    assert q.drop_missing(df, "x").count() == 1


def test_profile(spark):
    df = spark.sql("select * from values (1, 'x', 1), (null, 'y', null) v(a, b, c)")
    rows = {r["column_name"]: r for r in q.column_profile(df).collect()}
    assert (rows["a"]["rows"], rows["a"]["nulls"], rows["b"]["greatest"]) == (2, 1, "y")
    assert rows["b"]["approx_distinct"] == 2
    assert _sorted(q.duplicate_columns(df)) == [("a", "c")]
    assert q.duplicate_columns(df.select("a", "b")).count() == 0


def test_validate(spark):
    df = spark.sql("select * from values (1), (-1), (null) v(a)")
    good, bad, counts = q.validate(df, {"positive": F.col("a") > 0, "small": F.col("a") < 9})
    assert _sorted(good) == [(1,)]
    assert sorted(len(r["broken_rules"]) for r in bad.collect()) == [1, 2]
    assert _sorted(counts) == [("positive", 2), ("small", 1)]


def test_text_and_dates(spark):
    df = spark.sql("select ' Ab ' t, '31/01/2021' d")
    out = q.standardize_dates(q.standardize_text(df, "t", upper=True), "d", "yyyy-MM-dd",
                              "dd/MM/yyyy").first()
    assert out["t"] == "AB" and str(out["d"]) == "2021-01-31"


def test_anonymize(spark):
    df = spark.sql("select 'me' n, 'mail a.b@c.org, x@y.io!' t union all select null, null")
    rows = q.mask_text(q.pseudonymize(df, "s", "n"), "t").collect()
    assert len(rows[0]["n"]) == 64 and rows[1]["n"] is None
    assert rows[0]["t"] == "mail ***, ***!"


def test_iqr(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("x")).union(
        spark.sql("select 1000D")
    )
    assert q.iqr_filter(df, "x").agg(F.max("x")).first()[0] == 99.0


def test_quantiles_are_exact(spark):
    fractions = (0.0, 0.25, 0.5, 0.9, 1.0)

    def want(values):
        values = sorted(v for v in values if v is not None)
        return [values[max(1, math.ceil(f * len(values))) - 1] for f in fractions]

    rng = random.Random(3)
    cases = {
        "double": [
            [math.exp(rng.gauss(0, 60)) * rng.choice([-1, 1]) for _ in range(5000)],
            [7.5] * 3000 + [8.0] * 2000 + [None] * 50,
            [float("-inf"), -1.7e308, 1.7e308, float("inf")] * 600 + [0.1 * i for i in range(2000)],
        ],
        "bigint": [[2**62 + i for i in range(3000)], [3], [1, 2]],
        "decimal(20,2)": [[Decimal(rng.randint(-(10**17), 10**17)) / 100 for _ in range(3000)]],
    }
    for kind, tables in cases.items():
        for values in tables:
            df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
            assert q.exact_quantiles(df, "x", fractions) == want(values)
    empty = spark.createDataFrame([(None,)], "x double")
    assert q.exact_quantiles(empty, "x", fractions) == [None] * 5
    assert q.iqr_filter(empty, "x").count() == 0
    last = spark.createDataFrame([(1.0,), (float("nan"),), (float("nan"),)], "x double")
    first, top = q.exact_quantiles(last, "x", (0.3, 0.6))
    assert first == 1.0 and math.isnan(top)


def test_model_steps(spark):
    df = spark.range(50).select(
        "id", F.when(F.col("id") < 30, "a").otherwise("b").alias("c"),
        F.col("id").cast("double").alias("x"), (F.col("id") * 3.0 + 2).alias("y"),
    )
    out = ml.encode_scale(df, ["c"], ["x"])
    assert {r["c"]: r["c_index"] for r in out.select("c", "c_index").distinct().collect()} == {
        "a": 0.0, "b": 1.0}
    assert abs(out.agg(F.avg("x_scaled")).first()[0]) < 1e-9
    fit = {r["term"]: r["coefficient"] for r in ml.fit_linear(df, "y", ["x"]).collect()}
    assert fit["x"] == pytest.approx(3) and fit["intercept"] == pytest.approx(2)


def test_null_numbers_keep_their_rows(spark):
    df = spark.sql("select * from values ('a', 1.0D), ('b', null), ('a', 3.0D) v(c, x)")
    out = ml.encode_scale(df, ["c"], ["x"]).collect()
    assert len(out) == 3
    assert [r["x_scaled"] for r in out if r["x"] is None] == [None]


def test_mask_any_pattern(spark):
    df = spark.sql("select 'call 555-0100' as t")
    assert q.mask_text(df, "t", r"\d{3}-\d{4}").first()["t"] == "call ***"


def test_distinct_counts_are_exact(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "b", None), (2, None, None)], "x int, y string, z int")
    assert _sorted(q.distinct_counts(df)) == [("x", 2), ("y", 2), ("z", 0)]


def test_duplicate_columns_of_many(spark):
    """Groups of three and two; columns that hold the same values in other rows differ."""
    rows = [(i, i, i, 9 - i, str(i % 3), str(i % 3), None, None) for i in range(10)] * 2
    df = spark.createDataFrame(rows, "a int, b int, c int, d int, e string, f string, g int, h int")
    assert _sorted(q.duplicate_columns(df)) == [("a", "b"), ("a", "c"), ("b", "c"), ("e", "f"), ("g", "h")]
    wide = spark.range(50).select(*(F.col("id") * (k % 40) for k in range(80)))
    wide = wide.toDF(*(f"c{k}" for k in range(80)))
    assert q.duplicate_columns(wide).count() == 40


def test_labels_are_numbered_in_a_table(spark):
    """As the learner's own indexer, for 100,000 labels with ties, nulls and a hot one."""
    from pyspark.ml.feature import StringIndexer

    label = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 1000 != 1, F.concat(F.lit("v"), F.col("id") % 100_000))
    df = spark.range(300_000).select("id", label.alias("c"), F.lit(1.0).alias("x"))
    learner = StringIndexer(inputCol="c", outputCol="want", handleInvalid="keep").fit(df)
    got = learner.transform(ml.encode_scale(df, ["c"], ["x"]).select("c", "c_index"))
    assert got.count() == 300_000 and got.where("c_index != want").isEmpty()
    small = ml.encode_scale(spark.sql("select * from values ('b'), ('a'), ('b'), (null) v(c)"), ["c"], [])
    assert {r["c"]: r["c_onehot"] for r in small.collect()} == {"b": [1, 0, 0], "a": [0, 1, 0], None: [0, 0, 1]}
