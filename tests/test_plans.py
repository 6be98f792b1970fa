"""What single plans must and must not contain."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidemark.operators import relational as r
from tidemark.plans import flights
from tidemark.sources.driver_tables import Warehouse

QUERIES = entry.queries()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    plan = _plan(QUERIES["load_congestion"](spark, sf_dir))
    assert "GreaterThanOrEqual(l_shipdate,1998-06-15" in plan
    schema = re.search(r"ReadSchema: struct<(.*?)>", plan).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {
        "l_linenumber", "l_extendedprice", "l_discount", "l_shipdate"}


def test_year_filter_is_a_range(spark, sf_dir):
    plan = _plan(QUERIES["shippers_right_orders_year"](spark, sf_dir))
    assert "GreaterThanOrEqual(o_orderdate,1996-01-01" in plan


def test_top_k_is_not_a_full_sort(spark, sf_dir):
    plan = _plan(QUERIES["top10_airlines"](spark, sf_dir))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


@pytest.fixture()
def tight(spark):
    """Thresholds low enough that a small frame counts as skewed and nothing is broadcast."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("how", ["left", "right", "full"])
def test_outer_joins_split_a_hot_key(spark, tight, how):
    """The many-rows side is on the optional end, where a built-in join cannot be split."""
    one = spark.range(20000).select(F.col("id").alias("k"), F.col("id").alias("a"))
    many = spark.range(0, 300000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id") % 20000).alias("j"),
        F.xxhash64("id").alias("b"),
    )
    df = r.outer_join(one, many, [("k", "j")], how)
    df.collect()
    assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    builtin = one.join(many, one.k == many.j, how)
    builtin.collect()
    if how in ("left", "full"):
        assert "skew=true" not in builtin._jdf.queryExecution().executedPlan().toString()


def test_airport_lookup_is_broadcast_by_size_only(spark, sf_dir):
    w = Warehouse(spark, sf_dir)
    clean = flights.flights_clean(w.flights_raw("Domestico", True))
    out = flights.flight_origin_destination(
        clean, flights.airports_clean(w.airports_raw), "1997-01-01", "1999-06-30"
    )
    assert "ResolvedHint" not in out._jdf.queryExecution().analyzed().toString()


def test_outer_joins_read_a_side_twice_at_most(spark, tmp_path):
    """Also in a chain, whose first result is written."""
    for name in ("one", "two"):
        spark.range(50).select(F.col("id").alias(f"k_{name}")).write.parquet(str(tmp_path / name))
    one, two = (spark.read.parquet(str(tmp_path / n)) for n in ("one", "two"))
    for how in ("left", "right", "full"):
        plan = r.outer_join(one, two, [("k_one", "k_two")], how)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation [k_one") <= 2 and plan.count("Relation [k_two") <= 2
