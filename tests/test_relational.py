from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.operators import relational as r
from tidemark.operators.aggregate import (
    above_average,
    conditional_mean,
    counts_by_hue,
    top_k,
    top_share,
    with_dimension_totals,
    with_group_stats,
)


def _sides(spark):
    left = spark.createDataFrame(
        [(1, "a"), (2, "b"), (2, "c"), (3, "d"), (None, "e")], "k int, l string"
    )
    right = spark.createDataFrame(
        [(2, "x"), (2, "y"), (3, "z"), (9, "w"), (None, "v")], "j int, r string"
    )
    return left, right


def _sorted(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


@pytest.mark.parametrize("how", ["left", "right", "full"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_outer_join_equals_the_builtin(spark, how, null_safe):
    left, right = _sides(spark)
    test = left.k.eqNullSafe(right.j) if null_safe else left.k == right.j
    want = _sorted(left.join(right, test, how))
    assert _sorted(r.outer_join(left, right, [("k", "j")], how, null_safe)) == want


def test_outer_join_with_empty_sides(spark):
    left, right = _sides(spark)
    none = right.where("false")
    assert r.outer_join(left, none, [("k", "j")], "full").count() == 5
    assert r.outer_join(left.where("false"), right, [("k", "j")], "left").count() == 0


def test_outer_join_refuses_name_clashes(spark):
    left, _ = _sides(spark)
    with pytest.raises(ValueError):
        r.outer_join(left, left, ["k"], "left")


def test_join_on(spark):
    left, right = _sides(spark)
    assert r.join_on(left, right, [("k", "j")]).count() == 5
    assert r.join_on(left, right, [("k", "j")], null_safe=True).count() == 6
    same = right.withColumnRenamed("j", "k")
    assert r.join_on(left, same, ["k"]).columns == ["k", "l", "r"]


def test_semi_and_anti(spark):
    left, right = _sides(spark)
    assert _sorted(r.semi(left, right, [("k", "j")])) == [(2, "b"), (2, "c"), (3, "d")]
    assert _sorted(r.anti(left, right, [("k", "j")])) == [(1, "a"), (None, "e")]
    assert r.anti(left, right, [("k", "j")], null_safe=True).count() == 1


def test_dimension_twice(spark):
    fact = spark.createDataFrame([(1, 2), (2, 9)], "a int, b int")
    dim = spark.createDataFrame([(1, "x"), (2, "y")], "k int, n string")
    inner = r.join_dimension_twice(fact, dim, ("a", "k"), ("b", "k"), ["n"], ("_a", "_b"))
    assert _sorted(inner) == [(1, 2, "x", "y")]
    left = r.join_dimension_twice(fact, dim, ("a", "k"), ("b", "k"), ["n"], ("_a", "_b"), "left")
    assert _sorted(left) == [(1, 2, "x", "y"), (2, 9, "y", None)]


def test_set_operations(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x")], "k int, v string")
    b = spark.createDataFrame([("x", 1), ("y", 2)], "v string, k int")
    assert r.union_all(a, b).count() == 4
    assert _sorted(r.union_distinct(a, b)) == [(1, "x"), (2, "y")]


def test_append_rows(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    assert _sorted(r.append_rows(a, [{"k": 2}])) == [(1, "x"), (2, None)]
    with pytest.raises(ValueError):
        r.append_rows(a, [{"z": 1}])


def test_group_stats_keep_null_groups(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), (None, 5), (None, 7)], "g string, v int")
    got = _sorted(with_group_stats(df, ["g"], {"s": F.sum("v")}))
    assert got == [("a", 1, 4), ("a", 3, 4), (None, 5, 12), (None, 7, 12)]


def test_dimension_totals_equal_totals_of_the_joined_rows(spark):
    facts = spark.createDataFrame(
        [(1, 10), (1, None), (2, 5), (3, 7), (4, 1), (9, 99), (None, 50)], "k int, v int"
    )
    dimension = spark.createDataFrame(
        [(1, "a"), (2, "a"), (3, None), (4, None), (4, "a"), (5, "b")], "k int, g string"
    )
    got = with_dimension_totals(
        facts, dimension, "k", "g", {"_s": F.sum("v"), "_n": F.count("v")}, {"s": F.sum("_s"), "n": F.sum("_n")}
    ).select("k", "g", "v", "s", "n")
    want = with_group_stats(
        r.join_on(facts, dimension, ["k"]), ["g"], {"s": F.sum("v"), "n": F.count("v")}
    ).select("k", "g", "v", "s", "n")
    assert _sorted(got) == _sorted(want) and got.count() == 6


def test_above_average(spark):
    df = spark.createDataFrame([(1,), (2,), (9,), (None,)], "v int")
    assert _sorted(above_average(df, "v")) == [(9,)]


def test_conditional_mean(spark):
    df = spark.createDataFrame(
        [("f", 10.0), ("f", None), ("m", 4.0), ("m", 6.0), (None, 100.0)], "s string, a double"
    )
    got = _sorted(conditional_mean(df, "a", "s", "f", "m", "mean").select("s", "mean"))
    assert got == [("f", 10.0), ("f", 10.0), ("m", 5.0), ("m", 5.0), (None, 5.0)]


def test_counts_by_hue(spark):
    df = spark.createDataFrame(
        [("it", "y"), ("it", "n"), ("it", None), ("hr", "y"), (None, "y")], "a string, h string"
    )
    got = [tuple(r) for r in counts_by_hue(df, "a", "h").collect()]
    assert got == [("it", "n", 1, 3), ("it", "y", 1, 3), ("hr", "y", 1, 1)]


def test_top(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), (None,)], "k string")
    assert tuple(top_share(df, "k", 2).first()) == (3, 5, 0.6)
    assert [r[0] for r in top_k(df.na.drop().distinct(), [F.asc("k")], 2).collect()] == ["a", "b"]
