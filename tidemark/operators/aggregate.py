"""Aggregations. Every one has a map-side partial step, so a hot group shrinks
before it is shuffled."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import ratio
from tidemark.operators.relational import join_on
from tidemark.session import materialize, stored


def with_group_stats(
    df: DataFrame, keys: Sequence[str], stats: Mapping[str, Column]
) -> DataFrame:
    """Aggregates per group on every row of the group: ``agg OVER (PARTITION BY keys)``.

    Grouped and joined back instead of windowed: a window sends a whole group to
    one task, while here each group is reduced map-side. The reduced groups are
    written as a table, whose bytes the planner knows: within its broadcast threshold the
    rows are not shuffled at all, beyond it an equi-join carries them, which adaptive
    execution splits where a key is heavy. Null keys form a group.
    """
    grouped = stored(
        df.groupBy(*[F.col(k).alias(f"_g{i}") for i, k in enumerate(keys)]).agg(
            *[c.alias(n) for n, c in stats.items()]
        )
    )
    tests = [df[k].eqNullSafe(grouped[f"_g{i}"]) for i, k in enumerate(keys)]
    joined = df.join(grouped, reduce(lambda a, b: a & b, tests), "inner")
    return joined.drop(*[f"_g{i}" for i in range(len(keys))])


def with_dimension_totals(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    group: str,
    parts: Mapping[str, Column],
    totals: Mapping[str, Column],
) -> DataFrame:
    """``facts`` joined to ``dimension`` by ``key``, with totals over each of its groups.

    ``parts`` are sums of the facts of one key, ``totals`` aggregates of these. Facts shrink to
    one row a key before they meet the dimension, and each fact is joined once, to a dimension
    row that carries its group's totals. A null group is a group; a fact without a key has none.
    """
    per_key = facts.groupBy(key).agg(*[c.alias(n) for n, c in parts.items()])
    grouped = stored(
        join_on(per_key, dimension.select(key, group), [key])
        .groupBy(group)
        .agg(*[c.alias(n) for n, c in totals.items()])
    )
    return join_on(facts, join_on(dimension, grouped, [group], null_safe=True), [key])


def above_average(df: DataFrame, column: str) -> DataFrame:
    """Rows above the overall mean, as one query with a scalar subquery."""
    mean = df.select(ratio(F.sum(column), F.count(column))).scalar()
    return df.where(F.col(column) > mean)


def conditional_mean(
    df: DataFrame,
    value: str,
    group: str,
    first: str,
    second: str,
    name: str,
) -> DataFrame:
    """Mean of ``value`` over the rows of the own group, for a two-valued group.

    Rows whose group is ``first`` get its mean; all others, null included, get the
    mean of ``second``. Both means come from one pass.
    """
    number = F.col(value).cast("double")
    means = df.agg(
        F.avg(F.when(F.col(group) == first, number)).alias("_mean_first"),
        F.avg(F.when(F.col(group) == second, number)).alias("_mean_second"),
    ).select(F.struct("_mean_first", "_mean_second"))
    return (
        df.withColumn("_means", means.scalar())
        .withColumn(
            name,
            F.when(F.col(group) == first, F.col("_means")["_mean_first"]).otherwise(
                F.col("_means")["_mean_second"]
            ),
        )
        .drop("_means")
    )


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows; ``order`` must end in a unique tie-breaker."""
    return df.orderBy(*order).limit(k)


def counts_by_hue(df: DataFrame, y: str, hue: str) -> DataFrame:
    """Chart data: rows per (y, hue) with the total of y, most frequent y first.

    A null category is not shown; a null hue counts in the total only. The rows are
    counted once; totals come from the counts.
    """
    cells = materialize(
        df.where(F.col(y).isNotNull()).groupBy(y, hue).agg(F.count(F.lit(1)).alias("cases"))
    )
    return (
        with_group_stats(cells, [y], {"total_cases": F.sum("cases")})
        .where(F.col(hue).isNotNull())
        .select(y, hue, "cases", "total_cases")
        .orderBy(F.col("total_cases").desc(), y, hue)
    )


def mean_by_group(
    df: DataFrame, group: str, value: str, name: str, overall: str
) -> DataFrame:
    """Mean per group next to the mean of all rows, from one pass over the rows."""
    sums = materialize(
        df.groupBy(group).agg(F.sum(value).alias("_sum"), F.count(value).alias("_n"))
    )
    total = sums.select(ratio(F.sum("_sum"), F.sum("_n"))).scalar()
    return sums.select(
        group, ratio(F.col("_sum"), F.col("_n")).alias(name), total.alias(overall)
    )


def top_share(df: DataFrame, key: str, k: int) -> DataFrame:
    """Share of all rows held by the ``k`` most frequent keys (null is no key)."""
    groups = materialize(df.groupBy(key).agg(F.count(F.lit(1)).alias("cases")))
    named = groups.where(F.col(key).isNotNull())
    top = top_k(named, [F.col("cases").desc(), F.col(key).asc()], k)
    total = groups.select(F.sum("cases")).scalar()
    return top.agg(F.sum("cases").alias("top_cases")).select(
        "top_cases",
        total.alias("total_cases"),
        ratio(F.col("top_cases"), total).alias("share"),
    )
