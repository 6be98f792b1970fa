"""Data-quality steps: duplicates, missing values, profiles, rules, masks, outliers."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import parse_date, ratio
from tidemark.operators.aggregate import with_group_stats

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in ``order``, which should end in a unique column.

    Each map task passes on at most one row per key, so a heavily repeated key is
    no heavier than any other after the shuffle.
    """
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_nth", first).where(F.col("_nth") == 1).drop("_nth")


def impute_group_mean(df: DataFrame, value: str, group: str) -> DataFrame:
    """Nulls of a number become the mean of the row's group."""
    mean = ratio(F.sum(value), F.count(value))
    return with_group_stats(df, [group], {"_mean": mean}).withColumn(
        value, F.coalesce(F.col(value).cast("double"), "_mean")
    ).drop("_mean")


def drop_missing(df: DataFrame, *columns: str) -> DataFrame:
    return df.dropna(subset=list(columns) or None)


def column_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: rows, nulls, about how many distinct values, extremes."""
    names = list(columns or df.columns)

    def stats(i: int) -> list[Column]:
        c = F.col(f"`{names[i]}`")
        return [
            F.count_if(c.isNull()).alias(f"n{i}"),
            F.approx_count_distinct(c).alias(f"d{i}"),
            F.min(c).cast("string").alias(f"a{i}"),
            F.max(c).cast("string").alias(f"z{i}"),
        ]

    one = df.agg(F.count(F.lit(1)).alias("rows"), *[s for i in range(len(names)) for s in stats(i)])
    per_column = F.array(
        *[
            F.struct(
                F.lit(name).alias("column_name"),
                F.col("rows"),
                F.col(f"n{i}").alias("nulls"),
                F.col(f"d{i}").alias("approx_distinct"),
                F.col(f"a{i}").alias("least"),
                F.col(f"z{i}").alias("greatest"),
            )
            for i, name in enumerate(names)
        ]
    )
    return one.select(F.inline(per_column))


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, distinct) exactly, nulls apart. Rows are turned into pairs of column and
    value, of which each task keeps one before the shuffle, so no value is a hot key."""
    names = list(columns or df.columns)
    pairs = F.array(
        *(F.struct(F.lit(n).alias("column_name"), F.col(f"`{n}`").cast("string").alias("value")) for n in names)
    )
    values = df.select(F.inline(pairs)).groupBy("column_name", "value").agg(F.lit(1).alias("_one"))
    found = values.groupBy("column_name").agg(F.count("value").alias("distinct"))
    every = df.sparkSession.createDataFrame([(n,) for n in names], "column_name string")
    return every.join(found, "column_name", "left").select(
        "column_name", F.coalesce("distinct", F.lit(0)).alias("distinct")
    )


def duplicate_columns(df: DataFrame) -> DataFrame:
    """Pairs of columns of one type that agree in every row.

    One pass gives each column a digest, the sum of hashes of its value and its row, which does
    not depend on the order of rows. Only columns of equal digest are compared, each with the
    first of its kind, so the work grows with the columns and not with their pairs."""
    fields = df.schema.fields
    nothing = df.sparkSession.createDataFrame([], "first string, second string")
    # Columns without a hash (maps) take part by their text.
    def value(f):
        return F.col(f"`{f.name}`").cast("string") if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`")

    row = F.xxhash64(*(x for f in fields for x in (value(f), value(f).isNull())))
    digest = [
        F.sum(F.xxhash64("_row", value(f), value(f).isNull()).cast("decimal(20,0)")).alias(f"d{i}")
        for i, f in enumerate(fields)
    ]
    got = df.withColumn("_row", row).agg(*digest).first() if fields else None
    if got is None:
        return nothing
    alike: dict[tuple, list[str]] = {}
    for i, f in enumerate(fields):
        alike.setdefault((f.dataType.simpleString(), got[f"d{i}"]), []).append(f.name)
    groups = [names for names in alike.values() if len(names) > 1]
    if not groups:
        return nothing
    second = [(names[0], other) for names in groups for other in names[1:]]
    sure = df.agg(
        *[F.bool_and(F.col(f"`{a}`").eqNullSafe(F.col(f"`{b}`"))).alias(f"p{i}") for i, (a, b) in enumerate(second)]
    )
    equal = F.array(
        *[F.struct(F.lit(a).alias("first"), F.lit(b).alias("second"), F.col(f"p{i}").alias("eq")) for i, (a, b) in enumerate(second)]
    )
    to_first = sure.select(F.inline(equal)).where(F.coalesce("eq", F.lit(True))).drop("eq")
    # Columns that agree with the same first one agree with each other.
    order = {f.name: i for i, f in enumerate(fields)}
    place = F.create_map(*(x for n, i in order.items() for x in (F.lit(n), F.lit(i))))
    x, y = to_first.select("first", F.col("second").alias("a")), to_first.select("first", F.col("second").alias("b"))
    between = x.join(y, "first").where(F.element_at(place, F.col("a")) < F.element_at(place, F.col("b")))
    return to_first.unionByName(between.select(F.col("a").alias("first"), F.col("b").alias("second")))


def validate(
    df: DataFrame, rules: Mapping[str, Column]
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows passing every rule, others with the broken rules, broken rows per rule).

    A rule that evaluates to null is broken.
    """
    broken = F.array_compact(
        F.array(*[F.when(~F.coalesce(r, F.lit(False)), F.lit(n)) for n, r in rules.items()])
    )
    checked = df.withColumn("broken_rules", broken)
    good = checked.where(F.size("broken_rules") == 0).drop("broken_rules")
    bad = checked.where(F.size("broken_rules") > 0)
    one = df.agg(
        *[F.count_if(~F.coalesce(r, F.lit(False))).alias(f"r{i}")
          for i, r in enumerate(rules.values())]
    )
    rows = [
        F.struct(F.lit(n).alias("rule"), F.col(f"r{i}").alias("broken"))
        for i, n in enumerate(rules)
    ]
    return good, bad, one.select(F.inline(F.array(*rows)))


def standardize_text(df: DataFrame, *columns: str, upper: bool = False) -> DataFrame:
    case = F.upper if upper else F.lower
    return df.withColumns({c: case(F.trim(F.col(c))) for c in columns})


def standardize_dates(df: DataFrame, column: str, *formats: str) -> DataFrame:
    return df.withColumn(column, parse_date(column, *formats))


def pseudonymize(df: DataFrame, salt: str, *columns: str) -> DataFrame:
    """Replace identifying values by a salted digest; equal values stay equal."""
    return df.withColumns(
        {c: F.sha2(F.concat(F.lit(salt), F.col(c).cast("string")), 256) for c in columns}
    )


def mask_text(
    df: DataFrame,
    column: str,
    pattern: str = EMAIL,
    mask: str = "***",
    contains: str | None = None,
) -> DataFrame:
    """Replace every match of ``pattern``.

    Texts without ``contains``, where every match is known to hold it, skip the pattern.
    """
    c = F.col(column)
    masked = F.regexp_replace(c, pattern, mask)
    if contains is not None:
        masked = F.when(F.contains(c, F.lit(contains)), masked).otherwise(c)
    return df.withColumn(column, masked)


BINS = 1024


def exact_quantiles(df: DataFrame, column: str, fractions: Sequence[float]) -> list:
    """The value at rank ``ceil(fraction * n)`` of the ``n`` values of a numeric column, for each
    fraction; None where there are no values. Nulls count for nothing, NaN comes last.

    Rounds of counts: the range that holds a rank is cut into bins, each bin counted with its
    least and greatest value, and the bin that holds the rank is the next round's range. All
    fractions share a round, and no task or driver sees more than ``BINS`` rows for each of
    them, so the answer is exact at every size. ``df`` is read once a round.
    """
    v = F.col(column)
    kind = df.schema[column].dataType
    values = df.select(v).where(v.isNotNull())
    n, low, high = values.agg(F.count(v), F.min(v), F.max(v)).first()
    if not n:
        return [None] * len(fractions)
    # For each fraction the range its value is in, the rows there, and its rank among them.
    state = [(low, high, n, min(n, max(1, math.ceil(f * n)))) for f in fractions]
    while True:
        ranges = list(dict.fromkeys(s[:3] for s in state if not _same(s[0], s[1])))
        if not ranges:
            return [s[0] for s in state]
        cells = [
            F.when((v >= lo) & (v <= hi), F.struct(F.lit(i).alias("part"), cell.alias("cell"), own.alias("own")))
            for i, (lo, hi, rows) in enumerate(
                (F.lit(a).cast(kind), F.lit(b).cast(kind), m) for a, b, m in ranges
            )
            # Few rows are told apart by value.
            for cell, own in [
                (F.lit(0), v) if rows <= BINS else (_bin(v, lo, hi), F.lit(None).cast(kind))
            ]
        ]
        counted = (
            values.select(v, F.coalesce(*cells).alias("_at"))
            .where("_at is not null")
            .groupBy("_at")
            .agg(F.count(v).alias("rows"), F.min(v).alias("low"), F.max(v).alias("high"))
            .orderBy("_at.part", "low")
            .collect()
        )
        found = {r: [c for c in counted if c["_at"]["part"] == i] for i, r in enumerate(ranges)}
        state = [s if _same(s[0], s[1]) else _narrowed(found[s[:3]], s[3]) for s in state]


def _same(low, high) -> bool:
    return low == high or (low != low and high != high)


def _bin(v: Column, low: Column, high: Column) -> Column:
    """Bin of a value within a range. Both ends have bins of their own, so that every round gets
    on, also where one of them is infinite or the range too wide for a number."""
    x, a, b = (c.cast("double") / 2 for c in (v, low, high))
    place = F.nanvl((x - a) / F.nullif(b - a, F.lit(0.0)), F.lit(0.0))
    inner = 1 + F.floor(F.least(F.greatest(F.coalesce(place, F.lit(0.0)), F.lit(0.0)), F.lit(1.0)) * (BINS - 3))
    return F.when(v == low, 0).when(v == high, BINS - 1).otherwise(inner).cast("int")


def _narrowed(bins: Sequence, rank: int) -> tuple:
    """Range, rows and rank in the bin that holds a rank, of bins in order."""
    for one in bins:
        if rank <= one["rows"]:
            return one["low"], one["high"], one["rows"], rank
        rank -= one["rows"]
    raise ValueError("the rows changed between two rounds")


def iqr_filter(df: DataFrame, column: str, k: float = 1.5) -> DataFrame:
    """Rows within ``k`` inter-quartile ranges of the exact quartiles, which are found first."""
    kind = df.schema[column].dataType
    low, high = (F.lit(q).cast(kind) for q in exact_quantiles(df, column, (0.25, 0.75)))
    spread = (high - low) * k
    c = F.col(column)
    return df.where((c >= low - spread) & (c <= high + spread))
