"""Joins, membership tests and set operations that stay balanced on hot keys.

Adaptive execution splits a skewed partition only on sides whose unmatched rows
need not be tracked: both sides of an inner join, the kept side of a left, semi
or anti join. Outer joins with the many-rows side on the optional end, and full
outer joins, cannot be split. ``outer_join`` therefore builds them from an inner
join and anti joins against the *distinct* keys of the other side, where map-side
aggregation has already collapsed a hot key to one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import stored

Keys = Sequence[str | tuple[str, str]]


def _pairs(keys: Keys) -> list[tuple[str, str]]:
    return [(k, k) if isinstance(k, str) else k for k in keys]


def _condition(left: DataFrame, right: DataFrame, pairs, null_safe: bool) -> Column:
    tests = [
        left[a].eqNullSafe(right[b]) if null_safe else left[a] == right[b] for a, b in pairs
    ]
    return reduce(lambda x, y: x & y, tests)


def join_on(left: DataFrame, right: DataFrame, keys: Keys, null_safe: bool = False) -> DataFrame:
    """Inner equi-join; a key is a shared name or a (left, right) pair of names.

    The right key columns are dropped when they carry the left key's name.
    """
    pairs = _pairs(keys)
    joined = left.join(right, _condition(left, right, pairs, null_safe), "inner")
    same = [right[b] for a, b in pairs if a == b]
    return joined.drop(*same) if same else joined


def distinct_keys(df: DataFrame, names: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Distinct key values; without ``null_safe`` only those that can equal anything."""
    if not null_safe:
        for name in names:
            df = df.where(F.col(name).isNotNull())
    return df.select(*[F.col(n).alias(f"_key{i}") for i, n in enumerate(names)]).distinct()


def _membership(df, other, keys, how, null_safe):
    pairs = _pairs(keys)
    listed = distinct_keys(other, [b for _, b in pairs], null_safe)
    tests = []
    for i, (a, _) in enumerate(pairs):
        right = listed[f"_key{i}"]
        tests.append(df[a].eqNullSafe(right) if null_safe else df[a] == right)
    return df.join(listed, reduce(lambda x, y: x & y, tests), how)


def semi(df: DataFrame, other: DataFrame, keys: Keys, null_safe: bool = False) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``other`` (IN)."""
    return _membership(df, other, keys, "left_semi", null_safe)


def anti(df: DataFrame, other: DataFrame, keys: Keys, null_safe: bool = False) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``other``; a null key never occurs."""
    return _membership(df, other, keys, "left_anti", null_safe)


def outer_join(
    left: DataFrame, right: DataFrame, keys: Keys, how: str, null_safe: bool = False
) -> DataFrame:
    """Left, right or full outer equi-join without an unsplittable partition.

    The column names of both inputs must differ (rename first); the result has
    the columns of ``left`` followed by those of ``right``.
    """
    if how not in ("left", "right", "full"):
        raise ValueError("how must be left, right or full")
    clash = set(left.columns) & set(right.columns)
    if clash:
        raise ValueError(f"rename before joining: {sorted(clash)}")
    pairs = _pairs(keys)
    one = _with_keys(left, [a for a, _ in pairs], "__left", 1, null_safe)
    two = _with_keys(right, [b for _, b in pairs], "__right", 2, null_safe)
    present = _presence(one, two, len(pairs))
    if how == "full":
        # Both sides read it.
        present = stored(present, "outer-keys")
    if how in ("left", "full"):
        two = two.unionByName(_partners(present, "not has_right", "__right", right))
    if how in ("right", "full"):
        one = one.unionByName(_partners(present, "not has_left", "__left", left))
    same = [F.col(f"__left{i}").eqNullSafe(F.col(f"__right{i}")) for i in range(len(pairs))]
    same.append(F.col("__left_apart") == F.col("__right_apart"))
    joined = one.join(two, reduce(lambda x, y: x & y, same), "inner")
    return joined.select(left.columns + right.columns)


def _with_keys(df: DataFrame, names, prefix: str, side: int, null_safe: bool) -> DataFrame:
    """``df`` with copies of its keys, and 0 or, for a key that can equal none, its side."""
    unequal = reduce(lambda x, y: x | y, [F.col(n).isNull() for n in names])
    apart = F.lit(0) if null_safe else F.when(unequal, F.lit(side)).otherwise(F.lit(0))
    copies = [F.col(n).alias(f"{prefix}{i}") for i, n in enumerate(names)]
    return df.select("*", *copies, apart.alias(f"{prefix}_apart"))


def _presence(one: DataFrame, two: DataFrame, keys: int) -> DataFrame:
    """Distinct keys of both sides with the sides that have them, in one grouping."""
    names = [f"key{i}" for i in range(keys)] + ["apart"]

    def listed(df, prefix, has_left):
        columns = [F.col(f"{prefix}{i}") for i in range(keys)] + [F.col(f"{prefix}_apart")]
        flags = [F.lit(has_left).alias("l"), F.lit(not has_left).alias("r")]
        return df.select(*[c.alias(n) for c, n in zip(columns, names, strict=True)], *flags)

    both = listed(one, "__left", True).unionByName(listed(two, "__right", False))
    return both.groupBy(*names).agg(F.max("l").alias("has_left"), F.max("r").alias("has_right"))


def _partners(present: DataFrame, lacking: str, prefix: str, side: DataFrame) -> DataFrame:
    """A row of nulls, as of ``side``, for every key that it lacks."""
    keys = [n for n in present.columns if n.startswith("key")]
    return present.where(lacking).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in side.schema.fields],
        *[F.col(n).alias(f"{prefix}{i}") for i, n in enumerate(keys)],
        F.col("apart").alias(f"{prefix}_apart"),
    )


def join_dimension_twice(
    fact: DataFrame,
    dimension: DataFrame,
    first: tuple[str, str],
    second: tuple[str, str],
    columns: Sequence[str],
    suffixes: tuple[str, str],
    how: str = "inner",
) -> DataFrame:
    """Look up ``columns`` of one dimension by two keys of ``fact``.

    ``first`` and ``second`` are (fact key, dimension key); the looked-up columns
    get the matching suffix. The dimension key must be unique for a left join to
    keep one row per fact row.
    """
    out = fact
    for (fact_key, dim_key), suffix in zip((first, second), suffixes, strict=True):
        key = f"_dim{suffix}"
        side = dimension.select(
            F.col(dim_key).alias(key), *[F.col(c).alias(c + suffix) for c in columns]
        )
        out = out.join(side, out[fact_key] == side[key], how).drop(key)
    return out


def union_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    """UNION ALL by column name."""
    return reduce(DataFrame.unionByName, others, first)


def union_distinct(first: DataFrame, *others: DataFrame) -> DataFrame:
    return union_all(first, *others).distinct()


def append_rows(df: DataFrame, rows: Sequence[dict]) -> DataFrame:
    """Content of ``df`` after appending literal rows; absent columns are null."""
    names = set(df.columns)
    for row in rows:
        unknown = set(row) - names
        if unknown:
            raise ValueError(f"unknown columns: {sorted(unknown)}")
    one = df.sparkSession.range(1)
    literals = [
        one.select(*[F.lit(r.get(f.name)).cast(f.dataType).alias(f.name) for f in df.schema.fields])
        for r in rows
    ]
    return reduce(DataFrame.union, literals, df)
