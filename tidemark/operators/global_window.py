"""ROW_NUMBER, RANK, LAG and LEAD over one global order, without one global task.

A window with an order but no partition sends every row to a single task. Here the
rows are cut into ranges of the sort key instead:

1. a bounded sample of the sort key gives cut points, embedded as literals, so the
   range of a row is a deterministic function of its key (a retried task agrees);
2. each range is windowed on its own;
3. one summary row per range (its row count, or its edge value) is prefix-summed or
   shifted and broadcast back. Its size is bounded by the number of ranges.

Rows are numbered on (order, tie); the tie columns should make the key unique, so
that no key is heavier than one row and every range can be cut further. Where they do
not, and copies are found to outweigh a range, they are told apart by a written id. RANK only
looks at the order columns. A key that coincides with a cut point, as any heavy key
does, gets a range of its own. All rows there share one rank, so they need no
window and no shuffle at all, however many there are.

Nulls sort last in both directions. Inputs are read by several jobs (count, sample,
summary, result): pass derived frames through ``session.materialize`` first.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import materialize

Order = Sequence[str | tuple[str, str]]

ROWS_PER_RANGE = 2_000_000
MAX_RANGES = 20_000
SAMPLES_PER_RANGE = 20
_SEED = 17


@dataclass(frozen=True)
class _Key:
    name: str
    descending: bool

    def sort(self) -> Column:
        c = F.col(self.name)
        return c.desc_nulls_last() if self.descending else c.asc_nulls_last()

    def reverse(self) -> Column:
        c = F.col(self.name)
        return c.asc_nulls_first() if self.descending else c.desc_nulls_first()

    def after(self, cut: Column, has_null: bool) -> Column:
        """Whether the row sorts after a cut value (nulls last)."""
        own = F.col(self.name)
        after = (cut > own) if self.descending else (cut < own)
        # Unknown means one of the two is null; without null cuts it is the row's.
        return F.coalesce(after, cut.isNotNull() & own.isNull() if has_null else F.lit(True))

    def equals(self, cut: Column, has_null: bool) -> Column:
        own = F.col(self.name)
        return cut.eqNullSafe(own) if has_null else F.coalesce(cut == own, F.lit(False))


def _keys(order: Order) -> list[_Key]:
    out = []
    for item in order:
        name, direction = (item, "asc") if isinstance(item, str) else item
        if direction not in ("asc", "desc"):
            raise ValueError("direction must be asc or desc")
        out.append(_Key(name, direction == "desc"))
    return out


def _plan_ranges(
    df: DataFrame, keys: list[_Key], ranges: int | None, whole_key: bool = False
) -> list[tuple] | None:
    """Cut points (key values, in order), or None when one task is enough.

    A cut is as short a prefix of the key as keeps the cuts apart: leading columns
    without heavy values are cheaper to compare alone. ``whole_key`` keeps all columns.
    """
    frame = df.select(*[k.name for k in keys])
    rows = frame.count()
    if ranges is None:
        # Several ranges per task even out what hashing the range numbers does not.
        parallel = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        ranges = min(MAX_RANGES, max(parallel, rows // ROWS_PER_RANGE))
    if ranges <= 1 or rows == 0:
        return None
    wanted = SAMPLES_PER_RANGE * ranges
    if rows > wanted:
        frame = frame.sample(False, min(1.0, 1.2 * wanted / rows), _SEED)
    sample = frame.orderBy(*[k.sort() for k in keys]).collect()
    if not sample:
        return None
    picked = [tuple(sample[i * len(sample) // ranges]) for i in range(1, ranges)]
    if whole_key:
        return list(dict.fromkeys(picked))
    for length in range(1, len(keys) + 1):
        cuts = [cut[:length] for cut in picked]
        if len(set(cuts)) == len(cuts):
            break
    return cuts


def _ranges_of_rows(df: DataFrame, keys: list[_Key], ranges: int | None):
    """(rows, sort key, cuts) for numbering single rows.

    Where even the whole key repeats so often that two cuts agree, as with masses of
    exact copies, the rows get a further tie-breaker, written out so that it stays.
    """
    cuts = _plan_ranges(df, keys, ranges)
    if cuts is not None and len(set(cuts)) < len(cuts) and df.count() > len(cuts):
        df = materialize(df.withColumn("_copy", F.monotonically_increasing_id()))
        keys = [*keys, _Key("_copy", False)]
        cuts = _plan_ranges(df, keys, len(cuts) + 1)
    return df, keys, None if cuts is None else list(dict.fromkeys(cuts))


def _cut_array(df: DataFrame, keys: list[_Key], cuts: list[tuple]) -> Column:
    """The cuts as one literal array of structs, which the optimizer folds.

    Only their order matters for the result, not that a value survives unchanged.
    """
    width = len(cuts[0])
    fields = [
        T.StructField(f"k{i}", df.schema[k.name].dataType) for i, k in enumerate(keys[:width])
    ]
    rows = [{f"k{i}": v for i, v in enumerate(cut) if v is not None} for cut in cuts]
    text = json.dumps(rows, default=lambda v: v.isoformat() if hasattr(v, "isoformat") else str(v))
    return F.from_json(F.lit(text), T.ArrayType(T.StructType(fields)), {"mode": "FAILFAST"})


def _range_number(df: DataFrame, keys: list[_Key], cuts: list[tuple]) -> Column:
    """Number of cuts at or before the row, by binary search."""
    array, nulls = _cut_array(df, keys, cuts), _null_columns(cuts)

    def at_or_before(index: Column) -> Column:
        cut = F.get(array, index)
        result = F.lit(True)
        for i, has_null in reversed(list(enumerate(nulls))):
            value = cut[f"k{i}"]
            result = keys[i].after(value, has_null) | (keys[i].equals(value, has_null) & result)
        return result

    steps = [1 << b for b in reversed(range(len(cuts).bit_length()))]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda low, step: F.when(
            (low + step <= len(cuts)) & at_or_before(low + step - 1), low + step
        ).otherwise(low),
    )


def _null_columns(cuts: list[tuple]) -> list[bool]:
    return [any(v is None for v in column) for column in zip(*cuts, strict=True)]


def _on_cut(df: DataFrame, keys: list[_Key], cuts: list[tuple]) -> Column:
    """Whether the row's key is the last cut at or before it."""
    last = F.get(_cut_array(df, keys, cuts), F.col("_range") - 1)
    same = [
        keys[i].equals(last[f"k{i}"], has_null) for i, has_null in enumerate(_null_columns(cuts))
    ]
    return (F.col("_range") > 0) & reduce(lambda a, b: a & b, same)


def _with_offsets(counts: DataFrame, key: str) -> DataFrame:
    before = Window.orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")
    return F.broadcast(counts.select(F.col(key).alias("_summary_key"), offset))


def _ordering(keys: list[_Key]) -> list[Column]:
    return [k.sort() for k in keys]


def global_row_number(
    df: DataFrame, order: Order, tie: Order, name: str = "row_number", ranges: int | None = None
) -> DataFrame:
    """``row_number() OVER (ORDER BY order, tie)`` as bigint."""
    keys = _keys([*order, *tie])
    df, keys, cuts = _ranges_of_rows(df, keys, ranges)
    if cuts is None:
        return df.withColumn(
            name, F.row_number().over(Window.orderBy(*_ordering(keys))).cast("bigint")
        )
    ranged = df.withColumn("_range", _range_number(df, keys, cuts))
    offsets = _with_offsets(
        ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows")), "_range"
    )
    local = F.row_number().over(Window.partitionBy("_range").orderBy(*_ordering(keys)))
    return (
        ranged.withColumn("_local", local)
        .join(offsets, F.col("_range") == F.col("_summary_key"))
        .withColumn(name, F.col("_offset") + F.col("_local"))
        .drop("_range", "_local", "_summary_key", "_offset", "_copy")
    )


def global_rank(
    df: DataFrame, order: Order, name: str = "rank", ranges: int | None = None
) -> DataFrame:
    """``rank() OVER (ORDER BY order)`` as bigint; equal keys share a rank."""
    keys = _keys(order)
    cuts = _plan_ranges(df, keys, ranges, whole_key=True)
    if cuts is None:
        return df.withColumn(name, F.rank().over(Window.orderBy(*_ordering(keys))).cast("bigint"))
    # Even numbers hold the rows equal to a cut point, odd ones the rows between.
    ranged = (
        df.withColumn("_range", _range_number(df, keys, cuts))
        .withColumn("_on_cut", _on_cut(df, keys, cuts))
        .withColumn("_part", 2 * F.col("_range") + F.when(F.col("_on_cut"), 0).otherwise(1))
    )
    offsets = _with_offsets(
        ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows")), "_part"
    )
    local = F.rank().over(Window.partitionBy("_part").orderBy(*_ordering(keys)))
    between = ranged.where(~F.col("_on_cut")).withColumn("_local", local)
    tied = ranged.where("_on_cut").withColumn("_local", F.lit(1))
    parts = [
        part.join(offsets, F.col("_part") == F.col("_summary_key"))
        .withColumn(name, F.col("_offset") + F.col("_local"))
        .drop("_range", "_on_cut", "_part", "_local", "_summary_key", "_offset")
        for part in (between, tied)
    ]
    return parts[0].unionByName(parts[1])


def global_lag(
    df: DataFrame,
    value: str,
    order: Order,
    tie: Order,
    name: str = "previous",
    ranges: int | None = None,
) -> DataFrame:
    """``lag(value, 1) OVER (ORDER BY order, tie)``."""
    return _shifted(df, value, order, tie, name, ranges, forward=False)


def global_lead(
    df: DataFrame,
    value: str,
    order: Order,
    tie: Order,
    name: str = "following",
    ranges: int | None = None,
) -> DataFrame:
    """``lead(value, 1) OVER (ORDER BY order, tie)``."""
    return _shifted(df, value, order, tie, name, ranges, forward=True)


def _shifted(df, value, order, tie, name, ranges, forward):
    keys = _keys([*order, *tie])
    df, keys, cuts = _ranges_of_rows(df, keys, ranges)
    shift = F.lead if forward else F.lag
    if cuts is None:
        return df.withColumn(name, shift(value, 1).over(Window.orderBy(*_ordering(keys))))
    ranged = df.withColumn("_range", _range_number(df, keys, cuts))
    within = Window.partitionBy("_range")
    # The row next to a range's edge: its last row for lag, its first for lead.
    edge_order = _ordering(keys) if forward else [k.reverse() for k in keys]
    edges = (
        ranged.select("_range", *{k.name for k in keys} | {value})
        .withColumn("_edge", F.row_number().over(within.orderBy(*edge_order)))
        .where(F.col("_edge") == 1)
        .select(F.col("_range").alias("_edge_range"), F.col(value).alias("_edge_value"))
    )
    neighbour = shift("_edge_value", 1).over(Window.orderBy("_edge_range"))
    fill = F.broadcast(
        edges.select(F.col("_edge_range").alias("_summary_key"), neighbour.alias("_fill"))
    )
    ordered = within.orderBy(*_ordering(keys))
    at_edge = shift(F.lit(1), 1).over(ordered).isNull()
    return (
        ranged.withColumn("_own", shift(value, 1).over(ordered))
        .withColumn("_at_edge", at_edge)
        .join(fill, F.col("_range") == F.col("_summary_key"))
        .withColumn(name, F.when(F.col("_at_edge"), F.col("_fill")).otherwise(F.col("_own")))
        .drop("_range", "_own", "_at_edge", "_summary_key", "_fill", "_copy")
    )
