"""Column expressions shared by the jobs. All are Catalyst expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: Column | str, precision: int = 18) -> Column:
    """Exact two-digit amount. Sums of it do not depend on the row order."""
    return _c(c).cast(f"decimal({precision},2)")


def ratio(total: Column, count: Column) -> Column:
    """Mean from an exact total, null on an empty group."""
    return F.when(count > 0, total.cast("double") / count)


def safe_int(c: Column | str) -> Column:
    """Text to int by truncation ('4.9' is 4); text that is no number is null."""
    number = _c(c).try_cast("double")
    return F.when(~F.isnan(number) & (F.abs(number) < F.lit(2147483648.0)), number).cast("int")


def parse_date(c: Column | str, *formats: str) -> Column:
    """First format that reads the text; null when none does."""
    return F.coalesce(*[F.try_to_date(_c(c), fmt) for fmt in formats])


def epoch_to_date(c: Column | str, unit: str = "s") -> Column:
    """UTC date of an epoch count in seconds or milliseconds, in any session zone."""
    if unit not in ("s", "ms"):
        raise ValueError("unit must be 's' or 'ms'")
    per_day = 86400 if unit == "s" else 86400000
    return F.date_from_unix_date(F.floor(_c(c) / F.lit(per_day)).cast("int"))


def map_labels(c: Column | str, mapping: Mapping[str, str]) -> Column:
    """Exact relabelling; a value without an entry is kept."""
    source = _c(c)
    out = source
    for old, new in mapping.items():
        out = F.when(source == F.lit(old), F.lit(new)).otherwise(out)
    return out


def round_to_int(c: Column | str, digits: int = 1) -> Column:
    """Round to ``digits`` and then truncate: 4.96 gives 5, 4.9 gives 4."""
    return F.round(_c(c).try_cast("float"), digits).cast("int")


def range_midpoint(low: Column | str, high: Column | str) -> Column:
    return (_c(low) + _c(high)) / F.lit(2)


def sign_label(difference: Column | str, above: str, equal: str, below: str) -> Column:
    """Label by sign; an unknown difference has no label."""
    d = _c(difference)
    return F.when(d > 0, F.lit(above)).when(d < 0, F.lit(below)).when(d == 0, F.lit(equal))


def tenure_days(start: Column | str, end: Column | str) -> Column:
    """Length in days as a fraction, for dates and for timestamps."""
    length = _c(end).cast("timestamp_ntz") - _c(start).cast("timestamp_ntz")
    seconds = length.cast("interval second").cast("decimal(18,6)").cast("double")
    return seconds / F.lit(86400.0)
