"""Cleaning steps on frames: names, defaults, safe casts with a count of rejects."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import safe_int


def normalize_columns(df: DataFrame, renames: Mapping[str, str] | None = None) -> DataFrame:
    """Explicit renames, then lower case with anything but letters and digits as ``_``.

    Works on names with dots, spaces, slashes, accents and parentheses. Two columns
    that end up with one name are an error.
    """
    renames = dict(renames or {})
    names = [renames.get(n) or _plain(n) for n in df.columns]
    double = sorted({n for n in names if names.count(n) > 1})
    if double:
        raise ValueError(f"columns would share a name: {double}")
    return df.toDF(*names)


def _plain(name: str) -> str:
    decomposed = unicodedata.normalize("NFKD", name)
    ascii_only = "".join(ch for ch in decomposed if not unicodedata.combining(ch))
    return re.sub(r"[^0-9a-z]+", "_", ascii_only.lower()).strip("_")


def rename_columns(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    """Rename the listed columns, whatever characters they hold; others are kept."""
    return df.withColumnsRenamed(dict(renames))


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Drop by name; an absent name is ignored and a repeated name drops every holder."""
    return df.drop(*names)


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Replace nulls; the default is cast to the column's type (0 becomes '0' in text)."""
    return df.fillna(dict(defaults))


def _typed(column: Column, kind: str) -> Column:
    return safe_int(column) if kind == "int" else column.try_cast(kind)


def safe_cast(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast text columns; a value that does not read as the type becomes null."""
    return df.withColumns({name: _typed(F.col(name), kind) for name, kind in types.items()})


def cast_rejects(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """One row: per column, how many values ``safe_cast`` would turn to null."""
    counts = [
        F.count_if(F.col(n).isNotNull() & _typed(F.col(n), kind).isNull()).alias(n)
        for n, kind in types.items()
    ]
    return df.agg(*counts)
