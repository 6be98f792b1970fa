"""Race-result marts: points per driver and per constructor."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import safe_int
from tidemark.operators.aggregate import top_k
from tidemark.operators.relational import join_on, semi


def _points(results: DataFrame) -> Column:
    kind = results.schema["points"].dataType.typeName()
    return safe_int("points") if kind == "string" else F.col("points").cast("int")


def driver_points(results: DataFrame, drivers: DataFrame) -> DataFrame:
    """Points are summed per driver before the lookup, so the join is one row each."""
    per_driver = results.groupBy("driverId").agg(F.sum(_points(results)).alias("driver_total"))
    return (
        join_on(per_driver, drivers, ["driverId"])
        .groupBy(
            F.col("forename").alias("driver_forename"),
            F.col("surname").alias("driver_surname"),
            F.col("nationality").alias("driver_nationality"),
        )
        .agg(F.sum("driver_total").alias("points"))
        .orderBy(
            F.desc_nulls_last("points"),
            "driver_forename",
            "driver_surname",
            "driver_nationality",
        )
    )


def _constructor_totals(results: DataFrame, constructors: DataFrame) -> DataFrame:
    per_key = results.groupBy("constructorId").agg(F.sum(_points(results)).alias("key_total"))
    return (
        join_on(per_key, constructors, ["constructorId"])
        .groupBy(
            "constructorRef",
            F.col("name").alias("cons_name"),
            F.col("nationality").alias("cons_nationality"),
            "url",
        )
        .agg(F.sum("key_total").alias("points"))
    )


def _best(totals: DataFrame, k: int) -> DataFrame:
    return top_k(totals, [F.desc_nulls_last("points"), F.asc_nulls_last("constructorRef")], k)


def top_constructor_points(
    results: DataFrame, constructors: DataFrame, races: DataFrame, k: int = 5
) -> DataFrame:
    """Constructors by points over all known races."""
    known = semi(results, races, ["raceId"])
    return _best(_constructor_totals(known, constructors), k)


def constructor_points_race_year(
    results: DataFrame,
    constructors: DataFrame,
    races: DataFrame,
    race: str,
    year: int,
    k: int = 5,
) -> DataFrame:
    """The same for one grand prix of one year."""
    held = races.where((F.col("name") == race) & (F.col("year").cast("int") == year))
    return _best(_constructor_totals(semi(results, held, ["raceId"]), constructors), k)
