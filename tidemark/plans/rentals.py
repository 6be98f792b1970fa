"""Car rentals: listing and state files to one typed table, and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import ratio, round_to_int, safe_int
from tidemark.operators.aggregate import top_k
from tidemark.operators.clean import rename_columns
from tidemark.operators.relational import semi

# Headers of the delivered files and the target columns.
RENTAL_COLUMNS = {
    "fuelType": "fueltype",
    "rating": "rating",
    "renterTripsTaken": "rentertripstaken",
    "reviewCount": "reviewcount",
    "location.city": "city",
    "location.state": "state_name",
    "owner.id": "owner_id",
    "rate.daily": "rate_daily",
    "vehicle.make": "make",
    "vehicle.model": "model",
    "vehicle.year": "year",
}
STATE_KEY = "United States Postal Service state abbreviation"
ECO_FUELS = ("hybrid", "electric")
TEXAS = "TX"
_INTEGERS = ("rentertripstaken", "reviewcount", "rate_daily", "year")


def car_rental_clean(raw: DataFrame, states: DataFrame, excluded: str = TEXAS) -> DataFrame:
    """Rated listings of known states, without one state.

    Only the key of the state list survives the join, so a membership test does.
    Ratings round to one digit and truncate; unrated and zero-rated listings go.
    """
    listings = rename_columns(raw, RENTAL_COLUMNS).select(*RENTAL_COLUMNS.values())
    known = states.select(F.col(f"`{STATE_KEY}`").alias("state_key"))
    kept = semi(
        listings.where(F.col("state_name") != excluded), known, [("state_name", "state_key")]
    )
    return (
        kept.withColumn("rating", round_to_int("rating", 1))
        .where(F.col("rating") != 0)
        .withColumns({n: safe_int(n) for n in _INTEGERS})
        .withColumn("fueltype", F.lower("fueltype"))
    )


def eco_rentals_rated(
    rentals: DataFrame, at_least: int = 4, fuels: Sequence[str] = ECO_FUELS
) -> DataFrame:
    return rentals.where(F.col("fueltype").isin(*fuels) & (F.col("rating") >= at_least)).agg(
        F.count(F.lit(1)).alias("rentals")
    )


def _rentals_per(rentals: DataFrame, *keys: str) -> DataFrame:
    return rentals.groupBy(*keys).agg(F.count(keys[0]).alias("rentals"))


def bottom_states(rentals: DataFrame, k: int = 5) -> DataFrame:
    return top_k(
        _rentals_per(rentals, "state_name"),
        [F.asc("rentals"), F.asc_nulls_last("state_name")],
        k,
    )


def top_models(rentals: DataFrame, k: int = 10) -> DataFrame:
    totals = _rentals_per(rentals, "model", "make")
    return top_k(
        totals, [F.desc("rentals"), F.asc_nulls_last("make"), F.asc_nulls_last("model")], k
    ).select("make", "model", "rentals")


def rentals_by_year(rentals: DataFrame, first: int = 2010, last: int = 2015) -> DataFrame:
    return _rentals_per(rentals.where(F.col("year").between(first, last)), "year")


def top_eco_cities(
    rentals: DataFrame, k: int = 5, fuels: Sequence[str] = ECO_FUELS
) -> DataFrame:
    eco = rentals.where(F.col("fueltype").isin(*fuels))
    return top_k(
        _rentals_per(eco, "city"), [F.desc("rentals"), F.asc_nulls_last("city")], k
    )


def reviews_by_fuel(rentals: DataFrame) -> DataFrame:
    return (
        rentals.groupBy("fueltype")
        .agg(F.sum("reviewcount").alias("total"), F.count("reviewcount").alias("_n"))
        .select("fueltype", ratio(F.col("total"), F.col("_n")).alias("average"), "total")
        .orderBy(F.desc_nulls_last("average"), F.asc_nulls_last("fueltype"))
    )
