"""Taxi-trip queries and table loads.

Inputs are raw trips as delivered: CSV text columns or typed parquet columns under
the public record names (``tpep_pickup_datetime``, ``passenger_count``, ...).
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import money, ratio, safe_int
from tidemark.operators.aggregate import top_k
from tidemark.operators.relational import union_all

CREDIT_CARD = 1
CASH = 2


def _number(name: str) -> Column:
    return F.col(name).try_cast("double").alias(name)


def _integer(raw: DataFrame, name: str) -> Column:
    if raw.schema[name].dataType.typeName() == "string":
        return safe_int(name).alias(name)
    return F.col(name).cast("int").alias(name)


def _pickup(raw: DataFrame) -> Column:
    name = "tpep_pickup_datetime"
    if raw.schema[name].dataType.typeName() == "string":
        return F.col(name).try_cast("date").alias(name)
    return F.col(name).cast("date").alias(name)


def _day(value: str | datetime.date) -> Column:
    day = datetime.date.fromisoformat(value) if isinstance(value, str) else value
    return F.lit(day)


def on_day(raw: DataFrame, value: str | datetime.date) -> Column:
    """Pickup on one day, as a range a file scan can use on a timestamp column."""
    start = datetime.date.fromisoformat(value) if isinstance(value, str) else value
    kind = raw.schema["tpep_pickup_datetime"].dataType.typeName()
    if kind == "string":
        return _pickup(raw) == F.lit(start)
    c = F.col("tpep_pickup_datetime")
    end = start + datetime.timedelta(days=1)
    return (c >= F.lit(start).cast(kind)) & (c < F.lit(end).cast(kind))


def cheap_trips(raw: DataFrame, below: float = 10) -> DataFrame:
    return raw.select(
        _integer(raw, "VendorID"), _pickup(raw), _number("total_amount").cast("float")
    ).where(F.col("total_amount") < below)


def top10_revenue_days(raw: DataFrame, k: int = 10) -> DataFrame:
    days = raw.groupBy(_pickup(raw)).agg(
        F.sum(money(F.col("total_amount").try_cast("double"))).alias("total")
    )
    top = top_k(days, [F.desc_nulls_last("total"), F.asc("tpep_pickup_datetime")], k)
    return top.select("tpep_pickup_datetime", F.col("total").cast("double").alias("revenue"))


def lowest_revenue_long_trips(
    raw: DataFrame, tie: str, over: float = 10, k: int | None = 10
) -> DataFrame:
    trips = raw.select(_number("trip_distance"), _number("total_amount"), tie).where(
        F.col("trip_distance") > over
    )
    order = [F.asc_nulls_last("total_amount"), F.asc(tie)]
    out = trips.orderBy(*order) if k is None else top_k(trips, order, k)
    return out.select("trip_distance", "total_amount")


def card_trips_over_two_passengers(
    raw: DataFrame, tie: str, payment_type: int = CREDIT_CARD, more_than: int = 2
) -> DataFrame:
    return (
        raw.select(
            _number("trip_distance"),
            _pickup(raw),
            _integer(raw, "passenger_count"),
            _integer(raw, "payment_type"),
            tie,
        )
        .where((F.col("passenger_count") > more_than) & (F.col("payment_type") == payment_type))
        .orderBy(F.desc_nulls_last("tpep_pickup_datetime"), F.asc(tie))
        .select("trip_distance", "tpep_pickup_datetime")
    )


def top_tips_long_trips(
    raw: DataFrame, tie: str, over: float = 10, k: int | None = 7
) -> DataFrame:
    trips = raw.select(
        _number("trip_distance"),
        _pickup(raw),
        _integer(raw, "passenger_count"),
        _number("tip_amount"),
        tie,
    ).where(F.col("trip_distance") > over)
    order = [F.desc_nulls_last("tip_amount"), F.asc(tie)]
    out = trips.orderBy(*order) if k is None else top_k(trips, order, k)
    return out.drop(tie)


def amount_by_ratecode(raw: DataFrame, excluded: str = "Group Ride") -> DataFrame:
    amount = money(F.col("total_amount").try_cast("double"))
    return (
        raw.where(F.col("RatecodeID") != excluded)
        .groupBy("RatecodeID")
        .agg(F.sum(amount).alias("_sum"), F.count(amount).alias("_n"))
        .select(
            "RatecodeID",
            F.col("_sum").cast("double").alias("total"),
            ratio(F.col("_sum"), F.col("_n")).alias("average"),
        )
        .orderBy(F.asc_nulls_last("RatecodeID"))
    )


def load_payments(
    raw: DataFrame, payment_type: int = CREDIT_CARD, limit: int | None = None
) -> DataFrame:
    rows = raw.select(
        _integer(raw, "VendorID"), _pickup(raw), _integer(raw, "payment_type"),
        _number("total_amount"),
    ).where(F.col("payment_type") == payment_type)
    return rows if limit is None else rows.limit(limit)


def load_passengers(raw: DataFrame, more_than: int = 2, over: float = 8) -> DataFrame:
    return raw.select(
        _pickup(raw), _integer(raw, "passenger_count"), _number("total_amount")
    ).where((F.col("passenger_count") > more_than) & (F.col("total_amount") > over))


def load_tolls(raw: DataFrame, over: float = 0.1, more_than: int = 1) -> DataFrame:
    return raw.select(
        _pickup(raw),
        _integer(raw, "passenger_count"),
        _number("tolls_amount"),
        _number("total_amount"),
    ).where((F.col("tolls_amount") > over) & (F.col("passenger_count") > more_than))


def load_congestion(raw: DataFrame, day: str = "2021-01-18") -> DataFrame:
    return (
        raw.where(on_day(raw, day))
        .select(
            _pickup(raw),
            _integer(raw, "passenger_count"),
            _number("congestion_surcharge"),
            _number("total_amount"),
        )
        .where(F.col("congestion_surcharge") != 0)
    )


def load_distance(
    raw: DataFrame, day: str = "2021-01-31", passengers: int = 1, over: float = 15
) -> DataFrame:
    return (
        raw.where(on_day(raw, day))
        .select(
            _pickup(raw),
            _integer(raw, "passenger_count"),
            _number("trip_distance"),
            _number("total_amount"),
        )
        .where((F.col("passenger_count") == passengers) & (F.col("trip_distance") > over))
    )


def single_passenger_long_trips(
    raw: DataFrame, passengers: int = 1, over: float = 5
) -> DataFrame:
    """Whole rows, as delivered."""
    return raw.where(
        (F.col("passenger_count").try_cast("double") == passengers)
        & (F.col("trip_distance").try_cast("double") > over)
    )


def airport_trips_cash(*months: DataFrame, payment_type: int = CASH) -> DataFrame:
    """Cash trips with an airport fee (a fee of zero counts) over several months."""
    names = [
        "tpep_pickup_datetime",
        "payment_type",
        "airport_fee",
        "tolls_amount",
        "total_amount",
    ]
    raw = union_all(*[m.select(*names) for m in months])
    return raw.select(
        _pickup(raw),
        _integer(raw, "payment_type"),
        *[_number(n).cast("float") for n in names[2:]],
    ).where(F.col("airport_fee").isNotNull() & (F.col("payment_type") == payment_type))
