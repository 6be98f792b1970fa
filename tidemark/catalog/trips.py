from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.registry import query
from tidemark.plans import trips as t

DAY = "1998-06-15"


@query(
    "cheap_trips",
    """SELECT vendor_id AS "VendorID", pickup_date AS tpep_pickup_datetime,
              CAST(total_amount AS FLOAT) AS total_amount
       FROM v_trips WHERE CAST(total_amount AS FLOAT) < 5000""",
)
def _(w):
    return t.cheap_trips(w.trips, 5000)


@query(
    "top10_revenue_days",
    """SELECT pickup_date AS tpep_pickup_datetime,
              CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS revenue
       FROM v_trips GROUP BY pickup_date ORDER BY revenue DESC, pickup_date LIMIT 10""",
)
def _(w):
    return t.top10_revenue_days(w.trips)


@query(
    "lowest_revenue_long_trips",
    """SELECT trip_distance, total_amount FROM v_trips WHERE trip_distance > 10
       ORDER BY total_amount, trip_id LIMIT 10""",
)
def _(w):
    return t.lowest_revenue_long_trips(w.trips, "trip_id")


@query(
    "lowest_revenue_long_trips_all",
    "SELECT trip_distance, total_amount FROM v_trips WHERE trip_distance > 10",
)
def _(w):
    return t.lowest_revenue_long_trips(w.trips, "trip_id", k=None)


@query(
    "card_trips_over_two_passengers",
    """SELECT trip_distance, pickup_date AS tpep_pickup_datetime FROM v_trips
       WHERE passenger_count > 2 AND payment_type = 1""",
)
def _(w):
    return t.card_trips_over_two_passengers(w.trips, "trip_id")


@query(
    "top_tips_long_trips",
    """SELECT trip_distance, pickup_date AS tpep_pickup_datetime, passenger_count, tip_amount
       FROM v_trips WHERE trip_distance > 10 ORDER BY tip_amount DESC, trip_id LIMIT 7""",
)
def _(w):
    return t.top_tips_long_trips(w.trips, "trip_id")


@query(
    "amount_by_ratecode",
    """SELECT ratecode AS "RatecodeID", CAST(sum(a) AS DOUBLE) AS total,
              CAST(sum(a) AS DOUBLE) / count(a) AS average
       FROM (SELECT ratecode, CAST(total_amount AS DECIMAL(18,2)) AS a FROM v_trips)
       WHERE ratecode <> 'Group Ride' GROUP BY ratecode""",
)
def _(w):
    return t.amount_by_ratecode(w.trips)


@query(
    "load_payments",
    """SELECT vendor_id AS "VendorID", pickup_date AS tpep_pickup_datetime, payment_type,
              total_amount
       FROM v_trips WHERE payment_type = 1""",
)
def _(w):
    return t.load_payments(w.trips)


@query(
    "load_passengers",
    """SELECT pickup_date AS tpep_pickup_datetime, passenger_count, total_amount
       FROM v_trips WHERE passenger_count > 2 AND total_amount > 8""",
)
def _(w):
    return t.load_passengers(w.trips)


@query(
    "load_tolls",
    """SELECT pickup_date AS tpep_pickup_datetime, passenger_count, tolls_amount, total_amount
       FROM v_trips WHERE passenger_count > 1 AND tolls_amount > 0.05""",
)
def _(w):
    return t.load_tolls(w.trips, over=0.05)


@query(
    "load_congestion",
    f"""SELECT pickup_date AS tpep_pickup_datetime, passenger_count, congestion_surcharge,
               total_amount
        FROM v_trips WHERE pickup_date = DATE '{DAY}' AND congestion_surcharge <> 0""",
)
def _(w):
    return t.load_congestion(w.trips, DAY)


@query(
    "load_distance",
    f"""SELECT pickup_date AS tpep_pickup_datetime, passenger_count, trip_distance, total_amount
        FROM v_trips
        WHERE pickup_date = DATE '{DAY}' AND passenger_count = 1 AND trip_distance > 15""",
)
def _(w):
    return t.load_distance(w.trips, DAY)


@query(
    "single_passenger_long_trips",
    """SELECT trip_id, vendor_id AS "VendorID", pickup_date, passenger_count, trip_distance,
              total_amount
       FROM v_trips WHERE passenger_count = 1 AND trip_distance > 5""",
)
def _(w):
    return t.single_passenger_long_trips(w.trips).select(
        "trip_id",
        F.col("VendorID").cast("int").alias("VendorID"),
        F.col("tpep_pickup_datetime").cast("date").alias("pickup_date"),
        "passenger_count",
        "trip_distance",
        "total_amount",
    )


@query(
    "airport_trips_cash",
    """SELECT pickup_date AS tpep_pickup_datetime, payment_type,
              CAST(airport_fee AS FLOAT) AS airport_fee,
              CAST(tolls_amount AS FLOAT) AS tolls_amount,
              CAST(total_amount AS FLOAT) AS total_amount
       FROM v_trips WHERE payment_type = 2 AND airport_fee IS NOT NULL""",
)
def _(w):
    split = F.lit("1998-07-01").cast("timestamp_ntz")
    pickup = F.col("tpep_pickup_datetime")
    return t.airport_trips_cash(w.trips.where(pickup < split), w.trips.where(pickup >= split))
