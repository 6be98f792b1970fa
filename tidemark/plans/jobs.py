"""Whole jobs: files or databases in, warehouse tables out.

Each job reads its sources, applies the plan and loads the target, creating database
and table where absent. Loads overwrite, so a job can be run again after a failure;
``mode='append'`` adds instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import flights, logs, marts, races, rentals, staff, survivors, trips
from tidemark.sources.files import read_csv, read_json, read_parquet
from tidemark.sources.jdbc import import_jdbc
from tidemark.sources.tables import create_database, create_table, load, replace_table

# Declared columns of the target tables.
TARGETS = {
    "airport_trips": "tpep_pickup_datetetime timestamp, payment_type int, airport_fee float, "
    "tolls_amount float, total_amount float",
    "driver_results": "driver_forename string, driver_surname string, "
    "driver_nationality string, points int",
    "constructor_results": "constructorRef string, cons_name string, cons_nationality string, "
    "url string, points int",
    "products_sold": "customer_id string, company_name string, quantity int",
    "products_sent": "order_id string, shipped_date date, company_name string, phone string, "
    "unit_price_discount float, quantity int, total_price float",
    "titanic": "PassengerId int, Survived int, Pclass int, Name string, Sex string, Age int, "
    "Ticket string, Fare float, Cabin string, Embarked string, avg_age_by_gender float",
    "aeropuerto_tabla": "fecha date, horautc string, clase_de_vuelo string, "
    "clasificacion_de_vuelo string, tipo_de_movimiento string, aeropuerto string, "
    "origen_destino string, aerolinea_nombre string, aeronave string, pasajeros int",
    "aeropuerto_detalles_tabla": ", ".join(
        f"{n} {'float' if n in ('elev', 'distancia_ref') else 'string'}"
        for n in flights.AIRPORT_COLUMNS
    ),
    "car_rental_analytics": "fueltype string, rating int, rentertripstaken int, "
    "reviewcount int, city string, state_name string, owner_id string, rate_daily int, "
    "make string, model string, year int",
}


def _load(df: DataFrame, database: str, table: str, mode: str) -> str:
    """Load by position into the declared table; returns its name."""
    spark, name = df.sparkSession, f"{database}.{table}"
    create_database(spark, database)
    create_table(spark, name, TARGETS[table])
    load(df, name, mode=mode, by="position")
    return name


def trip_tables(spark: SparkSession, path: str, database: str, day_congestion="2021-01-18",
                day_distance="2021-01-31") -> list[str]:
    """Five tables of one trips file; each takes the schema of its frame."""
    raw = read_csv(spark, path)
    create_database(spark, database)
    frames = {
        "payments": trips.load_payments(raw),
        "passengers": trips.load_passengers(raw),
        "tolls": trips.load_tolls(raw),
        "congestion": trips.load_congestion(raw, day_congestion),
        "distance": trips.load_distance(raw, day_distance),
    }
    for table, frame in frames.items():
        replace_table(frame, f"{database}.{table}")
    return [f"{database}.{t}" for t in frames]


def airport_trips(
    spark: SparkSession, months: Sequence[str], database: str, mode: str = "overwrite"
) -> str:
    frames = [read_parquet(spark, m) for m in months]
    return _load(trips.airport_trips_cash(*frames), database, "airport_trips", mode)


def long_single_trips(spark: SparkSession, path: str, table: str) -> str:
    replace_table(trips.single_passenger_long_trips(read_csv(spark, path)), table)
    return table


def race_results(
    spark: SparkSession, folder: str, database: str, mode: str = "overwrite"
) -> list[str]:
    names = ("results", "drivers", "constructors", "races")
    results, drivers, constructors, held = (read_csv(spark, f"{folder}/{n}.csv") for n in names)
    return [
        _load(races.driver_points(results, drivers), database, "driver_results", mode),
        _load(
            races.top_constructor_points(results, constructors, held),
            database,
            "constructor_results",
            mode,
        ),
    ]


def ip_matches(spark: SparkSession, may_json: str, april_csv: str, table: str) -> str:
    create_database(spark, table.split(".")[0])
    may = read_json(spark, may_json, logs.USER_LOG)
    replace_table(logs.same_ip_across_months(may, read_csv(spark, april_csv)), table)
    return table


def import_orders(
    spark: SparkSession, url: str, lake: str, num_partitions: int = 8, **options: str
) -> dict[str, str]:
    """Three extracts of the order-entry database as parquet directories.

    The joins run in the database; each read is split over ranges of the order number.
    """
    queries = {
        "clientes": "select o.order_id, c.customer_id, c.company_name, d.quantity "
        "from order_details d join orders o on o.order_id = d.order_id "
        "join customers c on c.customer_id = o.customer_id",
        "envios": "select o.order_id, o.shipped_date, c.company_name, c.phone "
        "from customers c join orders o on o.customer_id = c.customer_id",
        "order_details": "select order_id, unit_price, quantity, discount from order_details",
    }
    for name, sql in queries.items():
        import_jdbc(spark, url, f"{lake}/{name}", query=sql, partition="order_id",
                    num_partitions=num_partitions, **options)
    return {name: f"{lake}/{name}" for name in queries}


def order_marts(
    spark: SparkSession, lake: str, database: str, unit: str = "s", mode: str = "overwrite"
) -> list[str]:
    sold = read_parquet(spark, f"{lake}/clientes").select(
        "customer_id", "company_name", "quantity"
    )
    sent = marts.products_sent_discounted(
        read_parquet(spark, f"{lake}/envios"), read_parquet(spark, f"{lake}/order_details"), unit
    )
    return [
        _load(marts.products_sold_above_average(sold), database, "products_sold", mode),
        _load(sent, database, "products_sent", mode),
    ]


def passenger_list(
    spark: SparkSession, path: str, database: str, mode: str = "overwrite"
) -> str:
    return _load(survivors.titanic_clean(read_csv(spark, path)), database, "titanic", mode)


def flight_tables(
    spark: SparkSession,
    years: Sequence[str],
    airports: str,
    database: str,
    mode: str = "overwrite",
) -> list[str]:
    movements = flights.flights_clean(*[read_csv(spark, y, sep=";") for y in years])
    details = flights.airports_clean(read_csv(spark, airports, sep=";"))
    return [
        _load(movements, database, "aeropuerto_tabla", mode),
        _load(details, database, "aeropuerto_detalles_tabla", mode),
    ]


def rental_table(
    spark: SparkSession, listings: str, states: str, database: str, mode: str = "overwrite"
) -> str:
    clean = rentals.car_rental_clean(
        read_csv(spark, listings), read_csv(spark, states, sep=";")
    )
    return _load(clean, database, "car_rental_analytics", mode)


def churn_table(
    spark: SparkSession, leavers: str, ranges: str, managers: str, table: str, loaded_at=None
) -> str:
    features = staff.churn_features(
        read_csv(spark, leavers),
        read_csv(spark, ranges, "Rango string, desde int, hasta int"),
        read_csv(spark, managers),
        loaded_at=loaded_at,
    )
    create_database(spark, table.split(".")[0])
    replace_table(features, table)
    return table
