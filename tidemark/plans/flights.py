"""Flight movements: yearly files and the airport list to typed tables, and reports."""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import map_labels, parse_date, safe_int
from tidemark.operators.aggregate import top_k
from tidemark.operators.clean import drop_columns, fill_defaults, rename_columns
from tidemark.operators.relational import join_dimension_twice, union_all

# Headers of the delivered files and the target columns.
FLIGHT_COLUMNS = {
    "Fecha": "fecha",
    "Hora UTC": "horautc",
    "Clase de Vuelo (todos los vuelos)": "clase_de_vuelo",
    "Clasificación Vuelo": "clasificacion_de_vuelo",
    "Tipo de Movimiento": "tipo_de_movimiento",
    "Aeropuerto": "aeropuerto",
    "Origen / Destino": "origen_destino",
    "Aerolinea Nombre": "aerolinea_nombre",
    "Aeronave": "aeronave",
    "Pasajeros": "pasajeros",
}
AIRPORT_COLUMNS = (
    "aeropuerto", "oac", "iata", "tipo", "denominacion", "coordenadas", "latitud", "longitud",
    "elev", "uom_elev", "ref", "distancia_ref", "direccion_ref", "condicion", "control",
    "region", "uso", "trafico", "sna", "concesionado", "provincia",
)
DOMESTIC = "Domestico"
# The second year's file spells the label with an accent.
DOMESTIC_SPELLINGS = {"Doméstico": DOMESTIC}
LANDING = "Aterrizaje"
TAKE_OFF = "Despegue"
MISSING = "0"
BUENOS_AIRES = ("CIUDAD AUTÓNOMA DE BUENOS AIRES", "BUENOS AIRES")


def flights_clean(
    *years: DataFrame, spellings: Mapping[str, str] = DOMESTIC_SPELLINGS
) -> DataFrame:
    """Domestic movements of several yearly files as one typed table."""
    raw = union_all(*[drop_columns(y, "Calidad dato") for y in years])
    renamed = rename_columns(raw, FLIGHT_COLUMNS)
    # Filtered on the delivered spellings, before the relabelling, so a scan can use it.
    domestic = renamed.where(F.col("clasificacion_de_vuelo").isin(DOMESTIC, *spellings))
    return (
        fill_defaults(domestic, {"pasajeros": 0})
        .withColumn("clasificacion_de_vuelo", map_labels("clasificacion_de_vuelo", spellings))
        .withColumn("fecha", parse_date("fecha", "dd/MM/yyyy"))
        .withColumn("pasajeros", safe_int("pasajeros"))
        .select(*FLIGHT_COLUMNS.values())
    )


def airports_clean(raw: DataFrame) -> DataFrame:
    kept = fill_defaults(drop_columns(raw, "inhab", "fir"), {"distancia_ref": 0})
    renamed = rename_columns(kept, {"local": "aeropuerto", "oaci": "oac"})
    numbers = ("elev", "distancia_ref")
    return renamed.select(
        *[F.col(n).try_cast("float" if n in numbers else "string").alias(n)
          for n in AIRPORT_COLUMNS]
    )


def _between(first: str, last: str) -> Column:
    days = [F.lit(datetime.date.fromisoformat(d)) for d in (first, last)]
    return F.col("fecha").between(*days)


def flights_between_dates(
    flights: DataFrame, first: str = "2021-12-01", last: str = "2022-01-31"
) -> DataFrame:
    return flights.where(_between(first, last)).agg(F.count(F.lit(1)).alias("flights"))


def airline_passengers(
    flights: DataFrame,
    airline: str = "AEROLINEAS ARGENTINAS SA",
    first: str = "2021-01-01",
    last: str = "2022-06-30",
) -> DataFrame:
    return flights.where((F.col("aerolinea_nombre") == airline) & _between(first, last)).agg(
        F.sum("pasajeros").alias("passengers")
    )


def _with_cities(flights: DataFrame, airports: DataFrame) -> DataFrame:
    """City of departure and of arrival. Both airports must be known.

    The record's airport is the departure, except on a landing.
    """
    both = join_dimension_twice(
        flights,
        airports,
        ("aeropuerto", "aeropuerto"),
        ("origen_destino", "aeropuerto"),
        ["provincia"],
        ("_own", "_other"),
    )
    movement = F.col("tipo_de_movimiento")
    own, other = F.col("provincia_own"), F.col("provincia_other")
    return both.withColumn(
        "ciudad_origen", F.when(movement == LANDING, other).otherwise(own)
    ).withColumn("ciudad_destino", F.when(movement == TAKE_OFF, other).otherwise(own))


def flight_origin_destination(
    flights: DataFrame, airports: DataFrame, first: str = "2022-01-01", last: str = "2022-06-30"
) -> DataFrame:
    return (
        _with_cities(flights.where(_between(first, last)), airports)
        .select(
            "fecha",
            "horautc",
            "aeropuerto",
            "origen_destino",
            "ciudad_origen",
            "ciudad_destino",
            "pasajeros",
        )
        .orderBy(
            F.desc("fecha"), "horautc", "aeropuerto", "origen_destino", "pasajeros"
        )
    )


def top10_airlines(
    flights: DataFrame, first: str = "2021-01-01", last: str = "2022-06-30", k: int = 10
) -> DataFrame:
    named = F.col("aerolinea_nombre").isNotNull() & (F.col("aerolinea_nombre") != MISSING)
    totals = (
        flights.where(named & _between(first, last))
        .groupBy("aerolinea_nombre")
        .agg(F.sum("pasajeros").alias("cant_pasajeros"))
    )
    return top_k(totals, [F.desc_nulls_last("cant_pasajeros"), F.asc("aerolinea_nombre")], k)


def top10_aircraft_from_city(
    flights: DataFrame,
    airports: DataFrame,
    cities: Sequence[str] = BUENOS_AIRES,
    first: str = "2021-01-01",
    last: str = "2022-06-30",
    k: int = 10,
) -> DataFrame:
    used = flights.where((F.col("aeronave") != MISSING) & _between(first, last))
    totals = (
        _with_cities(used, airports)
        .where(F.col("ciudad_origen").isin(*cities))
        .groupBy("aeronave")
        .agg(F.count("aeronave").alias("vuelos"))
    )
    return top_k(totals, [F.desc("vuelos"), F.asc("aeronave")], k)
