from __future__ import annotations

from tidemark.catalog.registry import query
from tidemark.plans import flights as f

FIRST, LAST = "1997-01-01", "1999-06-30"
CITIES = ("AMERICA", "EUROPE")
RANGE = f"fecha BETWEEN DATE '{FIRST}' AND DATE '{LAST}'"
# A landing comes from the other end and goes to the own airport, a take-off the other way.
ENDS_SQL = """
    SELECT t.*, start.provincia AS ciudad_origen, goal.provincia AS ciudad_destino
    FROM (SELECT * FROM v_flights WHERE tipo_de_movimiento = '{kind}') t, v_airports start, v_airports goal
    WHERE start.aeropuerto = t.{start} AND goal.aeropuerto = t.{goal}"""
CITY_SQL = " UNION ALL ".join(
    (
        ENDS_SQL.format(kind="Aterrizaje", start="origen_destino", goal="aeropuerto"),
        ENDS_SQL.format(kind="Despegue", start="aeropuerto", goal="origen_destino"),
    )
)


def _flights(w):
    return f.flights_clean(w.flights_raw("Domestico", True), w.flights_raw("Doméstico", False))


def _airports(w):
    return f.airports_clean(w.airports_raw)


@query("flights_clean", "SELECT * FROM v_flights")
def _(w):
    return _flights(w)


@query(
    "airports_clean",
    """SELECT 'AP' || n_nationkey AS aeropuerto, 'SA' || n_nationkey AS oac,
              'I' || n_nationkey AS iata, 'Aeródromo' AS tipo, n_name AS denominacion,
              n_nationkey || 'S ' || n_nationkey || 'W' AS coordenadas,
              '-' || n_nationkey AS latitud, '-' || (n_nationkey + 40) AS longitud,
              CAST(n_nationkey * 12 + 0.5 AS FLOAT) AS elev, 'Metros' AS uom_elev, n_name AS ref,
              CAST(CASE WHEN n_nationkey % 4 > 0 THEN n_nationkey + 0.25 ELSE 0 END AS FLOAT)
                  AS distancia_ref,
              'NE' AS direccion_ref, 'PUBLICO' AS condicion, 'CONTROL' AS control,
              'R' || n_regionkey AS region, 'CIVIL' AS uso, 'Nacional' AS trafico, 'SI' AS sna,
              'NO' AS concesionado, r_name AS provincia
       FROM nation JOIN region ON r_regionkey = n_regionkey""",
)
def _(w):
    return _airports(w)


@query("flights_between_dates", f"SELECT count(*) AS flights FROM v_flights WHERE {RANGE}")
def _(w):
    return f.flights_between_dates(_flights(w), FIRST, LAST)


@query(
    "airline_passengers",
    f"""SELECT CAST(sum(pasajeros) AS BIGINT) AS passengers FROM v_flights
        WHERE aerolinea_nombre = 'Airline 7' AND {RANGE}""",
)
def _(w):
    return f.airline_passengers(_flights(w), "Airline 7", FIRST, LAST)


@query(
    "flight_origin_destination",
    f"""SELECT fecha, horautc, aeropuerto, origen_destino, ciudad_origen, ciudad_destino,
               pasajeros
        FROM ({CITY_SQL}) WHERE {RANGE}""",
)
def _(w):
    return f.flight_origin_destination(_flights(w), _airports(w), FIRST, LAST)


@query(
    "top10_airlines",
    f"""SELECT aerolinea_nombre, CAST(sum(pasajeros) AS BIGINT) AS cant_pasajeros
        FROM v_flights WHERE aerolinea_nombre <> '0' AND {RANGE}
        GROUP BY aerolinea_nombre ORDER BY cant_pasajeros DESC, aerolinea_nombre LIMIT 10""",
)
def _(w):
    return f.top10_airlines(_flights(w), FIRST, LAST)


@query(
    "top10_aircraft_from_city",
    f"""SELECT aeronave, count(*) AS vuelos FROM ({CITY_SQL})
        WHERE {RANGE} AND aeronave <> '0' AND ciudad_origen IN ('AMERICA', 'EUROPE')
        GROUP BY aeronave ORDER BY vuelos DESC, aeronave LIMIT 10""",
)
def _(w):
    return f.top10_aircraft_from_city(_flights(w), _airports(w), CITIES, FIRST, LAST)
