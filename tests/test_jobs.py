from __future__ import annotations

import datetime
import uuid

import pytest
from pyspark.sql import functions as F

from tidemark.plans import jobs
from tidemark.sources import jdbc


@pytest.fixture()
def db():
    return f"job_{uuid.uuid4().hex[:8]}"


def _write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


TRIPS = (
    "VendorID,tpep_pickup_datetime,passenger_count,trip_distance,RatecodeID,payment_type,"
    "tip_amount,tolls_amount,congestion_surcharge,total_amount\n"
    "1,2021-01-18 10:00:00,3,20.5,1,1,5,0.2,2.5,9.99\n"
    "2,2021-01-31 23:59:59,1,16,Group Ride,2,1,0,0,30\n"
)


def test_trip_tables(spark, tmp_path, db):
    path = _write(tmp_path / "t.csv", TRIPS)
    for _ in range(2):
        names = jobs.trip_tables(spark, path, db)
    assert [spark.table(n).count() for n in names] == [1, 1, 1, 1, 1]
    kinds = {f.name: f.dataType.simpleString() for f in spark.table(f"{db}.payments").schema}
    assert kinds["tpep_pickup_datetime"] == "date" and kinds["total_amount"] == "double"
    jobs.long_single_trips(spark, path, f"{db}.long_trips")
    assert spark.table(f"{db}.long_trips").columns == TRIPS.split("\n")[0].split(",")


def test_airport_trips(spark, tmp_path, db):
    paths = []
    for month in (1, 2):
        paths.append(str(tmp_path / f"{month}.parquet"))
        spark.sql(
            f"select timestamp'2021-0{month}-05 10:00:00' tpep_pickup_datetime, 2L payment_type,"
            " 0.0D airport_fee, 1.0D tolls_amount, 9.5D total_amount"
            " union all select timestamp'2021-01-05 10:00:00', 2L, null, 1.0D, 9.5D"
        ).write.parquet(paths[-1])
    for _ in range(2):
        name = jobs.airport_trips(spark, paths, db)
    rows = spark.table(name).collect()
    assert sorted(r[0].month for r in rows) == [1, 2] and rows[0]["airport_fee"] == 0.0
    jobs.airport_trips(spark, paths, db, mode="append")
    assert spark.table(name).count() == 4


def test_race_results(spark, tmp_path, db):
    _write(tmp_path / "results.csv", "raceId,driverId,constructorId,points\n1,1,1,9.5\n2,1,2,4\n9,2,2,1\n")
    _write(tmp_path / "drivers.csv", "driverId,forename,surname,nationality\n1,A,B,X\n2,C,D,Y\n")
    _write(tmp_path / "constructors.csv",
           "constructorId,constructorRef,name,nationality,url\n1,r1,N1,X,u1\n2,r2,N2,Y,u2\n")
    _write(tmp_path / "races.csv", "raceId,year,name,url\n1,1991,G,u\n2,1992,G,u\n")
    a, b = jobs.race_results(spark, str(tmp_path), db)
    assert sorted(tuple(r) for r in spark.table(a).collect()) == [
        ("A", "B", "X", 13), ("C", "D", "Y", 1)]
    assert sorted((r[0], r[4]) for r in spark.table(b).collect()) == [("r1", 9), ("r2", 4)]


def test_ip_matches(spark, tmp_path, db):
    may = _write(tmp_path / "m.json", '{"id":1,"first_name":"A","last_name":"B","ip_address":"9"}\n')
    april = _write(tmp_path / "a.csv", "id,first_name,last_name,email,ip_address\n4,X,Y,e,9\n")
    name = jobs.ip_matches(spark, may, april, f"{db}.results")
    assert tuple(spark.table(name).first()) == (1, "A", "B", "X", "Y", "9")


def test_orders_from_database_to_marts(spark, tmp_path, db):
    url = f"jdbc:derby:memory:j{uuid.uuid4().hex};create=true"
    opts = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    tables = {
        "CUSTOMERS": "select * from values (1, 'Acme', '555'), (2, 'Bolt', '556')"
        " t(CUSTOMER_ID, COMPANY_NAME, PHONE)",
        "ORDERS": "select * from values (10, 1, 836438400L), (11, 2, 836524800L)"
        " t(ORDER_ID, CUSTOMER_ID, SHIPPED_DATE)",
        "ORDER_DETAILS": "select * from values (10, 5.0D, 2, 0.5D), (10, 3.0D, 9, 0.0D),"
        " (11, 8.0D, 1, 0.25D) t(ORDER_ID, UNIT_PRICE, QUANTITY, DISCOUNT)",
    }
    for name, sql in tables.items():
        df = spark.sql(sql)
        # Lower-case quoted names would not match the unquoted ones of a query.
        spark_cols = [F.col(c).alias(c) for c in df.columns]
        jdbc.write_jdbc(df.select(*spark_cols), url, name, **opts)
    lake = str(tmp_path / "lake")
    jobs.import_orders(spark, url, lake, 2, **opts)
    sold, sent = jobs.order_marts(spark, lake, db)
    assert [tuple(r) for r in spark.table(sold).collect()] == [("1", "Acme", 9)]
    rows = sorted(tuple(r) for r in spark.table(sent).collect())
    assert rows == [
        ("10", datetime.date(1996, 7, 4), "Acme", "555", 4.5, 2, 9.0),
        ("11", datetime.date(1996, 7, 5), "Bolt", "556", 7.75, 1, 7.75),
    ]


def test_passenger_list(spark, tmp_path, db):
    path = _write(
        tmp_path / "t.csv",
        "PassengerId,Survived,Pclass,Name,Sex,Age,SibSp,Parch,Ticket,Fare,Cabin,Embarked\n"
        '1,1,3,"Doe, Ms",female,22,0,0,T1,7.25,,S\n',
    )
    row = spark.table(jobs.passenger_list(spark, path, db)).first()
    assert (row["Name"], row["Cabin"], row["avg_age_by_gender"]) == ("Doe, Ms", "0", 22.0)


def test_flight_and_rental_tables(spark, tmp_path, db):
    head = (
        "Fecha;Hora UTC;Clase de Vuelo (todos los vuelos);Clasificación Vuelo;"
        "Tipo de Movimiento;Aeropuerto;Origen / Destino;Aerolinea Nombre;Aeronave;"
        "Pasajeros;Calidad dato\n"
    )
    one = _write(tmp_path / "1.csv", head + "31/12/2021;10:00;R;Domestico;Despegue;EZE;COR;X;B7;;D\n")
    two = _write(tmp_path / "2.csv", head + "01/02/2022;9:00;R;Doméstico;Despegue;EZE;COR;X;B7;7;D\n")
    names = ["local", "oaci", *jobs.flights.AIRPORT_COLUMNS[2:], "inhab", "fir"]
    values = [f"v{i}" for i in range(len(names))]
    values[names.index("elev")] = "12.5"
    values[names.index("distancia_ref")] = ""
    ports = _write(tmp_path / "p.csv", ";".join(names) + "\n" + ";".join(values) + "\n")
    moves, details = jobs.flight_tables(spark, [one, two], ports, db)
    assert sorted(r["pasajeros"] for r in spark.table(moves).collect()) == [0, 7]
    row = spark.table(details).first()
    assert (row["elev"], row["distancia_ref"], row["aeropuerto"]) == (12.5, 0.0, "v0")

    listing = _write(
        tmp_path / "r.csv",
        "fuelType,rating,renterTripsTaken,reviewCount,location.city,location.country,"
        "location.latitude,location.longitude,location.state,owner.id,rate.daily,vehicle.make,"
        "vehicle.model,vehicle.type,vehicle.year\n"
        "HYBRID,4.96,1,2,Reno,US,1,2,NV,7,99,Tesla,S,car,2015\n",
    )
    states = _write(
        tmp_path / "s.csv", "Year;United States Postal Service state abbreviation\n2021;NV\n"
    )
    row = spark.table(jobs.rental_table(spark, listing, states, db)).first()
    assert (row["fueltype"], row["rating"], row["year"]) == ("hybrid", 5, 2015)


def test_churn_table(spark, tmp_path, db):
    leavers = _write(
        tmp_path / "c.csv",
        "Id,Nombre,Apellido,Area,Fecha comienzo,Fecha fin,Nivel,Grupo recruitment,"
        "Tiempo recruitment,Rango Salarial,RS competencia,Manager,Realizo Cursos\n"
        "1,A,B,IT,01/01/2020,03/01/2020,N2,G,4,Rango 2,Rango 1,3,SI\n",
    )
    ranges = _write(tmp_path / "r.csv", "Rango,desde,hasta\nRango 1,1,2\nRango 2,3,4\n")
    managers = _write(tmp_path / "m.csv", "Id,Nombre,Apellido\n3,M,N\n")
    name = jobs.churn_table(
        spark, leavers, ranges, managers, f"{db}.churn", loaded_at=F.current_timestamp()
    )
    row = spark.table(name).first()
    assert (row["manager"], row["antiguedad"]) == ("M N", 60.0) and row["timestamp"] is not None
