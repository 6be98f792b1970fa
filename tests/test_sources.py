from __future__ import annotations

import datetime
import uuid

import pytest
from pyspark.sql import functions as F

from tidemark.plans import flights, logs, marts, rentals, staff, survivors, trips
from tidemark.sources import files, jdbc, tables


def _write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv_separators_and_source_file(spark, tmp_path):
    _write(tmp_path / "a.csv", "x;y\n1;é\n2;\n")
    _write(tmp_path / "b.csv", "x;y\n1;é\n2;\n")
    df = files.read_csv(spark, str(tmp_path), "x int, y string", ";", source_file="path")
    rows = sorted((r["x"], r["y"], r["path"].rsplit("/", 1)[1]) for r in df.collect())
    assert rows[0] == (1, "é", "a.csv") and len(rows) == 4 and rows[2][1] is None


def test_detect_schema(spark, tmp_path):
    _write(tmp_path / "a.csv", "x,y\n1,2.5\n2,3.5\n")
    schema = files.detect_schema(spark, str(tmp_path), sampling=1.0)
    assert [f.dataType.simpleString() for f in schema.fields] == ["int", "double"]


def test_json_logs_match_csv_logs(spark, tmp_path):
    _write(
        tmp_path / "may.json",
        '{"id":1,"first_name":"A","last_name":"B","ip_address":"1.1.1.1"}\n'
        '{"id":2,"first_name":"C","last_name":"D","ip_address":null}\n'
        '{"id":3,"first_name":"E","last_name":"F","ip_address":"1.1.1.1"}\n',
    )
    _write(
        tmp_path / "april.csv",
        "id,first_name,last_name,email,ip_address\n7,X,Y,e@x,1.1.1.1\n8,Z,W,,\n",
    )
    may = files.read_json(spark, str(tmp_path / "may.json"), logs.USER_LOG)
    april = files.read_csv(spark, str(tmp_path / "april.csv"), logs.USER_LOG)
    got = sorted(tuple(r) for r in logs.same_ip_across_months(may, april).collect())
    assert got == [(1, "A", "B", "X", "Y", "1.1.1.1"), (3, "E", "F", "X", "Y", "1.1.1.1")]


def test_parquet_roundtrip(spark, tmp_path):
    path = str(tmp_path / "p")
    files.write_parquet(spark.range(3).toDF("a"), path)
    files.write_parquet(spark.range(2).toDF("a"), path)
    assert files.read_parquet(spark, path).count() == 2
    with pytest.raises(Exception, match="already exists"):
        files.write_parquet(spark.range(2).toDF("a"), path, "errorifexists")


@pytest.fixture(scope="module")
def derby(spark):
    """An in-process database; no server and no port."""
    url = f"jdbc:derby:memory:t{uuid.uuid4().hex};create=true"
    opts = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    df = spark.range(100).select(
        F.col("id").cast("int").alias("ID"),
        (F.col("id") % 40).cast("int").alias("STOCK"),
        F.concat(F.lit("p"), F.col("id")).alias("NAME"),
    )
    jdbc.write_jdbc(df, url, "PRODUCTS", **opts)
    return url, opts


def test_jdbc_import(spark, derby, tmp_path):
    url, opts = derby
    path = str(tmp_path / "copy")
    full = jdbc.import_jdbc(spark, url, path, table="PRODUCTS", partition="ID",
                            num_partitions=4, **opts)
    assert full.count() == 100
    read = jdbc.read_jdbc(spark, url, table="PRODUCTS", partition=("ID", 0, 100, 5), **opts)
    assert read.rdd.getNumPartitions() == 5 and read.count() == 100
    some = jdbc.import_jdbc(spark, url, path, table="PRODUCTS", where="STOCK > 20", **opts)
    assert some.count() == sum(1 for i in range(100) if i % 40 > 20)


def test_whole_tables_are_split_unless_asked_otherwise(spark, derby, tmp_path):
    url, opts = derby
    path = str(tmp_path / "whole")
    with pytest.raises(ValueError, match="one_task"):
        jdbc.import_jdbc(spark, url, path, table="PRODUCTS", **opts)
    assert jdbc.import_jdbc(spark, url, path, one_task=True, table="PRODUCTS", **opts).count() == 100


def test_jdbc_query_and_predicates(spark, derby):
    url, opts = derby
    got = jdbc.read_jdbc(spark, url, query="select ID, NAME from PRODUCTS where ID < 3", **opts)
    assert sorted(r[0] for r in got.collect()) == [0, 1, 2]
    parts = jdbc.read_jdbc(
        spark, url, table="PRODUCTS", predicates=["ID < 50", "ID >= 50"], **opts
    )
    assert parts.rdd.getNumPartitions() == 2 and parts.count() == 100
    pushed = jdbc.read_jdbc(spark, url, table="PRODUCTS", **opts).where("STOCK > 20")
    assert "PushedFilters: [*IsNotNull(STOCK), *GreaterThan(STOCK,20)]" in (
        pushed._jdf.queryExecution().executedPlan().toString())
    with pytest.raises(ValueError):
        jdbc.read_jdbc(spark, url, table="A", query="B")


def test_jdbc_listing(spark, derby):
    url, opts = derby
    assert "PRODUCTS" in {r["NAME"] for r in jdbc.list_jdbc_tables(spark, url, **opts).collect()}
    assert jdbc.list_jdbc_databases(spark, url, **opts).count() > 0


@pytest.fixture()
def db(spark):
    name = f"db_{uuid.uuid4().hex[:8]}"
    tables.create_database(spark, name)
    return name


def test_load_modes(spark, db):
    t = f"{db}.target"
    tables.create_table(spark, t, "day timestamp, fee float, n int")
    frame = spark.sql("select date'2021-01-18' day, 1.5D fee, 2 n")
    tables.load(frame, t, "append", by="position")
    tables.load(frame, t, "append", by="position")
    assert tables.read_table(spark, t).count() == 2
    tables.load(frame, t)
    tables.load(frame.select("n", "fee", "day"), t)
    out = tables.read_table(spark, t)
    assert [f.dataType.simpleString() for f in out.schema] == ["timestamp", "float", "int"]
    assert out.collect()[0]["day"] == datetime.datetime(2021, 1, 18) and out.count() == 1
    with pytest.raises(Exception, match="INCOMPATIBLE_DATA_FOR_TABLE|cast"):
        tables.load(spark.sql("select 'x' day, 1.0D fee, 1 n"), t, by="position")
    with pytest.raises(ValueError):
        tables.load(frame.drop("n"), t)
    assert tables.list_tables(spark, db) == ["target"]
    assert db in tables.list_databases(spark)


def test_partition_overwrite(spark, db):
    t = f"{db}.parts"
    tables.create_table(spark, t, "n int, day date", partition_by=["day"])
    two = spark.sql("select * from values (1, date'2021-01-01'), (2, date'2021-01-02') v(n, day)")
    tables.load(two, t, partition_by=["day"])
    new = spark.sql("select 9 n, date'2021-01-02' day")
    tables.load(new, t, "overwrite_partitions", partition_by=["day"])
    assert sorted(r["n"] for r in spark.table(t).collect()) == [1, 9]
    tables.load(new, t, "overwrite", partition_by=["day"])
    assert [r["n"] for r in spark.table(t).collect()] == [9]


def test_replace_table_takes_the_frames_schema(spark, db):
    t = f"{db}.payments"
    tables.create_table(spark, t, "day timestamp, total float")
    tables.replace_table(spark.sql("select date'2021-01-01' day, 2.0D total"), t)
    assert [f.dataType.simpleString() for f in spark.table(t).schema] == ["date", "double"]
    tables.create_table(spark, t, "other int", replace=True)
    assert spark.table(t).columns == ["other"] and spark.table(t).count() == 0


def test_external_tables_have_a_location_of_their_own(spark, db, tmp_path):
    where = str(tmp_path / "ext")
    tables.create_table(spark, f"{db}.one", "n int", location=where)
    tables.create_table(spark, f"{db}.one", "n int", location=where)
    with pytest.raises(ValueError):
        tables.create_table(spark, f"{db}.two", "n int", location=where)
    tables.load(spark.range(3).select(F.col("id").cast("int").alias("n")), f"{db}.one")
    assert spark.read.parquet(where).count() == 3


def test_views_and_summary(spark):
    df = spark.sql("select * from values (1), (3), (null) v(x)")
    tables.register_view(df, "some_view")
    assert spark.table("some_view").count() == 3
    stats = {r[0]: r[1] for r in tables.column_summary(df, "x").collect()}
    assert stats["count"] == "2" and stats["mean"] == "2.0"


def test_flight_files(spark, tmp_path):
    head = (
        "Fecha;Hora UTC;Clase de Vuelo (todos los vuelos);Clasificación Vuelo;"
        "Tipo de Movimiento;Aeropuerto;Origen / Destino;Aerolinea Nombre;Aeronave;"
        "Pasajeros;Calidad dato\n"
    )
    a = _write(
        tmp_path / "a.csv",
        head
        + "31/12/2021;10:00;R;Domestico;Despegue;EZE;COR;X;B7;;D\n"
        + "31/12/2021;10:00;R;Internacional;Despegue;EZE;MIA;X;B7;4;D\n",
    )
    b = _write(tmp_path / "b.csv", head + "01/02/2022;9:00;R;Doméstico;Aterrizaje;COR;EZE;0;0;7;D\n")
    schema = files.text_schema(*flights.FLIGHT_COLUMNS, "Calidad dato")
    out = flights.flights_clean(*[files.read_csv(spark, p, schema, ";") for p in (a, b)])
    rows = sorted(out.collect(), key=lambda r: r["fecha"])
    assert [r["pasajeros"] for r in rows] == [0, 7]
    assert {r["clasificacion_de_vuelo"] for r in rows} == {"Domestico"}
    assert rows[0]["fecha"] == datetime.date(2021, 12, 31)
    airports = spark.sql(
        "select * from values ('EZE','BUENOS AIRES'), ('COR','CORDOBA') v(aeropuerto, provincia)"
    )
    trip = flights.flight_origin_destination(out, airports).first()
    assert (trip["ciudad_origen"], trip["ciudad_destino"]) == ("BUENOS AIRES", "CORDOBA")
    assert flights.flights_between_dates(out).first()[0] == 1
    top = flights.top10_aircraft_from_city(out, airports).collect()
    assert [tuple(r) for r in top] == [("B7", 1)]


def test_rental_files(spark, tmp_path):
    rows = (
        "fuelType,rating,renterTripsTaken,reviewCount,location.city,location.country,"
        "location.latitude,location.longitude,location.state,owner.id,rate.daily,vehicle.make,"
        "vehicle.model,vehicle.type,vehicle.year\n"
        "ELECTRIC,4.96,1,2,Reno,US,1,2,NV,7,99,Tesla,S,car,2015\n"
        ",4.9,1,2,Reno,US,1,2,NV,7,99,Tesla,S,car,2015\n"
        "ELECTRIC,0.04,1,2,Reno,US,1,2,NV,7,99,Tesla,S,car,2015\n"
        "ELECTRIC,,1,2,Reno,US,1,2,NV,7,99,Tesla,S,car,2015\n"
        "ELECTRIC,5,1,2,Austin,US,1,2,TX,7,99,Tesla,S,car,2015\n"
        "ELECTRIC,5,1,2,Nowhere,US,1,2,ZZ,7,99,Tesla,S,car,2015\n"
    )
    path = _write(tmp_path / "r.csv", rows)
    schema = files.text_schema(*rows.split("\n", 1)[0].split(","))
    raw = files.read_csv(spark, path, schema)
    states = spark.createDataFrame([("NV",), ("TX",)], [rentals.STATE_KEY])
    clean = rentals.car_rental_clean(raw, states)
    got = sorted((r["rating"], r["fueltype"]) for r in clean.collect())
    assert got == [(4, None), (5, "electric")]
    assert clean.schema["year"].dataType.simpleString() == "int"
    assert rentals.eco_rentals_rated(clean).first()[0] == 1


def test_passenger_file(spark, tmp_path):
    path = _write(
        tmp_path / "t.csv",
        "PassengerId,Survived,Pclass,Name,Sex,Age,SibSp,Parch,Ticket,Fare,Cabin,Embarked\n"
        '1,1,3,"Doe, Ms",female,0.75,0,0,T1,7.25,,S\n'
        "2,1,1,B,male,40,0,0,T2,x,C5,S\n3,0,1,C,,,0,0,T3,1,C6,S\n",
    )
    raw = files.read_csv(spark, path, survivors.PASSENGER_COLUMNS)
    rows = {r["PassengerId"]: r for r in survivors.titanic_clean(raw).collect()}
    assert (rows[1]["Age"], rows[1]["Cabin"], rows[1]["avg_age_by_gender"]) == (0, "0", 0.75)
    assert rows[2]["Fare"] is None and rows[3]["avg_age_by_gender"] == 40.0


def test_staff_file(spark, tmp_path):
    path = _write(
        tmp_path / "churn.csv",
        "Id,Nombre,Apellido,Area,Fecha comienzo,Fecha fin,Nivel,Grupo recruitment,"
        "Tiempo recruitment,Rango Salarial,RS competencia,Manager,Realizo Cursos\n"
        "1,A,B,IT,01/01/2020,03/01/2020,N2,G,4,Rango 2,Rango 1,3,SI\n"
        "2,A,B,IT,01/01/2020,01/02/2020,N2,G,4,Rango 1,Rango 2,9,NO\n",
    )
    names = open(path, encoding="utf-8").readline().strip().split(",")
    raw = files.read_csv(spark, path, files.text_schema(*names))
    ranges = spark.createDataFrame(
        [("Rango 1", 150000, 200000), ("Rango 2", 200001, 250000)],
        "Rango string, desde int, hasta int",
    )
    managers = spark.createDataFrame([("3", "M", "N")], "Id string, Nombre string, Apellido string")
    out = staff.churn_features(raw, ranges, managers, loaded_at=datetime.datetime(2024, 1, 1))
    rows = sorted(out.collect(), key=lambda r: -r["antiguedad"])
    assert [(r["antiguedad"], r["manager"], r["salario_versus_competencia"]) for r in rows] == [
        (60.0, "M N", "Mejor"), (1.0, None, "Peor")]
    assert rows[0]["realizo_cursos"] == "si" and rows[0]["timestamp"].year == 2024


def test_trip_csv(spark, tmp_path):
    path = _write(
        tmp_path / "t.csv",
        "VendorID,tpep_pickup_datetime,passenger_count,trip_distance,RatecodeID,payment_type,"
        "tip_amount,tolls_amount,congestion_surcharge,total_amount,airport_fee\n"
        "1,2021-01-18 10:00:00,3,20.5,1,1,5,0.2,2.5,9.99,0\n"
        "2,2021-01-31 23:59:59,1,16,Group Ride,2,1,0,0,30,\n"
        "2,bad,,x,2,2,1,0,0,y,\n",
    )
    names = open(path, encoding="utf-8").readline().strip().split(",")
    raw = files.read_csv(spark, path, files.text_schema(*names))
    assert [r["total_amount"] for r in trips.cheap_trips(raw).collect()] == [
        pytest.approx(9.99, abs=1e-5)]
    assert trips.load_payments(raw).count() == 1
    assert trips.load_payments(raw, limit=0).count() == 0
    assert trips.load_passengers(raw).count() == 1
    assert trips.load_tolls(raw).count() == 1
    assert trips.load_congestion(raw).count() == 1
    assert trips.load_distance(raw).count() == 1
    assert trips.single_passenger_long_trips(raw).count() == 1
    assert trips.airport_trips_cash(raw, raw, payment_type=1).count() == 2
    assert trips.amount_by_ratecode(raw).first()["total"] == 9.99


def test_shipping_date_units(spark):
    ship = spark.sql("select 1 order_id, 836438400L shipped_date, 'c' company_name, 'p' phone")
    lines = spark.sql("select 1 order_id, 10.0D unit_price, 3 quantity, 0.5D discount")
    row = marts.products_sent_discounted(ship, lines).first()
    assert row["shipped_date"] == datetime.date(1996, 7, 4) and row["total_price"] == 28.5
    ms = ship.withColumn("shipped_date", F.col("shipped_date") * 1000)
    assert marts.products_sent_discounted(ms, lines, "ms").first()["shipped_date"] == (
        datetime.date(1996, 7, 4))


def test_catalog_lists_tables_and_columns(spark, sf_dir):
    tables.register_tables(spark, "listed", {n: f"{sf_dir}/{n}.parquet" for n in ("nation", "region")})
    try:
        assert "listed" in tables.list_databases(spark)
        got = {(r["table_name"], r["position"]): r["column_name"] for r in tables.catalog_columns(spark, "listed").collect()}
        assert got[("region", 1)] == "r_regionkey" and len({t for t, _ in got}) == 2
        sizes = {r["table_name"]: r["rows"] for r in tables.database_sizes(spark, "listed").collect()}
        assert sizes["nation"] == spark.read.parquet(f"{sf_dir}/nation.parquet").count()
    finally:
        spark.sql("DROP DATABASE listed CASCADE")


def test_column_types_from_every_value(spark):
    """One odd value in the last of many rows is seen; blanks, zeros and suffixes are no numbers."""
    rows = [(str(i), f"{i}.5", "true", "2024-01-02", " ", "007", f"{i}d") for i in range(3000)]
    rows += [("x", "1e3", "false", "2024-1-3 10:20:00", None, "12", "1"), (None, "", None, None, "", "3", "")]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string, e string, f string, g string")
    got = {r["column_name"]: tuple(r)[1:] for r in files.column_types(df).collect()}
    assert got == {
        "a": ("string", 3001, 3000, "int"),
        "b": ("double", 3001, 3001, "double"),
        "c": ("boolean", 3001, 3001, "boolean"),
        "d": ("timestamp", 3001, 3001, "timestamp"),
        "e": ("string", 0, 0, "string"),
        "f": ("string", 3002, 2, "int"),
        "g": ("string", 3001, 1, "int"),
    }
    assert files.schema_of(files.column_types(df)).fieldNames() == list("abcdefg")
    assert files.column_types(df.where("false")).where("type != 'string'").isEmpty()
