from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from tidemark import functions as fn
from tidemark.operators import clean


def _col(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def _list(df):
    return [r[0] for r in df.collect()]


def test_safe_int_truncates_and_never_fails(spark):
    df = _col(spark, ["4.96", "4.9", "0.04", "-3.7", "x", "", None, "NaN", "3e10"])
    assert _list(df.select(fn.safe_int("x"))) == [4, 4, 0, -3, None, None, None, None, None]


def test_round_to_int(spark):
    df = _col(spark, ["4.96", "4.9", "0.04", "x", "", None])
    assert _list(df.select(fn.round_to_int("x", 1))) == [5, 4, 0, None, None, None]


def test_dates(spark):
    df = _col(spark, ["31/12/2021", "2021-12-31", "nope", None])
    day = datetime.date(2021, 12, 31)
    assert _list(df.select(fn.parse_date("x", "dd/MM/yyyy"))) == [day, None, None, None]
    both = fn.parse_date("x", "dd/MM/yyyy", "yyyy-MM-dd")
    assert _list(df.select(both)) == [day, day, None, None]


def test_epoch_units(spark):
    df = _col(spark, [836438400, None], "bigint")
    day = datetime.date(1996, 7, 4)
    assert _list(df.select(fn.epoch_to_date("x", "s"))) == [day, None]
    assert _list(df.select(fn.epoch_to_date(F.col("x") * 1000, "ms"))) == [day, None]
    with pytest.raises(ValueError):
        fn.epoch_to_date("x", "h")


def test_labels(spark):
    df = _col(spark, ["Doméstico", "Domestico", "Internacional", None])
    got = _list(df.select(fn.map_labels("x", {"Doméstico": "Domestico"})))
    assert got == ["Domestico", "Domestico", "Internacional", None]


def test_sign_label(spark):
    df = _col(spark, [2.0, 0.0, -1.0, None], "double")
    assert _list(df.select(fn.sign_label("x", "up", "same", "down"))) == [
        "up", "same", "down", None]


def test_tenure_days(spark):
    df = spark.sql(
        "select date'2020-01-01' a, date'2020-03-01' b, timestamp'2020-01-01 12:00:00' c"
    )
    assert df.select(fn.tenure_days("a", "b")).first()[0] == 60.0
    assert df.select(fn.tenure_days("a", "c")).first()[0] == 0.5


def test_normalize_columns(spark):
    names = ["location.city", "Origen / Destino", "Clase de Vuelo (todos los vuelos)",
             "Clasificación Vuelo", "Fecha"]
    df = spark.createDataFrame([("a", "b", "c", "d", "e")], names)
    out = clean.normalize_columns(df, {"Fecha": "day"})
    assert out.columns == ["location_city", "origen_destino",
                           "clase_de_vuelo_todos_los_vuelos", "clasificacion_vuelo", "day"]
    assert out.first()["location_city"] == "a"
    with pytest.raises(ValueError):
        clean.normalize_columns(df, {"Fecha": "location_city"})


def test_drop_absent_and_double_names(spark):
    a = spark.createDataFrame([(1, "x")], "k int, type string")
    b = spark.createDataFrame([(1, "y")], "k int, type string")
    joined = a.join(b, a.k == b.k)
    assert clean.drop_columns(joined, "type", "absent").columns == ["k", "k"]
    assert joined.drop(b.k).columns == ["k", "type", "type"]


def test_fill_defaults_takes_the_column_type(spark):
    df = _col(spark, ["a", None])
    assert _list(clean.fill_defaults(df, {"x": 0})) == ["a", "0"]


def test_safe_cast_counts_rejects(spark):
    df = spark.createDataFrame(
        [("1", "2.5"), ("x", None), (None, "y"), ("2.9", "z")], "a string, b string"
    )
    types = {"a": "int", "b": "double"}
    assert [tuple(r) for r in clean.safe_cast(df, types).collect()] == [
        (1, 2.5), (None, None), (None, None), (2, None)]
    assert tuple(clean.cast_rejects(df, types).first()) == (1, 2)
