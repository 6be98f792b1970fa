"""Passenger-list cleaning and survivor queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import safe_int
from tidemark.operators.aggregate import conditional_mean, top_k
from tidemark.operators.clean import drop_columns, fill_defaults

PASSENGER_COLUMNS = (
    "PassengerId string, Survived string, Pclass string, Name string, Sex string, Age string, "
    "SibSp string, Parch string, Ticket string, Fare string, Cabin string, Embarked string"
)


def titanic_clean(raw: DataFrame) -> DataFrame:
    """Typed passenger list with the mean age of the passenger's sex.

    Any sex but 'female', null included, gets the men's mean; ages below one
    truncate to zero.
    """
    kept = fill_defaults(drop_columns(raw, "SibSp", "Parch"), {"Cabin": 0})
    kept = kept.withColumn("_age", F.col("Age").try_cast("double"))
    with_mean = conditional_mean(kept, "_age", "Sex", "female", "male", "avg_age_by_gender")
    return with_mean.select(
        safe_int("PassengerId").alias("PassengerId"),
        safe_int("Survived").alias("Survived"),
        safe_int("Pclass").alias("Pclass"),
        "Name",
        "Sex",
        safe_int("Age").alias("Age"),
        "Ticket",
        F.col("Fare").try_cast("float").alias("Fare"),
        "Cabin",
        "Embarked",
        F.col("avg_age_by_gender").cast("float").alias("avg_age_by_gender"),
    )


def _survivors(clean: DataFrame) -> DataFrame:
    return clean.where(F.col("Survived") == 1)


def survivors_by(clean: DataFrame, group: str) -> DataFrame:
    return _survivors(clean).groupBy(group).agg(F.count(F.lit(1)).alias("survivors"))


def oldest_survivor(clean: DataFrame) -> DataFrame:
    rows = _survivors(clean).select("PassengerId", "Survived", "Age")
    return top_k(rows, [F.desc_nulls_last("Age"), F.asc("PassengerId")], 1)


def youngest_survivors(clean: DataFrame) -> DataFrame:
    """Survivors of known age, youngest first."""
    return (
        _survivors(clean)
        .where(F.col("Age").isNotNull())
        .select("PassengerId", "Survived", "Age")
        .orderBy("Age", "PassengerId")
    )
