"""Staff turnover: leaver records to features, and the counts behind its charts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import (
    parse_date,
    range_midpoint,
    sign_label,
    tenure_days,
)
from tidemark.operators.aggregate import counts_by_hue, mean_by_group, top_share
from tidemark.operators.relational import join_dimension_twice

# Headers of the delivered file and the feature columns.
STAFF_COLUMNS = {
    "Area": "area",
    "Nivel": "nivel",
    "Grupo recruitment": "grupo_recruitment",
    "Tiempo recruitment": "tiempo_recruitment",
}
PAY_LABELS = ("Mejor", "Igual", "Peor")


def churn_features(
    staff: DataFrame,
    ranges: DataFrame,
    managers: DataFrame,
    keep: tuple[str, ...] = (),
    loaded_at=None,
) -> DataFrame:
    """One feature row per leaver.

    Pay is compared by the midpoints of the own and the competitor's salary range; an
    unknown range leaves the label empty. ``loaded_at`` adds a load time column.
    """
    mid = ranges.select("Rango", range_midpoint("desde", "hasta").alias("mid"))
    paid = join_dimension_twice(
        staff,
        mid,
        ("Rango Salarial", "Rango"),
        ("RS competencia", "Rango"),
        ["mid"],
        ("_own", "_other"),
        how="left",
    )
    bosses = managers.select(
        F.col("Id").alias("manager_id"),
        F.concat("Nombre", F.lit(" "), "Apellido").alias("manager"),
    )
    joined = paid.withColumnRenamed("Manager", "manager_key").join(
        bosses, F.col("manager_key") == F.col("manager_id"), "left"
    )
    features = joined.select(
        *keep,
        *[F.col(old).alias(new) for old, new in STAFF_COLUMNS.items()],
        F.lower("Realizo Cursos").alias("realizo_cursos"),
        tenure_days(
            parse_date("Fecha comienzo", "MM/dd/yyyy"), parse_date("Fecha fin", "MM/dd/yyyy")
        ).alias("antiguedad"),
        "manager",
        sign_label(F.col("mid_own") - F.col("mid_other"), *PAY_LABELS).alias(
            "salario_versus_competencia"
        ),
    )
    return features if loaded_at is None else features.withColumn("timestamp", F.lit(loaded_at))


def churn_counts(features: DataFrame, by: str, hue: str) -> DataFrame:
    return counts_by_hue(features, by, hue)


def mean_tenure_by_area(features: DataFrame) -> DataFrame:
    """Mean days per area next to the overall mean."""
    return mean_by_group(features, "area", "antiguedad", "mean_days", "overall_mean_days")


def top_managers_share(features: DataFrame, k: int = 3) -> DataFrame:
    return top_share(features, "manager", k)
