"""Model preparation and a linear fit with Spark's own learners."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.global_window import global_row_number
from tidemark.session import materialize


def encode_scale(
    df: DataFrame, categories: Sequence[str], numbers: Sequence[str]
) -> DataFrame:
    """Index and one-hot encode categories, standardize numbers.

    Adds ``<c>_index`` and ``<c>_onehot`` per category and ``<n>_scaled`` per number.
    Categories are numbered by falling frequency, ties by name, nulls last, in a table that is
    joined, so a column may have many. The one-hot array has a place for each number; leave it
    unselected where they are many. A null number keeps its row and is scaled to null; a column
    without spread is scaled to 0.
    """
    indexed = df
    places = {}
    for c in categories:
        labels = label_index(df, c).select(F.col("label").alias("_label"), F.col("index").alias("_index"))
        places[c] = labels.count()
        found = F.coalesce(F.col("_index"), F.lit(places[c])).cast("double")
        indexed = (
            indexed.join(labels, F.col(f"`{c}`").cast("string") == F.col("_label"), "left")
            .withColumn(f"{c}_index", found)
            .drop("_label", "_index")
        )
    # One row; aggregates pass over nulls.
    moments = df.agg(
        F.count(F.lit(1)),
        *[F.avg(n).alias(f"m{i}") for i, n in enumerate(numbers)],
        *[F.stddev_samp(n).alias(f"s{i}") for i, n in enumerate(numbers)],
    ).first()
    scaled = [
        (F.col(n) - F.lit(moments[f"m{i}"])) / F.lit(moments[f"s{i}"])
        if moments[f"s{i}"]
        else F.when(F.col(n).isNotNull(), F.lit(0.0))
        for i, n in enumerate(numbers)
    ]
    onehot = [
        F.transform(F.sequence(F.lit(0), F.lit(places[c])), _is_at(F.col(f"{c}_index"))).alias(f"{c}_onehot")
        for c in categories
    ]
    return indexed.select(
        *df.columns,
        *[f"{c}_index" for c in categories],
        *onehot,
        *[scaled[i].alias(f"{n}_scaled") for i, n in enumerate(numbers)],
    )


def _is_at(index: Column):
    return lambda place: F.when(place == index, 1.0).otherwise(0.0)


def label_index(df: DataFrame, column: str) -> DataFrame:
    """(label, rows, index) of the values of a column, as text and without null: numbered from 0
    by falling frequency, ties by name. The numbers come from the global order, so neither the
    driver nor one task holds all labels."""
    label = F.col(f"`{column}`").cast("string").alias("label")
    counted = df.select(label).where("label is not null").groupBy("label").agg(F.count(F.lit(1)).alias("rows"))
    numbers = global_row_number(materialize(counted), [("rows", "desc")], ["label"], "number")
    return materialize(numbers.select("label", "rows", (F.col("number") - 1).alias("index")))


def fit_linear(df: DataFrame, label: str, features: Sequence[str]) -> DataFrame:
    """Least-squares fit: one row per term with its coefficient. Rows in which the label or
    a feature is null take no part."""
    vectors = VectorAssembler(
        inputCols=list(features), outputCol="_features", handleInvalid="skip"
    ).transform(df.select(F.col(label).cast("double").alias("_label"), *features))
    model = LinearRegression(
        featuresCol="_features", labelCol="_label", solver="normal"
    ).fit(vectors)
    terms = [("intercept", model.intercept), *zip(features, model.coefficients.toArray())]
    rows = F.array(
        *[
            F.struct(F.lit(n).alias("term"), F.lit(float(v)).alias("coefficient"))
            for n, v in terms
        ]
    )
    return df.sparkSession.range(1).select(F.inline(rows))
