"""Small helpers the operators of this folder share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.session import scratch_path

# What separates words: space and the five ASCII controls from tab to carriage return.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def written(df: DataFrame, label: str, codec: str = "snappy") -> DataFrame:
    """``df`` as a table in the shared folder: computed once, read by several jobs, and
    re-read instead of recomputed when an executor is lost."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words_of(text: Column) -> Column:
    """Maximal runs of anything but SPACES; an empty array for blank text."""
    trimmed = F.trim(text, F.lit(SPACES))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, SPACE_RUN)).otherwise(
        F.array().cast("array<string>")
    )


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a unique ``row``: ``doc_id`` itself where ids are whole numbers, unique
    and not null, else a number given in a written copy. A column of that name is replaced."""
    docs = docs.drop("row")
    if dict(docs.dtypes)["doc_id"] in ("bigint", "int", "smallint", "tinyint"):
        odd = docs.groupBy("doc_id").count().where("count > 1 or doc_id is null")
        if odd.isEmpty():
            return docs.withColumn("row", F.col("doc_id").cast("long"))
    return written(docs.withColumn("row", F.monotonically_increasing_id()), "numbered-rows")
