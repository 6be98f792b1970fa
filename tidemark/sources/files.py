"""File sources. A given schema saves reading a file to find one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def text_schema(*names: str) -> T.StructType:
    """All-text schema for a delimited file whose columns are cast afterwards."""
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    sep: str = ",",
    header: bool = True,
    source_file: str | None = None,
) -> DataFrame:
    """Delimited files: one file, several, or a directory.

    Without a schema the header line names the columns and all of them are text.
    ``source_file`` names a column that gets the path each row came from.
    """
    reader = spark.read.option("sep", sep).option("header", header)
    if schema is not None:
        # Headers are checked against the schema instead of being ignored.
        reader = reader.schema(schema).option("enforceSchema", not header)
    df = reader.csv(path)
    return df if source_file is None else df.withColumn(source_file, F.col("_metadata.file_path"))


def detect_schema(
    spark: SparkSession, path: str, sep: str = ",", sampling: float = 0.1
) -> T.StructType:
    """Column types guessed from a sample of a delimited file, to be pinned afterwards."""
    reader = spark.read.option("sep", sep).option("header", True).option("inferSchema", True)
    return reader.option("samplingRatio", sampling).csv(path).schema


# What a value must look like to count as one of a type, narrowest type first.
LATTICE = (
    ("boolean", r"^(true|false)$"),
    ("int", r"^[+-]?(0|[1-9]\d*)$"),
    ("bigint", r"^[+-]?(0|[1-9]\d*)$"),
    ("double", r"^[+-]?(0|[1-9]\d*)?(\.\d*)?([eE][+-]?\d+)?$"),
    ("date", r"^\d{4}-\d{1,2}-\d{1,2}$"),
    ("timestamp", r"^\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{2}.*)?$"),
)


def column_types(df: DataFrame) -> DataFrame:
    """(column_name, type, filled, fit, type_most_fit) of text columns, from every value.

    ``type`` is the narrowest that all filled values have, else string; a column without a filled
    value is a string. ``type_most_fit`` is the one that most values have and ``fit`` how many do,
    so ``filled - fit`` values are in conflict with it. Blanks around a value do not count, blank
    values are not filled, and a number with leading zeros is text, since it would not read back
    as it stood. One aggregate over all columns, in one pass.
    """
    counts = []
    for i, name in enumerate(df.columns):
        value = F.trim(F.col(f"`{name}`"))
        filled = F.length(value) > 0
        counts.append(F.count_if(filled).alias(f"n{i}"))
        for kind, form in LATTICE:
            reads = value.rlike(form) & value.try_cast(kind).isNotNull()
            counts.append(F.count_if(filled & reads).alias(f"{kind}{i}"))

    def entry(i: int, name: str):
        kinds = [k for k, _ in LATTICE]
        n = F.col(f"n{i}")
        whole = [F.when((n > 0) & (F.col(f"{k}{i}") == n), F.lit(k)) for k in kinds]
        fit = F.greatest(*[F.col(f"{k}{i}") for k in kinds])
        most = [F.when((fit > 0) & (F.col(f"{k}{i}") == fit), F.lit(k)) for k in kinds]
        return F.struct(
            F.lit(name).alias("column_name"),
            F.coalesce(*whole, F.lit("string")).alias("type"),
            n.alias("filled"),
            fit.alias("fit"),
            F.coalesce(*most, F.lit("string")).alias("type_most_fit"),
        )

    found = F.array(*[entry(i, name) for i, name in enumerate(df.columns)])
    return df.agg(*counts).select(F.inline(found))


def schema_of(types: DataFrame) -> T.StructType:
    """The schema that ``column_types`` found, one row for each column of a file."""
    return T.StructType([T.StructField(r["column_name"], T._parse_datatype_string(r["type"])) for r in types.collect()])


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | str | None = None):
    """A parquet file or directory."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Line-delimited JSON documents, such as an exported document collection."""
    return spark.read.schema(schema).json(path)


def read_avro(spark: SparkSession, path: str) -> DataFrame:
    """Avro files; needs the Avro module on the session's class path."""
    return spark.read.format("avro").load(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Replace (default), extend or refuse to touch a parquet directory."""
    df.write.mode(mode).parquet(path)
