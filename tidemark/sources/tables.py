"""Warehouse tables: databases, typed tables, loads, listings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MODES = ("append", "overwrite", "overwrite_partitions")


def create_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def _location(spark: SparkSession, table: str) -> str | None:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where(F.col("col_name") == "Location")
    found = rows.select("data_type").first()
    return None if found is None else found[0]


def _plain(path: str) -> str:
    return "/" + path.split(":", 1)[-1].strip("/")


def create_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType | str,
    location: str | None = None,
    partition_by: Sequence[str] = (),
    replace: bool = False,
) -> None:
    """Create a typed parquet table, managed or at a location of its own.

    Two tables on one location would read each other's files, so a location taken
    by another table of the database is refused.
    """
    columns = schema if isinstance(schema, str) else schema.toDDL()
    if location is not None:
        database = name.split(".")[0] if "." in name else spark.catalog.currentDatabase()
        for table in spark.catalog.listTables(database):
            other = f"{database}.{table.name}"
            if table.isTemporary or other == name or f"{database}.{name}" == other:
                continue
            if _plain(_location(spark, other) or "") == _plain(location):
                raise ValueError(f"{other} already uses {location}")
    if replace:
        drop_table(spark, name)
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    place = f" LOCATION '{location}'" if location is not None else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{parts}{place}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def load(
    df: DataFrame,
    table: str,
    mode: str = "overwrite",
    by: str = "name",
    partition_by: Sequence[str] = (),
) -> None:
    """Load a frame into an existing table, keeping the table's declared types.

    ``overwrite`` makes a repeated run harmless, ``overwrite_partitions`` replaces
    only the partitions present in the frame, ``append`` adds. ``by='position'``
    binds columns by position. For a partitioned table give ``partition_by``: rows of
    a partition are then gathered before writing, and a large one is still split.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    target = df.sparkSession.table(table).schema
    if by == "name":
        absent = [f.name for f in target.fields if f.name not in df.columns]
        if absent:
            raise ValueError(f"columns not in the frame: {absent}")
        df = df.select(*[f.name for f in target.fields])
    elif by != "position":
        raise ValueError("by must be name or position")
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    # insertInto takes this from the session only; the caller's value is put back.
    conf, key = df.sparkSession.conf, "spark.sql.sources.partitionOverwriteMode"
    before = conf.get(key)
    conf.set(key, "dynamic" if mode == "overwrite_partitions" else "static")
    try:
        df.write.insertInto(table, overwrite=mode != "append")
    finally:
        conf.set(key, before)


def replace_table(df: DataFrame, table: str) -> None:
    """Make the table what the frame is, schema included."""
    df.write.mode("overwrite").format("parquet").saveAsTable(table)


def read_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def list_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(database))


def list_databases(spark: SparkSession) -> list[str]:
    return sorted(d.name for d in spark.catalog.listDatabases())


def register_tables(spark: SparkSession, database: str, paths: Mapping[str, str]) -> None:
    """Tables of a database over parquet data where it lies; nothing is copied."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for name, path in paths.items():
        spark.catalog.createTable(f"`{database}`.`{name}`", path, "parquet")


def database_tables(spark: SparkSession, database: str) -> list[str]:
    """Tables of a database, without the temporary views the session lists with them."""
    return sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary)


def catalog_columns(spark: SparkSession, database: str) -> DataFrame:
    """(table_name, column_name, position, data_type) of all tables of a database, as the catalog
    has them; positions count from 1."""
    rows = [
        (table, column.name, place, column.dataType)
        for table in database_tables(spark, database)
        for place, column in enumerate(spark.catalog.listColumns(f"`{database}`.`{table}`"), 1)
    ]
    return spark.createDataFrame(rows, "table_name string, column_name string, position bigint, data_type string")


def database_sizes(spark: SparkSession, database: str) -> DataFrame:
    """(table_name, rows) of every table the catalog lists in a database."""
    return table_sizes(**{t: spark.table(f"`{database}`.`{t}`") for t in database_tables(spark, database)})


def table_sizes(**frames: DataFrame) -> DataFrame:
    """(table_name, rows) of named frames. Parquet answers from its footers."""
    counts = [
        df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows"))
        for name, df in sorted(frames.items())
    ]
    out = counts[0]
    for other in counts[1:]:
        out = out.union(other)
    return out


def column_summary(df: DataFrame, *columns: str) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles of columns; nulls do not count."""
    return df.select(*columns).summary()
