"""Relational sources over JDBC: whole tables, filtered tables, free queries.

A read is split over executors by ranges of a numeric or date column, or by the
caller's own predicates; filters and column selections are pushed into the database.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.files import write_parquet

# Rows a driver fetches at a time.
FETCH_ROWS = "10000"

# Catalog queries per kind of database (fixed values).
TABLE_LISTS = {
    "jdbc:postgresql:": "select table_schema as db, table_name as name "
    "from information_schema.tables where table_schema = 'public'",
    "jdbc:derby:": "select s.schemaname as db, t.tablename as name from sys.systables t "
    "join sys.sysschemas s on s.schemaid = t.schemaid where t.tabletype = 'T'",
}
DATABASE_LISTS = {
    "jdbc:postgresql:": "select datname as db from pg_database",
    "jdbc:derby:": "select schemaname as db from sys.sysschemas",
}


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str | None = None,
    query: str | None = None,
    where: str | None = None,
    partition: tuple[str, object, object, int] | str | None = None,
    num_partitions: int = 8,
    predicates: Sequence[str] | None = None,
    **options: str,
) -> DataFrame:
    """Read a table or a query.

    ``partition`` is (column, lower, upper, parts), or a column name alone, whose
    bounds are then asked from the database with one row. ``predicates`` gives one
    task per condition instead. ``where`` is evaluated by the database. ``fetchsize`` is
    ``FETCH_ROWS`` unless given: some drivers hold all rows of a task in memory without one.
    """
    if (table is None) == (query is None):
        raise ValueError("give a table or a query")
    options = {"fetchsize": FETCH_ROWS} | options
    source = table if query is None else f"({query}) q"
    if where is not None:
        source = f"(select * from {source} where {where}) w"
    if isinstance(partition, str):
        # A wholly null or empty column has no bounds; one task reads it.
        sql = f"select min({partition}) as lo, max({partition}) as hi from {source}"
        low, high = _reader(spark, url, options).option("query", sql).load().first()
        partition = None if low is None else (partition, low, high, num_partitions)
    if predicates is not None:
        return spark.read.jdbc(url, source, predicates=list(predicates), properties=dict(options))
    reader = _reader(spark, url, options).option("dbtable", source)
    if partition is not None:
        column, low, high, parts = partition
        reader = (
            reader.option("partitionColumn", column)
            .option("lowerBound", str(low))
            .option("upperBound", str(high))
            .option("numPartitions", parts)
        )
    return reader.load()


def _reader(spark: SparkSession, url: str, options: dict):
    return spark.read.format("jdbc").option("url", url).options(**options)


def import_jdbc(
    spark: SparkSession, url: str, target: str, one_task: bool = False, **read_options
) -> DataFrame:
    """Copy a table or query into a parquet directory, replacing it; returns the copy.

    A whole table is copied in one task only where ``one_task`` asks for it.
    """
    narrowed = [read_options.get(k) for k in ("query", "where", "partition", "predicates")]
    if not one_task and all(x is None for x in narrowed):
        raise ValueError("give a partition column or predicates, or one_task=True")
    write_parquet(read_jdbc(spark, url, **read_options), target)
    return spark.read.parquet(target)


def write_jdbc(df: DataFrame, url: str, table: str, **options: str) -> None:
    """Replace a database table by a frame."""
    df.write.jdbc(url, table, mode="overwrite", properties=dict(options))


def list_jdbc_tables(spark: SparkSession, url: str, **options: str) -> DataFrame:
    return _listed(spark, url, TABLE_LISTS, options)


def list_jdbc_databases(spark: SparkSession, url: str, **options: str) -> DataFrame:
    return _listed(spark, url, DATABASE_LISTS, options)


def _listed(spark, url, lists, options):
    for prefix, sql in lists.items():
        if url.startswith(prefix):
            return read_jdbc(spark, url, query=sql, **options)
    raise ValueError(f"no catalog query known for {url.split(':')[1]}")
