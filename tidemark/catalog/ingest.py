from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.catalog.registry import query
from tidemark.plans import relational as r
from tidemark.session import scratch_path
from tidemark.sources.files import column_types, read_csv, read_json, write_parquet
from tidemark.sources.tables import (
    catalog_columns,
    column_summary,
    create_database,
    create_table,
    database_sizes,
    load,
    read_table,
    register_tables,
)


@query("import_table", "SELECT * FROM v_orders")
def _(w):
    target = scratch_path(w.spark, "import-orders")
    write_parquet(w.orders, target)
    return w.spark.read.schema(w.orders.schema).parquet(target)


@query("import_table_where", "SELECT * FROM v_products WHERE units_in_stock > 20")
def _(w):
    return w.products.where(F.col("units_in_stock") > 20)


# The names of the given tables.
GIVEN = (
    "benchmark", "conversations", "customer", "documents", "embeddings", "events", "labels",
    "lineitem", "nation", "orders", "pages", "part", "region", "supplier",
)


def _given_database(w) -> str:
    """A database of the session's catalog that holds the given tables."""
    database = f"given_{uuid.uuid4().hex}"
    register_tables(w.spark, database, {n: f"{w.path}/{n}.parquet" for n in GIVEN})
    return database


@query(
    "list_source_tables",
    " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS rows FROM {n}" for n in GIVEN),
)
def _(w):
    return database_sizes(w.spark, _given_database(w))


@query(
    "list_source_columns",
    f"""SELECT table_name, column_name, CAST(ordinal_position AS BIGINT) AS position
        FROM information_schema.columns WHERE table_name IN ({", ".join(f"'{n}'" for n in GIVEN)})""",
)
def _(w):
    return catalog_columns(w.spark, _given_database(w)).drop("data_type")


@query("customers_of_country", "SELECT * FROM v_customers WHERE country = 'NATION_7'")
def _(w):
    return r.customers_of_country(w.customers, "NATION_7")


@query(
    "multi_file_csv_scan",
    """SELECT CASE WHEN o_orderstatus = 'P' THEN 'pending' ELSE 'settled' END AS folder,
              o_orderkey AS order_id, o_orderpriority AS priority
       FROM orders""",
)
def _(w):
    """Orders written as delimited files of two folders, then scanned as one source."""
    base = scratch_path(w.spark, "orders-csv")
    rows = w.raw("orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderpriority").alias("priority"),
        (F.col("o_orderstatus") == "P").alias("is_pending"),
    )
    for folder, flag in (("pending", F.col("is_pending")), ("settled", ~F.col("is_pending"))):
        rows.where(flag).drop("is_pending").write.option("header", True).csv(f"{base}/{folder}")
    both = read_csv(
        w.spark,
        [f"{base}/pending", f"{base}/settled"],
        "order_id bigint, priority string",
        source_file="path",
    )
    folder = F.element_at(F.split("path", "/"), -2)
    return both.select(folder.alias("folder"), "order_id", "priority")


@query(
    "semicolon_csv_scan",
    """SELECT o_orderkey AS order_id, o_orderpriority AS priority, o_totalprice AS total,
              CAST(o_orderdate AS DATE) AS day
       FROM orders""",
)
def _(w):
    """Orders written as text with semicolons, then parsed into declared types."""
    path = scratch_path(w.spark, "orders-semicolon")
    _order_rows(w).write.option("sep", ";").option("header", True).csv(path)
    return read_csv(w.spark, path, "order_id bigint, priority string, total double, day date", sep=";")


@query(
    "json_documents_scan",
    """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, c_nationkey AS nation
       FROM customer""",
)
def _(w):
    """Customers written as nested documents, one to a line, then read and flattened."""
    path = scratch_path(w.spark, "customers-json")
    w.raw("customer").select(
        F.col("c_custkey").cast("bigint").alias("id"),
        F.struct(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")).alias("profile"),
        F.col("c_nationkey").alias("nation"),
    ).write.json(path)
    schema = "id bigint, profile struct<name: string, segment: string>, nation int"
    return read_json(w.spark, path, schema).select("id", "profile.name", "profile.segment", "nation")


@query(
    "detected_column_types",
    """WITH f AS (SELECT count(*) AS n, count(*) FILTER (o_orderstatus = 'P') AS p,
                         count(*) FILTER (o_orderkey % 7 = 0) AS blank FROM orders)
       SELECT 'order_id' AS column_name, 'int' AS type, n AS filled, n AS fit, 'int' AS type_most_fit FROM f
       UNION ALL SELECT 'priority', 'string', n, 0, 'string' FROM f
       UNION ALL SELECT 'total', 'double', n, n, 'double' FROM f
       UNION ALL SELECT 'day', 'date', n, n, 'date' FROM f
       UNION ALL SELECT 'buyer', 'string', n, n - p, 'int' FROM f
       UNION ALL SELECT 'code', 'string', n, 0, 'string' FROM f
       UNION ALL SELECT 'sparse', 'bigint', n - blank, n - blank, 'bigint' FROM f""",
)
def _(w):
    """Types found in a text file whose columns are mixed: a buyer that is at times a word, codes
    with leading zeros, and wide numbers with gaps."""
    path = scratch_path(w.spark, "orders-mixed")
    orders = w.raw("orders")
    key = F.col("o_orderkey").cast("bigint")
    orders.select(
        key.alias("order_id"),
        F.col("o_orderpriority").alias("priority"),
        F.format_string("%.2f", F.col("o_totalprice").cast("double")).alias("total"),
        F.col("o_orderdate").cast("date").alias("day"),
        F.when(F.col("o_orderstatus") == "P", "unknown").otherwise(F.col("o_custkey").cast("string")).alias("buyer"),
        F.concat(F.lit("00"), key.cast("string")).alias("code"),
        F.when(key % 7 != 0, key + 10_000_000_000).alias("sparse"),
    ).write.option("sep", ";").option("header", True).csv(path)
    return column_types(read_csv(w.spark, path, sep=";"))


def _order_rows(w):
    return w.raw("orders").select(
        F.col("o_orderkey").cast("bigint").alias("order_id"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_totalprice").cast("double").alias("total"),
        F.col("o_orderdate").cast("date").alias("day"),
    )


def _loaded(w, name: str, frame, schema: str, times: int = 1, **how):
    """A frame loaded into a typed table of a database of its own, then read from the table."""
    database = f"loads_{uuid.uuid4().hex}"
    create_database(w.spark, database)
    table = f"{database}.{name}"
    parts = how.get("partition_by", ())
    create_table(w.spark, table, schema, scratch_path(w.spark, name), parts)
    for _ in range(times):
        load(frame, table, **how)
    return read_table(w.spark, table)


@query(
    "loaded_orders_by_priority",
    """SELECT o_orderpriority AS priority, count(*) AS orders,
              sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total
       FROM orders GROUP BY 1""",
)
def _(w):
    """Loaded twice, which must add nothing, into a table split by priority; then summed from it."""
    table = _loaded(
        w, "orders", _order_rows(w), "order_id bigint, total double, day date, priority string",
        times=2, partition_by=("priority",),
    )
    total = F.sum(F.col("total").cast("decimal(18,2)")).cast("decimal(38,2)")
    return table.groupBy("priority").agg(F.count(F.lit(1)).alias("orders"), total.alias("total"))


@query(
    "loaded_customers_appended",
    "SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT c_custkey, c_name FROM customer",
)
def _(w):
    """Two loads by position that add to a table."""
    rows = w.raw("customer").select(F.col("c_custkey").cast("bigint").alias("key"), F.col("c_name").alias("label"))
    return _loaded(w, "customers", rows, "id bigint, name string", times=2, mode="append", by="position")


@query(
    "order_total_summary",
    """SELECT 'count' AS summary, CAST(count(o_totalprice) AS DOUBLE) AS total FROM orders
       UNION ALL SELECT 'mean', round(avg(o_totalprice), 4) FROM orders
       UNION ALL SELECT 'stddev', round(stddev_samp(o_totalprice), 4) FROM orders
       UNION ALL SELECT 'min', min(o_totalprice) FROM orders
       UNION ALL SELECT 'max', max(o_totalprice) FROM orders""",
)
def _(w):
    """The summary of a column without its quartiles, which are estimates."""
    rows = column_summary(_order_rows(w), "total")
    return rows.where(~F.col("summary").endswith("%")).select(
        "summary", F.round(F.col("total").cast("double"), 4).alias("total")
    )
