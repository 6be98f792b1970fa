"""Queries over windows: group totals on every row, and global rank, lag and lead.

Group totals are grouped and joined back (see ``with_group_stats``); windows over
the whole table go through ``operators.global_window``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import ratio
from tidemark.operators.aggregate import with_dimension_totals, with_group_stats
from tidemark.operators.global_window import (
    global_lag,
    global_lead,
    global_rank,
    global_row_number,
)
from tidemark.operators.relational import join_on, semi
from tidemark.plans.relational import amount
from tidemark.session import materialize


def _mean(column):
    return ratio(F.sum(column), F.count(column))


def avg_price_by_category(products: DataFrame, categories: DataFrame) -> DataFrame:
    priced = with_group_stats(
        join_on(products, categories, ["category_id"]),
        ["category_id"],
        {"avg_price_by_category": _mean("unit_price")},
    )
    return priced.select("category_name", "product_name", "unit_price", "avg_price_by_category")


def _customer_lines(customers: DataFrame, orders: DataFrame, details: DataFrame) -> DataFrame:
    """Order lines of known customers."""
    known = semi(orders.select("order_id", "customer_id"), customers, ["customer_id"])
    return join_on(details, known, ["order_id"])


def avg_amount_by_customer(
    customers: DataFrame, orders: DataFrame, details: DataFrame
) -> DataFrame:
    lines = _customer_lines(customers, orders, details).withColumn("amount", amount())
    return with_group_stats(lines, ["customer_id"], {"avg_order_amount": _mean("amount")}).select(
        "avg_order_amount", "order_id", "customer_id", "unit_price", "quantity", "amount"
    )


def avg_qty_by_category(
    customers: DataFrame,
    orders: DataFrame,
    details: DataFrame,
    products: DataFrame,
    categories: DataFrame,
) -> DataFrame:
    catalog = join_on(products, categories, ["category_id"]).select(
        "product_id",
        "product_name",
        "category_id",
        "category_name",
        "quantity_per_unit",
        F.col("unit_price").alias("list_price"),
    )
    lines = _customer_lines(customers, orders, details)
    return (
        with_dimension_totals(
            lines.select("product_id", "quantity", "order_id", "line_no"),
            catalog,
            "product_id",
            "category_id",
            {"_units": F.sum("quantity"), "_lines": F.count("quantity")},
            {"avg_quantity": ratio(F.sum("_units"), F.sum("_lines"))},
        )
        .orderBy("category_name", "product_name", "product_id", "order_id", "line_no")
        .select(
            "product_name",
            "category_name",
            "quantity_per_unit",
            F.col("list_price").alias("unit_price"),
            "quantity",
            "avg_quantity",
        )
    )


def earliest_order_by_customer(orders: DataFrame) -> DataFrame:
    rows = orders.select("order_id", "customer_id", "order_date")
    return (
        with_group_stats(rows, ["customer_id"], {"earliest_date": F.min("order_date")})
        .orderBy(F.asc_nulls_last("customer_id"), "earliest_date", "order_id")
        .select("customer_id", "order_date", "earliest_date")
    )


def max_price_by_category(products: DataFrame) -> DataFrame:
    rows = products.select("product_id", "product_name", "unit_price", "category_id")
    return with_group_stats(rows, ["category_id"], {"max_unit_price": F.max("unit_price")})


def _units_by_product(products: DataFrame, details: DataFrame) -> DataFrame:
    """Units per product name; summed by key first, so the join sees one row per product."""
    per_key = details.groupBy("product_id").agg(F.sum("quantity").alias("units"))
    return (
        join_on(per_key, products.select("product_id", "product_name"), ["product_id"])
        .groupBy("product_name")
        .agg(F.sum("units").alias("units"))
    )


def best_seller_row_number(products: DataFrame, details: DataFrame) -> DataFrame:
    totals = materialize(_units_by_product(products, details))
    return global_row_number(totals, [("units", "desc")], ["product_name"], "ranking")


def customer_row_number(customers: DataFrame) -> DataFrame:
    rows = customers.drop("postal_code")
    return global_row_number(rows, ["customer_id"], [], "ranking")


def youngest_employee_row_number(employees: DataFrame) -> DataFrame:
    rows = employees.select(
        "employee_id", F.concat_ws(" ", "first_name", "last_name").alias("full_name"), "birth_date"
    )
    return global_row_number(rows, [("birth_date", "desc")], ["employee_id"], "ranking").drop(
        "employee_id"
    )


def sum_amount_by_customer(orders: DataFrame, details: DataFrame) -> DataFrame:
    header = orders.select(
        "order_id", "customer_id", "employee_id", "order_date", "required_date"
    )
    lines = join_on(details, header, ["order_id"])
    return with_group_stats(lines, ["customer_id"], {"sum_order_amount": F.sum(amount())}).select(
        F.col("sum_order_amount").cast("double").alias("sum_order_amount"),
        "order_id",
        "customer_id",
        "employee_id",
        "order_date",
        "required_date",
        "unit_price",
        "quantity",
    )


def _category_lines(
    products: DataFrame, categories: DataFrame, details: DataFrame
) -> DataFrame:
    catalog = join_on(
        products.select("product_id", "product_name", "category_id"), categories, ["category_id"]
    )
    return join_on(details, catalog, ["product_id"])


def total_sales_by_category(
    products: DataFrame, categories: DataFrame, details: DataFrame
) -> DataFrame:
    catalog = join_on(
        products.select("product_id", "product_name", "category_id"), categories, ["category_id"]
    )
    return (
        with_dimension_totals(
            details,
            catalog,
            "product_id",
            "category_name",
            {"_sales": F.sum(amount())},
            {"total": F.sum("_sales")},
        )
        .orderBy("category_name", "product_name", "product_id", "order_id", "line_no")
        .select(
            "category_name",
            "product_name",
            "unit_price",
            "quantity",
            F.col("total").cast("double").alias("total_sales"),
        )
    )


def freight_by_ship_country(orders: DataFrame) -> DataFrame:
    rows = orders.select("ship_country", "order_id", "shipped_date", "freight")
    return (
        with_group_stats(rows, ["ship_country"], {"total": F.sum("freight")})
        .orderBy("ship_country", "total", "order_id")
        .select(
            "ship_country",
            "order_id",
            "shipped_date",
            "freight",
            F.col("total").cast("double").alias("total_shipping_cost"),
        )
    )


def customer_sales_rank(
    customers: DataFrame, orders: DataFrame, details: DataFrame
) -> DataFrame:
    """Sales per customer, ranked. Lines are summed per order before any join."""
    per_order = details.groupBy("order_id").agg(F.sum(amount()).alias("order_total"))
    per_customer = (
        join_on(per_order, orders.select("order_id", "customer_id"), ["order_id"])
        .groupBy("customer_id")
        .agg(F.sum("order_total").cast("decimal(28,2)").alias("total"))
    )
    totals = materialize(
        join_on(per_customer, customers.select("customer_id", "company_name"), ["customer_id"])
    )
    return global_rank(totals, [("total", "desc")], "sales_rank").select(
        "customer_id",
        "company_name",
        F.col("total").cast("double").alias("total_sales"),
        "sales_rank",
    )


def hire_rank(employees: DataFrame) -> DataFrame:
    rows = employees.select("employee_id", "first_name", "last_name", "hire_date")
    return global_rank(rows, ["hire_date"], "hire_rank")


def price_rank(products: DataFrame) -> DataFrame:
    rows = products.select("product_id", "product_name", "unit_price")
    return global_rank(rows, [("unit_price", "desc")], "price_rank")


def prev_quantity(details: DataFrame) -> DataFrame:
    rows = details.select(
        "order_id", "line_no", "product_id", "supplier_id", "quantity", "unit_price"
    )
    tie = ["line_no", "product_id", "supplier_id", "quantity", "unit_price"]
    return global_lag(rows, "quantity", ["order_id"], tie, "prev_qty").select(
        "order_id", "product_id", "quantity", "prev_qty"
    )


def prev_order_date(orders: DataFrame) -> DataFrame:
    rows = orders.select("order_id", "order_date", "customer_id")
    return global_lag(
        rows, "order_date", ["customer_id", "order_date"], ["order_id"], "prev_order_date"
    )


def prev_price_difference(products: DataFrame) -> DataFrame:
    rows = products.select("product_id", "product_name", "unit_price")
    return global_lag(rows, "unit_price", ["product_id"], [], "prev_price").withColumn(
        "difference_price", (F.col("unit_price") - F.col("prev_price")).cast("decimal(12,2)")
    )


def next_price(products: DataFrame) -> DataFrame:
    rows = products.select("product_id", "product_name", "unit_price")
    return global_lead(rows, "unit_price", ["product_name"], ["product_id"], "next_price").select(
        "product_name", "unit_price", "next_price"
    )


def next_category_sales(
    products: DataFrame, categories: DataFrame, details: DataFrame
) -> DataFrame:
    per_product = details.groupBy("product_id").agg(F.sum(amount()).alias("product_total"))
    totals = materialize(
        _category_lines(products, categories, per_product)
        .groupBy("category_name")
        .agg(F.sum("product_total").cast("decimal(28,2)").alias("total"))
    )
    return global_lead(totals, "total", ["category_name"], [], "next_total").select(
        "category_name",
        F.col("total").cast("double").alias("total_sales"),
        F.col("next_total").cast("double").alias("next_total_sales"),
    )
