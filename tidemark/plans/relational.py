"""Order-entry queries: projections, joins, set operations, groupings, CASE."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import money, ratio
from tidemark.operators.relational import (
    anti,
    append_rows,
    join_on,
    outer_join,
    semi,
    union_distinct,
)
from tidemark.session import stored


def amount(price: str = "unit_price", quantity: str = "quantity") -> Column:
    return money(F.col(price) * F.col(quantity))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of a column; null counts as one value."""
    return df.select(column).distinct()


def customers_by_country(customers: DataFrame) -> DataFrame:
    return customers.orderBy(F.asc_nulls_last("country"), "customer_id")


def orders_by_employee_date(orders: DataFrame) -> DataFrame:
    return orders.orderBy(
        F.asc_nulls_last("employee_id"), F.asc_nulls_last("order_date"), "order_id"
    )


def append_customer(customers: DataFrame, **values) -> DataFrame:
    return append_rows(customers, [values])


def append_region(regions: DataFrame, region_id: int, description: str) -> DataFrame:
    return append_rows(regions, [{"region_id": region_id, "region_description": description}])


def customers_region_null(customers: DataFrame) -> DataFrame:
    return customers.where(F.col("region").isNull())


def price_or_default(products: DataFrame, default=10) -> DataFrame:
    return products.select(
        "product_name", F.coalesce("unit_price", F.lit(default)).alias("unit_price")
    )


def _order_keys(orders: DataFrame) -> DataFrame:
    return orders.select("order_id", "order_date", F.col("customer_id").alias("buyer_id"))


def customer_order_dates(customers: DataFrame, orders: DataFrame) -> DataFrame:
    return join_on(_order_keys(orders), customers, [("buyer_id", "customer_id")]).select(
        "company_name", "contact_name", "order_date"
    )


def order_product_discount(products: DataFrame, details: DataFrame) -> DataFrame:
    return join_on(details, products.select("product_id", "product_name"), ["product_id"]).select(
        "product_name", "order_id", "discount"
    )


def customers_left_orders(customers: DataFrame, orders: DataFrame) -> DataFrame:
    return outer_join(
        customers.select("customer_id", "company_name"),
        _order_keys(orders),
        [("customer_id", "buyer_id")],
        "left",
    ).select("customer_id", "company_name", "order_id", "order_date")


def orders_left_customers(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """All orders. The many side is the kept side, which adaptive execution can split."""
    return (
        _order_keys(orders)
        .join(customers, F.col("buyer_id") == F.col("customer_id"), "left")
        .select("order_id", "company_name")
    )


def orders_right_customers(orders: DataFrame, customers: DataFrame) -> DataFrame:
    return outer_join(
        _order_keys(orders),
        customers.select("customer_id", "company_name"),
        [("buyer_id", "customer_id")],
        "right",
    ).select("order_id", "company_name")


def employee_territories(
    employees: DataFrame, assignments: DataFrame, territories: DataFrame
) -> DataFrame:
    return join_on(
        join_on(assignments, employees.select("employee_id", "last_name"), ["employee_id"]),
        territories,
        ["territory_id"],
    ).select("employee_id", "last_name", "territory_id", "territory_description")


def shippers_right_orders_year(shippers: DataFrame, orders: DataFrame, year: int) -> DataFrame:
    """Orders of one year with their shipper, if known.

    The year is written as a date range, which the file scan can use.
    """
    in_year = F.col("order_date").between(
        F.lit(datetime.date(year, 1, 1)), F.lit(datetime.date(year, 12, 31))
    )
    return (
        shippers.select("shipper_id", "company_name")
        .join(orders.where(in_year), F.col("shipper_id") == F.col("ship_via"), "right")
        .select("company_name", "order_date")
    )


def employees_full_territories(
    employees: DataFrame, assignments: DataFrame, territories: DataFrame
) -> DataFrame:
    # Written, so that the second join does not read the first one's tables again.
    joined = outer_join(
        employees.select("employee_id", "first_name", "last_name"),
        assignments.select(
            F.col("employee_id").alias("assigned_id"), F.col("territory_id").alias("assigned_to")
        ),
        [("employee_id", "assigned_id")],
        "full",
    )
    assigned = stored(joined, "assigned")
    return outer_join(
        assigned, territories.select("territory_id"), [("assigned_to", "territory_id")], "full"
    ).select("first_name", "last_name", "territory_id")


def orders_full_details_total(orders: DataFrame, details: DataFrame) -> DataFrame:
    lines = details.select(
        F.col("order_id").alias("line_order_id"),
        "unit_price",
        "quantity",
        amount().alias("total"),
    )
    return outer_join(
        orders.select("order_id"), lines, [("order_id", "line_order_id")], "full"
    ).select("order_id", "unit_price", "quantity", "total")


def union_company_names(suppliers: DataFrame, customers: DataFrame) -> DataFrame:
    return union_distinct(suppliers.select("company_name"), customers.select("company_name"))


def union_employee_manager_names(employees: DataFrame) -> DataFrame:
    """First names of employees, and of those who report to an existing manager.

    The second part names the subordinate, so the union adds nothing to the first.
    """
    managers = employees.select("employee_id")
    reporting = semi(employees, managers, [("reports_to", "employee_id")])
    return union_distinct(
        employees.select(F.col("first_name").alias("name")),
        reporting.select(F.col("first_name").alias("name")),
    ).orderBy(F.asc_nulls_last("name"))


def products_sold_semi(products: DataFrame, details: DataFrame) -> DataFrame:
    return semi(products, details, ["product_id"]).select("product_name", "product_id")


def customers_shipped_to_country(
    customers: DataFrame, orders: DataFrame, country: str
) -> DataFrame:
    shipped = orders.where(F.col("ship_country") == country)
    return semi(customers, shipped, ["customer_id"]).select("company_name")


def _lines_of_customers(customers, orders, details):
    return semi(details, semi(orders, customers, ["customer_id"]), ["order_id"])


def products_ordered_outside_country(
    products: DataFrame, details: DataFrame, orders: DataFrame, customers: DataFrame, country: str
) -> DataFrame:
    """Product names ordered by some customer of another country."""
    others = customers.where(F.col("country") != country)
    lines = _lines_of_customers(others, orders, details)
    return semi(products, lines, ["product_id"]).select("product_name").distinct()


def products_never_ordered_by_country(
    products: DataFrame, details: DataFrame, orders: DataFrame, customers: DataFrame, country: str
) -> DataFrame:
    """Products no customer of the country ever ordered."""
    locals_ = customers.where(F.col("country") == country)
    lines = _lines_of_customers(locals_, orders, details)
    return anti(products, lines, ["product_id"]).select("product_id", "product_name")


def qty_per_order(details: DataFrame) -> DataFrame:
    return details.groupBy("order_id").agg(F.sum("quantity").alias("total_quantity"))


def avg_stock_per_product(products: DataFrame) -> DataFrame:
    return products.groupBy("product_name").agg(
        ratio(F.sum("units_in_stock"), F.count("units_in_stock")).alias("avg_stock")
    )


def stock_having_over(products: DataFrame, threshold: int = 100) -> DataFrame:
    return (
        products.groupBy("product_name")
        .agg(F.sum("units_in_stock").alias("total_stock"))
        .where(F.col("total_stock") > threshold)
    )


def avg_orders_per_company(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Mean order number per company, as the query is written.

    Totals are taken per customer before the join, so it carries one row each.
    """
    per_customer = orders.groupBy(F.col("customer_id").alias("buyer_id")).agg(
        F.sum("order_id").alias("id_total"), F.count("order_id").alias("orders")
    )
    return (
        join_on(per_customer, customers, [("buyer_id", "customer_id")])
        .groupBy("company_name")
        .agg(ratio(F.sum("id_total"), F.sum("orders")).alias("avg_order_id"))
    )


def companies_with_many_orders(
    customers: DataFrame, orders: DataFrame, more_than: int = 10
) -> DataFrame:
    per_customer = orders.groupBy(F.col("customer_id").alias("buyer_id")).agg(
        F.count(F.lit(1)).alias("orders")
    )
    return (
        join_on(per_customer, customers, [("buyer_id", "customer_id")])
        .groupBy("company_name")
        .agg(F.sum("orders").alias("orders"))
        .where(F.col("orders") > more_than)
    )


def category_or_discontinued(products: DataFrame, categories: DataFrame) -> DataFrame:
    return join_on(products, categories, ["category_id"]).select(
        "product_name",
        F.when(F.col("discontinued") == 0, F.col("category_name"))
        .otherwise("Discontinued")
        .alias("new_category"),
    )


def translated_title(
    employees: DataFrame, title: str = "Sales Manager", shown: str = "Gerente de Ventas"
) -> DataFrame:
    """The one title shown in Spanish; an unknown title is shown the same way."""
    return employees.select(
        "first_name",
        "last_name",
        F.when(F.col("title") != title, F.col("title")).otherwise(shown).alias("new_title"),
    )


def customers_of_country(customers: DataFrame, country: str) -> DataFrame:
    return customers.where(F.col("country") == country)
