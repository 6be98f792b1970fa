"""Order-entry extracts and the two marts built from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import epoch_to_date
from tidemark.operators.aggregate import above_average
from tidemark.operators.relational import join_on
from tidemark.session import materialize


def customer_quantities(
    customers: DataFrame, orders: DataFrame, details: DataFrame
) -> DataFrame:
    """One row per order line: customer, company, quantity. Files carry no order."""
    header = join_on(
        orders.select("order_id", F.col("customer_id").alias("buyer_id")),
        customers.select("customer_id", "company_name"),
        [("buyer_id", "customer_id")],
    )
    return join_on(details.select("order_id", "quantity"), header, ["order_id"]).select(
        "customer_id", "company_name", "quantity"
    )


def order_companies(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Order, shipping date as epoch seconds (as the import stores it), company, phone."""
    return join_on(
        orders.select(
            "order_id",
            (F.unix_date("shipped_date").cast("bigint") * 86400).alias("shipped_date"),
            F.col("customer_id").alias("buyer_id"),
        ),
        customers.select("customer_id", "company_name", "phone"),
        [("buyer_id", "customer_id")],
    ).select("order_id", "shipped_date", "company_name", "phone")


def detail_extract(details: DataFrame) -> DataFrame:
    return details.select("order_id", "unit_price", "quantity", "discount")


def products_sold_above_average(quantities: DataFrame) -> DataFrame:
    """Order lines above the mean line quantity."""
    return above_average(
        quantities.withColumn("quantity", F.col("quantity").cast("int")), "quantity"
    )


def customers_above_average_quantity(quantities: DataFrame) -> DataFrame:
    """Customers whose total is above the mean customer total.

    The totals feed both the mean and the result, so they are written out once.
    """
    totals = materialize(
        quantities.groupBy("customer_id", "company_name").agg(
            F.sum("quantity").alias("quantity")
        )
    )
    return above_average(totals, "quantity")


def products_sent_discounted(
    shipments: DataFrame, details: DataFrame, unit: str = "s"
) -> DataFrame:
    """Discounted lines with shipping data. The discount is subtracted as an amount."""
    net = F.col("unit_price").cast("double") - F.col("discount")
    return (
        join_on(details.where(F.col("discount") != 0), shipments, ["order_id"])
        .withColumn("_net", net)
        .select(
            F.col("order_id").cast("int").alias("order_id"),
            epoch_to_date("shipped_date", unit).alias("shipped_date"),
            "company_name",
            "phone",
            F.col("_net").cast("float").alias("unit_price_discount"),
            F.col("quantity").cast("int").alias("quantity"),
            (F.col("_net") * F.col("quantity")).cast("float").alias("total_price"),
        )
    )
