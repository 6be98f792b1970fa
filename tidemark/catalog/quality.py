from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.registry import query
from tidemark.operators import ml
from tidemark.operators import quality as q


@query(
    "dedup_first_order",
    """SELECT customer_id, order_date, order_id FROM v_orders
       QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY order_date, order_id) = 1""",
)
def _(w):
    rows = w.orders.select("customer_id", "order_date", "order_id")
    return q.dedup(rows, ["customer_id"], [F.asc("order_date"), F.asc("order_id")])


@query(
    "impute_price_by_category",
    """SELECT product_id, category_id,
              coalesce(CAST(unit_price AS DOUBLE), CAST(sum(unit_price) OVER g AS DOUBLE)
                       / count(unit_price) OVER g) AS unit_price
       FROM v_products WINDOW g AS (PARTITION BY category_id)""",
)
def _(w):
    rows = w.products.select("product_id", "category_id", "unit_price")
    return q.impute_group_mean(rows, "unit_price", "category_id")


ORDER_COLUMNS = (
    "order_id", "customer_id", "employee_id", "order_date", "required_date", "shipped_date",
    "ship_via", "freight", "ship_country",
)


@query(
    "column_profile",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS rows, count(*) - count({c}) AS nulls,
                   count(DISTINCT {c}) AS "distinct", CAST(min({c}) AS VARCHAR) AS least,
                   CAST(max({c}) AS VARCHAR) AS greatest FROM v_orders"""
        for c in ORDER_COLUMNS
    ),
)
def _(w):
    profile = q.column_profile(w.orders, ORDER_COLUMNS).drop("approx_distinct")
    return profile.join(q.distinct_counts(w.orders, ORDER_COLUMNS), "column_name")


@query(
    "distinct_estimates",
    " UNION ALL ".join(f"SELECT '{c}' AS column_name, true AS within FROM v_orders HAVING count(*) > 0" for c in ORDER_COLUMNS),
)
def _(w):
    """Whether the mergeable estimate is within four standard errors of the exact number."""
    estimate = q.column_profile(w.orders, ORDER_COLUMNS).select("column_name", "approx_distinct")
    exact = q.distinct_counts(w.orders, ORDER_COLUMNS)
    off = F.abs(F.col("approx_distinct") - F.col("distinct"))
    within = off <= F.greatest(F.lit(1.0), 4 * F.lit(0.05) * F.col("distinct"))
    return estimate.join(exact, "column_name").select("column_name", within.alias("within"))


@query(
    "duplicate_columns",
    """SELECT 'customer_id' AS first, 'buyer_id' AS second
       FROM v_orders o JOIN v_customers c ON c.customer_id = o.customer_id
       HAVING count(*) FILTER (WHERE o.customer_id IS DISTINCT FROM c.customer_id) = 0
       UNION ALL
       SELECT 'order_date', 'required_date' FROM v_orders o JOIN v_customers c ON c.customer_id = o.customer_id
       HAVING count(*) FILTER (WHERE order_date IS DISTINCT FROM required_date) = 0""",
)
def _(w):
    """The customer of an order and the key of the row it is joined to, from two tables."""
    buyers = w.customers.select(F.col("customer_id").alias("buyer_id"))
    return q.duplicate_columns(w.orders.join(buyers, F.col("customer_id") == F.col("buyer_id")))


def _order_rules():
    return {
        "shipped": F.col("shipped_date").isNotNull(),
        "known_shipper": F.col("ship_via").between(1, 4),
        "worth_shipping": F.col("freight") > 10000,
    }


BROKEN = {
    "shipped": "shipped_date IS NULL",
    "known_shipper": "ship_via NOT BETWEEN 1 AND 4",
    "worth_shipping": "freight <= 10000",
}


@query(
    "validation_counts",
    " UNION ALL ".join(
        f"SELECT '{n}' AS rule, count(*) FILTER (WHERE {p}) AS broken FROM v_orders"
        for n, p in BROKEN.items()
    ),
)
def _(w):
    return q.validate(w.orders, _order_rules())[2]


@query(
    "validation_quarantine",
    f"""SELECT order_id,
               concat_ws(',', CASE WHEN {BROKEN['shipped']} THEN 'shipped' END,
                         CASE WHEN {BROKEN['known_shipper']} THEN 'known_shipper' END,
                         CASE WHEN {BROKEN['worth_shipping']} THEN 'worth_shipping' END)
                   AS broken_rules
        FROM v_orders WHERE {' OR '.join(BROKEN.values())}""",
)
def _(w):
    _, bad, _ = q.validate(w.orders, _order_rules())
    return bad.select("order_id", F.concat_ws(",", "broken_rules").alias("broken_rules"))


@query(
    "standardized_orders",
    """SELECT o_orderkey AS order_id, lower(o_orderpriority) AS priority,
              CAST(o_orderdate AS DATE) AS order_date
       FROM orders""",
)
def _(w):
    """Dates delivered in two formats and labels in upper case, made uniform."""
    day = F.col("o_orderdate").cast("date")
    mixed = F.when(F.col("o_orderstatus") == "F", F.date_format(day, "dd/MM/yyyy")).otherwise(
        F.date_format(day, "yyyy-MM-dd")
    )
    raw = w.raw("orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.concat(F.lit(" "), "o_orderpriority").alias("priority"),
        mixed.alias("order_date"),
    )
    return q.standardize_dates(
        q.standardize_text(raw, "priority"), "order_date", "yyyy-MM-dd", "dd/MM/yyyy"
    )


@query(
    "pseudonymized_customers",
    """SELECT customer_id, sha256('pepper' || company_name) AS company_name, country
       FROM v_customers""",
)
def _(w):
    rows = w.customers.select("customer_id", "company_name", "country")
    return q.pseudonymize(rows, "pepper", "company_name")


@query(
    "masked_documents",
    rf"""SELECT doc_id, regexp_replace(text, '{q.EMAIL}', '***', 'g') AS text FROM documents""",
)
def _(w):
    return q.mask_text(w.documents.select("doc_id", "text"), "text", contains="@")


@query(
    "payments_without_outliers",
    """WITH f AS (SELECT quantile_disc(value, 0.25) AS lo, quantile_disc(value, 0.75) AS hi
                  FROM events)
       SELECT event_id, value FROM events, f
       WHERE value BETWEEN lo - 1.5 * (hi - lo) AND hi + 1.5 * (hi - lo)""",
)
def _(w):
    return q.iqr_filter(w.events.select("event_id", "value"), "value")


@query(
    "encoded_scaled_customers",
    """WITH seg AS (SELECT c_mktsegment, row_number() OVER (ORDER BY count(*) DESC, c_mktsegment)
                           - 1 AS pos FROM customer GROUP BY c_mktsegment),
            s AS (SELECT avg(c_acctbal) AS mu, stddev_samp(c_acctbal) AS sd FROM customer)
       SELECT c_custkey AS customer_id, CAST(pos AS DOUBLE) AS segment_index,
              round((c_acctbal - mu) / sd, 6) AS balance_scaled
       FROM customer JOIN seg USING (c_mktsegment), s""",
)
def _(w):
    rows = w.raw("customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("balance"),
    )
    return ml.encode_scale(rows, ["segment"], ["balance"]).select(
        "customer_id", "segment_index", F.round("balance_scaled", 6).alias("balance_scaled")
    )


@query(
    "linear_price_by_quantity",
    """SELECT 'intercept' AS term,
              round(regr_intercept(l_extendedprice, l_quantity), 3) AS coefficient FROM lineitem
       UNION ALL
       SELECT 'l_quantity', round(regr_slope(l_extendedprice, l_quantity), 3) FROM lineitem""",
)
def _(w):
    fit = ml.fit_linear(w.raw("lineitem"), "l_extendedprice", ["l_quantity"])
    return fit.withColumn("coefficient", F.round("coefficient", 3))
