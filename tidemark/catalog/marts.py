from __future__ import annotations

from tidemark.catalog.registry import query
from tidemark.plans import marts as m
from tidemark.session import scratch_path
from tidemark.sources.files import read_parquet, write_parquet

LINES = """SELECT customer_id, company_name, quantity
           FROM v_details JOIN v_orders USING (order_id) JOIN v_customers USING (customer_id)"""


def _quantities(w):
    return m.customer_quantities(w.customers, w.orders, w.order_details)


@query("import_customer_quantities", LINES)
def _(w):
    return _quantities(w)


@query(
    "import_order_companies",
    """SELECT order_id, CAST(epoch(CAST(shipped_date AS TIMESTAMP)) AS BIGINT) AS shipped_date,
              company_name, phone
       FROM v_orders JOIN v_customers USING (customer_id)""",
)
def _(w):
    return m.order_companies(w.orders, w.customers)


@query(
    "import_order_details",
    "SELECT order_id, unit_price, quantity, discount FROM v_details",
)
def _(w):
    return m.detail_extract(w.order_details)


@query(
    "products_sold_above_average",
    f"""WITH lines AS ({LINES})
        SELECT * FROM lines WHERE quantity > (SELECT avg(quantity) FROM lines)""",
)
def _(w):
    """As the job runs it: the extract is written first, the mart reads it twice."""
    extract = scratch_path(w.spark, "customer-quantities")
    rows = _quantities(w)
    write_parquet(rows, extract)
    return m.products_sold_above_average(read_parquet(w.spark, extract, rows.schema))


@query(
    "customers_above_average_quantity",
    f"""WITH totals AS (
            SELECT customer_id, company_name, CAST(sum(quantity) AS BIGINT) AS quantity
            FROM ({LINES}) GROUP BY customer_id, company_name)
        SELECT * FROM totals WHERE quantity > (SELECT avg(quantity) FROM totals)""",
)
def _(w):
    return m.customers_above_average_quantity(_quantities(w))


@query(
    "products_sent_discounted",
    """SELECT CAST(order_id AS INTEGER) AS order_id, shipped_date, company_name, phone,
              CAST(CAST(unit_price AS DOUBLE) - discount AS FLOAT) AS unit_price_discount,
              quantity,
              CAST((CAST(unit_price AS DOUBLE) - discount) * quantity AS FLOAT) AS total_price
       FROM v_details JOIN v_orders USING (order_id) JOIN v_customers USING (customer_id)
       WHERE discount <> 0""",
)
def _(w):
    return m.products_sent_discounted(
        m.order_companies(w.orders, w.customers), m.detail_extract(w.order_details)
    )
