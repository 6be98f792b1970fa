from __future__ import annotations

from tidemark.catalog.registry import query
from tidemark.plans import ranking as k


@query(
    "avg_price_by_category",
    """SELECT category_name, product_name, unit_price,
              CAST(sum(unit_price) OVER g AS DOUBLE) / count(unit_price) OVER g
                  AS avg_price_by_category
       FROM v_products JOIN v_categories USING (category_id)
       WINDOW g AS (PARTITION BY category_id)""",
)
def _(w):
    return k.avg_price_by_category(w.products, w.categories)


@query(
    "avg_amount_by_customer",
    """SELECT CAST(sum(amount) OVER g AS DOUBLE) / count(*) OVER g AS avg_order_amount,
              order_id, customer_id, unit_price, quantity, amount
       FROM v_details JOIN v_orders USING (order_id) JOIN v_customers USING (customer_id)
       WINDOW g AS (PARTITION BY customer_id)""",
)
def _(w):
    return k.avg_amount_by_customer(w.customers, w.orders, w.order_details)


@query(
    "avg_qty_by_category",
    """SELECT product_name, category_name, quantity_per_unit, p.unit_price, quantity,
              CAST(sum(quantity) OVER g AS DOUBLE) / count(*) OVER g AS avg_quantity
       FROM v_details d JOIN v_products p USING (product_id)
            JOIN v_categories USING (category_id) JOIN v_orders USING (order_id)
            JOIN v_customers USING (customer_id)
       WINDOW g AS (PARTITION BY category_id)""",
)
def _(w):
    return k.avg_qty_by_category(
        w.customers, w.orders, w.order_details, w.products, w.categories
    )


@query(
    "earliest_order_by_customer",
    """SELECT customer_id, order_date,
              min(order_date) OVER (PARTITION BY customer_id) AS earliest_date
       FROM v_orders""",
)
def _(w):
    return k.earliest_order_by_customer(w.orders)


@query(
    "max_price_by_category",
    """SELECT product_id, product_name, unit_price, category_id,
              max(unit_price) OVER (PARTITION BY category_id) AS max_unit_price
       FROM v_products""",
)
def _(w):
    return k.max_price_by_category(w.products)


@query(
    "best_seller_row_number",
    """SELECT row_number() OVER (ORDER BY units DESC, product_name) AS ranking,
              product_name, units
       FROM (SELECT product_name, CAST(sum(quantity) AS BIGINT) AS units
             FROM v_details JOIN v_products USING (product_id) GROUP BY product_name)""",
)
def _(w):
    return k.best_seller_row_number(w.products, w.order_details)


@query(
    "customer_row_number",
    """SELECT row_number() OVER (ORDER BY customer_id) AS ranking, customer_id, company_name,
              contact_name, contact_title, address, city, region, country, phone, fax
       FROM v_customers""",
)
def _(w):
    return k.customer_row_number(w.customers)


@query(
    "youngest_employee_row_number",
    """SELECT row_number() OVER (ORDER BY birth_date DESC, employee_id) AS ranking,
              first_name || ' ' || last_name AS full_name, birth_date
       FROM v_employees""",
)
def _(w):
    return k.youngest_employee_row_number(w.employees)


@query(
    "sum_amount_by_customer",
    """SELECT CAST(sum(amount) OVER (PARTITION BY customer_id) AS DOUBLE) AS sum_order_amount,
              order_id, customer_id, employee_id, order_date, required_date, unit_price, quantity
       FROM v_details JOIN v_orders USING (order_id)""",
)
def _(w):
    return k.sum_amount_by_customer(w.orders, w.order_details)


@query(
    "total_sales_by_category",
    """SELECT category_name, product_name, d.unit_price, quantity,
              CAST(sum(amount) OVER (PARTITION BY category_name) AS DOUBLE) AS total_sales
       FROM v_details d JOIN v_products USING (product_id) JOIN v_categories USING (category_id)
       """,
)
def _(w):
    return k.total_sales_by_category(w.products, w.categories, w.order_details)


@query(
    "freight_by_ship_country",
    """SELECT ship_country, order_id, shipped_date, freight,
              CAST(sum(freight) OVER (PARTITION BY ship_country) AS DOUBLE)
                  AS total_shipping_cost
       FROM v_orders""",
)
def _(w):
    return k.freight_by_ship_country(w.orders)


@query(
    "customer_sales_rank",
    """SELECT customer_id, company_name, CAST(total AS DOUBLE) AS total_sales,
              rank() OVER (ORDER BY total DESC) AS sales_rank
       FROM (SELECT customer_id, company_name, sum(amount) AS total
             FROM v_details JOIN v_orders USING (order_id) JOIN v_customers USING (customer_id)
             GROUP BY ALL)""",
)
def _(w):
    return k.customer_sales_rank(w.customers, w.orders, w.order_details)


@query(
    "hire_rank",
    """SELECT employee_id, first_name, last_name, hire_date,
              rank() OVER (ORDER BY hire_date) AS hire_rank
       FROM v_employees""",
)
def _(w):
    return k.hire_rank(w.employees)


@query(
    "price_rank",
    """SELECT product_id, product_name, unit_price,
              rank() OVER (ORDER BY unit_price DESC NULLS LAST) AS price_rank
       FROM v_products""",
)
def _(w):
    return k.price_rank(w.products)


@query(
    "prev_quantity",
    """SELECT order_id, product_id, quantity,
              lag(quantity) OVER (ORDER BY order_id, line_no, product_id, supplier_id,
                                           quantity, unit_price) AS prev_qty
       FROM v_details""",
)
def _(w):
    return k.prev_quantity(w.order_details)


@query(
    "prev_order_date",
    """SELECT order_id, order_date, customer_id,
              lag(order_date) OVER (ORDER BY customer_id, order_date, order_id)
                  AS prev_order_date
       FROM v_orders""",
)
def _(w):
    return k.prev_order_date(w.orders)


@query(
    "prev_price_difference",
    """SELECT product_id, product_name, unit_price, prev_price,
              CAST(unit_price - prev_price AS DECIMAL(12,2)) AS difference_price
       FROM (SELECT *, lag(unit_price) OVER (ORDER BY product_id) AS prev_price FROM v_products)
       """,
)
def _(w):
    return k.prev_price_difference(w.products)


@query(
    "next_price",
    """SELECT product_name, unit_price,
              lead(unit_price) OVER (ORDER BY product_name, product_id) AS next_price
       FROM v_products""",
)
def _(w):
    return k.next_price(w.products)


@query(
    "next_category_sales",
    """SELECT category_name, CAST(total AS DOUBLE) AS total_sales,
              CAST(lead(total) OVER (ORDER BY category_name) AS DOUBLE) AS next_total_sales
       FROM (SELECT category_name, sum(amount) AS total
             FROM v_details JOIN v_products USING (product_id)
                  JOIN v_categories USING (category_id)
             GROUP BY category_name)""",
)
def _(w):
    return k.next_category_sales(w.products, w.categories, w.order_details)
