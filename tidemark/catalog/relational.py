from __future__ import annotations

from tidemark.catalog.registry import query
from tidemark.plans import relational as r

NEW_CUSTOMER = {
    "customer_id": -1,
    "company_name": "New Company",
    "contact_name": "New Contact",
    "contact_title": "CEO",
    "address": "",
    "city": "Springfield",
    "region": "",
    "postal_code": "12209",
    "country": "NATION_1",
    "phone": "555-0100",
    "fax": "555-0101",
}


@query("distinct_categories", "SELECT DISTINCT category_name FROM v_categories")
def _(w):
    return r.distinct_values(w.categories, "category_name")


@query("distinct_customer_regions", "SELECT region FROM v_customers GROUP BY region")
def _(w):
    return r.distinct_values(w.customers, "region")


@query("distinct_contact_titles", "SELECT contact_title FROM v_customers GROUP BY contact_title")
def _(w):
    return r.distinct_values(w.customers, "contact_title")


@query(
    "customers_by_country",
    "SELECT * FROM v_customers ORDER BY country NULLS LAST, customer_id",
)
def _(w):
    return r.customers_by_country(w.customers)


@query(
    "orders_by_employee_date",
    "SELECT * FROM v_orders ORDER BY employee_id, order_date, order_id",
)
def _(w):
    return r.orders_by_employee_date(w.orders)


@query(
    "append_customer",
    """SELECT * FROM v_customers UNION ALL
       SELECT -1, 'New Company', 'New Contact', 'CEO', '', 'Springfield', '', '12209',
              'NATION_1', '555-0100', '555-0101'""",
)
def _(w):
    return r.append_customer(w.customers, **NEW_CUSTOMER)


@query(
    "append_region",
    """SELECT r_regionkey AS region_id, r_name AS region_description FROM region
       UNION ALL SELECT 5, 'CENTER'""",
)
def _(w):
    return r.append_region(w.regions, 5, "CENTER")


@query("customers_region_null", "SELECT * FROM v_customers WHERE region IS NULL")
def _(w):
    return r.customers_region_null(w.customers)


@query(
    "price_or_default",
    """SELECT product_name, CASE WHEN unit_price IS NULL THEN 10 ELSE unit_price END
              AS unit_price
       FROM v_products""",
)
def _(w):
    return r.price_or_default(w.products)


@query(
    "customer_order_dates",
    """SELECT company_name, contact_name, order_date
       FROM v_orders JOIN v_customers USING (customer_id)""",
)
def _(w):
    return r.customer_order_dates(w.customers, w.orders)


@query(
    "order_product_discount",
    """SELECT product_name, order_id, discount
       FROM v_details JOIN v_products USING (product_id)""",
)
def _(w):
    return r.order_product_discount(w.products, w.order_details)


@query(
    "customers_left_orders",
    """SELECT b.customer_id, b.company_name, a.order_id, a.order_date
       FROM v_customers b LEFT JOIN v_orders a ON a.customer_id = b.customer_id""",
)
def _(w):
    return r.customers_left_orders(w.customers, w.orders)


@query(
    "employee_territories",
    """SELECT a.employee_id, last_name, a.territory_id, territory_description
       FROM v_staff_territories a JOIN v_employees USING (employee_id)
            JOIN v_territories USING (territory_id)""",
)
def _(w):
    return r.employee_territories(w.employees, w.employee_territories, w.territories)


@query(
    "orders_left_customers",
    """SELECT a.order_id, b.company_name
       FROM v_orders a LEFT JOIN v_customers b ON a.customer_id = b.customer_id""",
)
def _(w):
    return r.orders_left_customers(w.orders, w.customers)


@query(
    "orders_right_customers",
    """SELECT a.order_id, b.company_name
       FROM v_customers b LEFT JOIN v_orders a ON a.customer_id = b.customer_id""",
)
def _(w):
    return r.orders_right_customers(w.orders, w.customers)


@query(
    "shippers_right_orders_year",
    """SELECT r_name AS company_name, order_date
       FROM v_orders LEFT JOIN region ON r_regionkey = ship_via
       WHERE year(order_date) = 1996""",
)
def _(w):
    return r.shippers_right_orders_year(w.shippers, w.orders, 1996)


@query(
    "employees_full_territories",
    """SELECT first_name, last_name, t.territory_id
       FROM v_employees e FULL JOIN v_staff_territories a ON a.employee_id = e.employee_id
            FULL JOIN v_territories t ON t.territory_id = a.territory_id""",
)
def _(w):
    return r.employees_full_territories(w.employees, w.employee_territories, w.territories)


@query(
    "orders_full_details_total",
    """SELECT a.order_id, unit_price, quantity, amount AS total
       FROM v_orders a FULL JOIN v_details b ON b.order_id = a.order_id""",
)
def _(w):
    return r.orders_full_details_total(w.orders, w.order_details)


@query(
    "union_company_names",
    "SELECT company_name FROM v_customers UNION SELECT company_name FROM v_suppliers",
)
def _(w):
    return r.union_company_names(w.suppliers, w.customers)


@query(
    "union_employee_manager_names",
    """SELECT first_name AS name FROM v_employees UNION
       SELECT s.first_name FROM v_employees s JOIN v_employees b
              ON b.employee_id = s.reports_to
       ORDER BY name""",
)
def _(w):
    return r.union_employee_manager_names(w.employees)


@query(
    "products_sold_semi",
    """SELECT product_name, product_id FROM v_products p
       WHERE EXISTS (SELECT 1 FROM v_details d WHERE d.product_id = p.product_id)""",
)
def _(w):
    return r.products_sold_semi(w.products, w.order_details)


@query(
    "customers_shipped_to_country",
    """SELECT company_name FROM v_customers c WHERE EXISTS (
           SELECT 1 FROM v_orders o
           WHERE o.customer_id = c.customer_id AND ship_country = 'NATION_7')""",
)
def _(w):
    return r.customers_shipped_to_country(w.customers, w.orders, "NATION_7")


@query(
    "products_ordered_outside_country",
    """SELECT DISTINCT product_name
       FROM v_products JOIN v_details USING (product_id) JOIN v_orders USING (order_id)
            JOIN v_customers USING (customer_id)
       WHERE country <> 'NATION_3'""",
)
def _(w):
    return r.products_ordered_outside_country(
        w.products, w.order_details, w.orders, w.customers, "NATION_3"
    )


@query(
    "products_never_ordered_by_country",
    """SELECT product_id, product_name FROM v_products
       EXCEPT
       SELECT product_id, product_name
       FROM v_products JOIN v_details USING (product_id) JOIN v_orders USING (order_id)
            JOIN v_customers USING (customer_id)
       WHERE country = 'NATION_3'""",
)
def _(w):
    return r.products_never_ordered_by_country(
        w.products, w.order_details, w.orders, w.customers, "NATION_3"
    )


@query(
    "qty_per_order",
    """SELECT order_id, CAST(sum(quantity) AS BIGINT) AS total_quantity
       FROM v_details GROUP BY order_id""",
)
def _(w):
    return r.qty_per_order(w.order_details)


@query(
    "avg_stock_per_product",
    """SELECT product_name, CAST(sum(units_in_stock) AS DOUBLE) / count(*) AS avg_stock
       FROM v_products GROUP BY product_name""",
)
def _(w):
    return r.avg_stock_per_product(w.products)


@query(
    "stock_having_over_100",
    """SELECT product_name, CAST(sum(units_in_stock) AS BIGINT) AS total_stock
       FROM v_products GROUP BY product_name HAVING sum(units_in_stock) > 100""",
)
def _(w):
    return r.stock_having_over(w.products, 100)


@query(
    "avg_orders_per_company",
    """SELECT company_name, CAST(sum(order_id) AS DOUBLE) / count(order_id) AS avg_order_id
       FROM v_orders JOIN v_customers USING (customer_id) GROUP BY company_name""",
)
def _(w):
    return r.avg_orders_per_company(w.customers, w.orders)


@query(
    "avg_orders_per_company_having",
    """SELECT company_name, count(*) AS orders
       FROM v_orders JOIN v_customers USING (customer_id)
       GROUP BY company_name HAVING count(*) > 10""",
)
def _(w):
    return r.companies_with_many_orders(w.customers, w.orders, 10)


@query(
    "category_or_discontinued",
    """SELECT product_name,
              CASE discontinued WHEN 0 THEN category_name ELSE 'Discontinued' END AS new_category
       FROM v_products JOIN v_categories USING (category_id)""",
)
def _(w):
    return r.category_or_discontinued(w.products, w.categories)


@query(
    "translated_title",
    """SELECT first_name, last_name,
              CASE WHEN title = 'Sales Representative' THEN title ELSE 'Gerente de Ventas' END
                  AS new_title
       FROM v_employees""",
)
def _(w):
    return r.translated_title(w.employees)
