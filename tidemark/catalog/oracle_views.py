"""The logical tables once more, in plain SQL, for the checking engine only."""

VIEWS = {
    "v_products": """
        SELECT p_partkey AS product_id, p_name AS product_name,
               CAST(split_part(p_brand, '#', 2) AS INTEGER) - 1 AS category_id,
               p_size || ' x ' || lower(p_type) AS quantity_per_unit,
               CASE WHEN p_size < 50 THEN CAST(p_retailprice AS DECIMAL(12,2)) END AS unit_price,
               p_size AS units_in_stock,
               CASE WHEN p_type = 'PROMO' THEN 1 ELSE 0 END AS discontinued
        FROM part""",
    "v_categories": """
        SELECT n_nationkey AS category_id, replace(n_name, 'NATION', 'Category') AS category_name
        FROM nation""",
    "v_customers": """
        SELECT c_custkey AS customer_id, c_name AS company_name,
               'Contact ' || c_custkey AS contact_name, c_mktsegment AS contact_title,
               'Street ' || c_custkey AS address, n_name || ' city' AS city,
               nullif(r_name, 'ASIA') AS region,
               lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS postal_code, n_name AS country,
               (c_nationkey + 10) || '-' || c_custkey AS phone, CAST(NULL AS VARCHAR) AS fax
        FROM customer JOIN nation ON c_nationkey = n_nationkey
             JOIN region ON n_regionkey = r_regionkey""",
    "v_orders": """
        SELECT o_orderkey AS order_id, o_custkey + 10 AS customer_id,
               o_custkey // 15 AS employee_id, CAST(o_orderdate AS DATE) AS order_date,
               CAST(o_orderdate AS DATE) + 28 AS required_date,
               CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) + 7 END
                   AS shipped_date,
               CAST(o_orderpriority[1] AS INTEGER) AS ship_via,
               CAST(o_totalprice AS DECIMAL(18,2)) AS freight,
               'NATION_' || (o_custkey % 25) AS ship_country
        FROM orders""",
    "v_details": """
        SELECT l_orderkey AS order_id, l_partkey AS product_id, l_linenumber AS line_no,
               l_suppkey AS supplier_id, CAST(l_extendedprice AS DECIMAL(12,2)) AS unit_price,
               CAST(l_quantity AS INTEGER) AS quantity, l_discount AS discount,
               CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_quantity AS INTEGER)
                    AS DECIMAL(18,2)) AS amount
        FROM lineitem""",
    "v_employees": """
        SELECT s_suppkey AS employee_id, 'Name' || s_nationkey AS first_name,
               s_name AS last_name,
               CASE WHEN s_acctbal > 6000 THEN 'Sales Manager'
                    WHEN s_acctbal > 0 THEN 'Sales Representative' END AS title,
               DATE '1970-01-01' + CAST(floor(s_acctbal) AS INTEGER) AS birth_date,
               DATE '1992-01-01' + s_nationkey * 30 AS hire_date,
               CASE WHEN s_suppkey > 0 THEN s_suppkey // 10 END AS reports_to
        FROM supplier""",
    "v_staff_territories": """
        SELECT s_suppkey AS employee_id, s_nationkey AS territory_id FROM supplier""",
    "v_territories": """
        SELECT n_nationkey + 3 AS territory_id, n_name AS territory_description FROM nation""",
    "v_suppliers": """
        SELECT s_suppkey AS supplier_id,
               CASE WHEN s_acctbal < 5000 THEN replace(s_name, 'Supplier', 'Customer')
                    ELSE s_name END AS company_name
        FROM supplier""",
    "v_trips": """
        SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS trip_id,
               CAST(l_suppkey % 2 + 1 AS INTEGER) AS vendor_id,
               CAST(l_shipdate AS DATE) AS pickup_date, l_linenumber AS passenger_count,
               l_quantity AS trip_distance,
               CASE l_returnflag WHEN 'A' THEN 'Group Ride' WHEN 'R' THEN 'Negotiated'
                    ELSE 'Standard' END AS ratecode,
               CASE WHEN l_linestatus = 'O' THEN 1 ELSE 2 END AS payment_type,
               CAST(CAST(l_discount AS DECIMAL(4,2)) * CAST(l_quantity AS INTEGER) AS DOUBLE)
                   AS tip_amount,
               l_tax AS tolls_amount, l_discount AS congestion_surcharge,
               nullif(l_tax, 0) AS airport_fee, l_extendedprice AS total_amount
        FROM lineitem""",
    "v_drivers": """
        SELECT p_partkey AS driver_id, p_name AS forename, p_brand AS surname,
               p_type AS nationality FROM part""",
    "v_constructors": """
        SELECT s_suppkey AS constructor_id, lower(s_name) AS ref, s_name AS name,
               'Nationality ' || s_nationkey AS nationality,
               'https://example.org/' || s_suppkey AS url
        FROM supplier""",
    "v_logs_may": """
        SELECT c_custkey AS id, c_name AS first_name, c_mktsegment AS last_name,
               CASE WHEN c_acctbal > -900 THEN '10.' || (c_custkey // 65536 % 256) || '.'
                    || (c_custkey // 256 % 256) || '.' || (c_custkey % 256) END AS ip
        FROM customer""",
    "v_logs_april": """
        SELECT s_suppkey AS id, s_name AS first_name, 'Nation ' || s_nationkey AS last_name,
               CASE WHEN s_acctbal > -900 THEN '10.' || (s_suppkey * 20 // 65536 % 256) || '.'
                    || (s_suppkey * 20 // 256 % 256) || '.' || (s_suppkey * 20 % 256) END AS ip
        FROM supplier""",
    "v_passengers": """
        SELECT CAST(c_custkey AS INTEGER) AS passenger_id,
               CASE WHEN c_acctbal > 4500 THEN 1 ELSE 0 END AS survived,
               c_nationkey % 3 + 1 AS pclass, c_name AS name,
               CASE WHEN c_mktsegment IN ('MACHINERY', 'AUTOMOBILE') THEN 'male'
                    WHEN c_mktsegment IN ('FURNITURE', 'HOUSEHOLD') THEN 'female' END AS sex,
               CASE WHEN c_acctbal >= 0 THEN CAST(floor(c_acctbal) AS INTEGER) % 80 END AS age,
               CASE WHEN c_acctbal >= 0 THEN CAST(floor(c_acctbal) AS INTEGER) % 80 + 0.5 END
                   AS exact_age,
               'T' || c_custkey AS ticket, CAST(c_acctbal AS FLOAT) AS fare,
               CASE WHEN c_mktsegment <> 'BUILDING' THEN 'C' || c_nationkey ELSE '0' END AS cabin,
               c_mktsegment[1] AS embarked
        FROM customer""",
    "v_flights": """
        SELECT CAST(l_shipdate AS DATE) AS fecha,
               (l_linenumber + 10) || ':' || (CAST(l_quantity AS INTEGER) + 9) AS horautc,
               CASE WHEN l_tax > 0 THEN 'Regular' ELSE 'No Regular' END AS clase_de_vuelo,
               'Domestico' AS clasificacion_de_vuelo,
               CASE WHEN l_returnflag = 'R' THEN 'Aterrizaje' ELSE 'Despegue' END
                   AS tipo_de_movimiento,
               'AP' || (l_suppkey % 30) AS aeropuerto,
               'AP' || (l_partkey % 25) AS origen_destino,
               CASE WHEN l_linenumber = 6 THEN '0'
                    WHEN l_linenumber < 6 THEN 'Airline ' || (l_suppkey % 50) END
                   AS aerolinea_nombre,
               CASE WHEN l_discount > 0 THEN 'BO-' || (l_partkey % 97) ELSE '0' END AS aeronave,
               CASE WHEN l_quantity < 50 THEN CAST(l_quantity AS INTEGER) ELSE 0 END AS pasajeros
        FROM lineitem WHERE l_linestatus = 'O'""",
    "v_airports": """
        SELECT 'AP' || n_nationkey AS aeropuerto, r_name AS provincia
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "v_rentals": """
        SELECT CASE p_type WHEN 'ECONOMY' THEN 'electric' WHEN 'STANDARD' THEN 'hybrid'
                    WHEN 'PROMO' THEN 'diesel' WHEN 'LARGE' THEN NULL ELSE 'gasoline' END
                   AS fueltype,
               p_size // 10 AS rating, p_size AS rentertripstaken,
               CAST(p_partkey % 300 AS INTEGER) AS reviewcount, p_name AS city,
               'S' || (p_partkey % 30) AS state_name, 'O' || (p_partkey % 500) AS owner_id,
               CAST(floor(p_retailprice) AS INTEGER) AS rate_daily, p_brand AS make,
               p_type AS model, p_size + 1980 AS year
        FROM part JOIN nation ON n_nationkey = p_partkey % 30
        WHERE p_size BETWEEN 10 AND 49 AND n_nationkey <> 7""",
    "v_staff": """
        SELECT o_orderkey AS row_key, o_orderpriority AS area, 'N' || (o_custkey // 200) AS nivel,
               'Grupo ' || o_orderstatus AS grupo_recruitment,
               CAST(o_custkey % 6 AS INTEGER) AS tiempo_recruitment,
               CASE WHEN o_orderstatus = 'F' THEN 'si' ELSE 'no' END AS realizo_cursos,
               CAST(o_custkey % 1500 AS DOUBLE) AS antiguedad,
               CASE WHEN o_custkey % 27 > 24 THEN NULL
                    WHEN o_custkey % 27 > o_orderkey % 25 THEN 'Mejor'
                    WHEN o_custkey % 27 < o_orderkey % 25 THEN 'Peor' ELSE 'Igual' END
                   AS salario_versus_competencia,
               'Name' || m.s_nationkey || ' ' || m.s_name AS manager
        FROM orders LEFT JOIN supplier m ON m.s_suppkey = o_custkey // 15 + 2""",
}
