"""The binding CTEs that start every DuckDB oracle.

Each oracle is ``BINDING_SQL`` (the domain tables as CTEs over the driver
views) followed by the query body registered next to its Spark code in
``registry_core`` / ``registry_derived``. Where possible the oracle
uses a different method from the Spark plan: plain ``OVER (ORDER BY ..)``
windows instead of range-segmented prefix sums, a max self-join instead of
a semi-join, a recursive CTE instead of a closed-form balance.
"""

from __future__ import annotations

BINDING_SQL = """
WITH countries AS (
  SELECT n_nationkey AS country_id, n_name AS country_name, r_name AS region,
         5 + (n_nationkey * 37) % 55 AS base_risk_score
  FROM nation JOIN region ON n_regionkey = r_regionkey),
suppliers AS (
  SELECT s_suppkey AS supplier_id, s_name AS supplier_name, s_nationkey AS country_id,
         ROUND((s_acctbal + 1000) / 110, 2) AS reliability_score
  FROM supplier),
ports AS (
  SELECT s_suppkey AS port_id, s_name AS port_name, s_nationkey AS country_id,
         CAST(10 + (s_suppkey * 13) % 70 AS DOUBLE) AS avg_congestion_score
  FROM supplier),
products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
         CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price
  FROM part),
purchase_orders AS (
  SELECT o_orderkey AS po_id, MIN(l_suppkey) AS supplier_id, MIN(l_partkey) AS product_id,
         MIN(CAST(o_orderdate AS DATE)) AS order_date, CAST(SUM(l_quantity) AS INT) AS quantity,
         MIN(o_orderstatus) AS status
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey
  GROUP BY o_orderkey),
shipments AS (
  SELECT l_orderkey AS po_id, l_linenumber AS line_no, l_partkey AS product_id,
         l_suppkey AS origin_port_id, l_extendedprice AS line_price,
         CAST(l_shipdate AS DATE) AS ship_date,
         CAST(GREATEST(l_quantity - 30, 0) AS INT) AS delay_days,
         CASE WHEN l_quantity <= 30 THEN 'None' WHEN l_returnflag = 'R' THEN 'Weather'
              WHEN l_returnflag = 'A' THEN 'Port Congestion' ELSE 'Political' END AS delay_reason
  FROM lineitem),
customer_orders AS (
  SELECT l_orderkey AS order_id, l_partkey AS product_id, l_linenumber AS warehouse_id,
         CAST(o_orderdate AS DATE) AS order_date, CAST(l_quantity AS INT) AS quantity,
         CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS fulfilled
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
inventory AS (
  SELECT l_partkey AS product_id, l_linenumber AS warehouse_id,
         CAST(l_shipdate AS DATE) AS snapshot_date, CAST(l_quantity AS INT) AS stock_quantity,
         p_size AS reorder_point
  FROM lineitem JOIN part ON l_partkey = p_partkey),
weather_events AS (
  SELECT event_id AS weather_event_id, CAST(user_id % 25 AS INT) AS country_id,
         DATE '1995-01-01' + CAST((event_id * 7) % 2499 AS INT) AS event_date,
         event_type, value AS severity_score
  FROM events),
months AS (
  SELECT DISTINCT CAST(DATE_TRUNC('month', l_shipdate) AS DATE) AS month_year FROM lineitem),
political_risk_index AS (
  SELECT country_id, month_year,
         CAST(base_risk_score + (country_id * 7 + MONTH(month_year) * 5) % 20 AS DOUBLE) AS risk_score
  FROM countries CROSS JOIN months),
fuel_prices AS (
  SELECT region, CAST(DATE_TRUNC('month', ship_date) AS DATE) AS month_year,
         ROUND(CAST(SUM(CAST(line_price AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*), 2) AS price_per_barrel
  FROM shipments JOIN ports ON port_id = origin_port_id JOIN countries ON countries.country_id = ports.country_id
  GROUP BY 1, 2)
"""
