"""All 18 tables of the supply-chain model over the driver tables, as the audits read them.

Each table has the key, NOT NULL and foreign-key columns of its
``TableSpec`` and the columns that a value rule names. ``Domain`` serves the
queries; here its tables get the single-column ids that the model declares
(a line's id is its order's id and line number), and the tables that no
query needs are bound as well: factories are customers, the warehouses are the
line numbers, the link tables are the pairs that occur in orders, and returns are
returned lines. ``MODEL_SQL`` states the same in SQL for the oracles.
"""

from __future__ import annotations

from copy import copy
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.operators.quality import View
from riskspark.sources.bindings import Domain

_PAIR = 10_000_000        # an id of a link table is first * _PAIR + second; it names a pair only while ids are below this
_STATUS = {"O": "Pending", "P": "Shipped", "F": "Received"}


def _line_id():
    return F.col("l_orderkey") * 10 + F.col("l_linenumber")


def _month_no(c: str):
    return F.year(c) * 12 + F.month(c)


def _line_columns(d: Domain) -> DataFrame:
    return d.t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_extendedprice",
                               F.to_date("l_shipdate").alias("ship_date"), _line_id().alias("line_id"))


def _order_columns(d: Domain) -> DataFrame:
    return d.t.orders.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("order_date"))


def _with_orders(lines: DataFrame, orders: DataFrame) -> DataFrame:
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")


def _purchase_orders(d: Domain) -> DataFrame:
    status = F.create_map(*[F.lit(x) for kv in _STATUS.items() for x in kv])
    return d.purchase_orders.withColumn("status", F.try_element_at(status, F.col("status")))


def model_views(d: Domain) -> tuple[dict[str, DataFrame], list[View]]:
    """(sources, views): the 18 tables as filters and projections of as few sources as can be, so that audits read each once."""
    c = F.col
    fuel = d.fuel_prices.join(d.t.region.select(c("r_name").alias("region"), "r_regionkey"), "region")
    sources = {
        "countries": d.countries, "suppliers": d.suppliers, "ports": d.ports, "products": d.products, "customers": d.t.read("customer"),
        "months": d.political_risk_index.withColumn("political_risk_id", (c("country_id") * 100_000 + _month_no("month_year")).cast("bigint")),
        "events": d.placed_events,
        "fuel": fuel, "orders": _purchase_orders(d), "lines": _with_orders(_line_columns(d), _order_columns(d)),
    }
    sold, returned = c("o_orderkey").isNotNull(), c("l_returnflag") == "R"

    def same(name: str, source: str) -> View:
        return View(name, source, {x: c(x) for x in sources[source].columns})

    views = [
        same("countries", "countries"), same("suppliers", "suppliers"),
        View("factories", "customers", {"factory_id": c("c_custkey"), "factory_name": c("c_name"), "country_id": c("c_nationkey")}),
        same("products", "products"),
        View("warehouses", "lines", {"warehouse_id": c("l_linenumber")}, distinct=True, derived=lambda of: {
            "warehouse_name": F.concat(F.lit("Warehouse "), of["warehouse_id"].cast("string")), "country_id": of["warehouse_id"]}),
        same("ports", "ports"),
        View("supplier_products", "lines", {"supplier_id": c("l_suppkey"), "product_id": c("l_partkey")}, distinct=True,
             derived=lambda of: {"supplier_product_id": of["product_id"] * _PAIR + of["supplier_id"]}),
        View("factory_suppliers", "lines", {"factory_id": c("o_custkey"), "supplier_id": c("l_suppkey")}, sold, distinct=True,
             derived=lambda of: {"factory_supplier_id": of["factory_id"] * _PAIR + of["supplier_id"]}),
        View("product_factories", "lines", {"product_id": c("l_partkey"), "factory_id": c("o_custkey")}, sold, distinct=True,
             derived=lambda of: {"product_factory_id": of["product_id"] * _PAIR + of["factory_id"]}),
        same("political_risk_index", "months"),
        View("weather_events", "events", {"weather_event_id": c("event_id"), "country_id": c("country_id"), "port_id": c("user_id"),
                                          "event_date": c("event_date"), "severity_score": c("value")}),
        View("news_events", "events", {"news_event_id": c("event_id"), "country_id": c("country_id"), "supplier_id": c("user_id"),
                                       "event_date": c("event_date"), "sentiment_score": c("value") / 100 - 1}),
        View("fuel_prices", "fuel", {"fuel_price_id": (_month_no("month_year") * 10 + c("r_regionkey")).cast("bigint"), "region": c("region"),
                                     "month_year": c("month_year"), "price_per_barrel": c("price_per_barrel")}),
        same("purchase_orders", "orders"),
        View("shipments", "lines", {
            "shipment_id": c("line_id"), "po_id": c("l_orderkey"), "origin_port_id": c("l_suppkey"), "destination_warehouse_id": c("l_linenumber"),
            "line_no": c("l_linenumber"), "product_id": c("l_partkey"), "line_price": c("l_extendedprice"),
            "ship_date": c("ship_date"), "delay_days": F.greatest(c("l_quantity") - 30, F.lit(0)).cast("int"),
            "delay_reason": F.when(c("l_quantity") <= 30, "None").when(returned, "Weather").when(c("l_returnflag") == "A", "Port Congestion").otherwise("Political")}),
        View("customer_orders", "lines", {"order_id": c("line_id"), "product_id": c("l_partkey"), "warehouse_id": c("l_linenumber"),
                                          "order_date": c("order_date")}, sold),
        View("inventory", "lines", {"inventory_id": c("line_id"), "product_id": c("l_partkey"), "warehouse_id": c("l_linenumber"),
                                    "snapshot_date": c("ship_date")}),
        View("returns", "lines", {"return_id": c("line_id"), "order_id": c("line_id"), "l_quantity": c("l_quantity")}, returned),
    ]
    return sources, views


#: Keys of orders without a customer are broadcast up to this number.
_FEW = 1_000_000
#: Lines that a task of a key audit holds, about.
ROWS_A_TASK = 1_000_000
#: Tasks of small tables.
LEAST_TASKS = 8


def _only_nulls(df: DataFrame, *keep: str) -> DataFrame:
    """The rows of ``df`` with one value in place of all, but in ``keep``; nulls stay. They take few bytes in a shuffle."""
    def flat(f: T.StructField):
        value = "2000-01-01" if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)) else "0"
        return F.when(F.col(f.name).isNotNull(), F.lit(value).cast(f.dataType)).alias(f.name)

    return df.select(*[F.col(f.name) if f.name in keep else flat(f) for f in df.schema.fields])


def null_views(d: Domain) -> tuple[dict[str, DataFrame], list[View]]:
    """``model_views`` for audits that ask of a row only which columns are null.

    The joins of lines and orders carry keys and nulls alone. Of a distinct view of the lines only rows with a null count, so
    its source holds the lines that have a null in a column of theirs or of their order.
    """
    sources, views = model_views(d)
    lines, orders = _line_columns(d), _order_columns(d)
    lean = copy(d)
    lean.__dict__.pop("purchase_orders", None)
    lean.t = copy(d.t)
    lean.t.lineitem = _only_nulls(d.t.lineitem.select("l_orderkey", "l_suppkey", "l_partkey", "l_quantity"), "l_orderkey")
    sources["orders"] = _purchase_orders(lean)
    flat = _only_nulls(lines, "l_orderkey", "l_returnflag")
    sources["lines"] = _with_orders(flat, _only_nulls(orders, "o_orderkey"))
    keys, customers = lines.select("l_orderkey", "l_suppkey", "l_partkey", "l_linenumber"), orders.select("o_orderkey", "o_custkey")
    gap = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in ("l_suppkey", "l_partkey", "l_linenumber")])
    gaps = _with_orders(keys.where(gap), customers)
    nobody = customers.where(F.col("o_custkey").isNull())
    if n := nobody.count():
        nobody = F.broadcast(nobody) if n <= _FEW else nobody
        gaps = gaps.unionByName(keys.where(~gap).join(nobody, F.col("l_orderkey") == F.col("o_orderkey")))
    sources["gaps"] = gaps
    return sources, [replace(v, source="gaps") if v.distinct and v.source == "lines" else v for v in views]


def key_views(d: Domain) -> tuple[dict[str, DataFrame], list[View], int]:
    """``model_views`` for audits that hold a key in memory for each row, and the number of tasks that they are dealt to.

    Lines and orders are dealt by order key to tasks that grow in number with the lines, whatever the session's number of
    shuffle partitions, so that no task sorts or groups much more than ``ROWS_A_TASK`` lines.
    """
    sources, views = model_views(d)
    tasks = max(-(-d.t.lineitem.count() // ROWS_A_TASK), LEAST_TASKS)
    orders = _order_columns(d).repartition(tasks, "o_orderkey")
    lean = copy(d)
    lean.__dict__.pop("purchase_orders", None)
    lean.t = copy(d.t)
    lean.t.lineitem = d.t.lineitem.select("l_orderkey", "l_suppkey", "l_partkey", "l_quantity").repartition(tasks, "l_orderkey")
    lean.t.orders = d.t.orders.select("o_orderkey", "o_orderdate", "o_orderstatus").repartition(tasks, "o_orderkey")
    sources["orders"] = _purchase_orders(lean)
    sources["lines"] = _with_orders(_line_columns(d).repartition(tasks, "l_orderkey"), orders)
    return sources, views, tasks


def model_tables(d: Domain) -> dict[str, DataFrame]:
    sources, views = model_views(d)
    return {v.name: v.frame(sources) for v in views}


#: What identifies a row of the link tables: the pair, whatever ids a table may carry.
PAIRS = {"supplier_products": ("supplier_id", "product_id"), "factory_suppliers": ("factory_id", "supplier_id"),
         "product_factories": ("product_id", "factory_id")}

#: Columns of the facts that queries read, beyond the declared ones.
READ_COLUMNS = {"shipments": ("po_id", "line_no", "product_id", "line_price", "delay_days", "delay_reason"),
                "purchase_orders": ("quantity", "status")}


#: CTEs after ``oracle.BINDING_SQL``: the model's tables as ``m_<name>``.
MODEL_SQL = """
, m_countries AS (SELECT * FROM countries), m_suppliers AS (SELECT * FROM suppliers), m_products AS (SELECT * FROM products),
m_ports AS (SELECT * FROM ports),
m_factories AS (SELECT c_custkey AS factory_id, c_name AS factory_name, c_nationkey AS country_id FROM customer),
m_warehouses AS (SELECT DISTINCT l_linenumber AS warehouse_id, 'Warehouse ' || l_linenumber AS warehouse_name,
                 l_linenumber AS country_id FROM lineitem),
m_supplier_products AS (SELECT DISTINCT l_suppkey AS supplier_id,
                        l_partkey AS product_id FROM lineitem),
sold AS (SELECT * FROM orders JOIN lineitem ON o_orderkey = l_orderkey),
m_factory_suppliers AS (SELECT DISTINCT o_custkey AS factory_id,
                        l_suppkey AS supplier_id FROM sold),
m_product_factories AS (SELECT DISTINCT l_partkey AS product_id,
                        o_custkey AS factory_id FROM sold),
m_political_risk_index AS (SELECT *, country_id * 100000 + YEAR(month_year) * 12 + MONTH(month_year) AS political_risk_id
                           FROM political_risk_index),
m_weather_events AS (SELECT w.*, user_id AS port_id FROM weather_events w JOIN events ON event_id = weather_event_id),
m_news_events AS (SELECT weather_event_id AS news_event_id, country_id, event_date, user_id AS supplier_id,
                  value / 100 - 1 AS sentiment_score FROM weather_events JOIN events ON event_id = weather_event_id),
m_fuel_prices AS (SELECT f.*, (YEAR(month_year) * 12 + MONTH(month_year)) * 10 + r_regionkey AS fuel_price_id
                  FROM fuel_prices f JOIN region ON r_name = region),
m_purchase_orders AS (SELECT * REPLACE (CASE status WHEN 'O' THEN 'Pending' WHEN 'P' THEN 'Shipped' WHEN 'F' THEN 'Received' END AS status)
                      FROM purchase_orders),
m_shipments AS (SELECT po_id * 10 + line_no AS shipment_id, po_id, origin_port_id, line_no AS destination_warehouse_id, ship_date,
                delay_days, delay_reason FROM shipments),
m_customer_orders AS (SELECT order_id * 10 + warehouse_id AS order_id, product_id, warehouse_id, order_date FROM customer_orders),
m_inventory AS (SELECT l_orderkey * 10 + l_linenumber AS inventory_id, l_partkey AS product_id, l_linenumber AS warehouse_id,
                CAST(l_shipdate AS DATE) AS snapshot_date FROM lineitem),
m_returns AS (SELECT l_orderkey * 10 + l_linenumber AS return_id, l_orderkey * 10 + l_linenumber AS order_id, l_quantity
              FROM lineitem WHERE l_returnflag = 'R')
"""

#: Further CTEs of the null audit: the link tables with their declared ids, and the shipments with all columns that queries read.
NULL_AUDIT_SQL = f"""
, a_supplier_products AS (SELECT product_id * {_PAIR} + supplier_id AS supplier_product_id, * FROM m_supplier_products),
a_factory_suppliers AS (SELECT factory_id * {_PAIR} + supplier_id AS factory_supplier_id, * FROM m_factory_suppliers),
a_product_factories AS (SELECT product_id * {_PAIR} + factory_id AS product_factory_id, * FROM m_product_factories),
a_shipments AS (SELECT *, po_id * 10 + line_no AS shipment_id, line_no AS destination_warehouse_id FROM shipments)
"""
NULL_AUDIT_TABLES = {t: f"a_{t}" for t in ("supplier_products", "factory_suppliers", "product_factories", "shipments")}
