"""Domain views over the driver's TPC-H-like tables.

The reference works on an 18-table supply-chain model. The driver hands us
TPC-H-like tables instead, so each domain table used by a query is a
DataFrame derived from them. Scores and delays are deterministic functions
of existing columns: they carry no supply-chain meaning, they only give the
queries non-degenerate selectivity. The same definitions, as SQL text, are
the prefix of every DuckDB oracle (``riskspark.plans.oracle.BINDING_SQL``).

Scale notes
-----------
* ``countries`` comes from ``nation`` x ``region`` (25 and 5 rows by the
  TPC-H definition). Every join is left to Catalyst's size estimate plus AQE,
  which broadcasts a side that is small and otherwise uses a sort-merge join
  with skew splitting.
* ``purchase_orders`` aggregates lineitem by order key *before* joining
  orders: the partial aggregate shrinks lineitem ~4x before the shuffle,
  and the join then reuses the aggregate's hash partitioning.
* The month calendar is generated (``sequence`` + ``explode``) from a
  one-row min/max aggregate: no join and no collect.
* ``ports`` and ``suppliers`` are both views of ``supplier``. A shipment's
  port is its own line's; its supplier is that of its purchase order, so
  the two often lie in different countries.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.sources.tables import DriverTables

# Fixed values of the binding (they must equal the oracle's SQL text).
RISK_BASE, RISK_MULT, RISK_MOD = 5, 37, 55          # base_risk_score = 5 + (id * 37) % 55
RELIABILITY_SHIFT, RELIABILITY_DIV = 1000, 110      # round((acctbal + 1000) / 110, 2)
CONGESTION_BASE, CONGESTION_MULT, CONGESTION_MOD = 10, 13, 70
DELAY_FREE_QTY = 30                                  # delay_days = greatest(qty - 30, 0)
WEATHER_EPOCH = "1995-01-01"                          # weather dates re-spread over 2,499 days
WEATHER_SPREAD_MULT, WEATHER_SPREAD_DAYS = 7, 2499
N_COUNTRIES = 25


def delay_reason_of(qty: Column, returnflag: Column) -> Column:
    return (F.when(qty <= DELAY_FREE_QTY, F.lit("None"))
            .when(returnflag == "R", F.lit("Weather"))
            .when(returnflag == "A", F.lit("Port Congestion"))
            .otherwise(F.lit("Political")))


class Domain:
    """The supply-chain tables as DataFrames over one driver scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.t = DriverTables(spark, sf_dir)

    # -- dimensions -------------------------------------------------------
    @cached_property
    def countries(self) -> DataFrame:
        n, r = self.t.nation, self.t.region
        return (n.join(r, n.n_regionkey == r.r_regionkey)
                .select(F.col("n_nationkey").alias("country_id"),
                        F.col("n_name").alias("country_name"),
                        F.col("r_name").alias("region"),
                        (F.lit(RISK_BASE) + (F.col("n_nationkey") * RISK_MULT) % RISK_MOD)
                        .alias("base_risk_score")))

    @cached_property
    def suppliers(self) -> DataFrame:
        return self.t.supplier.select(
            F.col("s_suppkey").alias("supplier_id"),
            F.col("s_name").alias("supplier_name"),
            F.col("s_nationkey").alias("country_id"),
            F.round((F.col("s_acctbal") + RELIABILITY_SHIFT) / RELIABILITY_DIV, 2).alias("reliability_score"))

    @cached_property
    def ports(self) -> DataFrame:
        return self.t.supplier.select(
            F.col("s_suppkey").alias("port_id"),
            F.col("s_name").alias("port_name"),
            F.col("s_nationkey").alias("country_id"),
            (F.lit(CONGESTION_BASE) + (F.col("s_suppkey") * CONGESTION_MULT) % CONGESTION_MOD)
            .cast("double").alias("avg_congestion_score"))

    @cached_property
    def products(self) -> DataFrame:
        return self.t.part.select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            F.col("p_retailprice").cast("decimal(10,2)").alias("unit_price"))

    # -- facts ------------------------------------------------------------
    @cached_property
    def purchase_orders(self) -> DataFrame:
        li = self.t.lineitem
        per_order = li.groupBy("l_orderkey").agg(
            F.min("l_suppkey").alias("supplier_id"),
            F.min("l_partkey").alias("product_id"),
            F.sum("l_quantity").alias("_qty"))
        o = self.t.orders
        return (per_order.join(o, per_order.l_orderkey == o.o_orderkey)
                .select(F.col("o_orderkey").alias("po_id"),
                        "supplier_id", "product_id",
                        F.to_date("o_orderdate").alias("order_date"),
                        F.col("_qty").cast("int").alias("quantity"),
                        F.col("o_orderstatus").alias("status")))

    @cached_property
    def shipments(self) -> DataFrame:
        q = F.col("l_quantity")
        return self.t.lineitem.select(
            F.col("l_orderkey").alias("po_id"),
            F.col("l_linenumber").alias("line_no"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("origin_port_id"),
            F.col("l_extendedprice").alias("line_price"),
            F.to_date("l_shipdate").alias("ship_date"),
            F.greatest(q - DELAY_FREE_QTY, F.lit(0)).cast("int").alias("delay_days"),
            delay_reason_of(q, F.col("l_returnflag")).alias("delay_reason"))

    @cached_property
    def customer_orders(self) -> DataFrame:
        li, o = self.t.lineitem, self.t.orders
        return (li.join(o, li.l_orderkey == o.o_orderkey)
                .select(F.col("l_orderkey").alias("order_id"),
                        F.col("l_partkey").alias("product_id"),
                        F.col("l_linenumber").alias("warehouse_id"),
                        F.to_date("o_orderdate").alias("order_date"),
                        F.col("l_quantity").cast("int").alias("quantity"),
                        F.when(F.col("l_linestatus") == "F", 1).otherwise(0).alias("fulfilled")))

    @cached_property
    def inventory(self) -> DataFrame:
        li, p = self.t.lineitem, self.t.part
        return (li.join(p, li.l_partkey == p.p_partkey)
                .select(F.col("l_partkey").alias("product_id"),
                        F.col("l_linenumber").alias("warehouse_id"),
                        F.to_date("l_shipdate").alias("snapshot_date"),
                        F.col("l_quantity").cast("int").alias("stock_quantity"),
                        F.col("p_size").alias("reorder_point")))

    # -- risk signals -----------------------------------------------------
    @cached_property
    def placed_events(self) -> DataFrame:
        """The events with a country and a date."""
        return self.t.events.select(
            "event_id", "user_id", "event_type", "value",
            (F.col("user_id") % N_COUNTRIES).cast("int").alias("country_id"),
            F.date_add(F.lit(WEATHER_EPOCH).cast("date"),
                       ((F.col("event_id") * WEATHER_SPREAD_MULT) % WEATHER_SPREAD_DAYS).cast("int"))
            .alias("event_date"))

    @cached_property
    def weather_events(self) -> DataFrame:
        return self.placed_events.select(F.col("event_id").alias("weather_event_id"), "country_id", "event_date",
                                         "event_type", F.col("value").alias("severity_score"))

    @cached_property
    def fuel_prices(self) -> DataFrame:
        """Region x month averages of the line prices shipped from the region's ports: a measured price series."""
        sh = self.shipments.select("origin_port_id", "line_price", F.trunc("ship_date", "MM").alias("month_year"))
        per_port = sh.groupBy("origin_port_id", "month_year").agg(
            F.sum(F.col("line_price").cast("decimal(18,2)")).alias("_sum"), F.count(F.lit(1)).alias("_n"))
        region = self.ports.select("port_id", "country_id").join(self.countries.select("country_id", "region"), "country_id")
        return (per_port.join(region, F.col("origin_port_id") == F.col("port_id")).groupBy("region", "month_year")
                .agg(F.round(F.sum("_sum").cast("double") / F.sum("_n"), 2).alias("price_per_barrel")))

    def month_bounds(self) -> tuple[Column, Column]:
        """First and last ship month as scalar subqueries (each run once, no join).

        Measured: two plain scalar subqueries beat one struct-valued subquery
        whose fields are read twice.
        """
        # Month truncation is monotone, so the raw column is aggregated (no per-row
        # work, and eligible for parquet min/max pushdown where Spark supports it).
        li = self.t.lineitem
        lo, hi = li.select(F.min("l_shipdate")).scalar(), li.select(F.max("l_shipdate")).scalar()
        return F.trunc(F.to_date(lo), "MM"), F.trunc(F.to_date(hi), "MM")

    @cached_property
    def months(self) -> DataFrame:
        """Contiguous calendar of ship months (bounded by the date span)."""
        bounds = self.t.lineitem.agg(F.min("l_shipdate").alias("lo"), F.max("l_shipdate").alias("hi"))
        return bounds.select(F.explode(F.sequence(F.trunc(F.to_date("lo"), "MM"), F.trunc(F.to_date("hi"), "MM"),
                                                  F.expr("INTERVAL 1 MONTH"))).alias("month_year"))

    @cached_property
    def political_risk_index(self) -> DataFrame:
        lo, hi = self.month_bounds()
        panel = self.countries.select(
            "country_id", "base_risk_score",
            F.explode(F.sequence(lo, hi, F.expr("INTERVAL 1 MONTH"))).alias("month_year"))
        return (panel
                .select("country_id", "month_year",
                        (F.col("base_risk_score")
                         + (F.col("country_id") * 7 + F.month("month_year") * 5) % 20)
                        .cast("double").alias("risk_score")))

    # -- SQL surface --------------------------------------------------------
    VIEW_NAMES = ("countries", "suppliers", "ports", "products", "purchase_orders", "shipments",
                  "customer_orders", "inventory", "weather_events", "months", "political_risk_index", "fuel_prices")

    def register_views(self) -> None:
        """Expose the domain tables to ``spark.sql`` under their reference names."""
        for name in self.VIEW_NAMES:
            getattr(self, name).createOrReplaceTempView(name)


# Shipment rows have no single id in the driver data; this 6-column key is
# unique and is the tie-break for every order-dependent shipment query.
SHIPMENT_KEY = ("ship_date", "po_id", "line_no", "product_id", "origin_port_id", "line_price")
