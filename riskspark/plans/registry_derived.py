"""Registered keys for the operators re-aimed from the generator, ingest and audits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.functions.calendar import explode_months, month_index, zero_fill
from riskspark.functions.scalar import HASH_RANGE, concat_strict, in_list, int_trunc, month_key, portable_hash, text_key
from riskspark.operators import quality as DQ
from riskspark.operators.lookups import lookup_default, lookup_monthly, monthly_max, tiered_lookup
from riskspark.operators.sampling import exact_fraction, sample_per_group, sample_with_replacement, weighted_pick
from riskspark.operators.snapshots import SnapshotStore
from riskspark.operators.windows import id_range
from riskspark.plans import queries as Q
from riskspark.plans import scoring as S
from riskspark.plans.catalog import register
from riskspark.plans.registry_core import CRISIS_COUNTRY
from riskspark.sources import ingest
from riskspark.session import scratch_path
from riskspark.sources.bindings import SHIPMENT_KEY, Domain
from riskspark.sources.model import MODEL_SQL, NULL_AUDIT_SQL, NULL_AUDIT_TABLES, PAIRS, READ_COLUMNS, key_views, model_tables, model_views, null_views
from riskspark.sources.schema import DOMAIN_RULES, TABLES, TableSpec
from riskspark.sources.tables import DRIVER_KEYS

SHIP_COLS = ", ".join(SHIPMENT_KEY)

def _sql_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _quoted(rule: str) -> str:
    """A rule's text as its name: without quotes, so that it can stand in a literal."""
    return rule.replace("'", "")


def _hash_sql(*exprs: str, seed: "int | str" = 42) -> str:
    parts = " || ':' || ".join(f"CAST({e} AS VARCHAR)" for e in exprs)
    return f"('0x' || SUBSTR(MD5('{seed}' || ':' || {parts}), 1, 15))::BIGINT"


def _signals(d: Domain):
    return S.enrich_signals(d.shipments, d.purchase_orders, d.suppliers, d.ports, d.political_risk_index, d.weather_events)


_SIGNALS_SQL = f"""
, wx AS (SELECT country_id, CAST(DATE_TRUNC('month', event_date) AS DATE) AS month_year,
                MAX(severity_score) AS max_severity
         FROM weather_events GROUP BY 1, 2),
sig AS (
  SELECT sh.*, su.country_id,
         COALESCE(pt.avg_congestion_score, 30.0) AS congestion,
         COALESCE(pri.risk_score, 30.0) AS political_risk,
         COALESCE(wx.max_severity, 0.0) AS weather_severity
  FROM shipments sh
  LEFT JOIN purchase_orders po ON po.po_id = sh.po_id
  LEFT JOIN suppliers su ON su.supplier_id = po.supplier_id
  LEFT JOIN ports pt ON sh.origin_port_id = pt.port_id
  LEFT JOIN political_risk_index pri
    ON pri.country_id = su.country_id AND pri.month_year = CAST(DATE_TRUNC('month', sh.ship_date) AS DATE)
  LEFT JOIN wx ON wx.country_id = su.country_id AND wx.month_year = CAST(DATE_TRUNC('month', sh.ship_date) AS DATE))
"""

_ELEVATED_SQL = "(political_risk > 55 OR weather_severity > 50 OR congestion > 68)"
_FACTOR_SQL = ("(GREATEST(0.0, political_risk - 55) * CAST(0.3 AS DOUBLE)"
               " + GREATEST(0.0, weather_severity - 50) * CAST(0.25 AS DOUBLE)"
               " + GREATEST(0.0, congestion - 68) * CAST(0.2 AS DOUBLE))")

_RATES_SQL = """
, rates AS (
  SELECT po.product_id, CAST(DATE_TRUNC('month', sh.ship_date) AS DATE) AS order_month,
         AVG(CASE WHEN sh.delay_days > 3 THEN 1 ELSE 0 END) AS delay_rate, COUNT(*) AS shipments
  FROM shipments sh JOIN purchase_orders po ON sh.po_id = po.po_id GROUP BY 1, 2)
"""

# -- S: sources and sinks ---------------------------------------------------------------
@register("s_csv_roundtrip", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def s_csv_roundtrip(d: Domain):
    # Free text: quotes, commas, line ends and blanks come back as they were.
    return ingest.csv_roundtrip(d.t.read("documents").select("doc_id", "text", "lang", "source", "n_chars"))


@register("s_defaults", f"SELECT {SHIP_COLS}, delay_days, delay_reason FROM shipments")
def s_defaults(d: Domain):
    # Zero delays are written as empty fields; the load restores the column default.
    blanked = d.shipments.withColumn("delay_days", F.when(F.col("delay_days") != 0, F.col("delay_days")))
    return ingest.csv_roundtrip(blanked, defaults={"delay_days": 0})


@register("s04_snapshot_load", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS row_count, CAST(SUM({_hash_sql(*[c for c in key if c != 'l_shipdate'])} % 1000003) AS BIGINT) AS key_sum FROM {t}"
    for t, key, _ in DRIVER_KEYS))
def s04(d: Domain):
    # Every relational table goes out as CSV, all are loaded as one snapshot, and the snapshot is read back.
    csv_dir, specs = scratch_path(d.spark, "manifest"), d.t.specs()
    for spec in specs:
        ingest.write_csv(d.t.read(spec.name), f"{csv_dir}/{spec.name}.csv")
    store = SnapshotStore(d.spark, scratch_path(d.spark, "snapshot-load"))
    loaded = ingest.load_snapshot(d.spark, csv_dir, store, specs, checks={s.name: [ingest.no_bad_rows] for s in specs})
    parts = []
    for spec in specs:
        h = portable_hash(*[c for c in spec.pk if c != "l_shipdate"]) % 1000003
        parts.append(ingest.snapshot_table(loaded, spec).agg(F.count(F.lit(1)).alias("row_count"), F.sum(h).alias("key_sum"))
                     .select(F.lit(spec.name).alias("table_name"), "row_count", "key_sum"))
    return reduce(DataFrame.unionByName, parts)


@register("s_values", """
, reason_codes(delay_reason, reason_code) AS (
  VALUES ('None', 0), ('Weather', 1), ('Port Congestion', 2), ('Political', 3), ('Operational', 4))
SELECT r.delay_reason, r.reason_code, COUNT(*) AS num_shipments
FROM shipments sh JOIN reason_codes r ON sh.delay_reason = r.delay_reason
GROUP BY r.delay_reason, r.reason_code""")
def s_values(d: Domain):
    codes = ingest.values(d.spark, [("None", 0), ("Weather", 1), ("Port Congestion", 2), ("Political", 3),
                                    ("Operational", 4)], "delay_reason string, reason_code int")
    return (d.shipments.groupBy("delay_reason").agg(F.count(F.lit(1)).alias("num_shipments"))
            .join(F.broadcast(codes), "delay_reason")
            .select("delay_reason", "reason_code", "num_shipments"))


@register("s_catalog_explode", """
, variants(variant, variant_pos) AS (VALUES ('Standard', 0), ('Pro', 1), ('Compact', 2))
SELECT category, product_id, variant,
       product_name || ' - ' || variant AS variant_name,
       ROW_NUMBER() OVER (ORDER BY category, product_id, variant_pos) AS catalog_id
FROM products CROSS JOIN variants""")
def s_catalog_explode(d: Domain):
    return ingest.explode_variants(d.products, "category", "product_id", "product_name",
                                   ["Standard", "Pro", "Compact"])


CATALOG_CAP = 60         # the reference's fixed-size product list


@register("s08_nested_catalog_cap", f"""
, variants(variant, variant_pos) AS (VALUES ('Standard', 0), ('Pro', 1), ('Compact', 2)),
first AS (SELECT category, product_id, variant, product_name || ' - ' || variant AS variant_name, variant_pos
          FROM products CROSS JOIN variants ORDER BY category, product_id, variant_pos LIMIT {CATALOG_CAP})
SELECT category, product_id, variant, variant_name, ROW_NUMBER() OVER (ORDER BY category, product_id, variant_pos) AS catalog_id FROM first""")
def s08(d: Domain):
    # Pages of 64 ids, each a nested map of categories to their items, flattened and then capped in catalog order.
    item = F.struct("product_id", "product_name").alias("item")
    lists = d.products.groupBy(id_range("product_id", 64).alias("page"), "category").agg(F.collect_list(item).alias("items"))
    pages = lists.groupBy("page").agg(F.map_from_entries(F.collect_list(F.struct("category", "items"))).alias("catalog"))
    flat = ingest.flatten_catalog(pages).select("category", "item.product_id", "item.product_name")
    return ingest.explode_variants(flat, "category", "product_id", "product_name", ["Standard", "Pro", "Compact"], cap=CATALOG_CAP)


# -- P: predicates ----------------------------------------------------------------------
EXTERNAL_REASONS = ("Weather", "Political")     # causes outside the carrier's control [ours]


@register("p_isin_weight", f"""
, w AS (SELECT delay_reason, COUNT(*) * CASE WHEN delay_reason IN ({_sql_list(EXTERNAL_REASONS)}) THEN 2 ELSE 1 END AS weight
        FROM shipments GROUP BY delay_reason)
SELECT delay_reason, weight, ROUND(weight / (SELECT SUM(weight) FROM w), 6) AS share FROM w""")
def p_isin_weight(d: Domain):
    w = d.shipments.groupBy("delay_reason").agg(F.count(F.lit(1)).alias("_n"))
    factor = F.when(in_list("delay_reason", EXTERNAL_REASONS), 2).otherwise(1)
    w = w.select("delay_reason", (F.col("_n") * factor).alias("weight"))
    return w.withColumn("share", F.round(F.col("weight") / w.select(F.sum("weight")).scalar(), 6))


@register("p_in_subquery", f"""
SELECT supplier_id, supplier_name, reliability_score FROM suppliers
WHERE supplier_id IN (SELECT supplier_id FROM suppliers
                      WHERE country_id = (SELECT country_id FROM countries WHERE country_name = '{CRISIS_COUNTRY}'))""")
def p_in_subquery(d: Domain):
    s = d.suppliers
    inner = s.where(F.col("country_id") == Q.country_id_of(d.countries, CRISIS_COUNTRY)).select("supplier_id")
    return s.join(inner, "supplier_id", "left_semi").select("supplier_id", "supplier_name", "reliability_score")


@register("p06_month_layout", """
SELECT po_id, line_no, delay_days FROM shipments WHERE ship_date BETWEEN DATE '1997-06-01' AND DATE '1997-09-01'""")
def p06(d: Domain):
    # The reference's date index: the range is read from the written month layout, of which it opens four months.
    path = scratch_path(d.spark, "month-layout")
    ingest.write_shipments(d.shipments, path)
    return Q.shipments_between(d.spark.read.parquet(path), "1997-06-01", "1997-09-01")


@register("t12_text_equality", """
, typed AS (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN lower(n_name) WHEN 1 THEN n_name || '  ' ELSE n_name END AS country
            FROM customer JOIN nation ON n_nationkey = c_nationkey)
SELECT c.country_id, c.region, COUNT(*) AS customers, COUNT(CASE WHEN country = c.country_name THEN 1 END) AS same_bytes
FROM typed JOIN countries c ON lower(rtrim(country)) = lower(rtrim(c.country_name)) GROUP BY 1, 2""")
def t12(d: Domain):
    # Country names as three hands wrote them: in lower case, with blanks behind, and as they are.
    nation = d.t.nation.select("n_nationkey", "n_name")
    name, which = F.col("n_name"), F.col("c_custkey") % 3
    typed = d.t.read("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.when(which == 0, F.lower(name)).when(which == 1, F.concat(name, F.lit("  "))).otherwise(name).alias("country"))
    counts = typed.groupBy("country").agg(F.count(F.lit(1)).alias("n"))
    met = counts.join(d.countries, text_key("country") == text_key("country_name"))
    return met.groupBy("country_id", "region").agg(
        F.sum("n").alias("customers"), F.sum(F.when(F.col("country") == F.col("country_name"), F.col("n")).otherwise(0)).alias("same_bytes"))


@register("p_scalar_subquery", f"""
SELECT supplier_id, supplier_name FROM suppliers
WHERE country_id = (SELECT country_id FROM countries WHERE country_name = '{CRISIS_COUNTRY}')""")
def p_scalar_subquery(d: Domain):
    return (d.suppliers.where(F.col("country_id") == Q.country_id_of(d.countries, CRISIS_COUNTRY))
            .select("supplier_id", "supplier_name"))


# -- E: risk derivations --------------------------------------------------------------------
@register("e01_risk_adjusted_score", """
SELECT 'supplier' AS entity_type, s.supplier_id AS entity_id, s.country_id, s.reliability_score AS raw_score,
       CAST(ROUND(CAST(LEAST(99.0, GREATEST(25.0, s.reliability_score + c.base_risk_score * CAST(-0.15 AS DOUBLE)))
                  AS DECIMAL(38,9)), 1) AS DOUBLE) AS adjusted_score
FROM suppliers s LEFT JOIN countries c ON s.country_id = c.country_id
UNION ALL
SELECT 'port', p.port_id, p.country_id, p.avg_congestion_score,
       CAST(ROUND(CAST(LEAST(95.0, GREATEST(5.0, p.avg_congestion_score + c.base_risk_score * CAST(0.25 AS DOUBLE)))
                  AS DECIMAL(38,9)), 1) AS DOUBLE)
FROM ports p LEFT JOIN countries c ON p.country_id = c.country_id""")
def e01(d: Domain):
    sup = S.risk_adjusted(d.suppliers, d.countries, "reliability_score", S.SUPPLIER_RISK_WEIGHT,
                          *S.SUPPLIER_CLIP, "adjusted_score")
    port = S.risk_adjusted(d.ports, d.countries, "avg_congestion_score", S.PORT_RISK_WEIGHT,
                           *S.PORT_CLIP, "adjusted_score")
    return (sup.select(F.lit("supplier").alias("entity_type"), F.col("supplier_id").alias("entity_id"),
                       "country_id", F.col("reliability_score").alias("raw_score"), "adjusted_score")
            .unionByName(port.select(F.lit("port").alias("entity_type"), F.col("port_id").alias("entity_id"),
                                     "country_id", F.col("avg_congestion_score").alias("raw_score"),
                                     "adjusted_score")))


@register("e03_signal_enrichment", _SIGNALS_SQL + f"""
SELECT {SHIP_COLS}, delay_days, country_id, political_risk, weather_severity, congestion FROM sig""")
def e03(d: Domain):
    return _signals(d).select(*SHIPMENT_KEY, "delay_days", "country_id", "political_risk", "weather_severity",
                              "congestion")


@register("e04_elevated_flag", _SIGNALS_SQL + f"""
SELECT {_ELEVATED_SQL} AS elevated, COUNT(*) AS num_shipments FROM sig GROUP BY 1""")
def e04(d: Domain):
    return (_signals(d).groupBy(S.elevated().alias("elevated"))
            .agg(F.count(F.lit(1)).alias("num_shipments")))


@register("e05_severity_factor", _SIGNALS_SQL + f"""
SELECT {SHIP_COLS}, ROUND({_FACTOR_SQL}, 6) AS severity_factor,
       ROUND(CASE WHEN {_ELEVATED_SQL} THEN GREATEST(1.0, {_FACTOR_SQL}) * CAST(0.7 AS DOUBLE)
                  ELSE CAST(0.04 AS DOUBLE) * CAST(1.2 AS DOUBLE) END, 6) AS expected_delay
FROM sig""")
def e05(d: Domain):
    return _signals(d).select(*SHIPMENT_KEY, F.round(S.severity_factor(), 6).alias("severity_factor"),
                              F.round(S.expected_delay(), 6).alias("expected_delay"))


@register("e06_delay_reason", _SIGNALS_SQL + """
SELECT CASE WHEN delay_days = 0 THEN 'None'
            WHEN weather_severity > 50 AND weather_severity >= political_risk THEN 'Weather'
            WHEN congestion > 55 THEN 'Port Congestion'
            WHEN political_risk > 50 THEN 'Political'
            ELSE 'Operational' END AS derived_reason,
       COUNT(*) AS num_shipments
FROM sig GROUP BY 1""")
def e06(d: Domain):
    return (_signals(d).groupBy(S.delay_reason().alias("derived_reason"))
            .agg(F.count(F.lit(1)).alias("num_shipments")))


@register("e07_delay_rate_product_month", _RATES_SQL + """
SELECT product_id, order_month, ROUND(delay_rate, 6) AS delay_rate, shipments FROM rates""")
def e07(d: Domain):
    return (S.disruption_rate(d.shipments, d.purchase_orders)
            .withColumn("delay_rate", F.round("delay_rate", 6)))


@register("e09_fulfilment_probability", _RATES_SQL + """
SELECT co.order_id, co.product_id, co.warehouse_id, co.order_date, co.quantity, co.fulfilled,
       COALESCE(r.delay_rate, CAST(0.05 AS DOUBLE)) AS disruption_rate,
       ROUND(GREATEST(CAST(0.55 AS DOUBLE), 1.0 - COALESCE(r.delay_rate, CAST(0.05 AS DOUBLE)) * CAST(0.8 AS DOUBLE)), 6)
         AS fulfilled_prob
FROM customer_orders co LEFT JOIN rates r
  ON r.product_id = co.product_id AND r.order_month = CAST(DATE_TRUNC('month', co.order_date) AS DATE)""")
def e09(d: Domain):
    rates = S.disruption_rate(d.shipments, d.purchase_orders)
    return S.fulfilment_probability(d.customer_orders, rates).withColumn("fulfilled_prob", F.round("fulfilled_prob", 6))


@register("w06_clamped_stock", """
, moves AS (
  SELECT product_id, CAST(DATE_TRUNC('month', order_date) AS DATE) AS month_year, quantity AS q FROM purchase_orders
  UNION ALL SELECT product_id, CAST(DATE_TRUNC('month', order_date) AS DATE), -quantity FROM customer_orders),
numbered AS (
  SELECT product_id, month_year, CAST(SUM(q) AS BIGINT) AS flow,
         ROW_NUMBER() OVER (PARTITION BY product_id ORDER BY month_year) AS rn FROM moves GROUP BY 1, 2)
SELECT product_id, month_year, stock FROM (
  WITH RECURSIVE bal(product_id, rn, month_year, stock) AS (
    SELECT product_id, rn, month_year, GREATEST(0, flow) FROM numbered WHERE rn = 1
    UNION ALL
    SELECT n.product_id, n.rn, n.month_year, GREATEST(0, b.stock + n.flow)
    FROM bal b JOIN numbered n ON n.product_id = b.product_id AND n.rn = b.rn + 1)
  SELECT product_id, month_year, CAST(stock AS BIGINT) AS stock FROM bal)""")
def w06(d: Domain):
    return (S.clamped_stock(S.monthly_flows(d.purchase_orders, d.customer_orders))
            .select("product_id", "month_year", F.col("stock").cast("bigint").alias("stock")))


# -- F: scalar functions over driver columns ------------------------------------------------
@register("f05_date_add", f"""
SELECT {SHIP_COLS}, delay_days, ship_date + delay_days AS arrival_date FROM shipments""")
def f05(d: Domain):
    return d.shipments.select(*SHIPMENT_KEY, "delay_days", F.date_add("ship_date", F.col("delay_days")).alias("arrival_date"))


@register("f10_int_trunc", """
SELECT supplier_id, CAST(TRUNC(reliability_score) AS INT) AS whole_score,
       CAST(TRUNC(reliability_score - 50) AS INT) AS from_middle FROM suppliers""")
def f10(d: Domain):
    return d.suppliers.select("supplier_id", int_trunc("reliability_score").alias("whole_score"),
                              int_trunc(F.col("reliability_score") - 50).alias("from_middle"))


@register("f11_seasonal_position", """
, m AS (SELECT CAST(DATE_TRUNC('month', ship_date) AS DATE) AS month_year, COUNT(*) AS shipments FROM shipments GROUP BY 1)
SELECT month_year, shipments, ROUND(SIN(DATE_DIFF('month', (SELECT MIN(month_year) FROM m), month_year) / CAST(6 AS DOUBLE)), 6) AS season FROM m""")
def f11(d: Domain):
    first = d.month_bounds()[0]
    return (d.shipments.groupBy(month_key("ship_date").alias("month_year")).agg(F.count(F.lit(1)).alias("shipments"))
            .withColumn("season", F.round(F.sin(month_index("month_year", first) / F.lit(6.0)), 6)))


LINE_LABELS = ("first", "second", "third", "fourth", "fifth", "sixth", "seventh")


@register("f14_array_by_position", f"""
SELECT label, COUNT(*) AS shipments FROM (SELECT [{", ".join(f"'{x}'" for x in LINE_LABELS)}][line_no] AS label FROM shipments)
GROUP BY label""")
def f14(d: Domain):
    label = F.try_element_at(F.array(*[F.lit(x) for x in LINE_LABELS]), F.col("line_no"))
    return d.shipments.groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("shipments"))


# -- J: lookups and joins -------------------------------------------------------------------
@register("j06_lookup_default", """
SELECT sh.po_id, sh.line_no, sh.origin_port_id, COALESCE(pt.avg_congestion_score, 30.0) AS congestion
FROM shipments sh LEFT JOIN ports pt ON sh.origin_port_id = pt.port_id""")
def j06(d: Domain):
    return lookup_default(d.shipments.select("po_id", "line_no", "origin_port_id"), d.ports,
                          {"origin_port_id": "port_id"}, "avg_congestion_score", "congestion",
                          float(S.CONGESTION_DEFAULT))


@register("j07_monthly_risk_lookup", """
, wx AS (SELECT country_id, CAST(DATE_TRUNC('month', event_date) AS DATE) AS month_year,
                MAX(severity_score) AS max_severity FROM weather_events GROUP BY 1, 2),
cm AS (SELECT DISTINCT pt.country_id, CAST(DATE_TRUNC('month', sh.ship_date) AS DATE) AS month_year
       FROM shipments sh JOIN ports pt ON sh.origin_port_id = pt.port_id)
SELECT cm.country_id, cm.month_year, COALESCE(pri.risk_score, 30.0) AS political_risk,
       COALESCE(wx.max_severity, 0.0) AS weather_severity
FROM cm LEFT JOIN political_risk_index pri ON pri.country_id = cm.country_id AND pri.month_year = cm.month_year
LEFT JOIN wx ON wx.country_id = cm.country_id AND wx.month_year = cm.month_year""")
def j07(d: Domain):
    cm = (d.shipments.join(d.ports.select("port_id", "country_id"), F.col("origin_port_id") == F.col("port_id"))
          .select("country_id", month_key("ship_date").alias("month_year")).distinct())
    res = lookup_monthly(cm, d.political_risk_index, {"country_id": "country_id"}, "month_year", "month_year",
                         "risk_score", "political_risk", float(S.POLITICAL_DEFAULT))
    wx = monthly_max(d.weather_events, ["country_id"], "event_date", "severity_score", "max_severity")
    return lookup_monthly(res, wx, {"country_id": "country_id"}, "month_year", "month_year", "max_severity",
                          "weather_severity", float(S.WEATHER_DEFAULT))


@register("j09_dense_panel", """
, counts AS (SELECT product_id, CAST(DATE_TRUNC('month', ship_date) AS DATE) AS month_year, COUNT(*) AS n
             FROM shipments GROUP BY 1, 2)
SELECT p.product_id, m.month_year, COALESCE(c.n, 0) AS shipments
FROM products p CROSS JOIN months m
LEFT JOIN counts c ON c.product_id = p.product_id AND c.month_year = m.month_year""")
def j09(d: Domain):
    lo, hi = d.month_bounds()
    panel = explode_months(d.products.select("product_id"), lo, hi, "month_year")
    counts = (d.shipments.groupBy("product_id", month_key("ship_date").alias("month_year"))
              .agg(F.count(F.lit(1)).alias("shipments")))
    return zero_fill(panel, counts, ["product_id", "month_year"], ["shipments"], 0)


@register("j10_fallback_region", f"""
, cand AS (SELECT pt.port_id, pt.country_id, c.region FROM ports pt JOIN countries c ON pt.country_id = c.country_id
 ),
by_country AS (SELECT country_id, port_id, ROW_NUMBER() OVER (PARTITION BY country_id ORDER BY port_id) - 1 AS idx,
                      COUNT(*) OVER (PARTITION BY country_id) AS n FROM cand),
by_region AS (SELECT region, port_id,
                     ROW_NUMBER() OVER (PARTITION BY region ORDER BY country_id, port_id) - 1 AS idx,
                     COUNT(*) OVER (PARTITION BY region) AS n FROM cand),
any_port AS (SELECT port_id, ROW_NUMBER() OVER (ORDER BY region, country_id, port_id) - 1 AS idx,
                    COUNT(*) OVER () AS n FROM cand),
s AS (SELECT s.supplier_id, s.country_id, c.region, {_hash_sql('s.supplier_id')} AS h
      FROM suppliers s JOIN countries c ON s.country_id = c.country_id),
picks AS (
  SELECT s.supplier_id,
         (SELECT port_id FROM by_country b WHERE b.country_id = s.country_id AND b.idx = s.h % b.n) AS p1,
         (SELECT port_id FROM by_region b WHERE b.region = s.region AND b.idx = s.h % b.n) AS p2,
         (SELECT port_id FROM any_port b WHERE b.idx = s.h % b.n) AS p3
  FROM s)
SELECT supplier_id, COALESCE(p1, p2, p3) AS origin_port_id,
       CASE WHEN p1 IS NOT NULL THEN 'country' WHEN p2 IS NOT NULL THEN 'region'
            WHEN p3 IS NOT NULL THEN 'any' END AS tier
FROM picks""")
def j10(d: Domain):
    c = d.countries.select("country_id", "region")
    cand = d.ports.select("port_id", "country_id").join(c, "country_id")
    sup = d.suppliers.select("supplier_id", "country_id").join(c, "country_id")
    res = tiered_lookup(sup, "supplier_id", cand, "port_id",
                        [("country", "country_id"), ("region", "region"), ("any", "")], "origin_port_id")
    return res.select("supplier_id", "origin_port_id", "tier")


@register("j11_region_text_join", """
SELECT c.country_id, c.region, f.month_year, f.price_per_barrel
FROM countries c JOIN fuel_prices f ON c.region = f.region""")
def j11(d: Domain):
    # Text key, many countries per region: the price side is unique per (region, month),
    # so the join yields exactly one row per country and month.
    return (d.countries.select("country_id", "region").join(d.fuel_prices, "region")
            .select("country_id", "region", "month_year", "price_per_barrel"))


# -- A: aggregates ---------------------------------------------------------------------------
@register("a06_monthly_max_severity", """
SELECT country_id, CAST(DATE_TRUNC('month', event_date) AS DATE) AS month_year,
       MAX(severity_score) AS max_severity, COUNT(*) AS events
FROM weather_events GROUP BY 1, 2""")
def a06(d: Domain):
    return monthly_max(d.weather_events, ["country_id"], "event_date", "severity_score", "max_severity")


@register("a10_delay_summary", """
SELECT ROUND(AVG(delay_days), 6) AS avg_delay_days,
       ROUND(AVG(CASE WHEN delay_days > 0 THEN 1 ELSE 0 END) * 100, 6) AS pct_delayed
FROM shipments""")
def a10(d: Domain):
    return d.shipments.agg(
        F.round(F.avg("delay_days"), 6).alias("avg_delay_days"),
        F.round(F.avg(F.when(F.col("delay_days") > 0, 1).otherwise(0)) * 100, 6).alias("pct_delayed"))


@register("a11_ids_by_region", """
SELECT region, STRING_AGG(CAST(country_id AS VARCHAR), ',' ORDER BY country_id) AS country_ids,
       COUNT(*) AS n_countries
FROM countries GROUP BY region""")
def a11(d: Domain):
    # Bounded groups only (countries per region): the list is collected per region.
    return (d.countries.groupBy("region")
            .agg(F.concat_ws(",", F.sort_array(F.collect_list("country_id")).cast("array<string>"))
                 .alias("country_ids"), F.count(F.lit(1)).alias("n_countries")))


@register("a12_distinct_regions", "SELECT DISTINCT region FROM countries")
def a12(d: Domain):
    return d.countries.select("region").distinct()


@register("a13_share_of_total", """
SELECT country_id, COUNT(*) AS suppliers, ROUND(COUNT(*) / (SELECT COUNT(*) FROM suppliers), 6) AS share
FROM suppliers GROUP BY country_id""")
def a13(d: Domain):
    total = d.suppliers.select(F.count(F.lit(1))).scalar()
    return (d.suppliers.groupBy("country_id").agg(F.count(F.lit(1)).alias("suppliers"))
            .withColumn("share", F.round(F.col("suppliers") / total, 6)))


# -- U: unions and calendars -------------------------------------------------------------------
_NAMES = [t.name for t in TABLES]


@register("u01_row_counts", MODEL_SQL + ", counts AS (\n" + "\n  UNION ALL ".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM m_{t}" for t in _NAMES) + """)
SELECT table_name, row_count FROM counts
UNION ALL SELECT 'TOTAL', CAST(SUM(row_count) AS BIGINT) FROM counts""")
def u01(d: Domain):
    return DQ.view_row_counts(*model_views(d))


@register("u04_zero_filled_trend", """
, hits AS (SELECT CAST(DATE_TRUNC('month', ship_date) AS DATE) AS month_year, COUNT(*) AS shipments,
                  CAST(SUM(delay_days) AS BIGINT) AS total_delay_days
           FROM shipments GROUP BY 1)
SELECT m.month_year, COALESCE(h.shipments, 0) AS shipments, COALESCE(h.total_delay_days, 0) AS total_delay_days
FROM months m LEFT JOIN hits h ON m.month_year = h.month_year""")
def u04(d: Domain):
    hits = (d.shipments
            .groupBy(month_key("ship_date").alias("month_year"))
            .agg(F.count(F.lit(1)).alias("shipments"), F.sum("delay_days").cast("bigint").alias("total_delay_days")))
    return zero_fill(d.months, hits, "month_year", ["shipments", "total_delay_days"], 0)


# -- F: string building ------------------------------------------------------------------------
@register("f12_label_template", """
SELECT s.supplier_id, s.supplier_name || ' (' || c.country_name || ')' AS supplier_label,
       printf('%s | reliability %s', s.supplier_name, CAST(s.reliability_score AS VARCHAR)) AS score_label
FROM suppliers s JOIN countries c ON s.country_id = c.country_id""")
def f12(d: Domain):
    s = d.suppliers.join(d.countries.select("country_id", "country_name"), "country_id")
    return s.select("supplier_id",
                    concat_strict("supplier_name", F.lit(" ("), "country_name", F.lit(")")).alias("supplier_label"),
                    F.format_string("%s | reliability %s", F.col("supplier_name"),
                                    F.col("reliability_score").cast("string")).alias("score_label"))


# -- D: data-quality audits -------------------------------------------------------------------
_KEYS = {t.name: PAIRS.get(t.name, t.pk) for t in TABLES}


@register("d01_pk_duplicates", MODEL_SQL + "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, CONCAT_WS('|', {', '.join(f'CAST({k} AS VARCHAR)' for k in key)}) AS key_value, "
    f"COUNT(*) AS occurrences FROM m_{t} GROUP BY {', '.join(key)} HAVING COUNT(*) > 1" for t, key in _KEYS.items()))
def d01(d: Domain):
    sources, views, tasks = key_views(d)
    return DQ.view_pk_duplicates(sources, views, _KEYS, tasks)


_FKS = [DQ.ForeignKey(t.name, cols, parent, pcols) for t in TABLES for cols, parent, pcols in t.fks]


@register("d02_fk_orphans", MODEL_SQL + "\nUNION ALL\n".join(
    f"SELECT '{f.child}' AS child_table, '{','.join(f.columns)}' AS fk_columns, '{f.parent}' AS parent_table, "
    f"COUNT(*) AS orphan_rows FROM m_{f.child} ch WHERE ch.{f.columns[0]} IS NOT NULL AND NOT EXISTS "
    f"(SELECT 1 FROM m_{f.parent} pa WHERE pa.{f.parent_columns[0]} = ch.{f.columns[0]})"
    for f in _FKS))
def d02(d: Domain):
    return DQ.view_fk_audit(*model_views(d), _FKS)


# Keys, NOT NULL columns, and what the queries read of the two facts.
_REQUIRED = {t.name: tuple(dict.fromkeys((*t.pk, *PAIRS.get(t.name, ()), *t.not_null, *READ_COLUMNS.get(t.name, ())))) for t in TABLES}


@register("d03_null_audit", MODEL_SQL + NULL_AUDIT_SQL + "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, COUNT(*) - COUNT({c}) AS null_rows FROM {NULL_AUDIT_TABLES.get(t, f'm_{t}')}"
    for t, cs in _REQUIRED.items() for c in cs))
def d03(d: Domain):
    return DQ.view_null_audit(*null_views(d), _REQUIRED)


# The declared value rules, and two that the model's loader relies on.
_RULES_SQL = [*DOMAIN_RULES, ("shipments", "delay_days >= 0"), ("purchase_orders", "quantity > 0")]


@register("d04_domain_rules", MODEL_SQL + "\nUNION ALL\n".join(
    f"SELECT '{_quoted(cond)}' AS rule_name, '{t}' AS table_name, COUNT(CASE WHEN NOT COALESCE({cond}, TRUE) THEN 1 END) "
    f"AS violations FROM m_{t}" for t, cond in _RULES_SQL))
def d04(d: Domain):
    return DQ.domain_audit(model_tables(d), [DQ.Rule(_quoted(cond), t, F.expr(cond)) for t, cond in _RULES_SQL])


# Tables whose rows are those of one driver table.
_SOURCES = {"countries": "nation", "suppliers": "supplier", "factories": "customer", "products": "part", "ports": "supplier",
            "weather_events": "events", "news_events": "events", "purchase_orders": "orders", "shipments": "lineitem",
            "customer_orders": "lineitem", "inventory": "lineitem"}


@register("d06_reconcile", MODEL_SQL + "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, (SELECT COUNT(*) FROM m_{t}) AS row_count, (SELECT COUNT(*) FROM {src}) AS expected_rows, "
    f"(SELECT COUNT(*) FROM m_{t}) = (SELECT COUNT(*) FROM {src}) AS matches" for t, src in _SOURCES.items()))
def d06(d: Domain):
    sources, views = model_views(d)
    counts = DQ.view_row_counts(sources, [v for v in views if v.name in _SOURCES], with_total=False)
    expected = DQ.row_counts({t: d.t.read(src) for t, src in _SOURCES.items()}, with_total=False)
    return DQ.reconcile(counts, expected.withColumnRenamed("row_count", "expected_rows"))


# -- G: sampling ----------------------------------------------------------------------------
@register("g01_sample_per_group", f"""
SELECT supplier_id, supplier_name, country_id FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY country_id ORDER BY {_hash_sql('supplier_id')}, supplier_id) AS rn
  FROM suppliers) WHERE rn <= 2""")
def g01(d: Domain):
    return sample_per_group(d.suppliers, ["country_id"], ["supplier_id"], 2).select(
        "supplier_id", "supplier_name", "country_id")


@register("g02_sample_with_replacement", f"""
, pop AS (SELECT product_id, product_name, ROW_NUMBER() OVER (ORDER BY product_id) - 1 AS idx FROM products),
n AS (SELECT COUNT(*) AS n FROM products)
SELECT o.o_orderkey AS po_id, pop.product_id, pop.product_name
FROM orders o CROSS JOIN n JOIN pop ON pop.idx = {_hash_sql('o.o_orderkey')} % n.n""")
def g02(d: Domain):
    draws = d.t.orders.select(F.col("o_orderkey").alias("po_id"))
    return sample_with_replacement(draws, "po_id", d.products.select("product_id", "product_name"),
                                   ["product_id"]).select("po_id", "product_id", "product_name")


@register("g03_fraction_sample", f"""
, f AS (SELECT *, {_hash_sql('order_id', 'product_id', 'warehouse_id', 'quantity')} AS h
        FROM customer_orders WHERE fulfilled = 1),
k AS (SELECT CAST(ROUND(0.04 * COUNT(*)) AS BIGINT) AS k FROM f)
SELECT order_id, product_id, warehouse_id, order_date, quantity FROM (
  SELECT f.*, ROW_NUMBER() OVER (ORDER BY h, order_id, product_id, warehouse_id, quantity) AS rn FROM f) x
JOIN k ON x.rn <= k.k""")
def g03(d: Domain):
    fulfilled = d.customer_orders.where(F.col("fulfilled") == 1)
    return exact_fraction(fulfilled, 0.04, ["order_id", "product_id", "warehouse_id", "quantity"]).select(
        "order_id", "product_id", "warehouse_id", "order_date", "quantity")


@register("g04_weighted_pick", f"""
, w AS (SELECT country_id, COUNT(*) AS w, {_hash_sql('country_id', seed='42/cells')} AS h FROM suppliers GROUP BY country_id),
n AS (SELECT COUNT(*) AS n, SUM(w)::BIGINT AS total FROM w),
r AS (SELECT country_id, ROW_NUMBER() OVER (ORDER BY h, country_id) - 1 AS cell, n * w AS nw, total, n * w - total AS over,
             SUM(GREATEST(total - n * w, 0)) OVER o AS lacks, SUM(GREATEST(n * w - total, 0)) OVER o AS spares
      FROM w, n WINDOW o AS (ORDER BY h, country_id ROWS UNBOUNDED PRECEDING)),
cells AS (
  SELECT cell, country_id, CASE WHEN over < 0 THEN nw WHEN over = 0 THEN total
                                ELSE total + spares - (SELECT MIN(lacks) FROM r l WHERE l.over < 0 AND l.lacks >= r.spares) END / total AS share,
         (SELECT ARG_MIN(country_id, spares) FROM r h WHERE h.over > 0
          AND h.spares > CASE WHEN r.over < 0 THEN r.lacks + r.over ELSE r.spares END) AS other
  FROM r),
p AS (SELECT product_id, {_hash_sql('product_id')} AS h, {_hash_sql('product_id', seed='42/share')} / CAST({HASH_RANGE} AS DOUBLE) AS u FROM products)
SELECT p.product_id, CASE WHEN u < share THEN country_id ELSE COALESCE(other, country_id) END AS country_id
FROM p, n, cells WHERE cells.cell = p.h % n.n""")
def g04(d: Domain):
    # a country's weight is its number of suppliers
    w = d.suppliers.groupBy("country_id").agg(F.count(F.lit(1)).alias("weight"))
    return weighted_pick(d.products.select("product_id"), "product_id", w, "country_id", "weight").select(
        "product_id", "country_id")


@register("d05_quarantine", """
SELECT COUNT(*) AS rows_in, COUNT(CASE WHEN l_quantity % 2 = 0 THEN 1 END) AS loaded,
       COUNT(CASE WHEN l_quantity % 2 <> 0 THEN 1 END) AS quarantined FROM lineitem""")
def d05(d: Domain):
    # Half of an odd quantity is no INT, so those lines are set aside by the load.
    spec = TableSpec("pairs", (("order_id", T.LongType()), ("line_no", T.IntegerType()), ("pairs", T.IntegerType())),
                     ("order_id", "line_no"), staging={"pairs": T.DoubleType()})
    raw = d.t.lineitem.select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"),
                              (F.col("l_quantity") / 2).alias("pairs"))
    path = scratch_path(d.spark, "quarantine")
    ingest.write_csv(raw, path)
    typed = ingest.type_rows(ingest.read_staged(d.spark, path, spec), spec)
    return typed.agg(F.count(F.lit(1)).alias("rows_in"), F.count(F.when(~F.col("_bad"), 1)).alias("loaded"),
                     F.count(F.when(F.col("_bad"), 1)).alias("quarantined"))
