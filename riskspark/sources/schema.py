"""Typed schemas of the 18 reference tables, with keys, defaults and staging types.

This is the registry the CSV loader and the audits read: declared Spark
types (never inferred), the primary key, foreign keys, NOT NULL columns,
column defaults, and the raw staging type where the CSV text differs from
the table type (ints written as "7.0", booleans written as 0/1).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

D52 = T.DecimalType(5, 2)


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: tuple[tuple[str, T.DataType], ...]
    pk: tuple[str, ...]
    not_null: tuple[str, ...] = ()
    fks: tuple[tuple[tuple[str, ...], str, tuple[str, ...]], ...] = ()   # (cols, parent, parent cols)
    defaults: dict = field(default_factory=dict)
    staging: dict = field(default_factory=dict)                          # column -> raw CSV type

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, t, c not in self.not_null and c not in self.pk)
                             for c, t in self.columns])

    @property
    def staging_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, self.staging.get(c, t), True) for c, t in self.columns])


I, S, D, B = T.IntegerType(), T.StringType(), T.DateType(), T.BooleanType()


def _fk(col: str, parent: str, pcol: str | None = None):
    return ((col,), parent, (pcol or col,))


# Parent tables come first: this order is the load manifest.
TABLES: tuple[TableSpec, ...] = (
    TableSpec("countries", (("country_id", I), ("country_name", S), ("region", S), ("currency_code", S),
                            ("base_risk_score", D52)), ("country_id",), ("country_name",)),
    TableSpec("suppliers", (("supplier_id", I), ("supplier_name", S), ("country_id", I),
                            ("reliability_score", D52), ("onboarded_date", D)),
              ("supplier_id",), ("supplier_name", "country_id"), (_fk("country_id", "countries"),)),
    TableSpec("factories", (("factory_id", I), ("factory_name", S), ("country_id", I),
                            ("capacity_units_per_month", I)),
              ("factory_id",), ("factory_name", "country_id"), (_fk("country_id", "countries"),)),
    TableSpec("products", (("product_id", I), ("product_name", S), ("category", S),
                           ("unit_price", T.DecimalType(10, 2)), ("unit_weight_kg", T.DecimalType(6, 2))),
              ("product_id",), ("product_name",)),
    TableSpec("warehouses", (("warehouse_id", I), ("warehouse_name", S), ("country_id", I), ("capacity_units", I)),
              ("warehouse_id",), ("warehouse_name", "country_id"), (_fk("country_id", "countries"),)),
    TableSpec("ports", (("port_id", I), ("port_name", S), ("country_id", I), ("avg_congestion_score", D52)),
              ("port_id",), ("port_name", "country_id"), (_fk("country_id", "countries"),)),
    TableSpec("supplier_products", (("supplier_product_id", I), ("supplier_id", I), ("product_id", I),
                                    ("unit_cost", T.DecimalType(10, 2)), ("avg_lead_time_days", I)),
              ("supplier_product_id",), ("supplier_id", "product_id"),
              (_fk("supplier_id", "suppliers"), _fk("product_id", "products"))),
    TableSpec("factory_suppliers", (("factory_supplier_id", I), ("factory_id", I), ("supplier_id", I)),
              ("factory_supplier_id",), ("factory_id", "supplier_id"),
              (_fk("factory_id", "factories"), _fk("supplier_id", "suppliers"))),
    TableSpec("product_factories", (("product_factory_id", I), ("product_id", I), ("factory_id", I)),
              ("product_factory_id",), ("product_id", "factory_id"),
              (_fk("product_id", "products"), _fk("factory_id", "factories"))),
    TableSpec("political_risk_index", (("political_risk_id", I), ("country_id", I), ("month_year", D),
                                       ("risk_score", D52)),
              ("political_risk_id",), ("country_id", "month_year"), (_fk("country_id", "countries"),)),
    TableSpec("weather_events", (("weather_event_id", I), ("country_id", I), ("port_id", I), ("event_date", D),
                                 ("event_type", S), ("severity_score", D52)),
              ("weather_event_id",), ("country_id", "event_date"),
              (_fk("country_id", "countries"), _fk("port_id", "ports")),
              staging={"port_id": T.DoubleType()}),
    TableSpec("news_events", (("news_event_id", I), ("country_id", I), ("supplier_id", I), ("event_date", D),
                              ("headline", S), ("sentiment_score", D52)),
              ("news_event_id",), ("event_date",),
              (_fk("country_id", "countries"), _fk("supplier_id", "suppliers")),
              staging={"country_id": T.DoubleType(), "supplier_id": T.DoubleType()}),
    TableSpec("fuel_prices", (("fuel_price_id", I), ("region", S), ("month_year", D),
                              ("price_per_barrel", T.DecimalType(8, 2))),
              ("fuel_price_id",), ("region", "month_year")),
    TableSpec("purchase_orders", (("po_id", I), ("supplier_id", I), ("product_id", I), ("order_date", D),
                                  ("expected_date", D), ("quantity", I), ("status", S)),
              ("po_id",), ("supplier_id", "product_id", "order_date"),
              (_fk("supplier_id", "suppliers"), _fk("product_id", "products"))),
    TableSpec("shipments", (("shipment_id", I), ("po_id", I), ("origin_port_id", I), ("destination_warehouse_id", I),
                            ("ship_date", D), ("expected_arrival_date", D), ("actual_arrival_date", D),
                            ("delay_days", I), ("delay_reason", S)),
              ("shipment_id",), ("origin_port_id", "destination_warehouse_id", "ship_date"),
              (_fk("po_id", "purchase_orders"), _fk("origin_port_id", "ports", "port_id"),
               _fk("destination_warehouse_id", "warehouses", "warehouse_id")),
              defaults={"delay_days": 0}),
    TableSpec("customer_orders", (("order_id", I), ("product_id", I), ("warehouse_id", I), ("order_date", D),
                                  ("quantity", I), ("fulfilled", B)),
              ("order_id",), ("product_id", "warehouse_id", "order_date"),
              (_fk("product_id", "products"), _fk("warehouse_id", "warehouses")),
              defaults={"fulfilled": False}, staging={"fulfilled": I}),
    TableSpec("inventory", (("inventory_id", I), ("product_id", I), ("warehouse_id", I), ("snapshot_date", D),
                            ("stock_quantity", I), ("reorder_point", I)),
              ("inventory_id",), ("product_id", "warehouse_id", "snapshot_date"),
              (_fk("product_id", "products"), _fk("warehouse_id", "warehouses"))),
    TableSpec("returns", (("return_id", I), ("order_id", I), ("return_date", D), ("reason", S), ("quantity", I)),
              ("return_id",), ("order_id",), (_fk("order_id", "customer_orders"),)),
)

BY_NAME = {t.name: t for t in TABLES}

# Value sets and ranges stated in the reference's DDL comments and generator.
STATUS_VALUES = ("Pending", "Shipped", "Delayed", "Received")
DELAY_REASONS = ("None", "Weather", "Port Congestion", "Political", "Operational")
WEATHER_EVENT_TYPES = ("Storm", "Typhoon", "Flood", "Heatwave", "Fog Delay")
RETURN_REASONS = ("Defective Unit", "Wrong Item Shipped", "Customer Changed Mind", "Damaged in Transit",
                  "Quality Issue")
DOMAIN_RULES = (
    ("countries", "base_risk_score BETWEEN 0 AND 100"),
    ("suppliers", "reliability_score BETWEEN 0 AND 100"),
    ("ports", "avg_congestion_score BETWEEN 0 AND 100"),
    ("political_risk_index", "risk_score BETWEEN 0 AND 100"),
    ("political_risk_index", "DAY(month_year) = 1"),
    ("fuel_prices", "DAY(month_year) = 1"),
    ("weather_events", "severity_score BETWEEN 0 AND 100"),
    ("news_events", "sentiment_score BETWEEN -1 AND 1"),
    ("purchase_orders", "status IN ('Pending', 'Shipped', 'Delayed', 'Received')"),
    ("shipments", "delay_reason IN ('None', 'Weather', 'Port Congestion', 'Political', 'Operational')"),
)
