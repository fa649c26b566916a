"""Dashboard measures (the KPI cards, the risk map and the trend).

Only "Revenue at Risk" has a formula in the reference:
``CALCULATE(SUMX(shipments, RELATED(po.quantity) * RELATED(products.unit_price)), delay_days > 3)``.
The other cards name a number without defining it; the definitions below
are ours and say so.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _money(total):
    """An exact decimal sum, rounded to cents and given as a double."""
    return F.round(total, 2).cast("double")


def delayed_shipments_count(shipments: DataFrame, min_delay: int = 0) -> DataFrame:   # K1
    """Delayed Shipments: rows with ``delay_days > min_delay`` (Q3's definition)."""
    return shipments.agg(F.count(F.when(F.col("delay_days") > min_delay, 1)).alias("delayed_shipments"))


def avg_delay(shipments: DataFrame) -> DataFrame:                                     # K2
    """Avg Delay Days: the card does not say over which rows, so both readings are given."""
    d = F.col("delay_days")
    return shipments.agg(F.round(F.avg(d), 6).alias("avg_delay_all"),
                         F.round(F.avg(F.when(d > 0, d)), 6).alias("avg_delay_delayed"))


def revenue_at_risk(summary: DataFrame, min_delay: int = 3, by: Sequence[str] | None = None) -> DataFrame:  # K3
    """Sum of quantity x unit price over shipments delayed more than ``min_delay`` days.

    The delay filter always comes from the measure (``CALCULATE`` replaces
    an outer filter on the same column); ``by`` is the visual's grouping.
    Shipments without a purchase order are absent from the view and so add
    nothing, as ``RELATED`` of a blank adds nothing in the measure.
    """
    risky = summary.where(F.col("delay_days") > min_delay)
    value = _money(F.sum(F.col("quantity") * F.col("unit_price"))).alias("revenue_at_risk")
    shipments = F.count(F.lit(1)).alias("delayed_shipments")
    if by:
        return risky.groupBy(*by).agg(value, shipments)
    return risky.agg(value, shipments)


def critical_suppliers(suppliers: DataFrame, below: float = 60) -> DataFrame:         # K4
    """Critical Suppliers: reliability under Q5's threshold (our definition)."""
    return suppliers.agg(F.count(F.when(F.col("reliability_score") < below, 1)).alias("critical_suppliers"))


def country_risk_map(countries: DataFrame, suppliers: DataFrame, summary: DataFrame,
                     min_delay: int = 3) -> DataFrame:                                # K5
    """Country risk map: base risk per country (bubble size) and the counts behind it.

    Each fact is reduced to one row per country before it meets the
    25-row country table, so no join multiplies fact rows.
    """
    sup = suppliers.groupBy("country_id").agg(F.count(F.lit(1)).alias("suppliers"))
    risk = (summary.where(F.col("delay_days") > min_delay)
            .groupBy(F.col("origin_country").alias("country_name"))
            .agg(F.count(F.lit(1)).alias("delayed_shipments"),
                 _money(F.sum(F.col("quantity") * F.col("unit_price"))).alias("revenue_at_risk")))
    return (countries.join(sup, "country_id", "left").join(risk, "country_name", "left")
            .select("country_id", "country_name", "region", "base_risk_score",
                    F.coalesce("suppliers", F.lit(0)).alias("suppliers"),
                    F.coalesce("delayed_shipments", F.lit(0)).alias("delayed_shipments"),
                    F.coalesce("revenue_at_risk", F.lit(0.0)).alias("revenue_at_risk")))
