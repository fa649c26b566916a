"""Month calendars and zero-filled series.

The reference builds its month list with a recursive CTE capped at 100
levels. Here the calendar is one ``sequence`` + ``explode``: no recursion
at run time, and the cap becomes a check that fails the query (lazily,
on the executors) instead of silently truncating it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.functions.scalar import col_of


def one_month() -> Column:
    return F.expr("INTERVAL 1 MONTH")


def months_between_inclusive(lo: Column, hi: Column) -> Column:
    return F.sequence(lo, hi, one_month())


def month_series(bounds: DataFrame, lo: str = "lo", hi: str = "hi", out: str = "month_start",
                 max_steps: int | None = 100) -> DataFrame:
    """One row per month from ``lo`` to ``hi`` (both first-of-month dates) of each bounds row.

    ``max_steps`` mirrors ``OPTION (MAXRECURSION 100)``: a series needing
    more than that many recursive steps raises instead of being cut.
    """
    lo_c, hi_c = F.trunc(F.col(lo), "MM"), F.trunc(F.col(hi), "MM")
    seq = months_between_inclusive(lo_c, hi_c)
    if max_steps is not None:
        seq = F.when(F.size(seq) - 1 > max_steps,
                     F.raise_error(F.lit(f"month series needs more than {max_steps} recursion steps"))
                     .cast("array<date>")).otherwise(seq)
    return bounds.select(F.explode(seq).alias(out))


def month_series_by_recursion(bounds: DataFrame, lo: str = "lo", hi: str = "hi", out: str = "month_start", max_level: int = 100) -> DataFrame:
    """``month_series`` of one row of bounds by the engine's recursion; needing more than ``max_level`` levels fails the query.

    A level is a pass over one row, so this is for calendars; ``month_series``
    gives the same months in one step.
    """
    firsts = bounds.select(F.trunc(F.col(lo), "MM").alias("lo"), F.trunc(F.col(hi), "MM").alias("hi"))
    return bounds.sparkSession.sql(f"""
        WITH RECURSIVE months(month_start, last) MAX RECURSION LEVEL {int(max_level)} AS (
          SELECT lo, hi FROM {{bounds}} WHERE lo <= hi
          UNION ALL
          SELECT CAST(add_months(month_start, 1) AS DATE), last FROM months WHERE month_start < last)
        SELECT month_start FROM months""", bounds=firsts).withColumnRenamed("month_start", out)


def explode_months(df: DataFrame, lo: Column, hi: Column, out: str = "month_year") -> DataFrame:
    """Entity x calendar panel: every row of ``df`` repeated for each month in [lo, hi].

    ``lo``/``hi`` are usually scalar subqueries (evaluated once), so the
    panel needs no join at all.
    """
    return df.withColumn(out, F.explode(months_between_inclusive(lo, hi)))


def zero_fill(calendar: DataFrame, series: DataFrame, on: str | Sequence[str], fill_cols: Sequence[str],
              fill_value=0) -> DataFrame:
    """Left-join a sparse series to a calendar and put ``fill_value`` where nothing happened."""
    keys = [on] if isinstance(on, str) else list(on)
    joined = calendar.join(series, keys, "left")
    return joined.select(*keys, *[c for c in calendar.columns if c not in keys],
                         *[F.coalesce(F.col(c), F.lit(fill_value)).alias(c) for c in fill_cols])


def month_index(month: str | Column, first: str | Column) -> Column:
    """0-based month number of ``month`` counted from ``first``."""
    return F.months_between(col_of(month), col_of(first)).cast("int")
