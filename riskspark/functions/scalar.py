"""Column expressions shared by the queries (all JVM-side, codegen friendly)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_key(d: str | Column) -> Column:
    """First day of the month of a date or timestamp (DATEFROMPARTS(y, m, 1))."""
    return F.trunc(F.to_date(col_of(d)), "MM")


def clip(x: str | Column, lo: float, hi: float) -> Column:
    """Clamp to [lo, hi]; null stays null (``greatest``/``least`` alone skip nulls)."""
    x = col_of(x)
    return F.when(x.isNotNull(), F.least(F.lit(hi), F.greatest(F.lit(lo), x)))


def hinge(x: str | Column, threshold: float) -> Column:
    """max(0, x - threshold)."""
    return F.greatest(F.lit(0.0), col_of(x) - F.lit(threshold))


def round_to(x: str | Column, digits: int, half_even: bool = False) -> Column:
    """SQL rounding (half away from zero) or numpy/Python rounding (half to even)."""
    return F.bround(col_of(x), digits) if half_even else F.round(col_of(x), digits)


def int_trunc(x: str | Column) -> Column:
    """Python ``int()`` on a float: truncation toward zero."""
    return col_of(x).cast("int")


#: Hashes are below this: 15 hex digits, the most that a signed 64-bit integer holds.
HASH_RANGE = 1 << 60


def portable_hash(*parts: str | Column, seed: int | str = 42) -> Column:
    """Deterministic 60-bit hash of ``seed:part1:part2..`` from md5, below ``HASH_RANGE``.

    Chosen because DuckDB computes the same value
    (``('0x' || substr(md5(s), 1, 15))::BIGINT``), so sampling and picking
    operators can be checked against an independent engine.
    """
    text = F.concat_ws(":", F.lit(str(seed)), *[col_of(p).cast("string") for p in parts])
    return F.conv(F.substr(F.md5(text), F.lit(1), F.lit(15)), 16, 10).cast("bigint")


def label(template: str, *cols: str | Column, null_as: str | None = None) -> Column:
    """``format_string`` template; with ``null_as`` nulls print as that text instead of 'null'."""
    args = [col_of(c) for c in cols]
    if null_as is not None:
        args = [F.coalesce(a.cast("string"), F.lit(null_as)) for a in args]
    return F.format_string(template, *args)


def concat_strict(*cols: str | Column) -> Column:
    """String ``+`` of T-SQL: null if any part is null."""
    return F.concat(*[col_of(c).cast("string") for c in cols])


def in_list(c: str | Column, values: Sequence) -> Column:
    return col_of(c).isin(list(values))


def text_key(c: str | Column) -> Column:
    """A text that is equal to others as the reference's server compares: without case and trailing blanks.

    Filters, joins and groupings on it stay ordinary ones (hash or sort on the
    collation's key); plain columns keep comparing byte by byte.
    """
    return F.collate(col_of(c).cast("string"), "UTF8_LCASE_RTRIM")
