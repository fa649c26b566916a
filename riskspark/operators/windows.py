"""Window operators that stay distributed at any size.

Spark runs an un-partitioned window (``OVER (ORDER BY ..)``) through an
``Exchange SinglePartition``: one task sees every row. The operators below
give the same answers with work spread over many tasks.

``running_sum`` / ``dense_position``
    The caller names *segments*: nested pieces of the order that are pure
    functions of a row and follow its order, such as (day, range of ids).
    A partial aggregate gives each segment's total; the totals are summed up
    level by level (over the first piece, then within it over the second,
    ..), which gives each segment's offset; and a window within the segment
    finishes the running sum. Two passes over the rows, nothing sampled
    and nothing collected. A hot day or value is spread over its ranges.

``global_rank``
    Rank depends only on the value histogram: ``rank = 1 + rows with a
    better value``, ``dense_rank = 1 + distinct better values``. The
    histogram is built with a partial aggregate (skew-safe), ranked with
    ``running_sums`` over pieces of the values' bits that are refined where they
    are dense, and joined back on the value.

``latest_per_group``
    Max date per group (partial aggregate, skew-safe) joined back on
    (group, date); keeps every row tied at the max like the reference's
    self-join does.

``clamped_balance``
    s_t = max(0, s_{t-1} + x_t), s_0 = b >= 0, in closed form:
    with S_t = b + x_1 + .. + x_t, s_t = S_t - min(0, min_{k<=t} S_k).

Sort keys are given as column names (ascending, nulls first) or
``(name, "desc")`` (descending, nulls last), Spark's default null order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.functions.scalar import col_of


def _parse(key) -> tuple[str, bool]:
    if isinstance(key, str):
        return key, True
    name, direction = key
    return name, direction.lower() != "desc"


def _sort_cols(order: Sequence) -> list[Column]:
    out = []
    for k in order:
        name, asc = _parse(k)
        out.append(F.col(name).asc_nulls_first() if asc else F.col(name).desc_nulls_last())
    return out


def id_range(c: "str | Column", width: int = 1 << 24) -> Column:
    """Number of the fixed-width range that a numeric id lies in: a segment piece."""
    return F.floor(col_of(c) / F.lit(width))


def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(y)) for x, y in zip(left, right)])


def _offsets(totals: DataFrame, pieces: Sequence, sums: Sequence[str]) -> DataFrame:
    """Per segment, the sums over all segments before it: level by level, so that no window holds more than
    the values of one piece within one value of the pieces above it."""
    names = [p if isinstance(p, str) else p[0] for p in pieces]
    out = None
    for i, piece in enumerate(pieces):
        level = totals if i == len(pieces) - 1 else totals.groupBy(*names[:i + 1]).agg(*[F.sum(t).alias(t) for t in sums])
        prior = Window.partitionBy(*names[:i]).orderBy(*_sort_cols([piece])).rowsBetween(Window.unboundedPreceding, -1)
        level = level.select(*names[:i + 1], *[F.coalesce(F.sum(t).over(prior), F.lit(0)).alias(t) for t in sums])
        if out is not None:
            above = out.select(*[F.col(n).alias(f"_a{n}") for n in names[:i]], *[F.col(t).alias(f"_a{t}") for t in sums])
            level = level.join(above, _same(names[:i], [f"_a{n}" for n in names[:i]])).select(
                *names[:i + 1], *[(F.col(t) + F.col(f"_a{t}")).alias(t) for t in sums])
        out = level
    return out


def running_sums(df: DataFrame, values: Mapping[str, "str | Column"], order: Sequence, segments: Sequence,
                 exclusive: bool = False) -> DataFrame:
    """Global running sums ``SUM(v) OVER (ORDER BY order ROWS UNBOUNDED PRECEDING)`` for each ``out: v``.

    ``order`` must be a total order for the result to be deterministic,
    exactly as for the plain window; ``exclusive`` stops one row earlier.
    ``segments``: columns, or ``(column, "desc")``, that sort the rows as a
    prefix of ``order`` does; any choice gives the same sums.
    """
    tmp = {out: f"_v{i}" for i, out in enumerate(values)}
    pieces = [p if isinstance(p, tuple) else (p, "asc") for p in segments]
    names = [f"_s{i}" for i in range(len(pieces))]
    keyed = [n if way == "asc" else (n, way) for n, (_, way) in zip(names, pieces)]
    base = df.select("*", *[col_of(v).alias(tmp[o]) for o, v in values.items()], *[col_of(p).alias(n) for n, (p, _) in zip(names, pieces)])
    totals = base.groupBy(*names).agg(*[F.sum(t).alias(t) for t in tmp.values()])
    before = _offsets(totals, keyed, list(tmp.values()))
    before = before.select(*[F.col(n).alias(f"_o{n}") for n in names], *[F.col(t).alias(f"_o{t}") for t in tmp.values()])
    frame = (Window.partitionBy(*names).orderBy(*_sort_cols(order))
             .rowsBetween(Window.unboundedPreceding, -1 if exclusive else Window.currentRow))
    out = base.join(before, _same(names, [f"_o{n}" for n in names]))
    for o, t in tmp.items():
        local = F.sum(t).over(frame)
        out = out.withColumn(o, F.col(f"_o{t}") + (F.coalesce(local, F.lit(0)) if exclusive else local))
    return out.drop(*names, *tmp.values(), *[f"_o{x}" for x in (*names, *tmp.values())])


def running_sum(df: DataFrame, value: "str | Column", order: Sequence, out: str, segments: Sequence,
                exclusive: bool = False) -> DataFrame:
    return running_sums(df, {out: value}, order, segments, exclusive)


def dense_position(df: DataFrame, order: Sequence, segments: Sequence, out: str = "row_index", start: int = 0) -> DataFrame:
    """Dense ``start``-based row index in a total order, without a single partition."""
    res = running_sums(df, {out: F.lit(1).cast("bigint")}, order, segments, exclusive=True)
    return res.withColumn(out, F.col(out) + F.lit(start)) if start else res


def order_bits(score: str, kind: T.DataType) -> Column:
    """A 63-bit whole number that sorts as the score does (equal for scores that differ by their last bit only).

    The bits of a double, those of a negative one turned round, sort as the
    doubles do, with NaN last; whole numbers are their own key, and decimals go
    by the double nearest to them, which never turns an order round.
    """
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.expr(f"shiftright(CAST(`{score}` AS BIGINT), 1)")
    bits = f"CAST(reflect('java.lang.Double', 'doubleToLongBits', CAST(`{score}` AS DOUBLE) + 0D) AS BIGINT)"
    turned = F.expr(f"shiftright(CASE WHEN {bits} < 0 THEN {bits} ^ {2 ** 63 - 1} ELSE {bits} END, 1)")
    return F.when(F.col(score).isNotNull(), turned)


def radix_pieces(hist: DataFrame, score: str, dense: int = 1 << 16, fan: int = 4096) -> DataFrame:
    """``hist`` (one row per score) with ``_p0``, ``_p1``, ``_p2``: nested pieces of the order of the scores.

    The range of the scores' bits is cut in ``fan`` equal parts. A part that holds
    more than ``dense`` scores, by count, is cut again between its own least and
    greatest, in as many parts as its count asks for, and those once more. So
    scores may lie in any range, on any scale, or in clusters.
    """
    out = hist.withColumn("_key", order_bits(score, hist.schema[score].dataType))
    ends = out.select(F.min("_key").alias("lo"), F.max("_key").alias("hi"))
    lo, hi = ends.select("lo").scalar(), ends.select("hi").scalar()
    out = out.withColumn("_lo", lo).withColumn("_hi", hi).withColumn("_p0", F.expr(f"(_key - _lo) div ((_hi - _lo) div {fan} + 1)")).drop("_lo", "_hi")
    for level in (1, 2):
        names = [f"_p{i}" for i in range(level)]
        stats = out.groupBy(*names).agg(F.count(F.lit(1)).alias("_count"), F.min("_key").alias("_least"), F.max("_key").alias("_most"))
        stats = stats.where(f"_count > {dense}").select(*[F.col(n).alias(f"_of{n}") for n in names], "_count", "_least", "_most")
        finer = F.expr(f"(_key - _least) div ((_most - _least) div (_count div {dense} + 1) + 1)")
        out = out.join(stats, _same(names, [f"_of{n}" for n in names]), "left").withColumn(f"_p{level}", F.coalesce(finer, F.lit(0))).select(
            *hist.columns, "_key", *names, f"_p{level}")
    return out.drop("_key")


def global_rank(df: DataFrame, score: str, descending: bool = True, rank_col: str = "rank",
                dense_col: str = "dense_rank", dense: int = 1 << 16) -> DataFrame:
    """``RANK()`` and ``DENSE_RANK()`` over the whole table, computed from the histogram of a numeric score.

    The histogram is summed up over the pieces of ``radix_pieces``; ``dense`` is the number of scores above which a
    piece is cut further.
    """
    hist = radix_pieces(df.groupBy(score).agg(F.count(F.lit(1)).alias("_n")), score, dense)
    # Null scores sort last for DESC and first for ASC (Spark, SQL Server, DuckDB agree for DESC).
    way = "desc" if descending else "asc"
    ranked = running_sums(hist, {"_before": "_n", "_dense": F.lit(1).cast("bigint")}, [(score, way)],
                          [("_p0", way), ("_p1", way), ("_p2", way)], exclusive=True)
    ranked = ranked.select(
        F.col(score).alias("_score"),
        (F.col("_before") + 1).cast("bigint").alias(rank_col),
        (F.col("_dense") + 1).cast("bigint").alias(dense_col))
    return df.join(ranked, df[score].eqNullSafe(ranked["_score"])).drop("_score")


def top_n_per_group(df: DataFrame, keys: Sequence[str], order: Sequence, n: int = 1,
                    rank_col: str | None = None) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order) <= n``.

    Catalyst plans a partial ``WindowGroupLimit`` before the shuffle, so a
    huge group contributes at most n rows per map task to the exchange.
    """
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(*_sort_cols(order)))
    name = rank_col or "_rn"
    res = df.withColumn(name, rn).where(F.col(name) <= n)
    return res if rank_col else res.drop(name)


def latest_per_group(df: DataFrame, keys: Sequence[str], date_col: str,
                     candidates: DataFrame | None = None) -> DataFrame:
    """Rows at the latest ``date_col`` of each group; ties at the max are all kept.

    ``candidates`` (default ``df``) are the rows to return, e.g. ``df`` with a
    row filter applied first: the max still comes from all of ``df``.
    """
    rows = df if candidates is None else candidates
    latest = df.groupBy(*keys).agg(F.max(date_col).alias("_latest"))
    cond = [rows[k] == latest[k] for k in keys] + [rows[date_col] == latest["_latest"]]
    return rows.join(latest, cond, "left_semi")


def clamped_balance(df: DataFrame, keys: Sequence[str], order: Sequence, delta: str | Column,
                    start: str | Column, out: str) -> DataFrame:
    """s = max(0, s_prev + delta) per group in ``order``, starting from ``start`` (>= 0)."""
    w = (Window.partitionBy(*keys).orderBy(*_sort_cols(order))
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    level = col_of(start) + F.sum(col_of(delta)).over(w)
    return (df.withColumn("_level", level)
            .withColumn(out, F.col("_level") - F.least(F.lit(0), F.min("_level").over(w)))
            .drop("_level"))
