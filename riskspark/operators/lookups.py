"""Keyed lookups with defaults (the generator's dict ``.get(key, default)``).

Each lookup is a left join plus ``coalesce``. Lookup tables are reduced to
one row per key first (the largest value holds), so a lookup can never
multiply fact rows. Whether a side is broadcast is left to Catalyst's size
estimate and AQE.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.functions.scalar import month_key, portable_hash
from riskspark.operators.windows import dense_position, id_range


def lookup_default(df: DataFrame, table: DataFrame, on: Mapping[str, str], value: str, out: str,
                   default=None, strict: bool = False) -> DataFrame:
    """``df[out] = table[value]`` matched on ``on`` (left column -> table column), else ``default``.

    ``strict=True`` is the generator's ``lookup[key]`` (a missing key is an
    error): the query fails at run time instead of producing a default.
    """
    right = table.groupBy(*[F.col(r).alias(f"_k{i}") for i, r in enumerate(on.values())]).agg(F.max(value).alias("_val"))
    cond = [df[left] == right[f"_k{i}"] for i, left in enumerate(on.keys())]
    joined = df.join(right, cond, "left")
    val = F.col("_val")
    if strict:
        val = F.when(F.col("_k0").isNull(), F.raise_error(F.lit(f"lookup key missing in {value}"))).otherwise(val)
    elif default is not None:
        val = F.coalesce(val, F.lit(default))
    return joined.select(*[df[c] for c in df.columns], val.alias(out))


def monthly_max(events: DataFrame, keys: Sequence[str], date_col: str, value: str,
                out: str = "max_value", month_col: str = "month_year") -> DataFrame:
    """Max of ``value`` per (keys, month of ``date_col``); partial aggregation makes it skew-safe."""
    return (events.groupBy(*keys, month_key(date_col).alias(month_col))
            .agg(F.max(value).alias(out), F.count(F.lit(1)).alias("events")))


def lookup_monthly(df: DataFrame, signal: DataFrame, keys: Mapping[str, str], date_col: str,
                   month_col: str, value: str, out: str, default) -> DataFrame:
    """Signal for (keys, month of ``date_col``) with a default for missing months."""
    tmp = "_month_of_" + out
    with_month = df.withColumn(tmp, month_key(date_col))
    res = lookup_default(with_month, signal, {**keys, tmp: month_col}, value, out, default)
    return res.drop(tmp)


def tiered_lookup(df: DataFrame, entity_key: str, candidates: DataFrame, value: str,
                  tiers: Sequence[tuple[str, str]], out: str, seed: int | str = 42,
                  tier_col: str = "tier") -> DataFrame:
    """First tier with a candidate wins; within the tier one candidate is picked by hash.

    ``tiers`` lists ``(name, group column)`` from the most specific to the
    least, ``""`` meaning "any candidate" (e.g. country, region, any). Each
    group column must be determined by the one before it (a country lies in
    one region), so ordering candidates by (coarsest .. finest group, value)
    keeps every group of every tier contiguous: one dense position numbers
    all tiers. An entity picks ``first + hash(seed:entity) % size`` of its
    group, an equi-join on the position: no entity is paired with every
    candidate, and a group holding a third of the candidates is numbered
    by many tasks.
    """
    groups = [g for _, g in tiers if g]
    order = [*reversed(groups), value]
    n = candidates.select(F.count(F.lit(1))).scalar()
    pos = dense_position(candidates.select(*groups, value), order, [*order[:-1], id_range(value)], "_pos")
    h = portable_hash(F.col(entity_key), seed=seed)
    res = df
    idx = []
    for i, (name, g) in enumerate(tiers):
        if g:   # first position and size of each group: one row per group
            stats = pos.groupBy(g).agg(F.min("_pos").alias(f"_f{i}"), F.count(F.lit(1)).alias(f"_n{i}"))
            res = res.join(stats, g, "left")
        else:   # the "any" tier is one group: positions 0 .. n-1 (no candidates: no pick)
            res = (res.withColumn(f"_f{i}", F.lit(0).cast("bigint"))
                   .withColumn(f"_n{i}", F.when(n > 0, n)))
        # null exactly when the entity's group has no candidate
        res = res.withColumn(f"_i{i}", F.col(f"_f{i}") + F.pmod(h, F.col(f"_n{i}"))).drop(f"_f{i}", f"_n{i}")
        idx.append((name, f"_i{i}"))
    which = F.lit(None).cast("string")
    for name, c in reversed(idx):
        which = F.when(F.col(c).isNotNull(), F.lit(name)).otherwise(which)
    res = (res.withColumn(tier_col, which)
           .withColumn("_pos", F.coalesce(*[F.col(c) for _, c in idx]))
           .drop(*[c for _, c in idx]))
    # one join from the chosen position to the candidate value
    picked = res.join(pos.select("_pos", F.col(value).alias(out)), "_pos", "left").drop("_pos")
    return picked.select(*df.columns, out, tier_col)
