"""Reproducible sampling.

The reference draws with seeded numpy/pandas generators. A seeded RNG is
not reproducible across partitionings, so every operator here orders or
selects by a portable hash of ``seed:key`` instead: the same rows come
out whatever the cluster size, and DuckDB can recompute the hash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskspark.functions.scalar import HASH_RANGE, portable_hash
from riskspark.operators.windows import dense_position, id_range, running_sums, top_n_per_group


def sample_per_group(df: DataFrame, group: Sequence[str], key: Sequence[str], n: int,
                     seed: int | str = 42) -> DataFrame:
    """n rows per group without replacement (``np.random.choice(.., replace=False)`` per group)."""
    h = portable_hash(*key, seed=seed)
    return top_n_per_group(df.withColumn("_h", h), group, ["_h", *key], n).drop("_h")


def sample_with_replacement(draws: DataFrame, draw_key: str, population: DataFrame, order: Sequence[str],
                            seed: int | str = 42, index_col: str = "_row") -> DataFrame:
    """For each draw row, one population row picked uniformly with replacement.

    The population gets a dense 0..N-1 index in ``order``, whose first column is a
    numeric id (ranges of it are numbered apart, no single partition); each draw maps to ``hash(seed:draw) % N``. The draw count
    is exact, unlike ``DataFrame.sample(True, f)`` which only approximates it.
    """
    n = population.select(F.count(F.lit(1))).scalar()
    indexed = dense_position(population, list(order), [id_range(order[0])], index_col)
    picks = draws.withColumn(index_col, F.pmod(portable_hash(draw_key, seed=seed), F.greatest(n, F.lit(1))))
    return picks.join(indexed, index_col).drop(index_col)


def exact_fraction(df: DataFrame, fraction: float, key: Sequence[str], seed: int | str = 42,
                   buckets: int = 1 << 16) -> DataFrame:
    """Exactly ``round(fraction * count)`` rows: those with the smallest ``hash(seed:key)``, ties in key order.

    One count per bucket of hash values (``buckets`` rows, whatever the
    input) says which buckets are taken whole and which one is cut; only
    that one bucket's rows are ranked. ``df.sample(fraction)`` is Bernoulli
    and only approximates the count.
    """
    bucket = F.floor(F.col("_h") / F.lit(HASH_RANGE // buckets)).cast("bigint")
    hashed = df.withColumn("_h", portable_hash(*key, seed=seed)).withColumn("_b", bucket)
    counts = hashed.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    order = Window.orderBy("_b")         # over the bucket counts alone
    # SQL ROUND (half away from zero) of fraction x count
    total = F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    before = F.coalesce(F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    wanted = F.round(F.lit(fraction) * total).cast("bigint")
    cuts = counts.select("_b", (wanted - before).alias("_take"), "_n").where("_take > 0")
    held = hashed.join(cuts, "_b")
    whole, part = held.where("_n <= _take"), held.where("_n > _take")
    rank = F.row_number().over(Window.partitionBy("_b").orderBy("_h", *key))
    part = part.withColumn("_rank", rank).where("_rank <= _take").drop("_rank")
    return whole.unionByName(part).drop("_h", "_b", "_n", "_take")


#: Weights are taken in whole units of this.
WEIGHT_UNIT = "0.000000001"
_WHOLE = "decimal(38,0)"


def alias_table(weights: DataFrame, category: str, weight: str, out: str = "category", seed: int | str = 42) -> DataFrame:
    """(cell, out, other, share): as many cells as categories, each shared by its category and at most one other.

    A uniform cell, and within it ``out`` with probability ``share`` and else
    ``other``, gives every category its weight's part of the total. Weights that
    are zero or null have no cell; equal categories are added up.

    Built without a sequence of steps: a category below the average lacks
    something, one above it can spare something. The running sums L of what the
    first kind lacks and H of what the second spares lie on one line. A category i
    that lacks is filled by the first j whose H(j) is above L(i - 1); a category j
    that spares is left, after the first i with L(i) >= H(j), with the average
    less L(i) - H(j), and is filled by its next. Both are counts of the one kind
    before the other on that line, so they come from running counts over pieces of it.
    Sums are whole numbers and exact; n * total stays below 10**38.
    """
    units = F.round(F.col(weight).cast("decimal(28,9)") / F.expr(f"CAST({WEIGHT_UNIT} AS DECIMAL(10,9))")).cast(_WHOLE)
    used = weights.groupBy(F.col(category).alias(out)).agg(F.sum(units).cast(_WHOLE).alias("_w")).where("_w > 0")
    used = used.withColumn("_h", portable_hash(out, seed=f"{seed}/cells")).withColumn("_piece", F.floor(F.col("_h") / F.lit(HASH_RANGE >> 12)))
    sums = used.select(F.count(F.lit(1)).cast(_WHOLE).alias("n"), F.sum("_w").cast(_WHOLE).alias("t"))
    rows = used.withColumn("_n", sums.select("n").scalar()).withColumn("_full", sums.select("t").scalar())
    rows = rows.withColumn("_over", (F.col("_n") * F.col("_w")).cast(_WHOLE) - F.col("_full"))
    rows = running_sums(rows, {
        "cell": F.lit(1).cast("bigint"),
        "_lacks": F.greatest(-F.col("_over"), F.lit(0)).cast(_WHOLE), "_spares": F.greatest(F.col("_over"), F.lit(0)).cast(_WHOLE),
        "_rank_l": F.when(F.col("_over") < 0, 1).otherwise(0).cast("bigint"), "_rank_h": F.when(F.col("_over") > 0, 1).otherwise(0).cast("bigint"),
    }, ["_h", out], ["_piece"])
    rows = rows.withColumn("cell", F.col("cell") - 1)
    # the line: H(j) of those that spare, L(i - 1) and L(i) of those that lack
    lack, spare = F.col("_over") < 0, F.col("_over") > 0
    start, end = F.col("_lacks") + F.col("_over"), F.col("_lacks")
    events = F.when(spare, F.array(F.struct(F.col("_spares").cast(_WHOLE).alias("at"), F.lit(0).alias("kind")))).when(
        lack, F.array(F.struct(start.cast(_WHOLE).alias("at"), F.lit(1).alias("kind")), F.struct(end.cast(_WHOLE).alias("at"), F.lit(2).alias("kind"))))
    line = rows.where("_over != 0").select("cell", F.explode(events).alias("e")).select("cell", "e.at", "e.kind")
    line = line.withColumn("_length", rows.select(F.sum(F.greatest(F.col("_over"), F.lit(0))).cast(_WHOLE)).scalar())
    line = line.withColumn("_part", F.floor(F.col("at").cast("double") / F.col("_length").cast("double") * 4096))
    counted = running_sums(line, {"_spared": F.when(F.col("kind") == 0, 1).otherwise(0).cast("bigint"),
                                  "_lacked": F.when(F.col("kind") == 2, 1).otherwise(0).cast("bigint")}, ["at", "kind", "cell"], ["_part"])
    filled = counted.where("kind = 1").select(F.col("cell").alias("_of"), (F.col("_spared") + 1).alias("_by"))
    left = counted.where("kind = 0").select(F.col("cell").alias("_of"), (F.col("_lacked") + 1).alias("_after"))
    heavy = rows.where(spare).select(F.col("_rank_h").alias("_j"), F.col(out).alias("other"))
    light = rows.where(lack).select(F.col("_rank_l").alias("_i"), F.col("_lacks").alias("_l"))
    full = F.col("_full")
    lacking = rows.where(lack).join(filled, F.col("cell") == F.col("_of")).join(heavy, F.col("_by") == F.col("_j"), "left").select(
        "cell", out, "other", ((F.col("_n") * F.col("_w")).cast("double") / full.cast("double")).alias("share"))
    sparing = rows.where(spare).join(left, F.col("cell") == F.col("_of")).join(light, F.col("_after") == F.col("_i"), "left")
    sparing = sparing.withColumn("_by", F.col("_rank_h") + 1).join(heavy, F.col("_by") == F.col("_j"), "left").select(
        "cell", out, "other", ((full + F.col("_spares") - F.coalesce(F.col("_l"), F.col("_spares"))).cast("double") / full.cast("double")).alias("share"))
    even = rows.where("_over = 0").select("cell", out, F.lit(None).cast(rows.schema[out].dataType).alias("other"), F.lit(1.0).alias("share"))
    return lacking.unionByName(sparing).unionByName(even)


def weighted_pick(df: DataFrame, entity_key: str, weights: DataFrame, category: str, weight: str,
                  seed: int | str = 42, out: str | None = None) -> DataFrame:
    """Each entity picks one category with probability weight / total weight.

    By ``alias_table``: an entity's hash names a cell, which it meets by an equi-join,
    and a second hash one of the cell's two categories, so an entity looks at two
    categories, however many there are. No categories: no rows.
    """
    out = out or category
    table = alias_table(weights, category, weight, "_own", seed)
    n = weights.where(F.round(F.col(weight).cast("decimal(28,9)"), 9) > 0).select(F.count_distinct(category)).scalar()
    cell = F.when(n > 0, F.pmod(portable_hash(entity_key, seed=seed), F.greatest(n, F.lit(1))))
    point = portable_hash(entity_key, seed=f"{seed}/share") / F.lit(float(HASH_RANGE))
    joined = df.withColumn("_cell", cell).withColumn("_u", point).join(table, F.col("_cell") == F.col("cell"))
    picked = F.when(F.col("_u") < F.col("share"), F.col("_own")).otherwise(F.coalesce("other", "_own"))
    return joined.withColumn(out, picked).drop("_cell", "_u", "cell", "_own", "other", "share")
