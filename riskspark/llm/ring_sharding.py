"""Sharding by a consistent-hash ring with virtual nodes and bounded loads, as DataFrame expressions.

Every shard stands at ``VNODES`` places of a ring of 2**16 arcs; a row's place
is a hash of its doc_id. A row belongs to the first shard clockwise. Loads are
bounded: a shard takes rows, nearest arcs first, up to its quota; what
overflows goes on clockwise to the next shard with room, until all have a
place. So no shard is over its quota, and when a shard is added only rows
of its arcs and overflow move. The quotas are the row count divided by the
number of shards, rounded so that they add up (with ``slack``: that much
more); without slack all shards are full and counts differ by one at most.

Scale. The decision needs only the number of rows of each arc: 65,536 counts
at most, whatever the input. Overflow is decided on those; an arc that is
cut in the middle is cut by rank, its rows being numbered by (place, doc_id,
hash of the text). The result is a table of ranges (arc, first and last
rank, shard, first slot), which the numbered rows look up: one shuffle of
narrow rows. An arc of a large input holds 1/65,536 of its rows, as doc_ids
differ; one that a repeated doc_id fills is ranked in parts. The lists of shards
clockwise are one per node, told as far as overflow goes.

Edge cases. Null text has size 1; a row without doc_id has its place by its text.
Repeated rows each get a slot. An empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left

import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskspark.llm.common import Scratch

ARCS, VNODES = 1 << 16, 64
ARC_ROWS = 100_000


def ring(n_shards: int, vnodes: int = VNODES) -> list[tuple[int, int]]:
    """(arc, shard) of the virtual nodes, in order; a shard's nodes do not depend on the number of shards."""
    return sorted({xxhash.xxh64_intdigest(f"{s}/{v}") % ARCS: s for s in range(n_shards) for v in range(vnodes)}.items())


def clockwise(nodes: list[tuple[int, int]], arc: int) -> list[int]:
    """The shards in the order in which a row of this arc meets them."""
    at = bisect_left(nodes, (arc, -1))
    return list(dict.fromkeys(s for _, s in nodes[at:] + nodes[:at]))


class Walks:
    """The shards met clockwise from each node, told as far as they are asked for."""

    def __init__(self, nodes: list[tuple[int, int]]):
        self.shards, self.met, self.last = [s for _, s in nodes], {}, {}

    def shard(self, node: int, step: int) -> int | None:
        """The ``step``-th other shard from a node, or None after a whole turn."""
        met, n = self.met.setdefault(node, {}), len(self.shards)
        last = self.last.get(node, 0)
        while len(met) <= step and last < n:
            met.setdefault(self.shards[(node + last) % n], len(met))
            last += 1
        self.last[node] = last
        if len(met) <= step:
            return None
        order = self.met.setdefault(("order", node), [])
        if len(order) <= step:
            order.extend(list(met)[len(order):])
        return order[step]


def quotas(n: int, n_shards: int, slack: float = 0.0) -> list[int]:
    if slack:
        return [-(-int(n * (1 + slack)) // n_shards) + 1] * n_shards
    return [n // n_shards + (s < n % n_shards) for s in range(n_shards)]


def assign(counts: dict[int, int], n_shards: int, slack: float = 0.0, vnodes: int = VNODES) -> list[tuple[int, int, int, int, int]]:
    """Ranges (arc, first rank, end rank, shard, first slot) that tile the rows of every arc.

    Round k deals each piece left over to the shard k steps on; a shard's
    pieces come in ring order, so what it refuses is at the far end.
    """
    nodes, room = ring(n_shards, vnodes), quotas(sum(counts.values()), n_shards, slack)
    used, out = [0] * n_shards, []
    pending = [(arc, 0, n) for arc, n in sorted(counts.items())]
    places = [arc for arc, _ in nodes]
    node, walks = {arc: bisect_left(places, arc) % len(nodes) for arc in counts}, Walks(nodes)
    for step in range(n_shards):
        left = []
        for arc, first, end in pending:
            shard = walks.shard(node[arc], step)
            shard = step if shard is None else shard
            take = min(end - first, room[shard] - used[shard])
            if take:
                out.append((arc, first, first + take, shard, used[shard]))
                used[shard] += take
            if first + take < end:
                left.append((arc, first + take, end))
        pending = left
    for arc, first, end in pending:      # shards without a node of their own, if two places coincide
        for shard in range(n_shards):
            take = min(end - first, room[shard] - used[shard])
            if take:
                out.append((arc, first, first + take, shard, used[shard]))
                used[shard] += take
                first += take
    return out


def shard(docs: DataFrame, n_shards: int = 16, slack: float = 0.0, vnodes: int = VNODES, text: str = "text",
          doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) per row: slots are gapless from 0 within a shard."""
    spark: SparkSession = docs.sparkSession
    scratch = Scratch(spark, "ring-sharding")
    named = F.col(f"`{doc_id}`").cast("string")
    named = F.when(named.isNull(), F.concat(F.lit("null:"), F.sha2(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary"), 256))).otherwise(named)
    place = F.pmod(F.xxhash64(named, F.lit("ring")), F.lit(ARCS)).cast("int")
    body = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    rows = scratch.save(docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32"),
        place.alias("arc"), F.monotonically_increasing_id().alias("uid")), "rows")
    counts = {r.arc: r.n for r in rows.groupBy("arc").agg(F.count(F.lit(1)).alias("n")).collect()}     # ARCS rows at most
    ranges = spark.createDataFrame(assign(counts, n_shards, slack, vnodes) or [], "arc int, first long, end long, shard int, base long")
    ranked = _ranked(spark, rows, counts)
    # ARCS ranges and n_shards cuts for each shard at most.
    ranges = F.broadcast(ranges.withColumnRenamed("arc", "of"))
    joined = ranked.join(ranges, (F.col("arc") == F.col("of")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("end")))
    return joined.select("doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("rank") - F.col("first")).alias("slot"))


def _ranked(spark: SparkSession, rows: DataFrame, counts: dict[int, int]) -> DataFrame:
    """``rows`` with their rank within their arc. An arc of more than ARC_ROWS rows (an id that is repeated) is ranked in
    parts, dealt by the row's own number, one after the other."""
    order = (F.xxhash64("doc_id"), "doc_id", "text_crc32", "size", "uid")
    crowded = [(arc, -(-n // ARC_ROWS)) for arc, n in counts.items() if n > ARC_ROWS]
    if not crowded:
        return rows.withColumn("rank", F.row_number().over(Window.partitionBy("arc").orderBy(*order)) - 1)
    parts = F.broadcast(spark.createDataFrame(crowded, "arc int, parts int"))          # ARCS rows at most
    dealt = rows.join(parts, "arc", "left").withColumn("part", F.pmod(F.xxhash64("uid"), F.coalesce("parts", F.lit(1))))
    sizes = dealt.groupBy("arc", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("arc").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("arc", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    local = F.row_number().over(Window.partitionBy("arc", "part").orderBy(*order)) - 1
    return dealt.withColumn("local", local).join(sizes, ["arc", "part"]).withColumn("rank", F.col("ahead") + F.col("local"))
