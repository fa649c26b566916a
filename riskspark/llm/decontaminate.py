"""Benchmark decontamination, as DataFrame expressions only.

Words are runs of digits, letters and non-ASCII characters of the text with
A-Z lower-cased. A benchmark item gives its windows of ``n`` words; an
item of fewer words gives one window, all of it. A document word inside
any occurrence of a window is hit.

Scan. A window of n words at any place covers a whole aligned block of
``b`` = (n + 1) // 2 words of the document (positions k b to k b + b - 1). So
only every b-th position of a document is probed, with the hash of the b
words there, against the set of all b-word anchors of the benchmark
windows. Documents with a block in the set are read again: the windows
around those blocks are compared with the benchmark windows as text, word
by word, so hashes decide nothing. Short windows of each length that occurs
in the benchmark are scanned in the same way by their own length.

The benchmark sets are counted and broadcast within ``broadcast_rows``; a
larger benchmark is joined by shuffle. The rows that are exploded hold a
document id, a position and a hash, not the text. Windows that many items
share are one row with the list of items, and a document gathers only its
own hits.

Edge cases. Null text and null items have no words. Documents are told
apart by a row key (doc_id and a hash of the text), so repeated rows of a
doc_id each get their own result. An empty benchmark hits nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import Scratch, ascii_lower, small_side

BROADCAST_ROWS = 2_000_000
#: Windows with their texts and items are broadcast up to this size.
BROADCAST_BYTES = 32 << 20
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def item_words(text: Column) -> Column:
    """The words of a text: the gaps become single spaces first, as one at either end would give an empty word."""
    spaced = F.btrim(F.regexp_replace(ascii_lower(text), _GAP, " "))
    return F.when(F.length(spaced) > 0, F.split(spaced, " ")).otherwise(F.array().cast("array<string>"))


def windows(benchmark: DataFrame, n: int, item: str = "item_id", text: str = "text") -> DataFrame:
    """(size, gram, items): the distinct windows, their number of words, and the ids of their items as strings."""
    words = benchmark.select(F.col(f"`{item}`").cast("string").alias("item"), item_words(F.col(f"`{text}`")).alias("w")).where(F.size("w") > 0)
    size = F.least(F.size("w"), F.lit(n))
    grams = words.select("item", size.alias("size"), F.explode(F.transform(
        F.sequence(F.lit(1), F.size("w") - size + 1), lambda i: F.array_join(F.slice("w", i, F.least(F.size("w"), F.lit(n))), " "))).alias("gram"))
    return grams.groupBy("size", "gram").agg(F.collect_set("item").alias("items"))


def _anchors(grams: DataFrame) -> DataFrame:
    """(size, anchor, back): hashes of the b-word runs of each window; ``back`` is the run's place in the window."""
    b = ((F.col("size") + 1) / 2).cast("int")
    runs = F.transform(F.sequence(F.lit(0), F.col("size") - b), lambda i: F.struct(F.xxhash64(F.slice(F.split("gram", " "), i + 1, b)).alias("anchor"), i.alias("back")))
    return grams.select("size", F.explode(runs).alias("r")).select("size", "r.anchor", "r.back").distinct()


def _probes(sizes: list[int]) -> Column:
    """The block hashes of the words ``w``, for each window size: array of (size, at, anchor)."""
    none = F.array().cast("array<struct<size:int,at:int,anchor:bigint>>")

    def blocks(size: int) -> Column:
        b = (size + 1) // 2
        return F.transform(F.sequence(F.lit(0), (F.size("w") / b).cast("int") - 1), lambda k: F.struct(
            F.lit(size).alias("size"), (k * b).alias("at"), F.xxhash64(F.slice("w", k * b + 1, b)).alias("anchor")))

    return F.concat(*[F.when(F.size("w") >= s, blocks(s)).otherwise(none) for s in sizes])


def find_hits(docs: DataFrame, benchmark: DataFrame, n: int = 10, text: str = "text", doc_id: str = "doc_id",
              broadcast_rows: int = BROADCAST_ROWS, scratch: Scratch | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_key, n_words, n_hit, items (sorted), spans.

    ``spans``: the hit word ranges (first, end), merged and in order.
    """
    scratch = scratch or Scratch(docs.sparkSession, "decontaminate")
    grams = scratch.save(windows(benchmark, n), "windows")
    sizes = sorted(r.size for r in grams.select("size").distinct().collect())      # at most n values
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    key = F.xxhash64("text").alias("text_key")
    counted = rows.select("doc_id", key, item_words(F.col("text")).alias("w"))
    none = F.array().cast("array<struct<size:int,at:int,anchor:bigint>>")
    counted = scratch.save(counted.select("doc_id", "text_key", F.size("w").cast("long").alias("n_words"),
                                          (_probes(sizes) if sizes else none).alias("probes")), "probes")
    anchors = scratch.save(_anchors(grams), "anchors")
    found = counted.select("doc_id", "text_key", F.explode("probes").alias("p")).select("doc_id", "text_key", "p.*")
    found = found.join(small_side(anchors, anchors.count(), broadcast_rows), ["size", "anchor"])
    places = found.groupBy("doc_id", "text_key").agg(
        F.collect_set(F.struct("size", (F.col("at") - F.col("back")).alias("first"))).alias("places"))
    places = scratch.save(places, "places")
    # The texts of documents with a place worth comparing, each split once. These documents grow with the input: never broadcast.
    again = rows.withColumn("text_key", F.xxhash64("text"))
    same = again["doc_id"].eqNullSafe(places["doc_id"]) & (again["text_key"] == places["text_key"])
    again = again.join(places.hint("merge"), same).select(
        again["doc_id"], again["text_key"], item_words(F.col("text")).alias("w"), "places").distinct()
    taken = F.transform(F.filter("places", lambda x: (x["first"] >= 0) & (x["first"] + x["size"] <= F.size("w"))), lambda x: F.struct(
        x["size"].alias("size"), x["first"].alias("first"), F.array_join(F.slice("w", x["first"] + 1, x["size"]), " ").alias("gram")))
    seen = again.select("doc_id", "text_key", F.explode(taken).alias("t")).select("doc_id", "text_key", "t.*")
    listed = F.aggregate("items", F.lit(0).cast("long"), lambda total, x: total + F.octet_length(x) + 16)
    held = grams.agg(F.coalesce(F.sum(F.octet_length("gram") + listed + 64), F.lit(0))).first()[0]
    hits = seen.join(F.broadcast(grams) if held <= BROADCAST_BYTES else grams, ["size", "gram"])
    hits = hits.groupBy("doc_id", "text_key").agg(
        F.array_sort(F.collect_set(F.struct("first", (F.col("first") + F.col("size")).alias("end")))).alias("ranges"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    hits = scratch.save(hits.select("doc_id", "text_key", "items", _merged("ranges").alias("spans")), "hits")
    base = counted.select("doc_id", "text_key", "n_words")
    on = base["doc_id"].eqNullSafe(hits["doc_id"]) & (base["text_key"] == hits["text_key"])
    words_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, x: total + x["end"] - x["first"])
    return base.join(hits, on, "left").select(
        base["doc_id"], base["text_key"], "n_words", F.coalesce(words_hit, F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), "spans")


def _merged(ranges: str) -> Column:
    """Sorted ranges (first, end), overlapping or touching ones joined."""
    kind = "array<struct<first:int,end:int>>"

    def step(done, x):
        last = F.try_element_at(done, F.lit(-1))
        joined = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
            last["first"].alias("first"), F.greatest(last["end"], x["end"]).alias("end"))))
        return F.when((F.size(done) > 0) & (x["first"] <= last["end"]), joined).otherwise(F.concat(done, F.array(x)))

    return F.aggregate(F.col(ranges).cast(kind), F.array().cast(kind), step)


def remove(docs: DataFrame, benchmark: DataFrame, n: int = 10, mode: str = "document", scratch: Scratch | None = None) -> DataFrame:
    """``docs`` (all columns) without its contaminated documents, or (``mode="span"``) without the hit words.

    In span mode a contaminated text is its remaining words, joined by
    single spaces; other texts are left as they are.
    """
    hits = find_hits(docs, benchmark, n, scratch=scratch).where("n_hit > 0").select(
        F.col("doc_id").alias("_hit_id"), F.col("text_key").alias("_hit_key"), F.col("spans").alias("_hit_spans"))
    rows = docs.select(F.struct("*").alias("row"))
    on = F.col("row.doc_id").eqNullSafe(F.col("_hit_id")) & (F.xxhash64(F.coalesce("row.text", F.lit(""))) == F.col("_hit_key"))
    if mode == "document":
        return rows.join(hits, on, "left_anti").select("row.*")
    if mode != "span":
        raise ValueError("mode is 'document' or 'span'")
    hits = hits.dropDuplicates(["_hit_id", "_hit_key"])           # repeated rows have the same hits
    w = item_words(F.col("row.text"))
    left = F.filter(w, lambda _, i: ~F.exists("_hit_spans", lambda s: (i >= s["first"]) & (i < s["end"])))
    text = F.when(F.col("_hit_id").isNull() & F.col("_hit_key").isNull(), F.col("row.text")).otherwise(F.array_join(left, " "))
    return rows.join(hits, on, "left").withColumn("row", F.col("row").withField("text", text)).select("row.*")
