"""Quoted CSV files cut into records by many tasks, though a field may hold line ends.

Spark's reader takes a file whole when records may span lines, as a line end
can only be told from one inside a field by the quotes before it. Here the file
is read as lines, in blocks as Spark deals them out. Every quote turns
"inside a field" to "outside" and back (a doubled quote twice).

Files without such fields need none of this (``lines_are_records``). For the others:

1. one aggregate counts the quotes of each block, by parity;
2. a running sum over a file's blocks tells which blocks begin inside a field;
3. each block is gone through once from that state, and gives its records. The one
   that runs over the block's end is given in parts, which are put together by
   file and block order; only these are shuffled.

The lines of a block are read in order by one task, and step 3 streams them, in
Arrow batches, with line-by-line work only for records of several lines. The table of
blocks is broadcast: a row of about 100 bytes per block of
``spark.sql.files.maxPartitionBytes``, which is some 80 MB for 100 TB in blocks of 128 MB.

A quote has no meaning but this one: a stray quote within an unquoted field joins
records. The header is the first line of each file and is compared with the
expected names. Empty lines are no records. A field left open at a file's end takes the rest of the
file, which then is one bad record.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WHOLE, END, MIDDLE, START = 0, 1, 2, 3
_PARTS = "file string, block long, kind int, text string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def lines_are_records(spark: SparkSession, path: str, names: Sequence[str]) -> bool:
    """Whether every line is a record to Spark's line reader as it is to ``records``: its quotes are in pairs, it is not of blanks
    alone (that reader drops these), and a header in other letter case, which that reader takes, does not occur."""
    line, header = F.col("value"), ",".join(names)
    odd = (F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))) % 2 == 1
    blank = (F.length(line) > 0) & ~line.rlike(r"[^\x00-\x20]")
    cased = (F.lower(line) == header.lower()) & (line != header)
    return spark.read.option("lineSep", "\n").text(path).where(odd | blank | cased).isEmpty()


def _blocks(lines: DataFrame) -> DataFrame:
    """(file, block, inside, inside_after): whether a block begins, and ends, inside a field."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    odd = lines.groupBy("file", "block").agg((F.sum(quotes) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2
    return odd.select("file", "block", "odd", inside.alias("inside")).select(
        "file", "block", (F.col("inside") == 1).alias("inside"), ((F.col("inside") + F.col("odd")) % 2 == 1).alias("inside_after"))


class _Block:
    """The way through one block: what is open, and the lines of the record in hand."""

    def __init__(self, file: str, block: int, inside: bool):
        self.file, self.block, self.inside = file, block, inside
        self.kind, self.held = (END if inside else WHOLE), []

    def take(self, lines: pa.Array) -> tuple[pa.Array, list[tuple[int, str]]]:
        """(lines that are records, other records and parts) of the next lines."""
        quotes = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False)
        after = (int(self.inside) + np.cumsum(quotes)) % 2 == 1
        before = np.concatenate([[self.inside], after[:-1]])
        other = []
        for i in np.flatnonzero(before | after).tolist():
            self.held.append(lines[i].as_py())
            if not after[i]:
                other.append((self.kind, "\n".join(self.held)))
                self.kind, self.held = WHOLE, []
        if len(after):
            self.inside = bool(after[-1])
        return lines.filter(pa.array(~(before | after) & (pc.binary_length(lines).to_numpy(zero_copy_only=False) > 0))), other

    def rest(self) -> list[tuple[int, str]]:
        """The part that runs over the end."""
        if not self.held:
            return []
        return [(MIDDLE if self.kind == END else START, "\n".join(self.held))]


def _cut(lines: DataFrame, names: Sequence[str]) -> DataFrame:
    """(file, block, kind, text) of lines (value, file, block, inside)."""
    expected = list(names)

    def made(block: _Block, lines: pa.Array, other: list[tuple[int, str]]):
        kinds = np.concatenate([np.zeros(len(lines), np.int32), np.array([k for k, _ in other], np.int32)])
        texts = pa.concat_arrays([lines.cast(pa.string()), pa.array([t for _, t in other], pa.string())])
        n = len(texts)
        return pa.RecordBatch.from_arrays([pa.array([block.file] * n, pa.string()), pa.array([block.block] * n, pa.int64()), pa.array(kinds), texts],
                                          names=["file", "block", "kind", "text"])

    def run(batches):
        at = None
        for batch in batches:
            files, blocks, inside = batch["file"], batch["block"].to_numpy(), batch["inside"]
            coded = files.dictionary_encode().indices.to_numpy()
            cuts = [0, *(np.flatnonzero((np.diff(coded) != 0) | (np.diff(blocks) != 0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                lines, key = batch["value"].slice(a, b - a), (files[a].as_py(), int(blocks[a]))
                if at is None or (at.file, at.block) != key:
                    if at is not None and (left := at.rest()):
                        yield made(at, lines[:0], left)
                    at = _Block(*key, inside[a].as_py())
                    if key[1] == 0:
                        head = next(csv.reader([lines[0].as_py()]), [])
                        if head != expected:
                            raise ValueError(f"CSV header of {key[0]} is {head}, not {expected}")
                        lines = lines[1:]
                yield made(at, *at.take(lines))
        if at is not None and (left := at.rest()):
            yield made(at, pa.array([], pa.string()), left)

    return lines.mapInArrow(run, _PARTS)


def records(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """(text): the records of the files under ``path``, without headers, in no order."""
    lines = _lines(spark, path)
    blocks = _blocks(lines)
    whole = _cut(lines.join(F.broadcast(blocks), ["file", "block"]), names).where(F.col("kind") == WHOLE).select("text")
    # Again through the blocks that a record runs into or out of, for its parts.
    over = lines.join(F.broadcast(blocks.where("inside OR inside_after")), ["file", "block"])
    parts = _cut(over, names).where(F.col("kind") != WHOLE)
    order = Window.partitionBy("file").orderBy("block", "kind")
    parts = parts.withColumn("record", F.count_if(F.col("kind") == START).over(order))
    joined = parts.groupBy("file", "record").agg(F.array_sort(F.collect_list(F.struct("block", "kind", "text"))).alias("parts"))
    return whole.union(joined.select(F.array_join(F.transform("parts", lambda p: p.text), "\n").alias("text")))
