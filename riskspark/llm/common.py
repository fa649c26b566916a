"""Helpers that the operators of this subpackage share.

Intermediate results that several passes read are written as Parquet under
the session's shared checkpoint folder (``Scratch``): lineage is cut, a lost
executor only costs the tasks it ran, and shuffle files of the writing job
are freed when the write ends.
"""

from __future__ import annotations

import io
import os
import zipfile
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.session import scratch_path

#: The six characters of the class [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, by way of the shared folder and once per application, so that tasks
    import it wherever they run."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root, data = os.path.dirname(os.path.dirname(os.path.abspath(__file__))), io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for folder, _, files in os.walk(root):
            for f in sorted(files):
                if f.endswith(".py"):
                    path = os.path.join(folder, f)
                    z.write(path, os.path.join("riskspark", os.path.relpath(path, root)))
    target = sc._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, "package"), "riskspark.zip")
    out = target.getFileSystem(sc._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(data.getvalue()))
    finally:
        out.close()
    sc.addPyFile(target.toString())
    _shipped.add(sc.applicationId)


class Scratch:
    """Tables under the shared checkpoint folder, dropped once nothing reads them."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name, self.paths = spark, name, {}
        ship_package(spark)

    def save(self, df: DataFrame, table: str) -> DataFrame:
        """Write ``df`` once and return the written table."""
        path = scratch_path(self.spark, f"{self.name}-{table}")
        before = self.spark.conf.get(_FREE_SHUFFLES, None)
        self.spark.conf.set(_FREE_SHUFFLES, "true")
        try:
            df.write.option("compression", "zstd").parquet(path)
        finally:
            if before is None:
                self.spark.conf.unset(_FREE_SHUFFLES)
            else:
                self.spark.conf.set(_FREE_SHUFFLES, before)
        self.paths.setdefault(table, []).append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *tables: str) -> None:
        """Delete tables that no later plan reads (all, if none are named)."""
        tables = tables or tuple(self.paths)
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for table in tables:
            for path in self.paths.pop(table, []):
                p = jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(conf).delete(p, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have yet (compared without case)."""
    taken = {c.lower() for c in df.columns}
    name = f"_{base}"
    while name.lower() in taken:
        name = f"_{name}"
    return name


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; ``lower`` does it for texts that are all ASCII, and is faster."""
    return F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(text, UPPER, UPPER.lower())).otherwise(F.lower(text))


def split_words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text; none for null."""
    trimmed = F.btrim(text, F.lit(BLANKS))
    none = F.array().cast("array<string>")
    return F.when(F.length(trimmed) > 0, F.split(trimmed, r"[\x20\x09-\x0D]+")).otherwise(none)


def chunks(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of ``most`` in all, or of one row that is larger."""
    first, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > most:
            yield first, i
            first, held = i, 0
        held += size
    if first < len(sizes):
        yield first, len(sizes)


def small_side(df: DataFrame, n_rows: int, bound: int = 1_000_000) -> DataFrame:
    """Broadcast hint for a table counted to be within ``bound`` rows; else Spark picks the join."""
    return F.broadcast(df) if n_rows <= bound else df
