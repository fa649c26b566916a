"""Conditional update and all-or-nothing publish on plain files.

Parquet tables reject ``UPDATE`` and ``MERGE`` and cannot overwrite
themselves, so an update is copy-on-write: compute the new full table,
write it as a new version, validate it, then mark it as committed. Until the
marker exists, readers keep seeing the old version, which is the
rollback of the reference's ``BEGIN TRAN .. COMMIT / ROLLBACK``.
Single writer per table is assumed; this is not a transaction log.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def update_where_in(df: DataFrame, keys: DataFrame, on: Sequence[str], set_exprs: Mapping[str, Column]) -> DataFrame:
    """``UPDATE df SET c = expr WHERE (on) IN (SELECT on FROM keys)``, returning the full table.

    The key set is de-duplicated before the left join, so the join can
    neither drop nor multiply rows. Not idempotent, like the SQL it mirrors:
    running it twice applies the change twice.
    """
    hits = keys.select(*on).distinct().withColumn("_hit", F.lit(True))
    joined = df.join(hits, list(on), "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    return joined.select(*[
        (F.when(hit, set_exprs[c]).otherwise(F.col(c)).alias(c) if c in set_exprs else F.col(c))
        for c in df.columns])


# -- versioned publish ----------------------------------------------------------
_MARK = "_COMMITTED"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p, jvm


def _versions(fs, root) -> list[str]:
    """Names of all version folders, committed or not, oldest first."""
    if not fs.exists(root):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(root) if st.isDirectory()]
    return sorted((n for n in names if n.startswith("v=") and n[2:].isdigit()), key=lambda n: int(n[2:]))


def current_version(spark: SparkSession, table_path: str) -> str | None:
    """Name of the newest version folder that carries the commit marker, or None before the first publish."""
    fs, root, jvm = _fs(spark, table_path)
    path = jvm.org.apache.hadoop.fs.Path
    return next((v for v in reversed(_versions(fs, root)) if fs.exists(path(path(root, v), _MARK))), None)


def read_current(spark: SparkSession, table_path: str) -> DataFrame:
    v = current_version(spark, table_path)
    if v is None:
        raise FileNotFoundError(f"nothing published at {table_path}")
    return spark.read.parquet(f"{table_path.rstrip('/')}/{v}")


Check = Callable[[DataFrame], None]


def publish(df: DataFrame, table_path: str, checks: Sequence[Check] = (),
            partition_by: Sequence[str] = ()) -> str:
    """Write ``df`` as a new version, run ``checks`` on what was written, then commit it by one empty marker file.

    A version counts once its marker exists, and creating a file is one step
    on any store, so a failure at any point (in the write, in a check, before
    or while the marker is made) leaves the previous version current and
    nothing that was committed is ever touched. Folders that a failed publish
    left behind are never current, and their numbers are not used again.
    """
    spark = df.sparkSession
    fs, root, jvm = _fs(spark, table_path)
    taken = _versions(fs, root)
    version = f"v={(int(taken[-1][2:]) if taken else 0) + 1:06d}"
    target = f"{table_path.rstrip('/')}/{version}"
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(target)
    written = spark.read.parquet(target)
    for check in checks:
        check(written)
    _commit(fs, jvm.org.apache.hadoop.fs.Path(target, _MARK))
    return version


def _commit(fs, marker) -> None:
    fs.create(marker, False).close()
