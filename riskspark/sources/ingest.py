"""CSV ingest and export: staged read, typing, defaults, quarantine, parquet layout.

The reference bulk-loads one headered CSV per table, parents first. Here:

1. read with the *staging* schema (text-tolerant types: "7.0" for an int,
   0/1 for a boolean), never inferred, in PERMISSIVE mode with a
   corrupt-record column;
2. cast to the table types with ``try_cast`` (ANSI mode would otherwise
   fail the job on one bad value) and fill column defaults for empty fields;
3. split rows into good and quarantined (unparseable line, failed cast,
   missing NOT NULL value) so that good + quarantined = input;
4. write parquet; shipments are partitioned by ship month so a date-range
   query prunes files instead of scanning the table.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.operators.snapshots import Check, Snapshot, SnapshotStore
from riskspark.session import scratch_path
from riskspark.sources.csv_records import lines_are_records, records
from riskspark.sources.schema import BY_NAME, TABLES, TableSpec

CORRUPT = "_corrupt_record"
#: One form for reading and writing. Null is an empty field and empty text is ``""``; blanks stay; fields may
#: hold line ends; timestamps keep their microseconds; the header must name the columns in their order.
CSV_OPTIONS = {
    "header": True, "encoding": "UTF-8", "quote": '"', "escape": '"', "lineSep": "\n",
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "nullValue": "", "emptyValue": '""',
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
#: What quoted empty text is read as, so that it differs from an empty field; ``type_rows`` turns it back.
_EMPTY = "\ue000"
READ_OPTIONS = CSV_OPTIONS | {"emptyValue": _EMPTY, "mode": "PERMISSIVE",
                              "columnNameOfCorruptRecord": CORRUPT}


def read_staged(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """Headered UTF-8 CSV with the staging schema, by as many tasks as its size asks for. "None" stays a string; swapped header columns raise.

    A pass over the lines tells whether a field may hold line ends. If none does, Spark's own reader takes the files by lines. Else
    they are cut into records first (``csv_records``), and each record is then parsed by itself.
    """
    schema = spec.staging_schema.add(T.StructField(CORRUPT, T.StringType(), True))
    if lines_are_records(spark, path, [c for c, _ in spec.columns]):
        return spark.read.schema(schema).options(**READ_OPTIONS, enforceSchema=False).csv(path)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    options = {k: str(v).lower() if isinstance(v, bool) else v for k, v in READ_OPTIONS.items()}
    found = records(spark, path, [c for c, _ in spec.columns])
    return found.select(F.from_csv("text", ddl, options).alias("row")).select("row.*")


def type_rows(staged: DataFrame, spec: TableSpec) -> DataFrame:
    """Cast staged columns to the table types, fill defaults, and flag bad rows in ``_bad``."""
    out, bad = [], [F.col(CORRUPT).isNotNull()]
    for name, dtype in spec.columns:
        raw = F.col(name)
        if isinstance(dtype, T.StringType):
            raw = F.when(raw == _EMPTY, "").otherwise(raw)
        if isinstance(dtype, T.BooleanType) and name in spec.staging:
            typed = F.when(raw == 1, F.lit(True)).when(raw == 0, F.lit(False))
        elif isinstance(dtype, (T.IntegerType, T.LongType)) and isinstance(spec.staging.get(name), T.DoubleType):
            # "7.0" -> 7; "7.5" and what the type cannot hold -> bad
            typed = F.when(raw == F.floor(raw), raw.try_cast(dtype))
        else:
            typed = F.expr(f"try_cast(`{name}` AS {dtype.simpleString()})") if name in spec.staging else raw
        if name in spec.defaults:
            typed = F.coalesce(typed, F.lit(spec.defaults[name]).cast(dtype))
        bad.append(raw.isNotNull() & typed.isNull())                  # value present but not castable
        if name in spec.not_null or name in spec.pk:
            bad.append(typed.isNull())
        out.append(typed.alias(name))
    flag = reduce(lambda a, b: a | b, bad)
    return staged.select(*out, F.col(CORRUPT), flag.alias("_bad"))


def load_table(spark: SparkSession, path: str, spec: TableSpec) -> tuple[DataFrame, DataFrame]:
    """(good rows with table types, quarantined raw rows with a reason-free copy of the text)."""
    typed = type_rows(read_staged(spark, path, spec), spec)
    good = typed.where(~F.col("_bad")).drop("_bad", CORRUPT)
    quarantined = typed.where(F.col("_bad")).drop("_bad")
    return good, quarantined


def load_all(spark: SparkSession, csv_dir: str, out_dir: str | None = None,
             tables: Iterable[TableSpec] = TABLES) -> dict[str, DataFrame]:
    """Load every table of the manifest in parent-first order; optionally write parquet.

    With ``out_dir`` each CSV is read once: typed rows are written in one
    pass partitioned by the quarantine flag, so ``{out}/{table}/_bad=false``
    is the table (shipments further partitioned by ship month) and
    ``{out}/{table}/_bad=true`` holds the quarantined rows with their raw line.
    """
    loaded = {}
    for spec in tables:
        path = f"{csv_dir.rstrip('/')}/{spec.name}.csv"
        if not out_dir:
            loaded[spec.name] = load_table(spark, path, spec)[0]
            continue
        typed = type_rows(read_staged(spark, path, spec), spec)
        parts = ["_bad"]
        if spec.name == "shipments":
            typed = typed.withColumn("ship_month", F.trunc(F.col("ship_date"), "MM"))
            parts.append("ship_month")
            # rebalance: one shuffle (no sampling pass over the CSV); AQE splits a hot month
            typed = typed.hint("rebalance", "_bad", "ship_month").sortWithinPartitions(*parts, "ship_date")
        typed.write.mode("overwrite").partitionBy(*parts).parquet(f"{out_dir}/{spec.name}")
        loaded[spec.name] = _loaded(spark, out_dir, spec, typed.schema).where(~F.col("_bad")).drop(CORRUPT, "_bad")
    return loaded


def load_snapshot(spark: SparkSession, csv_dir: str, store: SnapshotStore, tables: Iterable[TableSpec] = TABLES,
                  checks: Mapping[str, Sequence[Check]] | None = None) -> Snapshot:
    """Load every table of the manifest, parents first, and publish all of them as one snapshot.

    Readers of ``store`` see the tables of the load before until the last table
    is written and checked. Each table keeps its quarantined rows under
    ``_bad=true``; ``snapshot_table`` reads the good ones.
    """
    specs = list(tables)
    seen: set[str] = set()
    for spec in specs:
        if late := [parent for _, parent, _ in spec.fks if parent not in seen and any(t.name == parent for t in specs) and parent != spec.name]:
            raise ValueError(f"{spec.name} comes before its parents {late}")
        seen.add(spec.name)
    path = f"{csv_dir.rstrip('/')}/{{}}.csv"
    return store.commit(lambda _: {s.name: type_rows(read_staged(spark, path.format(s.name), s), s) for s in specs},
                        checks=checks, partition_by={s.name: ["_bad"] for s in specs})


def snapshot_table(snapshot: Snapshot, spec: TableSpec) -> DataFrame:
    """The good rows of a table that ``load_snapshot`` published."""
    return snapshot.read(spec.name).where(~F.col("_bad")).drop("_bad", CORRUPT)


def no_bad_rows(written: DataFrame) -> None:
    """A check for ``load_snapshot``: fails the load if a row was set aside."""
    if written.where("_bad").limit(1).count():
        raise ValueError("the load set rows aside")


def _loaded(spark: SparkSession, out_dir: str, spec: TableSpec, schema: T.StructType) -> DataFrame:
    """All rows that ``load_all`` wrote; the schema is given, as a table may have no good or no bad rows."""
    return spark.read.schema(schema).parquet(f"{out_dir}/{spec.name}")


def quarantined(spark: SparkSession, out_dir: str, table: str) -> DataFrame:
    """Rows of ``table`` that ``load_all`` set aside (typed columns as far as they parsed, raw line); none on a clean load."""
    spec = BY_NAME[table]
    fields = [T.StructField(c, t, True) for c, t in spec.columns]
    schema = T.StructType([*fields, T.StructField(CORRUPT, T.StringType()), T.StructField("_bad", T.BooleanType())])
    return _loaded(spark, out_dir, spec, schema).where("_bad").drop("_bad")


def write_shipments(shipments: DataFrame, path: str, date_col: str = "ship_date", mode: str = "overwrite") -> None:
    """Shipments laid out by ship month: the replacement of the reference's date index.

    Rows are clustered by month before the write (a ``rebalance`` shuffle:
    AQE splits a month holding a large share of rows and merges small
    ones), so each task writes few partition folders; within a month they
    are sorted by date, so parquet row-group statistics also skip data for
    ranges inside one month.
    """
    (shipments.withColumn("ship_month", F.trunc(F.col(date_col), "MM"))
     .hint("rebalance", "ship_month")
     .sortWithinPartitions("ship_month", date_col)
     .write.mode(mode).partitionBy("ship_month").parquet(path))


def write_csv(df: DataFrame, path: str) -> None:
    """Headered CSV, one folder per table (the generator's ``to_csv(index=False)``)."""
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def csv_roundtrip(df: DataFrame, defaults: Mapping[str, object] | None = None, path: str | None = None) -> DataFrame:
    """Write ``df`` as CSV under the shared checkpoint folder and read it back typed.

    Empty fields come back as null and then take ``defaults`` (the load's
    column defaults). The result is read from the written files; a row that
    cannot be read back is an error.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, "csv")
    write_csv(df, path)
    spec = TableSpec("roundtrip", tuple((f.name, f.dataType) for f in df.schema.fields), (),
                     defaults=dict(defaults or {}))
    typed = type_rows(read_staged(spark, path, spec), spec)
    refused = F.raise_error(F.lit(f"rows of {path} cannot be read back"))
    return typed.where(F.when(F.col("_bad"), refused.cast("boolean")).otherwise(True)).drop("_bad", CORRUPT)


def values(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """An inline literal relation (``VALUES``)."""
    return spark.createDataFrame(list(rows), schema)


def explode_variants(items: DataFrame, category: str, item_id: str, item_name: str, variants: Sequence[str],
                     cap: int | None = None, width: int = 1 << 16) -> DataFrame:
    """Every item in every variant, numbered in catalog order (category, item, variant position).

    The variants are a literal array exploded per row (a generator, not a
    join). A category's items are numbered in ranges of ``width`` ids, so that no
    category has a window of its own. ``cap`` keeps the first n catalog entries, the
    reference's fixed-size product list: each task keeps its first n and those are
    merged, so nothing but n rows is numbered.
    """
    from riskspark.operators.windows import dense_position, id_range

    order = [category, item_id, "variant_pos"]
    exploded = items.select(category, item_id, item_name,
                            F.posexplode(F.array(*[F.lit(v) for v in variants])).alias("variant_pos", "variant"))
    exploded = exploded.withColumn("variant_name", F.concat(F.col(item_name), F.lit(" - "), F.col("variant")))
    if cap is not None:
        exploded = exploded.orderBy(*order).limit(cap)
    numeric = isinstance(items.schema[item_id].dataType, T.NumericType)
    numbered = dense_position(exploded, order, [category, id_range(item_id, width) if numeric else item_id], "catalog_id", start=1)
    return numbered.select(category, item_id, "variant", "variant_name", "catalog_id")


def flatten_catalog(catalog: DataFrame, map_col: str = "catalog", category: str = "category",
                    item: str = "item") -> DataFrame:
    """A nested ``map<category, array<item>>`` literal as (category, item_pos, item) rows."""
    cats = catalog.select(F.posexplode(F.map_entries(map_col)).alias("category_pos", "entry"))
    return cats.select("category_pos", F.col("entry.key").alias(category),
                       F.posexplode(F.col("entry.value")).alias("item_pos", item))
