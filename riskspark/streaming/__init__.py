"""Incremental form of the CSV load.

The reference has no streams, watermarks or state: its loader is a
one-shot bulk insert. The only streaming piece here is that same load run
incrementally with Structured Streaming: new CSV files landing in a folder
are read with the staging schema, typed and split into good and
quarantined rows by exactly the batch code (``sources.ingest.type_rows``),
and written to a folder per micro-batch (``_batch=<id>``). A batch that is
run again after a failure overwrites its own folder, so no row is lost or
doubled across restarts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskspark.sources.ingest import CORRUPT, READ_OPTIONS, type_rows, write_shipments
from riskspark.sources.schema import TableSpec


def read_csv_stream(spark: SparkSession, folder: str, spec: TableSpec, max_files_per_trigger: int = 100) -> DataFrame:
    schema = spec.staging_schema.add(T.StructField(CORRUPT, T.StringType(), True))
    return (spark.readStream.schema(schema)
            .options(**READ_OPTIONS, multiLine=True, enforceSchema=False).option("maxFilesPerTrigger", max_files_per_trigger)
            .csv(folder))


def ingest_stream(spark: SparkSession, folder: str, spec: TableSpec, out_path: str, quarantine_path: str,
                  checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Type each micro-batch of new files and write its good and quarantined rows, each under the batch's id."""
    typed = type_rows(read_csv_stream(spark, folder, spec), spec)

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        # Two sinks per micro-batch: keep the (bounded) batch so its files are read once.
        batch.persist()
        try:
            good = batch.where(~F.col("_bad")).drop("_bad", CORRUPT)
            if spec.name == "shipments":
                write_shipments(good, f"{out_path}/_batch={epoch_id}")
            else:
                good.write.mode("overwrite").parquet(f"{out_path}/_batch={epoch_id}")
            batch.where(F.col("_bad")).drop("_bad").write.mode("overwrite").parquet(f"{quarantine_path}/_batch={epoch_id}")
        finally:
            batch.unpersist()

    writer = typed.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
