"""Incremental warehouse loads from landed trip summaries (Structured Streaming).

The batch pipeline runs once a day; this is its incremental counterpart: a
file stream over the summary folder, one micro-batch per new set of files,
each upserted into the warehouse (dimensions on their natural key, facts on
(trip, feed)) by the same ``load_summary`` the batch job uses.
``trigger(availableNow=True)`` processes whatever has landed and stops, so a
scheduler can run it like a batch job with exactly-once file tracking.

Batch and stream loads are numbered in one sequence (``plans.store``). A
micro-batch's origin (stream and batch number) stands in the table of runs, so a
batch replayed after a failure is recognised and skipped. The stream checkpoint
must be named by the caller and live on shared storage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, IntegerType, StringType, StructField, StructType)

from ..operators.trips import SUMMARY_COLUMNS
from ..plans.store import FACT_BUCKETS, finished_loads, load_summary

_DOUBLES = {"distance_km", "duration_h", "emission_gco2e_pkm", "total_emission_kgco2e"}
SUMMARY_SCHEMA = StructType(
    [StructField("dataset_id", StringType())]
    + [StructField(c, DoubleType() if c in _DOUBLES else
                   IntegerType() if c == "frequency_per_week" else StringType())
       for c in SUMMARY_COLUMNS])


def upsert_batch(root: str, buckets: int = FACT_BUCKETS):
    """foreachBatch handler: load one micro-batch of summary rows, once."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # The query id is kept in the checkpoint: a new checkpoint is a new
        # stream, whose batch numbers start again.
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        origin = f"stream {query} batch {batch_id}"
        if not finished_loads(spark, root).where(F.col("origin") == origin).limit(1).count():
            load_summary(spark, batch, root, origin, buckets)
    return handle


def run_incremental_load(spark: SparkSession, summary_dir: str, warehouse_root: str,
                         checkpoint_location: str, buckets: int = FACT_BUCKETS):
    """Process every summary file landed since the last run, then stop."""
    if not checkpoint_location:
        raise ValueError("the stream needs a checkpoint location on shared storage")
    stream = (spark.readStream.schema(SUMMARY_SCHEMA).option("recursiveFileLookup", True)
              .parquet(summary_dir))
    q = (stream.writeStream.foreachBatch(upsert_batch(warehouse_root, buckets))
         .option("checkpointLocation", checkpoint_location).trigger(availableNow=True).start())
    q.awaitTermination()
    return q
