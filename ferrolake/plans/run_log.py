"""Stage metrics of the batch jobs: a table of one row per run and stage.

Counts come from ``DataFrame.observe`` on the job's own writes, so no stage reads
its data twice; ``run_summary`` (A16) adds them up.
"""

from __future__ import annotations

import time
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

RUNS = ("run_id string, stage string, origin string, load_id int, buckets int, "
        "duration_seconds double, success boolean, downloaded long, files_generated long, "
        "rows_loaded long, rows_rejected long, finished_at timestamp_ntz")
_FIELDS = [f.strip().split(" ")[0] for f in RUNS.split(",")]


@contextmanager
def stage(spark: SparkSession, runs: str, run_id: str, name: str):
    """Times one stage and appends its row to the table ``runs``; the body fills the
    yielded dict. A stage that raises is recorded without success."""
    seen: dict = {}
    begun, ok = time.monotonic(), False
    try:
        yield seen
        ok = True
    finally:
        row = {"run_id": run_id, "stage": name, "success": ok,
               "duration_seconds": round(time.monotonic() - begun, 3), **seen}
        # The clock of the session, as for the loads themselves.
        (spark.createDataFrame([tuple(row.get(c) for c in _FIELDS)], RUNS)
         .withColumn("finished_at", F.localtimestamp()).coalesce(1)
         .write.mode("append").parquet(runs))


def read_runs(spark: SparkSession, runs: str) -> DataFrame:
    """The stage rows under ``runs`` (none if no stage has ended yet)."""
    try:
        return spark.read.schema(RUNS).parquet(runs)
    except AnalysisException:
        return spark.createDataFrame([], RUNS)


def observed(df: DataFrame, *metrics) -> tuple[DataFrame, Observation]:
    """``df`` that reports the aggregates ``metrics`` when it is written."""
    seen = Observation()
    return df.observe(seen, *metrics), seen
