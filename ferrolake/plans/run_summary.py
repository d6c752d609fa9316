"""Run summary of the daily pipeline from its stage metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def run_summary(stages: DataFrame, run_key: str = "run_id") -> DataFrame:
    """``stages``: (stage, duration_seconds, success, downloaded, files_generated,
    rows_loaded), one row per stage of a run (extract, transform, load). One
    row per value of ``run_key`` (one row in all if there is no such column):
    total duration, counts, and whether every stage succeeded."""
    runs = stages.groupBy(run_key) if run_key in stages.columns else stages.groupBy()
    return runs.agg(
        F.sum(F.coalesce("duration_seconds", F.lit(0.0))).alias("total_duration_seconds"),
        F.sum(F.coalesce("downloaded", F.lit(0))).alias("files_downloaded"),
        F.sum(F.coalesce("files_generated", F.lit(0))).alias("files_transformed"),
        F.sum(F.coalesce("rows_loaded", F.lit(0))).alias("rows_loaded"),
        F.coalesce(F.bool_and(F.coalesce("success", F.lit(False))), F.lit(False)).alias("success"),
    )
