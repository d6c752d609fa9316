"""Batch jobs on landed data, as run by a scheduler (spark-submit friendly).

    python -m ferrolake.plans.jobs transform --feeds <root> --summary <path> [--archives <glob>]
    python -m ferrolake.plans.jobs load --summary <path> --warehouse <root>
    python -m ferrolake.plans.jobs report --warehouse <root> --name by_country --out <path>
    python -m ferrolake.plans.jobs runs --runs <path> --out <path>

All paths are shared storage. ``transform`` skips feeds that already have
output (S7) unless their landed archive changed (S12), and overwrites only the
partitions of the feeds it processes; next to the summary it leaves the clean-up
report (P8). ``load`` upserts into the stored warehouse and leaves the rejected
rows (P10); ``report`` reads the warehouse. Every job appends its stage metrics to
a table of runs, which ``runs`` sums up per run (A16).
"""

from __future__ import annotations

import argparse

import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..operators import reports as R
from ..operators.quality import sanitize_report
from ..operators.stop_times import trip_facts
from ..operators.trips import classify, trip_rows, trips_summary
from ..session import job_session
from ..sources.catalog import changed_archives
from ..sources.gtfs import read_feeds
from .pipeline import write_summary
from .run_log import observed, read_runs, stage
from .run_summary import run_summary
from .store import latest_warehouse, load_summary

REPORTS = {
    "overview": R.overview, "by_country": R.by_country, "by_train_type": R.by_train_type,
    "by_traction": R.by_traction, "by_agency": R.by_agency,
    "emissions_by_route": R.emissions_by_route, "by_service_type": R.by_service_type,
    "search_trips": R.search_trips, "spotlight": R.spotlight, "top_countries": R.top_countries,
    "trip_view": R.trip_view, "fact_count": R.fact_count, "load_counts": R.load_counts,
}


def _processed(spark: SparkSession, summary_path: str) -> set[str]:
    """Feeds that have output: the summary's partition folders, no data column."""
    try:
        s = spark.read.parquet(summary_path)
    except AnalysisException:
        return set()
    return {str(r[0]) for r in s.select("part_dataset").distinct().collect()}


def cleanup_path(summary_path: str) -> str:
    return f"{summary_path.rstrip('/')}_cleanup"


def transform_runs(summary_path: str) -> str:
    return f"{summary_path.rstrip('/')}_runs"


def transform(spark: SparkSession, feeds_root: str, summary_path: str, skip_done: bool = True,
              archives: str | None = None) -> None:
    """Entry 1: every landed feed → trips summary table (partition per feed) and the
    clean-up report of the same feeds. Feeds that have output already are left out
    before any file is parsed, unless the hash of their archive (``archives``: a glob
    of landed zip files) differs from the one of their last run."""
    with stage(spark, transform_runs(summary_path), uuid.uuid4().hex, "transform") as seen:
        done = _processed(spark, summary_path) if skip_done else set()
        state = f"{summary_path.rstrip('/')}_archives"
        changed = changed_archives(spark, archives, state) if archives else None
        redo = {r["dataset_name"] for r in changed.where("changed").collect()} if archives else set()
        feed = read_feeds(spark, feeds_root, skip=done, redo=redo)
        facts = trip_facts(feed.stop_times, feed.stops).persist(StorageLevel.MEMORY_AND_DISK)
        rows = trip_rows(feed, facts).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            summary, counts = observed(trips_summary(feed, rows), F.count(F.lit(1)).alias("rows"),
                                       F.size(F.collect_set("source_dataset")).alias("feeds"))
            write_summary(summary, summary_path)
            every = classify(rows.withColumn("departures", F.lit(None).cast("bigint")), feed.stops)
            (sanitize_report(every).withColumn("part_dataset", F.col("dataset_id"))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("part_dataset").parquet(cleanup_path(summary_path)))
        finally:
            rows.unpersist()
            facts.unpersist()
        if archives:
            # Only now: a run that failed meets the same changes again. Written through
            # a checkpoint, as the state itself is read.
            (changed.checkpoint().select("file_hash", F.col("dataset_name").alias("part_dataset"))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("part_dataset").parquet(state))
        seen.update(origin=feeds_root, files_generated=counts.get["feeds"],
                    rows_loaded=counts.get["rows"])


def load(spark: SparkSession, summary_path: str, warehouse_root: str, **settings) -> int:
    """Entry 2: summary table → staging, rejects and star schema, upserted into the
    stored warehouse; returns the load's number."""
    summary = spark.read.parquet(summary_path).drop("part_dataset")
    return load_summary(spark, summary, warehouse_root, **settings)


def report(spark: SparkSession, warehouse_root: str, name: str, **params) -> DataFrame:
    """A dashboard report over the stored warehouse."""
    wh = latest_warehouse(spark, warehouse_root)
    if wh is None:
        raise FileNotFoundError(f"no finished load under {warehouse_root}")
    return REPORTS[name](wh, **params)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="ferrolake.plans.jobs")
    sub = ap.add_subparsers(dest="cmd", required=True)
    t = sub.add_parser("transform")
    t.add_argument("--feeds", required=True)
    t.add_argument("--summary", required=True)
    t.add_argument("--archives")
    t.add_argument("--all", action="store_true", help="reprocess feeds that have output")
    ld = sub.add_parser("load")
    ld.add_argument("--summary", required=True)
    ld.add_argument("--warehouse", required=True)
    r = sub.add_parser("report")
    r.add_argument("--warehouse", required=True)
    r.add_argument("--name", required=True, choices=sorted(REPORTS))
    r.add_argument("--out", required=True)
    rs = sub.add_parser("runs")
    rs.add_argument("--runs", required=True)
    rs.add_argument("--out", required=True)
    a = ap.parse_args(argv)
    spark = job_session()
    if a.cmd == "transform":
        transform(spark, a.feeds, a.summary, skip_done=not a.all, archives=a.archives)
    elif a.cmd == "load":
        load(spark, a.summary, a.warehouse)
    elif a.cmd == "runs":
        run_summary(read_runs(spark, a.runs)).write.mode("overwrite").parquet(a.out)
    else:
        report(spark, a.warehouse, a.name).write.mode("overwrite").parquet(a.out)


if __name__ == "__main__":
    main()
