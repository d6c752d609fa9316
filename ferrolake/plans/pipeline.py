"""The two batch jobs of the timetable pipeline, as lazy DataFrame plans.

``transform``: GTFS feeds → trips summary (one row per feed × trip).
``load``: trips summary → staging → star schema (dimensions + fact).
Nothing here collects to the driver: each step returns DataFrames and Spark
runs the whole chain as one plan (or as stored tables, see ``store``).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from ..operators.stop_times import trip_facts
from ..operators.trips import trip_rows, trips_summary
from ..operators.warehouse import (DEFAULT_LOAD_ID, DEFAULT_LOADED_AT, Warehouse,
                                   load_warehouse)
from ..sources.driver_views import Feed, feed_from_driver


@dataclass
class Pipeline:
    """Lazy handles on every stage for one input folder.

    The fan-out points (joined trip rows, staging, facts) are persisted:
    a later query of the same pipeline reads them from Spark's cache, not from
    the files. They are re-registered on every access so that a cleared cache is
    rebuilt instead of silently bypassed; ``release`` drops them."""

    spark: SparkSession
    sf_dir: str
    load_id: int = DEFAULT_LOAD_ID
    loaded_at: str = DEFAULT_LOADED_AT

    @cached_property
    def feed(self) -> Feed:
        return feed_from_driver(self.spark, self.sf_dir)

    @cached_property
    def _facts(self) -> DataFrame:
        return trip_facts(self.feed.stop_times, self.feed.stops)

    @cached_property
    def _rows(self) -> DataFrame:
        return trip_rows(self.feed)

    @cached_property
    def _summary(self) -> DataFrame:
        return trips_summary(self.feed, rows=self._rows)

    @cached_property
    def _warehouse(self) -> Warehouse:
        return load_warehouse(self.summary, self.load_id, self.loaded_at)

    @property
    def summary(self) -> DataFrame:
        _keep_cached(self._rows)
        return self._summary

    @cached_property
    def _fact_warehouse(self) -> Warehouse:
        return load_warehouse(self.summary, self.load_id, self.loaded_at, keep=("facts",))

    @property
    def fact_warehouse(self) -> Warehouse:
        """``warehouse`` for reports on facts alone: the staging rows, which feed the
        dimensions, get no copy of their own (the facts are the same cached table)."""
        _ = self.summary
        for table in self._fact_warehouse.kept:
            _keep_cached(table)
        return self._fact_warehouse

    @property
    def warehouse(self) -> Warehouse:
        _ = self.summary
        wh = self._warehouse
        for table in wh.kept:
            _keep_cached(table)
        return wh


    def release(self) -> None:
        """Drop this pipeline's persisted tables (rows, staging, facts)."""
        if "_rows" in self.__dict__:
            self._rows.unpersist()
        for name in ("_warehouse", "_fact_warehouse"):
            if name in self.__dict__:
                self.__dict__[name].release()


def _keep_cached(df: DataFrame) -> None:
    if df.storageLevel == StorageLevel(False, False, False, False, 1):  # not cached any more
        df.persist(StorageLevel.MEMORY_AND_DISK)


def pipeline_for(spark: SparkSession, sf_dir: str) -> Pipeline:
    """The lazy pipeline of one session and input folder: building the
    ~60-operator plan costs seconds of analysis, so queries share it. It is kept
    on the session object and ends with it; a stopped session's plans are never
    reused."""
    kept = spark.__dict__.setdefault("_ferrolake_pipelines", {})
    key = sf_dir.rstrip("/")
    p = kept.get(key)
    if p is None or p.spark.sparkContext is not spark.sparkContext:
        p = kept[key] = Pipeline(spark, sf_dir)
    return p


def write_summary(summary: DataFrame, path: str) -> None:
    """The summary table, one partition folder per feed; re-running a feed
    replaces only its own folder (dynamic partition overwrite)."""
    (summary.withColumn("part_dataset", summary["source_dataset"])
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("part_dataset").parquet(path))
