"""GTFS feeds landed as text files: scan, latest version, metadata.

Layout: ``<root>/<dataset>/[<version>/]<file>.txt`` plus ``metadata.json``.
Paths are chosen first, from a listing: the latest version of each feed, without
the feeds that are done. The files of a kind are then read by one scan per
distinct header, with the dataset and version taken from the file path, so
thousands of feeds are the input splits of a few scans.
"""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.utils import AnalysisException

from .driver_views import Feed

# Columns carried per GTFS file (others in the header are dropped, missing
# ones become nulls).
GTFS_COLUMNS = {
    "agency": ["agency_id", "agency_name"],
    "routes": ["route_id", "agency_id", "route_short_name", "route_long_name", "route_type"],
    "stops": ["stop_id", "stop_name", "stop_lat", "stop_lon"],
    "calendar": ["service_id", "monday", "tuesday", "wednesday", "thursday", "friday",
                 "saturday", "sunday"],
    "trips": ["trip_id", "route_id", "service_id"],
    "stop_times": ["trip_id", "stop_id", "stop_sequence", "arrival_time", "departure_time",
                   "shape_dist_traveled"],
}
# A folder is a feed version when it holds at least one of these.
CORE_FILES = ["stops.txt", "routes.txt", "trips.txt", "stop_times.txt", "agency.txt"]


def _path_parts(root: str, path_col: str = "_metadata.file_path") -> tuple[Column, Column]:
    """(dataset, version) from a file path under ``root``."""
    rel = F.regexp_replace(F.col(path_col), r"^.*?" + _escape(root.rstrip("/")) + "/", "")
    parts = F.split(rel, "/")
    n = F.size(parts)
    dataset = F.get(parts, 0)
    version = F.when(n > 2, F.get(parts, n - 2)).otherwise(F.lit(""))
    return dataset, version


def _escape(s: str) -> str:
    import re
    return re.escape(s.replace("file://", ""))


def feed_files(spark: SparkSession, root: str) -> DataFrame:
    """(dataset_id, version, file, path) of the text files under ``root``: a
    listing, no file is opened. A file of a deeper folder belongs to the
    version named by its own folder."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", "*.txt").load(root).select("path"))
    dataset, version = _path_parts(root, "path")
    return files.select(dataset.alias("dataset_id"), version.alias("version"),
                        F.element_at(F.split("path", "/"), -1).alias("file"), "path")


def _header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Column names of one file, as they stand (Spark reads its first line)."""
    return tuple(_csv(spark).csv(path).columns)


def _csv(spark: SparkSession):
    return (spark.read.option("header", True).option("encoding", "UTF-8")
            .option("mode", "PERMISSIVE").option("quote", '"').option("escape", '"'))


def _clean(name: str) -> str:
    return name.replace("\ufeff", "").strip()


def read_files(spark: SparkSession, root: str, name: str, paths: list[str]) -> DataFrame:
    """The given files of one GTFS kind as strings.

    Every file is read by its own header: files are grouped by header (column
    order is free in GTFS), one scan per distinct header with its explicit
    paths, so each group is one set of input splits. Header names are trimmed;
    columns absent from a file are typed nulls, others dropped; doubled quotes
    inside a quoted value are one quote; bad UTF-8 bytes become U+FFFD. Adds
    ``dataset_id``, ``version`` and ``file_row`` (row order inside a file)."""
    cols = GTFS_COLUMNS[name]
    schema = StructType([StructField(c, StringType()) for c in ["dataset_id", "version", *cols]])
    out = spark.createDataFrame([], schema.add("file_row", "long"))
    with ThreadPool(8) as pool:  # headers are metadata: a line per file
        headers = pool.map(lambda p: _header(spark, p), paths) if paths else []
    groups: dict[tuple, list[str]] = {}
    for path, header in zip(paths, headers):
        groups.setdefault(header, []).append(path)
    for header, some in sorted(groups.items()):
        names = [f"c{i}" for i in range(len(header))]
        at = {}
        for n, h in zip(names, header):
            at.setdefault(_clean(h), n)  # of a repeated name the first counts
        raw = _csv(spark).schema(", ".join(f"{n} string" for n in names)) \
            .option("enforceSchema", True).csv(some)
        dataset, version = _path_parts(root)
        out = out.unionByName(raw.select(
            dataset.alias("dataset_id"), version.alias("version"),
            *[(F.col(at[c]) if c in at else F.lit(None).cast("string")).alias(c) for c in cols],
            F.monotonically_increasing_id().alias("file_row")))
    return out


def read_gtfs_file(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One GTFS file of every feed and version under ``root`` (see ``read_files``);
    a file missing everywhere gives an empty frame."""
    try:
        found = feed_files(spark, root).where(F.col("file") == f"{name}.txt").collect()
    except AnalysisException:
        found = []
    return read_files(spark, root, name, [r["path"] for r in found])


def latest_versions(spark: SparkSession, root: str) -> DataFrame:
    """S3: the version folder used per dataset (highest name; '' = the dataset
    folder itself, used only when it has no version folder and holds at least
    one core GTFS file)."""
    f = feed_files(spark, root)
    per = f.groupBy("dataset_id").agg(
        F.max(F.when(F.col("version") != "", F.col("version"))).alias("top_version"),
        F.max((F.col("version") == "") & F.col("file").isin(CORE_FILES)).alias("root_feed"))
    return (per.where(F.col("top_version").isNotNull() | F.col("root_feed"))
            .select("dataset_id", F.coalesce("top_version", F.lit("")).alias("version")))


def read_metadata(spark: SparkSession, root: str) -> DataFrame:
    """``metadata.json`` of each feed version → (dataset_folder, version,
    dataset_id), the id defaulting to the folder name."""
    try:
        m = (spark.read.option("multiLine", True).option("recursiveFileLookup", True)
             .option("pathGlobFilter", "metadata.json").json(root))
    except AnalysisException:
        return spark.createDataFrame([], "dataset_folder string, version string, dataset_id string")
    dataset, version = _path_parts(root)
    meta_id = F.col("dataset_id").cast("string") if "dataset_id" in m.columns else F.lit(None)
    return m.select(dataset.alias("dataset_folder"), version.alias("version"),
                    F.coalesce(meta_id, dataset).alias("dataset_id"))


def read_feeds(spark: SparkSession, root: str, skip: set[str] = frozenset(),
               redo: set[str] = frozenset()) -> Feed:
    """Every feed under ``root`` at its latest version, as one ``Feed``.

    ``dataset_id`` becomes the id from the feed's metadata when present. The
    versions, and the feeds to ``skip`` (S7) but for the folders to ``redo``, are
    settled on the listing (a few rows per feed), so only files that are needed are
    opened."""
    latest = latest_versions(spark, root)
    meta = read_metadata(spark, root).select(
        F.col("dataset_folder").alias("dataset_id"), "version", F.col("dataset_id").alias("meta_id"))
    chosen = feed_files(spark, root).join(latest, ["dataset_id", "version"]) \
        .join(meta, ["dataset_id", "version"], "left") \
        .select("dataset_id", "file", "path", F.coalesce("meta_id", "dataset_id").alias("feed_id"))
    rows = [r for r in chosen.collect() if r["feed_id"] not in skip or r["dataset_id"] in redo]
    ids = spark.createDataFrame(sorted({(r["dataset_id"], r["feed_id"]) for r in rows}),
                                "dataset_id string, feed_id string")

    def table(name: str) -> DataFrame:
        paths = sorted(r["path"] for r in rows if r["file"] == f"{name}.txt")
        t = read_files(spark, root, name, paths).join(ids, "dataset_id").drop("dataset_id", "version")
        return t.withColumnRenamed("feed_id", "dataset_id")

    return Feed(table("stops"), table("agency"), table("routes"), table("calendar"),
                table("trips"), table("stop_times"))


def skip_existing(feeds: DataFrame, processed: DataFrame) -> DataFrame:
    """S7 as a join: rows of feeds with no output yet."""
    return feeds.join(processed.select("dataset_id").distinct(), "dataset_id", "left_anti")
