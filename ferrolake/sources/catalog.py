"""Open-data catalogue and archive handling as Spark jobs.

The HTTP calls themselves are not part of this library: catalogue answers and
archives are expected to be landed as files. Everything after landing —
choosing the feed version, de-duplicating downloads, hashing and unpacking
archives — runs distributed.
"""

from __future__ import annotations

import io
import os
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from .gtfs import CORE_FILES

# Only the first history entries of a catalogue answer are considered.
HISTORY_WINDOW = 5
GTFS_FORMAT = "GTFS"


def catalog_latest(answers: DataFrame, window: int = HISTORY_WINDOW) -> DataFrame:
    """Per catalogue answer, the newest usable GTFS resource.

    ``answers``: one row per answer with ``source_url`` and ``history``
    (array of {created_at, updated_at, payload{format, permanent_url, filename,
    dataset_id, created_at, updated_at}}). Of the first five history entries,
    the first whose format is GTFS and whose url and filename are non-empty;
    dates fall back from the payload to the entry."""
    h = answers.select("source_url", F.posexplode("history").alias("pos", "item"))
    p = F.col("item.payload")
    ok = ((F.col("pos") < window) & (p["format"] == GTFS_FORMAT)
          & (F.coalesce(p["permanent_url"], F.lit("")) != "")
          & (F.coalesce(p["filename"], F.lit("")) != ""))
    pick = F.struct(
        p["permanent_url"].alias("url"), p["filename"].alias("filename"),
        F.coalesce(p["dataset_id"], F.lit("")).alias("dataset_id"),
        F.coalesce(F.nullif(p["created_at"], F.lit("")), F.col("item.created_at")).alias("created_at"),
        F.coalesce(F.nullif(p["updated_at"], F.lit("")), F.col("item.updated_at")).alias("updated_at"),
        p["format"].alias("format"))
    best = h.where(ok).groupBy("source_url").agg(F.min_by(pick, F.col("pos")).alias("r"))
    return best.select("r.url", "r.filename", "source_url", "r.dataset_id", "r.created_at",
                       "r.updated_at", "r.format")


def catalog_dedup(resolved: DataFrame) -> DataFrame:
    """One download per resource url, the last source (config order
    ``pos``) winning; blank source urls are dropped."""
    r = resolved.withColumn("source_url", F.trim("source_url")).where(F.col("source_url") != "")
    cols = [c for c in r.columns if c not in ("url", "pos")]
    best = r.groupBy("url").agg(F.max_by(F.struct(*cols), F.col("pos")).alias("r"))
    return best.select("url", "r.*")


def url_dataset_name(url) -> tuple:
    """(file name, dataset name) of a direct archive URL: last path part
    (trailing slashes ignored; 'dataset.zip' if empty), '.zip' appended when
    missing, stem = name without its last extension. Unparsable URLs count as
    an empty path (``try_parse_url``: no failure in ANSI mode)."""
    path = F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit(""))
    last = F.regexp_extract(F.regexp_replace(path, "/+$", ""), r"([^/]*)$", 1)
    name = F.when(last == "", F.lit("dataset.zip")).otherwise(last)
    filename = F.when(F.lower(name).endswith(".zip"), name).otherwise(F.concat(name, F.lit(".zip")))
    stem = F.regexp_replace(filename, r"(?<=.)\.[^.]*$", "")
    return filename, stem


def archive_manifest(spark: SparkSession, zip_glob: str, previous: DataFrame | None = None) -> DataFrame:
    """SHA-256 per landed archive, and whether it is already unpacked.

    ``previous`` (dataset_name, file_hash, has_metadata, has_gtfs_file)
    describes what the extract folder holds. An archive is already extracted
    when its folder has metadata and a core GTFS file, and — when a hash was
    recorded — the hash is unchanged."""
    z = (spark.read.format("binaryFile").load(zip_glob)
         .select(F.element_at(F.split("path", "/"), -1).alias("filename"),
                 F.sha2("content", 256).alias("file_hash"), "length"))
    z = z.withColumn("dataset_name", F.regexp_replace("filename", r"(?<=.)\.[^.]*$", ""))
    if previous is None:
        return z.withColumn("already_extracted", F.lit(False))
    prev = previous.select("dataset_name", F.col("file_hash").alias("old_hash"),
                           "has_metadata", "has_gtfs_file")
    j = z.join(prev, "dataset_name", "left")
    same = F.col("old_hash").isNull() | (F.col("old_hash") == F.col("file_hash"))
    done = F.coalesce(F.col("has_metadata") & F.col("has_gtfs_file") & same, F.lit(False))
    return j.select("filename", "dataset_name", "file_hash", "length",
                    done.alias("already_extracted"))


def changed_archives(spark: SparkSession, zip_glob: str, state: str) -> DataFrame:
    """S12 → S7: (dataset_name, file_hash, changed) of the landed archives whose hash is
    not the one kept under ``state`` (file_hash by ``part_dataset``); ``changed`` if
    another hash is kept, so that the feed's output is out of date."""
    landed = archive_manifest(spark, zip_glob).select("dataset_name", "file_hash")
    try:
        known = spark.read.schema("file_hash string, part_dataset string").parquet(state)
    except AnalysisException:
        return landed.withColumn("changed", F.lit(False))
    known = known.select(F.col("part_dataset").alias("dataset_name"), F.col("file_hash").alias("old"))
    return (landed.join(known, "dataset_name", "left").where("old IS NULL OR old <> file_hash")
            .select("dataset_name", "file_hash", F.col("old").isNotNull().alias("changed")))


def unpack_archives(spark: SparkSession, zip_glob: str, extract_root: str) -> DataFrame:
    """Unzip every archive into ``<extract_root>/<dataset_name>/``.

    One archive per task (``mapInPandas`` over the binary files; the only
    Python in the pipeline: there is no native unzip). ``extract_root`` must be
    storage every executor can write (a shared mount). Returns one row per
    archive with its member count and whether it holds a core GTFS file."""
    files = spark.read.format("binaryFile").load(zip_glob).select("path", "content")

    def unzip(batches):
        import pandas as pd
        for pdf in batches:
            out = []
            for path, content in zip(pdf["path"], pdf["content"]):
                name = os.path.splitext(path.rsplit("/", 1)[-1])[0]
                target = os.path.join(extract_root, name)
                members, ok = 0, False
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as zf:
                        os.makedirs(target, exist_ok=True)
                        zf.extractall(target)
                        names = zf.namelist()
                    members = len(names)
                    ok = any(os.path.exists(os.path.join(target, f)) for f in CORE_FILES)
                except zipfile.BadZipFile:
                    pass
                out.append((name, members, ok))
            yield pd.DataFrame(out, columns=["dataset_name", "members", "valid"])

    return files.mapInPandas(unzip, "dataset_name string, members int, valid boolean")
