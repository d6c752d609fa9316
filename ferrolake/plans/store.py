"""Stored warehouse: Spark tables on shared storage, upserted per load.

    <root>/staging/load_id=<n>/accepted=<true|false>   P10/P11: every row of a load,
                                                       the rejected ones with reasons
    <root>/<dimension>/load=<n>                        dimension rows that load n brought
    <root>/fact/dataset_id=<feed>                      facts, bucketed by their key
    <root>/runs                                        one row per run and stage (A16)

Only Spark's own table features are used. The fact table is partitioned by feed
and bucketed by ``fact_sk``: a load compares its keys with the stored rows of its
feeds without moving those (their buckets are the partitioning of the join), and
dynamic partition overwrite replaces the folders of these feeds only. Staging and
dimensions are overwritten by load number, so a load that died is redone in place.
A load counts once its row stands in ``runs``; readers take the dimension rows of
finished loads, the newest per key.
"""

from __future__ import annotations

import hashlib
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.warehouse import (DIM_KEYS, FACT_KEY, Warehouse, build_dimensions, build_fact,
                                   key_of, newest_per_key, staged_or_rejected, upsert)
from ..session import ensure_checkpoint_dir
from .run_log import observed, read_runs, stage

#: Buckets of the fact table of a new warehouse (kept in ``runs`` from then on).
FACT_BUCKETS = 200
NEWEST = ["last_load_id", "last_loaded_at"]


def runs_path(root: str) -> str:
    return f"{root.rstrip('/')}/runs"


def finished_loads(spark: SparkSession, root: str) -> DataFrame:
    """(load_id, origin, buckets) of the loads that ended well."""
    return read_runs(spark, runs_path(root)).where("stage = 'load' AND success") \
        .select("load_id", "origin", "buckets")


def loads(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the finished loads under ``root``."""
    return sorted(r["load_id"] for r in finished_loads(spark, root).collect())


def _buckets(spark: SparkSession, root: str, default: int) -> int:
    first = finished_loads(spark, root).agg(F.min_by("buckets", "load_id")).first()[0]
    return default if first is None else first


def _overwrite(df: DataFrame, path: str, *by: str) -> None:
    """Replaces only the partitions that ``df`` holds."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*by).parquet(path))


@contextmanager
def _dynamic_overwrite(spark: SparkSession):
    """The session replaces only the partitions that a write brings."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def fact_table(spark: SparkSession, root: str, columns: DataFrame, buckets: int) -> str:
    """Name of the fact table under ``root`` in this session's catalog, declared and
    brought up to date with its folders; ``columns``: a frame with the facts' columns."""
    path = f"{root.rstrip('/')}/fact"
    name = "fact_" + hashlib.sha256(path.encode()).hexdigest()[:16]
    if not spark.catalog.tableExists(name):
        fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in columns.schema
                  if f.name != "dataset_id"]
        spark.sql(f"CREATE TABLE {name} ({', '.join(fields)}, dataset_id string) USING parquet "
                  f"PARTITIONED BY (dataset_id) CLUSTERED BY (fact_sk) INTO {buckets} BUCKETS "
                  f"LOCATION '{path}'")
    if loads(spark, root):  # the folder is there
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        spark.catalog.refreshTable(name)
    return name


def unchanged_facts(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Stored facts whose key ``new`` does not bring. Joined on ``fact_sk`` alone, the
    bucket key of the stored side; the natural key guards against equal hashes, as two
    bounds, since an equality would join the keys of the exchange."""
    keys = new.select("fact_sk", *[F.col(c).alias(f"new_{c}") for c in FACT_KEY])
    same = stored["fact_sk"] == keys["fact_sk"]
    for c in FACT_KEY:
        same = same & (stored[c] <= keys[f"new_{c}"]) & (stored[c] >= keys[f"new_{c}"])
    return stored.join(keys, same, "left_anti")


def store_facts(spark: SparkSession, root: str, incoming: DataFrame, feeds: list[str],
                buckets: int) -> None:
    """M2: newest incoming row per key over the stored facts of ``feeds``."""
    table = fact_table(spark, root, incoming, buckets)
    # One exchange, to the buckets of the table: the reduction to one row per key, the
    # comparison with the stored keys and the bucketed write all use it.
    new = newest_per_key(incoming.repartition(buckets, "fact_sk"), ["fact_sk", *FACT_KEY], NEWEST)
    stored = spark.table(table).where(F.col("dataset_id").isin(feeds))
    # Checkpointed (in the folder of ``spark.checkpoint.dir``), as the folders that these
    # rows come from are replaced.
    ensure_checkpoint_dir(spark)
    kept = unchanged_facts(stored, new).checkpoint()
    facts = new.select(*stored.columns).unionByName(kept.select(*stored.columns))
    # ``insertInto`` takes the mode from the session only.
    with _dynamic_overwrite(spark):
        facts.write.insertInto(table, overwrite=True)


def stored_dimension(spark: SparkSession, root: str, name: str, done: DataFrame) -> DataFrame:
    """M1 on read: the newest row per key of a dimension over the finished loads."""
    rows = spark.read.parquet(f"{root.rstrip('/')}/{name}")
    rows = rows.join(F.broadcast(done.select(F.col("load_id").alias("load"))), "load", "left_semi")
    return upsert(None, rows.drop("load"), [key_of(c) for c in DIM_KEYS[name][1]], ["load_id"])


def load_summary(spark: SparkSession, summary: DataFrame, root: str, origin: str = "batch",
                 buckets: int = FACT_BUCKETS) -> int:
    """Entry 2 as a stored load: summary rows → staging and rejects (one tagged write) →
    dimensions → facts; returns the load's number."""
    root = root.rstrip("/")
    done = loads(spark, root)
    load_id = done[-1] + 1 if done else 1
    buckets = _buckets(spark, root, buckets)
    with stage(spark, runs_path(root), f"load-{load_id}", "load") as seen:
        tagged, counts = observed(
            staged_or_rejected(summary, load_id, now(spark)),
            F.count_if("accepted").alias("accepted"), F.count_if(~F.col("accepted")).alias("rejected"))
        _overwrite(tagged, f"{root}/staging", "load_id", "accepted")
        seen.update(origin=origin, load_id=load_id, buckets=buckets,
                    rows_loaded=counts.get["accepted"], rows_rejected=counts.get["rejected"])
        staging = staging_rows(spark, root, load_id)
        dims = build_dimensions(staging, spark)
        for name in DIM_KEYS:
            _overwrite(dims[name].withColumn("load", F.lit(load_id)), f"{root}/{name}", "load")
        # The feeds of one load: a few thousand names at most, for partition pruning.
        feeds = [r[0] for r in staging.select("dataset_id").distinct().collect()]
        store_facts(spark, root, build_fact(staging), feeds, buckets)
    return load_id


def _staging(spark: SparkSession, root: str, load_id: int | None, accepted: bool) -> DataFrame:
    rows = spark.read.parquet(f"{root.rstrip('/')}/staging").where(F.col("accepted") == accepted)
    rows = rows if load_id is None else rows.where(F.col("load_id") == load_id)
    return rows.withColumn("load_id", F.col("load_id").cast("bigint")).drop("accepted")


def staging_rows(spark: SparkSession, root: str, load_id: int | None = None) -> DataFrame:
    """The accepted rows of a load (of all loads)."""
    return _staging(spark, root, load_id, True).drop("reject_reason", "distance_text")


def rejected_rows(spark: SparkSession, root: str, load_id: int | None = None) -> DataFrame:
    """P10's side table: the rejected rows of a load (of all loads) with their reason."""
    return _staging(spark, root, load_id, False)


def latest_warehouse(spark: SparkSession, root: str) -> Warehouse | None:
    """The stored warehouse as of its newest finished load; None before the first."""
    done = loads(spark, root)
    if not done:
        return None
    staging = staging_rows(spark, root, done[-1])
    finished = finished_loads(spark, root)
    dims = {n: stored_dimension(spark, root, n, finished) for n in DIM_KEYS}
    table = fact_table(spark, root, build_fact(staging), _buckets(spark, root, FACT_BUCKETS))
    return Warehouse(dims, spark.table(table), staging)


def now(spark: SparkSession) -> str:
    """The session's current timestamp as DATETIME text."""
    return spark.range(1).select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")).first()[0]
