"""Spark session settings for the timetable jobs.

Everything here is plain Spark configuration. On a cluster the session comes
from the platform; ``get_spark`` only fills in what is unset so tests and the
benchmark get a sane local session.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings a 1000-executor run wants as much as local[8]: adaptive execution
# re-plans joins from real shuffle sizes (runtime broadcast, skew splitting,
# partition coalescing), so no join needs a hand-made size guess.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Static broadcast only for sides Catalyst *estimates* under 32 MB; AQE
    # re-checks the measured shuffle size before turning a join into a
    # broadcast, so a wrong estimate falls back to a sort-merge join.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
}


def get_spark(app: str = "ferrolake", cores: int | str = "*", shuffle_partitions: int = 8,
              extra: dict | None = None) -> SparkSession:
    """Local session for tests and the benchmark (the cluster provides its own).

    Only here, where driver and executors are one process, a scratch folder
    stands in for an unset ``spark.checkpoint.dir``."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for k, v in {**SCALE_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="ferrolake-ckpt-"))
    ensure_checkpoint_dir(spark)
    return spark


def job_session(app: str = "ferrolake") -> SparkSession:
    """The platform's session with ``SCALE_CONF`` for whatever it leaves unset."""
    spark = SparkSession.builder.appName(app).getOrCreate()
    given = dict(spark.sparkContext.getConf().getAll())
    for k, v in SCALE_CONF.items():
        if k not in given:
            spark.conf.set(k, v)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``; an error if
    it is unset, since a folder of the driver's own would not survive it."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        raise ValueError("spark.checkpoint.dir must name a folder on shared storage")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d
