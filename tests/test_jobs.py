"""Batch jobs end to end on landed feed files."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F
from test_sources import FEED, write_feed

from ferrolake.operators.warehouse import build_fact, known_countries, stage_rows
from ferrolake.plans import jobs, store
from ferrolake.plans.pipeline import Pipeline
from ferrolake.plans.run_log import read_runs
from ferrolake.plans.run_summary import run_summary
from ferrolake.sources.countries import country_seed

SF = "/root/testdata/sf0.001"


def test_transform_load_report(spark, tmp_path):
    feeds, summary, wh = tmp_path / "feeds", str(tmp_path / "summary"), str(tmp_path / "wh")
    write_feed(feeds / "feedA")
    jobs.transform(spark, str(feeds), summary)
    assert spark.read.parquet(summary).count() == 2

    # A second feed lands; the first is skipped, its partition stays.
    write_feed(feeds / "feedB")
    jobs.transform(spark, str(feeds), summary)
    s = spark.read.parquet(summary)
    assert s.count() == 4 and s.select("source_dataset").distinct().count() == 2
    assert [(r.files_generated, r.rows_loaded) for r in
            read_runs(spark, jobs.transform_runs(summary)).orderBy("finished_at").collect()] == [(1, 2), (1, 2)]

    assert jobs.load(spark, summary, wh, buckets=4) == 1
    by_type = {r["train_type"]: r["trip_count"]
               for r in jobs.report(spark, wh, "by_train_type").collect()}
    # Trip ids are keyed across feeds (as in the source's trip dimension): both
    # feeds hold T1 and T2, so 2 distinct trips over 4 facts.
    assert by_type == {"Rail": 2}
    assert jobs.report(spark, wh, "fact_count").first()["count"] == 4
    # Reloading the same summary is an upsert: same facts, newer load id.
    assert jobs.load(spark, summary, wh) == 2
    f = jobs.report(spark, wh, "load_counts").collect()
    assert [(r["load_id"], r["fact_rows"]) for r in f] == [(2, 4)]


def _archive(path, text):
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("trips.txt", text)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data.getvalue())


def test_a_changed_archive_reprocesses_its_feed_only(spark, tmp_path):
    feeds, summary, zips = tmp_path / "feeds", str(tmp_path / "summary"), tmp_path / "zips"
    run = lambda: jobs.transform(spark, str(feeds), summary, archives=str(zips / "*.zip"))
    for f in ("feedA", "feedB"):
        write_feed(feeds / f)
        _archive(zips / f"{f}.zip", f)
    run()
    run()  # nothing new
    before = {str(p) for p in (tmp_path / "summary").rglob("*.parquet")}
    stop_times = FEED["stop_times.txt"]
    write_feed(feeds / "feedB", {**FEED, "stop_times.txt": stop_times + "T3,S1,1,08:00:00,08:00:00\n"})
    _archive(zips / "feedB.zip", "other bytes")
    run()
    after = {str(p) for p in (tmp_path / "summary").rglob("*.parquet")}
    assert {p for p in before - after} and all("feedB" in p for p in before ^ after)
    loaded = [r.files_generated for r in read_runs(spark, jobs.transform_runs(summary))
              .orderBy("finished_at").collect()]
    assert loaded == [2, 0, 1]
    run()
    assert {str(p) for p in (tmp_path / "summary").rglob("*.parquet")} == after


def test_rejects_report_and_runs_are_left_behind(spark, tmp_path):
    summary = Pipeline(spark, SF).summary.where("dataset_id = 'ds0'")
    bad = summary.limit(3).withColumns({"agency_name": F.lit("ERROR"), "trip_id": F.concat(F.lit("bad"), "trip_id")})
    root = str(tmp_path / "wh")
    store.load_summary(spark, summary.unionAll(bad), root, buckets=4)
    n = stage_rows(summary).count()
    rejected = store.rejected_rows(spark, root)
    assert rejected.where("reject_reason = 'Missing or invalid agency_name' AND trip_id LIKE 'bad%'").count() == 3
    total = summary.count() + 3
    assert rejected.count() == total - n and store.staging_rows(spark, root, 1).count() == n
    runs = read_runs(spark, store.runs_path(root))
    row = runs.first()
    assert (row.load_id, row.rows_loaded, row.rows_rejected, row.success) == (1, n, total - n, True)
    out = run_summary(runs).first()
    assert out.rows_loaded == n and out.success and out.total_duration_seconds > 0
    # The same rows as the in-memory load's, column for column.
    got = store.staging_rows(spark, root, 1).drop("loaded_at")
    want = stage_rows(summary).drop("loaded_at")
    assert got.select(*want.columns).exceptAll(want).count() == 0
    # A stage that fails is recorded as such, and its number is used again.
    with pytest.raises(Exception):
        store.load_summary(spark, summary.drop("trip_id"), root)
    assert [r.success for r in read_runs(spark, store.runs_path(root)).orderBy("finished_at").collect()] == [True, False]
    assert store.loads(spark, root) == [1]
    assert store.load_summary(spark, summary, root) == 2


def test_a_stored_upsert_moves_no_stored_row(spark, tmp_path):
    """The stored side of the key comparison has no exchange; only its feeds are read."""
    summary = Pipeline(spark, SF).summary.cache()
    root = str(tmp_path / "wh")
    store.load_summary(spark, summary, root, buckets=4)
    files = lambda: {str(p): p.stat().st_mtime_ns for p in (tmp_path / "wh" / "fact").rglob("*.parquet")}
    before = files()
    some = summary.where("dataset_id = 'ds1'")
    incoming = build_fact(stage_rows(some, 2))
    stored = spark.table(store.fact_table(spark, root, incoming, 4)).where("dataset_id = 'ds1'")
    new = store.newest_per_key(incoming.repartition(4, "fact_sk"), ["fact_sk", *store.FACT_KEY], store.NEWEST)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = store.unchanged_facts(stored, new)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    side = plan[plan.index("LeftAnti"):plan.index("Bucketed: true")]
    assert "Exchange" not in side and "FileScan parquet" in side
    assert plan.count("Exchange hashpartitioning(fact_sk") == 1  # the incoming side
    store.load_summary(spark, some, root)
    after = files()
    assert {k: v for k, v in after.items() if "dataset_id=ds1" not in k} == \
        {k: v for k, v in before.items() if "dataset_id=ds1" not in k}
    wh = store.latest_warehouse(spark, root)
    assert wh.fact.groupBy("trip_id", "dataset_id").count().where("count > 1").count() == 0
    got = {r.dataset_id: (r.x, r.y) for r in wh.fact.groupBy("dataset_id").agg(
        F.min("last_load_id").alias("x"), F.max("last_load_id").alias("y")).collect()}
    assert got == {"ds0": (1, 1), "ds1": (2, 2), "ds2": (1, 1)}


def test_facts_that_a_load_does_not_bring_stay(spark, tmp_path):
    summary = Pipeline(spark, SF).summary.cache()
    root = str(tmp_path / "wh")
    store.load_summary(spark, summary, root, buckets=4)
    part = summary.where("dataset_id = 'ds1'")
    few = part.limit(5).withColumn("distance_km", F.lit(1.5))
    few = spark.createDataFrame(few.collect(), few.schema)
    store.load_summary(spark, few, root)
    f = store.latest_warehouse(spark, root).fact.where("dataset_id = 'ds1'")
    ids = {r.trip_id for r in f.where("last_load_id = 2").collect()}
    assert f.where("last_load_id = 2 AND distance_km <> 1.5").count() == 0 and len(ids) <= 5
    assert f.count() == build_fact(stage_rows(part)).select("trip_id").distinct().count()


def test_unknown_country_codes_are_null_on_locations(spark):
    staging = spark.createDataFrame([("FR", "XX"), (None, "DE"), ("ZZ", "FR")],
                                    "origin_country string, destination_country string")
    got = known_countries(staging, country_seed(spark)).collect()
    assert sorted(map(tuple, got), key=str) == sorted([("FR", None), (None, "DE"), (None, "FR")], key=str)
