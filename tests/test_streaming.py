"""Incremental loads: two landed summary drops, one stream run each."""

import pytest

from ferrolake.plans.pipeline import Pipeline
from ferrolake.operators.warehouse import load_warehouse
from ferrolake.plans.store import latest_warehouse, load_summary, loads
from ferrolake.streaming.summary_stream import run_incremental_load, upsert_batch


def test_incremental_upsert(spark, tmp_path):
    summary = Pipeline(spark, "/root/testdata/sf0.001").summary.cache()
    land, wh_root, ckpt = tmp_path / "land", str(tmp_path / "wh"), str(tmp_path / "ckpt")
    summary.where("dataset_id = 'ds0'").write.parquet(str(land / "day1"))
    run_incremental_load(spark, str(land), wh_root, ckpt, buckets=4)
    first = latest_warehouse(spark, wh_root)
    n0 = summary.where("dataset_id = 'ds0'").count()
    loaded = first.fact.count()  # the table is live: counted before the next load
    assert 0 < loaded <= n0

    # Second drop: ds1 new, ds0 re-sent (must overwrite, not duplicate).
    summary.where("dataset_id IN ('ds0', 'ds1')").write.parquet(str(land / "day2"))
    run_incremental_load(spark, str(land), wh_root, ckpt, buckets=4)
    second = latest_warehouse(spark, wh_root)
    f = second.fact
    assert f.groupBy("trip_id", "dataset_id").count().where("count > 1").count() == 0
    assert f.where("dataset_id = 'ds0'").count() == loaded
    assert f.select("last_load_id").distinct().count() == 1  # every row touched by batch 2
    assert f.where("dataset_id = 'ds1'").count() > 0


def files(root):
    return {str(p.relative_to(root)): p.stat().st_mtime_ns for p in root.rglob("*.parquet")}


def test_batch_batch_stream_replay(spark, tmp_path):
    """One sequence of loads; untouched feeds keep their files; a replay adds nothing."""
    summary = Pipeline(spark, "/root/testdata/sf0.001").summary.cache()
    part = lambda d: summary.where(f"dataset_id = '{d}'")
    land, root = tmp_path / "land", tmp_path / "wh"
    load_summary(spark, part("ds0"), str(root), buckets=4)
    load_summary(spark, part("ds1"), str(root))
    before = files(root)
    part("ds2").write.parquet(str(land / "day1"))
    run_incremental_load(spark, str(land), str(root), str(tmp_path / "ckpt"))
    assert loads(spark, str(root)) == [1, 2, 3]
    assert {k: v for k, v in files(root).items() if k in before} == before
    new = [k for k in set(files(root)) - set(before) if k.startswith("fact/")]
    assert new and all("dataset_id=ds2" in k for k in new)
    wh = latest_warehouse(spark, str(root))
    assert wh.fact.groupBy("trip_id", "dataset_id").count().where("count > 1").count() == 0
    got = {r["dataset_id"]: r["count"] for r in wh.fact.groupBy("dataset_id").count().collect()}
    want = {d: load_warehouse(part(d), 1).fact.count() for d in ("ds0", "ds1", "ds2")}
    assert got == want
    # The same batch of the same stream again (as after a failure).
    sc = spark.sparkContext
    handle = upsert_batch(str(root))
    sc.setLocalProperty("sql.streaming.queryId", "q")
    handle(part("ds2"), 0)
    handle(part("ds2"), 0)
    sc.setLocalProperty("sql.streaming.queryId", None)
    assert loads(spark, str(root)) == [1, 2, 3, 4]
    assert latest_warehouse(spark, str(root)).fact.count() == sum(want.values())


def test_a_checkpoint_location_is_required(spark, tmp_path):
    with pytest.raises((TypeError, ValueError)):
        run_incremental_load(spark, str(tmp_path), str(tmp_path / "wh"))
    with pytest.raises(ValueError):
        run_incremental_load(spark, str(tmp_path), str(tmp_path / "wh"), "")
