"""Physical-plan checks: the shapes the design relies on at scale."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from ferrolake.operators.quality import reject_reason
from ferrolake.operators.reports import search_predicate
from ferrolake.operators.stop_times import shape_flags, trip_distances
from ferrolake.operators.trips import DAY_COLUMNS, first_per_trip
from ferrolake.plans.pipeline import Pipeline
from ferrolake.plans.queries import QUERIES, _two_loads
from ferrolake.session import SCALE_CONF

SF = "/root/testdata/sf0.001"


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_cartesian_or_nested_loop(spark, key):
    plan = formatted(QUERIES[key](spark, SF))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_trip_facts_one_exchange_on_trip_key(spark):
    plan = formatted(Pipeline(spark, SF)._facts)
    # stop_times is shuffled on the trip key only (a cached copy of the same
    # plan may be listed too: same partitioning, other plan id); the windows
    # and per-trip values reuse it, and no aggregate with struct buffers runs.
    keys = set(re.findall(r"hashpartitioning\(([^)]*)\)", plan))
    # The only other exchange is the small stops table's, one row per stop.
    assert len([k for k in keys if "trip_id" in k and "dataset_id" in k]) == 1
    assert all("trip_id" in k or "stop_id" in k for k in keys)
    assert "SortAggregate" not in plan


def test_scan_prunes_columns(spark):
    plan = formatted(QUERIES["trip_duration"](spark, SF))
    line = [x for x in plan.splitlines() if x.strip().startswith("ReadSchema") and "l_orderkey" in x][0]
    assert "l_extendedprice" not in line and "l_shipdate" not in line


def test_filter_pushed_to_parquet(spark, tmp_path):
    """The search's distance bounds reach the scan of a stored fact."""
    spark.sql("SELECT CAST(60 AS DECIMAL(10,3)) AS distance_km").write.parquet(str(tmp_path / "f"))
    near = spark.read.parquet(str(tmp_path / "f")).where(search_predicate(min_distance=50.0))
    assert "GreaterThanOrEqual(distance_km,50.000)" in formatted(near)
    assert near.count() == 1


@pytest.mark.parametrize("key", ["dim_country", "dim_time", "dim_location", "dim_route_latest"])
def test_dimensions_hash_aggregate(spark, key):
    assert "SortAggregate" not in formatted(QUERIES[key](spark, SF))


def test_no_fact_exchange_on_a_country(spark):
    """by_country shuffles (country, trip) partial rows, never the fact by its country key."""
    plan = formatted(QUERIES["by_country"](spark, SF))
    assert not re.search(r"hashpartitioning\(origin_country_sk", plan)
    assert "SortMergeJoin" not in plan.split("InMemoryTableScan")[0]


def test_overview_has_no_expand(spark):
    assert "Expand" not in formatted(QUERIES["overview"](spark, SF)).split("InMemoryTableScan")[0]


def test_facts_are_not_shuffled_by_feed(spark):
    """The flags (one row per feed) are the broadcast side however large the facts are."""
    facts = spark.range(4).selectExpr("CAST(id % 2 AS STRING) AS dataset_id", "CAST(id AS STRING) AS trip_id",
                                      "id > 2 AS has_shape", "1D AS shape_km", "2D AS geo_km")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = formatted(trip_distances(facts, shape_flags(facts)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", SCALE_CONF["spark.sql.autoBroadcastJoinThreshold"])
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_first_per_trip_sorts_once(spark):
    """No cut to the first row before the exchange, which would sort all rows twice."""
    rows = spark.range(9).selectExpr(
        "'a' AS dataset_id", "CAST(id % 3 AS STRING) AS trip_id", "id AS file_row", "0 AS cal_row",
        *[f"'1' AS {d}" for d in DAY_COLUMNS])
    first = first_per_trip(rows)
    assert "WindowGroupLimit" not in formatted(first)
    assert sorted(r["file_row"] for r in first.collect()) == [0, 1, 2]


def test_summary_join_carries_a_title_not_two_names(spark):
    plan = Pipeline(spark, SF).summary._jdf.queryExecution().optimizedPlan().toString()
    join = plan.split("Join LeftOuter")[-1]  # the pattern join lies lowest
    head = join.split("Window")[0]
    assert "named_title" in head and "active_days" in head


def test_reports_on_facts_keep_narrow_facts_only(spark):
    """Neither the staging rows nor the surrogate keys are copied for a report on facts."""
    p = Pipeline(spark, SF)
    (facts,) = p.fact_warehouse.kept
    assert not [c for c in facts.columns if c.endswith("_sk")]
    assert facts.is_cached and not p.fact_warehouse.staging.is_cached
    assert "xxhash64" not in formatted(QUERIES["top_countries"](spark, SF))
    p.release()


def test_search_facts_are_kept_without_keys(spark):
    p = Pipeline(spark, SF)
    assert not [c for t in p.warehouse.kept for c in t.columns if c.endswith("_sk")]
    p.release()


def test_upserted_dimension_keeps_no_staging(spark):
    wh = _two_loads(spark, SF)
    assert wh.kept == () and not wh.staging.is_cached


def test_upsert_fact_derives_the_sent_rows_once(spark):
    plan = QUERIES["upsert_fact"](spark, SF)._jdf.queryExecution().analyzed().toString()
    assert "explode(array(1, 2))" in plan


def test_double_distances_are_judged_without_text(spark):
    row = ["'t' AS trip_id", "'a' AS agency_name", "'r' AS route_name", "'o' AS origin_stop_name",
           "'d' AS destination_stop_name"]
    df = spark.sql("SELECT inline(array(struct(1, -1D), struct(2, 0D), struct(3, double('NaN')), struct(4, CAST(NULL AS DOUBLE)), "
                   "struct(5, double('-Infinity')), struct(6, -1e-9D))) AS (id, distance_km)").selectExpr("*", *row)
    text = df.withColumn("distance_km", F.col("distance_km").cast("string"))
    got = dict(df.select("id", reject_reason(df)).collect())
    assert got == dict(text.select("id", reject_reason(text)).collect())
    assert got[1] == "distance_km out of range: -1.0" and got[2] is None and got[3] == "distance_km not numeric"
    assert "RLIKE" not in formatted(df.select(reject_reason(df)))
