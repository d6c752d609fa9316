"""Search predicates (P13), newest fact per trip (W3) and report shapes."""

import pytest
from pyspark.sql import functions as F

from ferrolake.operators import reports as R
from ferrolake.plans.pipeline import Pipeline


@pytest.fixture(scope="module")
def wh(spark):
    return Pipeline(spark, "/root/testdata/sf0.001").warehouse


def ids(df):
    return {(r["trip_id"], r["dataset_id"]) for r in df.select("trip_id", "dataset_id").collect()}


def test_search_is_case_and_accent_insensitive(wh):
    a = R.search_trips(wh, limit=1000, origin="zurich")
    b = R.search_trips(wh, limit=1000, origin="ZÜRICH")
    assert ids(a) == ids(b) and len(ids(a)) > 0
    assert all(r["origin"].split(" ")[0] in ("Zürich", "ZURICH") for r in a.collect())


def test_search_wildcards_are_literal(wh):
    assert R.search_trips(wh, limit=1000, origin="%").count() == 0
    assert R.search_trips(wh, limit=1000, destination="_").count() == 0


def test_search_filters_combine(wh):
    rows = R.search_trips(wh, limit=1000, train_type="Régional", min_distance=100.0,
                          max_distance=300.0).collect()
    low = R.search_trips(wh, limit=1000, train_type="REGIONAL", min_distance=100.0, max_distance=300.0)
    assert ids(low) == {(r["trip_id"], r["dataset_id"]) for r in rows}
    assert rows and all(r["train_type"] == "Régional" and 100 <= r["distance_km"] <= 300 for r in rows)
    top = R.search_trips(wh, limit=5).collect()
    assert len(top) == 5
    assert [r["distance_km"] for r in top] == sorted((r["distance_km"] for r in top), reverse=True)


def test_latest_per_trip_keeps_newest(spark):
    df = spark.createDataFrame(
        [("t1", "a", 1, "2025-01-01 00:00:00"), ("t1", "b", 2, "2025-01-02 00:00:00"),
         ("t2", "a", 3, "2025-01-01 00:00:00")],
        "trip_id string, dataset_id string, fact_sk long, last_loaded_at string")
    df = df.withColumn("last_loaded_at", F.col("last_loaded_at").cast("timestamp_ntz"))
    got = {r["trip_id"]: r["dataset_id"] for r in R.latest_per_trip(df).collect()}
    assert got == {"t1": "b", "t2": "a"}


def test_report_totals_agree(wh):
    ov = R.overview(wh).first()
    by_type = R.by_train_type(wh).collect()
    assert sum(r["trip_count"] for r in by_type) >= ov["total_trips"]
    # A trip id of several feeds may run by day in one and by night in another.
    assert sum(r["trip_count"] for r in R.by_service_type(wh).collect()) >= ov["total_trips"]
    assert R.fact_count(wh).first()["count"] == wh.fact.count()


def test_limits_are_bounded(wh):
    for report, most in ((R.by_agency, 100), (R.emissions_by_route, 100), (R.search_trips, 1000)):
        for limit in (0, most + 1):
            with pytest.raises(ValueError):
                report(wh, limit=limit)


def test_latest_per_trip_drops_other_feeds(wh):
    assert R.latest_per_trip(wh.fact).count() < wh.fact.count()


def test_distance_bounds_keep_the_same_rows(spark):
    df = spark.createDataFrame([("1.000",), ("1.001",), ("1.002",)], "d string") \
        .selectExpr("CAST(d AS DECIMAL(10,3)) AS distance_km")
    assert df.where(R.search_predicate(min_distance=1.0004)).count() == 2
    assert df.where(R.search_predicate(max_distance=1.0016)).count() == 2
    assert df.where(R.search_predicate(min_distance=1.001, max_distance=1.001)).count() == 1
