"""Trip-level operators on hand-made feeds, and invariants on the driver data."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from ferrolake.operators.stop_times import feed_shape_flags, shape_flags, trip_distances, trip_facts
from ferrolake.operators.trips import trips_summary
from ferrolake.operators.warehouse import load_warehouse
from ferrolake.plans.pipeline import Pipeline
from ferrolake.sources.driver_views import Feed

ST = ("dataset_id string, trip_id string, stop_id string, stop_sequence string, "
      "arrival_time string, departure_time string, shape_dist_traveled string, file_row long")
STOPS = "stop_id string, stop_name string, stop_lat string, stop_lon string"


def facts(spark, rows, stops=()):
    st = spark.createDataFrame(rows, ST)
    s = spark.createDataFrame(list(stops), STOPS)
    f = trip_facts(st, s)
    return {r["trip_id"]: r.asDict() for r in trip_distances(f, shape_flags(f)).collect()}


def test_duration_direct(spark):
    f = facts(spark, [("d", "t1", "A", "1", None, "09:50:00", None, 1),
                      ("d", "t1", "B", "2", "11:00:00", None, None, 2),
                      ("d", "t2", "A", "1", None, "11:55", None, 3),
                      ("d", "t2", "B", "2", "13:00", None, None, 4)])
    assert f["t1"]["duration_min"] == 70.0 and f["t2"]["duration_min"] == 65.0


def test_duration_negative_uses_span(spark):
    f = facts(spark, [("d", "t", "A", "1", "08:00", "09:00", None, 1),
                      ("d", "t", "B", "2", "07:00", "10:00", None, 2)])
    # last arrival 07:00 − first departure 09:00 < 0 → span of all times: 10:00 − 07:00
    assert f["t"]["duration_min"] == 180.0


def test_duration_one_value_is_zero(spark):
    f = facts(spark, [("d", "t", "A", "1", None, "09:00", None, 1)])
    assert f["t"]["duration_min"] == 0.0


def test_shape_km_and_metres(spark):
    f = facts(spark, [("d", "k", "A", "1", None, None, "0", 1), ("d", "k", "B", "2", None, None, "10", 2),
                      ("d", "m", "A", "1", None, None, "0", 3), ("d", "m", "B", "2", None, None, "2000", 4)])
    assert f["k"]["distance_km"] == 10.0 and f["m"]["distance_km"] == 2.0


def test_shape_regression_dropped(spark):
    # 0, 50, 30 (dropped: below 50), 40 (kept: its previous original row is 30)
    f = facts(spark, [("d", "t", "A", "1", None, None, "0", 1), ("d", "t", "B", "2", None, None, "50", 2),
                      ("d", "t", "C", "3", None, None, "30", 3), ("d", "t", "D", "4", None, None, "40", 4)])
    assert f["t"]["distance_km"] == 50.0


def test_geo_distance_and_single_stop(spark):
    stops = [("P", "Paris", "48.8566", "2.3522"), ("L", "Lyon", "45.7640", "4.8357")]
    f = facts(spark, [("d", "two", "P", "1", None, "08:00", None, 1),
                      ("d", "two", "L", "2", "10:00", None, None, 2),
                      ("d", "one", "P", "1", None, "08:00", None, 3)], stops)
    assert 390 <= f["two"]["distance_km"] <= 400
    assert f["one"]["distance_km"] == 0.0


def test_first_last_skip_nulls_per_column(spark):
    f = facts(spark, [("d", "t", "A", "1", None, None, None, 1),
                      ("d", "t", "B", "2", "08:10", "08:12", None, 2),
                      ("d", "t", "C", "x", None, "07:00", None, 0)])  # 'x' → sequence 0: first
    r = f["t"]
    assert r["origin_stop_id"] == "C" and r["destination_stop_id"] == "B"
    assert r["departure_time"] == "07:00" and r["arrival_time"] == "08:10"


def mini_feed(spark, days="11111", count=5, extra_trip_without_times=True):
    flags = list(days.ljust(7, "0"))
    stops = spark.createDataFrame([("S1", "Paris Gare de Lyon", "48.84", "2.37"),
                                   ("S2", "Lyon Part Dieu", "45.76", "4.86")], STOPS)
    agency = spark.createDataFrame([("A1", "SNCF")], "agency_id string, agency_name string")
    routes = spark.createDataFrame([("R1", "A1", "TGV", "Paris - Lyon", "101")],
                                   "route_id string, agency_id string, route_short_name string, "
                                   "route_long_name string, route_type string")
    cal = spark.createDataFrame([("WK", *flags, 0)],
                                "service_id string, monday string, tuesday string, wednesday string, "
                                "thursday string, friday string, saturday string, sunday string, "
                                "file_row long")
    trips = [("d", f"T{i}", "R1", "WK", i) for i in range(count)]
    if extra_trip_without_times:
        trips.append(("d", "NOSTOP", "R1", "WK", 99))
    trips = spark.createDataFrame(trips, "dataset_id string, trip_id string, route_id string, "
                                         "service_id string, file_row long")
    st = spark.createDataFrame(
        [r for i in range(count) for r in
         [("d", f"T{i}", "S1", "1", None, f"0{6 + i}:00:00", None, 2 * i),
          ("d", f"T{i}", "S2", "2", f"0{8 + i}:00:00", None, None, 2 * i + 1)]], ST)
    return Feed(stops, agency, routes, cal, trips, st)


def test_feed_flags_from_stop_times(spark):
    """The flags read from stop_times are those of the per-trip facts: a fall, text that
    is no number, a blank trip id and a feed without shapes included."""
    rows = [("a", "1", "S1", "1", "5", 1), ("a", "1", "S2", "2", "3", 2), ("b", "1", "S1", "1", "x", 1),
            ("b", " ", "S1", "1", "7", 2), ("c", "2", "S1", "1", None, 1)]
    st = spark.createDataFrame(rows, "dataset_id string, trip_id string, stop_id string, stop_sequence string, "
                                     "shape_dist_traveled string, file_row long")
    st = st.withColumns({"departure_time": F.lit("10:00:00"), "arrival_time": F.lit("10:00:00")})
    stops = spark.createDataFrame([("S1", "A", "48", "2", 1), ("S2", "B", "47", "2", 2)], STOPS + ", file_row long")
    read = {r["dataset_id"]: r["feed_has_shape"] for r in feed_shape_flags(st).collect()}
    assert read == {"a": True, "b": False, "c": False}
    assert read == {r["dataset_id"]: r["feed_has_shape"] for r in shape_flags(trip_facts(st, stops)).collect()}


def test_mini_trip_frequency_and_summary(spark):
    s = trips_summary(mini_feed(spark)).collect()
    assert len(s) == 5  # the trip without stop_times vanishes
    r = sorted(s, key=lambda x: x["trip_id"])[0]
    assert r["frequency_per_week"] == 25  # 5 weekdays × 5 departures of the pattern
    assert r["train_type"] == "Grande vitesse" and r["traction"] == "électrique"
    assert r["origin_country"] == "FR" and r["destination_country"] == "FR"
    assert r["duration_h"] == 2.0 and r["service_type"] == "JOUR"
    assert r["route_name"] == "TGV" and r["emission_gco2e_pkm"] == 3.2


@pytest.fixture(scope="module")
def small(spark):
    return Pipeline(spark, "/root/testdata/sf0.001")


def test_summary_invariants(small):
    s = small.summary
    assert s.where("distance_km < 0 OR duration_h <= 0").count() == 0
    assert s.groupBy("dataset_id", "trip_id").count().where("count > 1").count() == 0
    assert s.where("origin_stop_name = destination_stop_name").count() == 0


def test_fact_unique_and_reload_idempotent(small):
    wh = small.warehouse
    f = wh.fact
    assert f.groupBy("trip_id", "dataset_id").count().where("count > 1").count() == 0
    again = load_warehouse(small.summary, 2, "2025-01-02 00:00:00", existing=wh)
    cols = [c for c in f.columns if c not in ("last_load_id", "last_loaded_at")]
    assert again.fact.select(cols).exceptAll(f.select(cols)).count() == 0
    assert f.select(cols).exceptAll(again.fact.select(cols)).count() == 0
    assert again.fact.where("last_load_id = 2").count() == f.count()


def test_first_load_collapses_repeats(small):
    """A day and its re-send in one load: one fact per (trip, feed)."""
    twice = load_warehouse(small.summary.unionAll(small.summary), 1)
    assert twice.fact.count() == small.warehouse.fact.count()
    twice.release()


def test_repeated_stop_does_not_multiply_trips(spark):
    feed = mini_feed(spark, count=2, extra_trip_without_times=False)
    stops = feed.stops.withColumn("file_row", F.monotonically_increasing_id())
    again = spark.createDataFrame([("S1", "Other name", "0", "0", 10 ** 12)], STOPS + ", file_row long")
    s = trips_summary(replace(feed, stops=stops.unionByName(again))).collect()
    assert len(s) == 2 and {r["origin_stop_name"] for r in s} == {"Paris Gare de Lyon"}


def test_surrogate_keys_unique(small):
    from ferrolake.operators.warehouse import DIM_KEYS
    for name, (key, nat) in DIM_KEYS.items():
        d = small.warehouse.dims[name]
        assert d.select(key).distinct().count() == d.select(*nat).distinct().count(), name


def test_materialize_cuts_lineage(spark, small):
    from ferrolake.operators.warehouse import materialize
    wh = small.warehouse
    m = materialize(wh)
    assert spark.conf.get("spark.checkpoint.dir")  # reliable checkpoints, shared folder
    assert m.fact.count() == wh.fact.count()
    assert m.dims["dim_route"].count() == wh.dims["dim_route"].count()
