"""Ingestion jobs on small files written by the tests themselves."""

import io
import json
import zipfile

from pyspark.sql import functions as F

from ferrolake.operators.trips import trips_summary
from ferrolake.plans.run_summary import run_summary
from ferrolake.sources.catalog import (archive_manifest, catalog_dedup, catalog_latest,
                                       unpack_archives, url_dataset_name)
from ferrolake.sources.gtfs import latest_versions, read_feeds, read_gtfs_file, skip_existing

FEED = {
    "agency.txt": "agency_id,agency_name\nA1,SNCF\n",
    "routes.txt": "route_id,agency_id,route_short_name,route_long_name,route_type\nR1,A1,,Paris - Lyon,2\n",
    "stops.txt": " stop_id , stop_name,stop_lat,stop_lon,extra\nS1,Paris,48.84,2.37,x\nS2,Lyon,45.76,4.86,y\n",
    "trips.txt": "route_id,service_id,trip_id\nR1,WK,T1\nR1,WK,T2\n",
    "calendar.txt": "service_id,monday,tuesday,wednesday,thursday,friday,saturday,sunday\nWK,1,1,1,1,1,0,0\n",
    "stop_times.txt": ("trip_id,arrival_time,departure_time,stop_id,stop_sequence\n"
                       "T1,,08:00:00,S1,1\nT1,10:00:00,,S2,2\nT2,,09:00:00,S1,1\nT2,11:30:00,,S2,2\n"),
}


def write_feed(folder, files=FEED):
    folder.mkdir(parents=True, exist_ok=True)
    for name, text in files.items():
        (folder / name).write_text(text, encoding="utf-8")


def test_scan_trims_header_and_fills_missing(spark, tmp_path):
    write_feed(tmp_path / "feedA")
    st = read_gtfs_file(spark, str(tmp_path), "stops").orderBy("stop_id").collect()
    assert [r["stop_id"] for r in st] == ["S1", "S2"] and st[0]["dataset_id"] == "feedA"
    times = read_gtfs_file(spark, str(tmp_path), "stop_times")
    assert "shape_dist_traveled" in times.columns
    assert times.where(F.col("shape_dist_traveled").isNotNull()).count() == 0
    empty = read_gtfs_file(spark, str(tmp_path / "nothing"), "stops")
    assert empty.count() == 0


def test_latest_version_and_metadata(spark, tmp_path):
    write_feed(tmp_path / "feedA" / "2024-01-01")
    write_feed(tmp_path / "feedA" / "2025-06-01")
    (tmp_path / "feedA" / "2025-06-01" / "metadata.json").write_text(json.dumps({"dataset_id": "42"}))
    write_feed(tmp_path / "feedB")  # no version folder: the folder itself
    (tmp_path / "junk").mkdir()
    (tmp_path / "junk" / "readme.txt").write_text("nothing here")
    v = {r["dataset_id"]: r["version"] for r in latest_versions(spark, str(tmp_path)).collect()}
    assert v == {"feedA": "2025-06-01", "feedB": ""}
    feed = read_feeds(spark, str(tmp_path))
    ids = {r["dataset_id"] for r in feed.trips.select("dataset_id").distinct().collect()}
    assert ids == {"42", "feedB"}
    assert feed.trips.count() == 4  # two trips per feed, old version ignored
    s = trips_summary(feed).collect()
    assert len(s) == 4 and {r["frequency_per_week"] for r in s} == {10}
    assert {r["route_name"] for r in s} == {"Paris - Lyon"}


def test_each_file_is_read_by_its_own_header(spark, tmp_path):
    """Three column orders, an extra column, doubled quotes, two versions."""
    stops = {"a/2024": "stop_id,stop_name,stop_lat,stop_lon\nOLD,Old,1,1\n",
             "a/2025": "stop_id,stop_name,stop_lat,stop_lon\nA1,\"Gare \"\"du\"\" Nord\",48.8,2.3\n",
             "b": "stop_name, stop_lat ,stop_lon,stop_id\nBerlin,52.5,13.4,B1\n",
             "c": "stop_id,stop_code,stop_name,stop_lat,stop_lon\nC1,X1,\"Lyon, Part Dieu\",45.7,4.8\n"}
    for folder, text in stops.items():
        write_feed(tmp_path / folder, {**FEED, "stops.txt": text})
    feed = read_feeds(spark, str(tmp_path))
    got = sorted((r["dataset_id"], r["stop_id"], r["stop_name"], r["stop_lat"], r["stop_lon"])
                 for r in feed.stops.collect())
    assert got == [("a", "A1", 'Gare "du" Nord', "48.8", "2.3"), ("b", "B1", "Berlin", "52.5", "13.4"),
                   ("c", "C1", "Lyon, Part Dieu", "45.7", "4.8")]
    paths = feed.stops.inputFiles() + feed.trips.inputFiles()
    assert len(paths) == 6 and not any("2024" in p for p in paths)
    left = read_feeds(spark, str(tmp_path), skip={"a", "c"})
    assert all("/b/" in p for p in left.stops.inputFiles()) and left.trips.count() == 2


def test_skip_existing(spark):
    feeds = spark.createDataFrame([("a",), ("b",), ("c",)], "dataset_id string")
    done = spark.createDataFrame([("b",)], "dataset_id string")
    assert sorted(r[0] for r in skip_existing(feeds, done).collect()) == ["a", "c"]


def test_catalog_first_gtfs_in_first_five(spark):
    def item(fmt, url="u", fn="f.zip", created=None):
        return {"created_at": "item-date", "updated_at": "item-upd",
                "payload": {"format": fmt, "permanent_url": url, "filename": fn,
                            "dataset_id": "d1", "created_at": created, "updated_at": None}}
    rows = [("src1", [item("NeTEx")] * 5 + [item("GTFS", url="late")]),
            ("src2", [item("NeTEx"), item("GTFS", url="", fn="x.zip"), item("GTFS", url="ok", created="p-date")]),
            ("src3", [])]
    schema = ("source_url string, history array<struct<created_at:string, updated_at:string, "
              "payload:struct<format:string, permanent_url:string, filename:string, dataset_id:string, "
              "created_at:string, updated_at:string>>>")
    got = {r["source_url"]: r.asDict() for r in catalog_latest(spark.createDataFrame(rows, schema)).collect()}
    assert set(got) == {"src2"}
    assert got["src2"]["url"] == "ok" and got["src2"]["created_at"] == "p-date"
    assert got["src2"]["updated_at"] == "item-upd"


def test_catalog_dedup_last_wins(spark):
    df = spark.createDataFrame([(0, " a ", "u1", "f1"), (1, "", "u2", "f2"), (2, "b", "u1", "f3")],
                               "pos int, source_url string, url string, filename string")
    got = {r["url"]: r["filename"] for r in catalog_dedup(df).collect()}
    assert got == {"u1": "f3"}


def test_url_dataset_name(spark):
    df = spark.createDataFrame([("https://x.org/data/feed.zip?x=1",), ("https://x.org/data/feed",),
                                ("https://x.org/",), ("https://x.org/a/b.tar.ZIP",),
                                ("https://x.org/a/feeds/",), ("not a url",)], "u string")
    fn, stem = url_dataset_name(F.col("u"))
    got = [tuple(r) for r in df.select(fn, stem).collect()]
    assert got == [("feed.zip", "feed"), ("feed.zip", "feed"), ("dataset.zip", "dataset"),
                   ("b.tar.ZIP", "b.tar"), ("feeds.zip", "feeds"), ("dataset.zip", "dataset")]


def _zip(files):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        for n, t in files.items():
            zf.writestr(n, t)
    return buf.getvalue()


def test_archives_manifest_and_unpack(spark, tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    (land / "good.zip").write_bytes(_zip(FEED))
    (land / "bad.zip").write_bytes(_zip({"readme.md": "x"}))
    m = {r["dataset_name"]: r.asDict() for r in archive_manifest(spark, str(land / "*.zip")).collect()}
    assert len(m["good"]["file_hash"]) == 64 and m["good"]["already_extracted"] is False
    prev = spark.createDataFrame([("good", m["good"]["file_hash"], True, True), ("bad", "old", True, True)],
                                 "dataset_name string, file_hash string, has_metadata boolean, "
                                 "has_gtfs_file boolean")
    m2 = {r["dataset_name"]: r["already_extracted"]
          for r in archive_manifest(spark, str(land / "*.zip"), prev).collect()}
    assert m2 == {"good": True, "bad": False}
    out = tmp_path / "extract"
    u = {r["dataset_name"]: r["valid"] for r in unpack_archives(spark, str(land / "*.zip"), str(out)).collect()}
    assert u == {"good": True, "bad": False}
    assert read_gtfs_file(spark, str(out), "trips").count() == 2


def test_run_summary(spark):
    stages = spark.createDataFrame(
        [("extract", 1.5, True, 3, None, None), ("transform", 2.0, True, None, 2, None),
         ("load", 4.0, False, None, None, 100)],
        "stage string, duration_seconds double, success boolean, downloaded int, "
        "files_generated int, rows_loaded int")
    r = run_summary(stages).first()
    two = stages.selectExpr("*", "stage = 'load' AS run_id")
    assert {x["run_id"]: x["success"] for x in run_summary(two).collect()} == {True: False, False: True}
    assert r["total_duration_seconds"] == 7.5 and r["success"] is False and r["rows_loaded"] == 100
