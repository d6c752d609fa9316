"""Literal cases of the source's unit tests, restated on the Spark expressions."""

import pytest
from pyspark.sql import functions as F

from expressions import one
from ferrolake.functions import (active_days, agency_id_of, clean_country, country_of_name,
                                 country_of_point, day_night, emission_factor, haversine_km,
                                 is_valid_numeric, route_id_of, route_title, time_parts,
                                 time_to_seconds, traction, train_class, transport_type,
                                 weekly_frequency)


@pytest.mark.parametrize("text,expected", [
    ("12:34:56", 45296), ("01:02", 3720), ("23", 82800), ("", None), ("notatime", None),
    ("12:xx:00", None), (" 08:00:00 ", 28800), ("25:10:00", 90600), ("12.0", None),
])
def test_time_to_seconds(spark, text, expected):
    assert one(spark, time_to_seconds(F.col("t")), t=text) == expected


@pytest.mark.parametrize("text,expected", [
    ("23:00", "NUIT"), ("05:59", "NUIT"), ("06:00", "JOUR"), ("21:59", "JOUR"), ("bad", "INCONNU"),
    ("25:10:00", "NUIT"), ("30:00", "NUIT"),
])
def test_day_night(spark, text, expected):
    assert one(spark, day_night(F.col("t")), t=text) == expected


@pytest.mark.parametrize("text,parts", [
    ("26:15:59", (2, 15, 59)), ("not-a-time", (0, 0, 0)), ("08:15", (8, 15, 0)),
])
def test_time_parts(spark, text, parts):
    r = one(spark, time_parts(F.col("t")), t=text)
    assert (r["hour"], r["minute"], r["second"]) == parts


def test_haversine_paris_lyon(spark):
    d = one(spark, haversine_km(F.lit(48.8566), F.lit(2.3522), F.lit(45.7640), F.lit(4.8357)))
    assert 390 <= d <= 400


def test_haversine_one_degree_at_equator(spark):
    d = one(spark, haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0)))
    assert 110 <= d <= 112


@pytest.mark.parametrize("lat,lon,expected", [
    (48.85, 2.35, "FR"), (52.52, 13.40, "DE"), (50.5, 3.0, "FR"), (0.0, 0.0, None),
])
def test_country_of_point(spark, lat, lon, expected):
    df = spark.createDataFrame([(lat, lon)], "lat double, lon double")
    assert df.select(country_of_point("lat", "lon").alias("v")).first()["v"] == expected


@pytest.mark.parametrize("name,expected", [
    ("lisbon oriente", "PT"), ("zürich hb", "CH"), ("Unknown City", None),
    ("Venice Santa Lucia", "FR"),  # "VENICE" contains "NICE": list order decides
])
def test_country_of_name(spark, name, expected):
    df = spark.createDataFrame([(name,)], "n string")
    assert df.select(country_of_name("n").alias("v")).first()["v"] == expected


@pytest.mark.parametrize("klass,trac,km,factor,total", [
    ("Grande vitesse", "électrique", 100, 3.2, 0.32), ("Régional", "diesel", 100, 45.0, 4.5),
    ("Régional", "mixte", 100, 37.45, 3.745), ("Inconnu", "diesel", 100, 25.0, 2.5),
    ("Inconnu", "mixte", 100, 30.0, 3.0),
])
def test_emission_factor(spark, klass, trac, km, factor, total):
    df = spark.createDataFrame([(klass, trac, float(km))], "k string, t string, km double")
    f = df.select(emission_factor("k", "t").alias("f"), "km").first()
    assert f["f"] == pytest.approx(factor)
    assert round(f["f"] * f["km"] / 1000, 3) == pytest.approx(total)


@pytest.mark.parametrize("title,agency,klass,expected", [
    ("TGV 6201", "SNCF", "Grande vitesse", "électrique"),
    ("AUTORAIL 12", "X", "Régional", "diesel"),
    ("Plain", "X", "Inconnu", "mixte"),
])
def test_traction(spark, title, agency, klass, expected):
    df = spark.createDataFrame([(title, agency, klass)], "t string, a string, k string")
    assert df.select(traction("t", "a", "k").alias("v")).first()["v"] == expected


@pytest.mark.parametrize("rt,title,agency,km,h,expected", [
    ("101", "x", "y", 10.0, 0.1, "Grande vitesse"), ("106", "x", "y", 10.0, 0.1, "Régional"),
    ("", "TGV INOUI", "y", 10.0, 0.1, "Grande vitesse"), ("", "x", "Nightjet", 10.0, 0.1, "International"),
    ("", "x", "y", 900.0, 1.0, "Grande ligne"), ("", "x", "y", 300.0, 1.0, "Intercité"),
    ("", "x", "y", 50.0, 1.0, "Régional"), ("", "x", "y", 0.0, 0.0, "Inconnu"),
    ("", "INTERNATIONAL", "y", 10.0, 0.1, "Régional"),  # contains "TER": list order decides
])
def test_train_class(spark, rt, title, agency, km, h, expected):
    df = spark.createDataFrame([(rt, title, agency, km, h)],
                               "rt string, t string, a string, km double, h double")
    assert df.select(train_class("rt", "t", "a", "km", "h").alias("v")).first()["v"] == expected


@pytest.mark.parametrize("short,long,expected", [
    ("---/---", "---/---", "Paris - Lyon"), ("TGV", "Paris Lyon", "TGV"), (None, "Ligne 3", "Ligne 3"),
    ("", "", "Paris - Lyon"), ("IC 7", None, "IC 7"),
])
def test_route_title(spark, short, long, expected):
    df = spark.createDataFrame([(short, long)], "s string, l string")
    v = df.select(route_title(F.col("s"), F.col("l"), F.lit("Paris"), F.lit("Lyon")).alias("v"))
    assert v.first()["v"] == expected


@pytest.mark.parametrize("flags,count,expected", [
    ("1111111", 50, 140), ("0000000", 5, 35), ("1110000", 2, 6), ("1111100", 5, 25),
])
def test_weekly_frequency(spark, flags, count, expected):
    days = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
    df = spark.createDataFrame([tuple(flags) + (count,)],
                               ", ".join(f"{d} string" for d in days) + ", n long")
    cal = {d: F.col(d) for d in days}
    assert df.select(weekly_frequency(active_days(cal), F.col("n")).alias("v")).first()["v"] == expected


@pytest.mark.parametrize("raw,width,expected", [
    ("France", 5, "FRANC"), ("F-R!", 5, "FR"), ("UNK", 5, None), ("2022-01-01", 5, None),
    ("31/12/2025", 10, None), (None, 5, None), ("  de ", 30, "DE"),
])
def test_clean_country(spark, raw, width, expected):
    df = spark.createDataFrame([(raw,)], "c string")
    assert df.select(clean_country(F.col("c"), width).alias("v")).first()["v"] == expected


def test_route_and_agency_ids(spark):
    df = spark.createDataFrame([("R1 - Paris-Lyon", "A1:SNCF"), ("Solo", "NoColon")], "r string, a string")
    got = [tuple(r) for r in df.select(route_id_of(F.col("r")), agency_id_of(F.col("a"))).collect()]
    assert got == [("R1", "A1"), ("Solo", "NoColon")]


@pytest.mark.parametrize("text,expected", [
    ("  -12.5  ", True), ("12/34", False), ("12-34-56", False), ("", False), ("abc", False), ("3", True),
])
def test_is_valid_numeric(spark, text, expected):
    assert one(spark, is_valid_numeric(F.col("t")), t=text) == expected


@pytest.mark.parametrize("code,expected", [("2", "Rail"), ("101", "High Speed Rail"), ("9999", "Type 9999")])
def test_transport_type(spark, code, expected):
    assert one(spark, transport_type(F.col("c")), c=code) == expected
