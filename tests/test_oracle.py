"""Registered queries against their DuckDB twins on the smallest driver tables
(the full set runs with ``python tools/compare.py``)."""

import math
from collections import Counter
from decimal import Decimal

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from ferrolake.plans.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
KEYS = ["gtfs_time_sec", "country_by_name", "trip_duration", "trips_summary", "sanitize_report",
        "stage_rows", "dim_location", "build_fact", "overview", "by_country", "emissions_by_route",
        "search_trips", "search_trips_all_filters", "latest_per_trip", "by_agency", "trip_view",
        "sanitize_raw_rows", "sanitize_raw_report", "country_offenders", "orphan_countries", "upsert_dim",
        "upsert_fact", "insert_ignore_dim", "stops_per_country"]


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, Decimal):
        return round(float(v), 9)
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    df = queries()[key](spark, SF)
    rel = con.sql(oracle_sql()[key])
    assert sorted(df.columns) == sorted(rel.columns)
    cols = sorted(df.columns)
    mine = Counter(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    assert mine, "no row: the comparison proves nothing"
    theirs = Counter(tuple(_norm(dict(zip(rel.columns, r))[c]) for c in cols) for r in rel.fetchall())
    assert mine == theirs


def test_entry_runs(spark):
    rows = entry(spark).collect()
    assert rows and set(rows[0].asDict()) == {"service_type", "trip_count"}
