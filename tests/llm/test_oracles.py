"""The operators' SQL twins, as the driver runs them, on the smallest tables."""

import math
from collections import Counter

import duckdb
import pytest

from ferrolake.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def norm(v):
    return round(v, 9) if isinstance(v, float) and not math.isnan(v) else v


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_oracle(spark, key):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    rel = con.sql(ORACLE[key])
    df = QUERIES[key](spark, SF)
    cols = sorted(df.columns)
    assert cols == sorted(rel.columns)
    mine = Counter(tuple(norm(r[c]) for c in cols) for r in df.collect())
    theirs = Counter(tuple(norm(dict(zip(rel.columns, r))[c]) for c in cols) for r in rel.fetchall())
    assert mine and mine == theirs
