import math

import numpy as np
import pytest

from ferrolake.llm import ann
from ferrolake.llm.queries import op3_nearest_neighbours

SF = "/root/testdata/sf0.1"
SCHEMA = "vec_id long, embedding array<float>"


def usable(v):
    return v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v) and any(v)


def brute(rows, k, every, kind=np.float32):
    """query -> [(vec_id, score)] over all candidates, exactly; of several vectors of
    an id the nearest pair."""
    rows = [(i, np.array(v, kind).astype(float)) for i, v in rows if i is not None and usable(v)]
    rows = [(i, v / np.abs(v).max()) for i, v in rows]
    near = {}
    for q, v in rows:
        if q % every:
            continue
        best = near.setdefault(q, {})
        for i, w in rows:
            if i != q and len(w) == len(v):
                s = float((v * w).sum() / (np.sqrt((v * v).sum()) * np.sqrt((w * w).sum())))
                best[i] = max(s, best.get(i, -2))
    return {q: sorted(best.items(), key=lambda x: (-round(x[1], 12), x[0]))[:k]
            for q, best in near.items()}


def collected(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return out


def compare(got, want):
    """Share of the true neighbours found; ranks and scores of the found are exact."""
    hit = total = 0
    for q, best in want.items():
        mine = got.get(q, [])
        assert [r for r, _, _ in mine] == list(range(1, len(mine) + 1)) and len(mine) == len(best)
        assert mine == sorted(mine, key=lambda m: (-round(m[2], 12), m[1]))
        true = dict(best)
        hit += sum(v in true for _, v, _ in mine)
        total += len(best)
        for _, v, s in mine:
            if v in true:
                assert s == pytest.approx(true[v], abs=1e-12)
    return hit / total


def test_recall_on_embeddings(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet")
            .select("vec_id", "embedding").collect()]
    got = collected(op3_nearest_neighbours(spark, SF))
    assert compare(got, brute(rows, 5, 50)) >= 0.9


def test_several_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 20)
    rnd = np.random.default_rng(4)
    centres = rnd.normal(size=(12, 16))
    rows = [(i, (centres[i % 12] + 0.3 * rnd.normal(size=16)).tolist()) for i in range(900)]
    rows += [(900 + i, (centres[0] + 1e-3 * rnd.normal(size=16)).tolist()) for i in range(400)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = collected(ann.nearest(df, "vec_id % 20 = 0", k=5, shard_rows=200))
    assert compare(got, brute(rows, 5, 20)) >= 0.9


def test_copies_and_ties(spark):
    rnd = np.random.default_rng(1)
    one = rnd.normal(size=8).tolist()
    rows = [(i, one) for i in range(300)] + [(300 + i, rnd.normal(size=8).tolist()) for i in range(50)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = collected(ann.nearest(df, "vec_id % 10 = 0", k=5))
    assert compare(got, brute(rows, 5, 10)) == 1.0
    assert [v for _, v, _ in got[0]] == [1, 2, 3, 4, 5] and [v for _, v, _ in got[3 * 10]] == [0, 1, 2, 3, 4]


def test_ids_with_several_vectors(spark):
    rnd = np.random.default_rng(9)
    near = rnd.normal(size=8)
    rows = [(i % 60, rnd.normal(size=8).tolist()) for i in range(240)]
    # Thirty vectors of id 5 around those of query 50, which has three itself.
    rows += [(5, (near + 1e-3 * rnd.normal(size=8)).tolist()) for _ in range(30)]
    rows += [(50, (near + 1e-3 * rnd.normal(size=8)).tolist()) for _ in range(3)]
    rows += rows[:20]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = collected(ann.nearest(df, "vec_id % 10 = 0", k=5, shard_rows=100))
    assert compare(got, brute(rows, 5, 10)) >= 0.98
    assert got[50][0][1] == 5 and len({v for _, v, _ in got[50]}) == 5


def test_very_large_and_small_components(spark):
    rnd = np.random.default_rng(3)
    rows = [(i, (rnd.normal(size=4) * 10.0 ** rnd.choice([-200, 0, 200])).tolist()) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = collected(ann.nearest(df, "vec_id % 10 = 0", k=5))
    assert compare(got, brute(rows, 5, 10, float)) == 1.0


def test_edge_cases(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]),
            (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, [1e30, 1e30]), (8, [0.0, 1.0]),
            (None, [1.0, 1.0]), (10, [1.0, 2.0, 3.0]), (11, [3.0, 2.0, 1.0]), (20, [5.0])]
    df = spark.createDataFrame(rows, SCHEMA)
    got = collected(ann.nearest(df, "vec_id % 10 = 0", k=5))
    assert compare(got, brute([r for r in rows], 5, 10)) == 1.0
    assert set(got) == {0, 10}  # 20 is alone in its dimension
    assert ann.nearest(df.limit(0), "vec_id % 10 = 0").count() == 0
    wide = spark.createDataFrame([(0, [1.0], 1, "a"), (1, [2.0], 2, "b")], SCHEMA + ", node int, h1 string")
    out = ann.nearest(wide, "vec_id = 0")
    assert out.columns == ["query_id", "rank", "vec_id", "score"] and out.count() == 1


def test_prune_keeps_diverse_edges():
    x = np.array([[1, 0], [0.999, 0.04], [0.998, 0.06], [0, 1.0]], np.float32)
    x /= np.linalg.norm(x, axis=1)[:, None]
    out = ann.robust_prune(x, np.array([0]), np.array([[1, 2, 3, -1, 1]]), 3, 1.2)
    assert out[0].tolist()[:2] == [1, 3] and out[0][2] == -1
