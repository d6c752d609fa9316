import random

import numpy as np
import pytest
from test_jaccard import brute as brute_classes

from ferrolake.llm import minhash
from ferrolake.llm.queries import op11_minhash_dedup

SF = "/root/testdata/sf0.001"


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = minhash.minhash_classes(df, **kw).collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in out)


def near_copies(rnd, vocab, groups, size, words, edits):
    rows = []
    for _ in range(groups):
        base = rnd.choices(vocab, k=rnd.randrange(*words))
        for _ in range(rnd.randrange(1, size)):
            w = list(base)
            for _ in range(rnd.randrange(edits + 1)):
                w[rnd.randrange(len(w))] = rnd.choice(vocab)
            rows.append((len(rows), " ".join(w)))
    return rows


@pytest.mark.parametrize("words,num,den", [(2, 80, 100), (1, 3, 4), (5, 3, 4)])
def test_against_brute_force(spark, words, num, den):
    rnd = random.Random(words)
    rows = near_copies(rnd, [f"w{i}" for i in range(300)], 60, 12, (6, 120), 12)
    rows += [(len(rows) + i, t) for i, t in enumerate([None, "", " \n", "a", "A", "a b", "a B", "a b c"])]
    rows += [(9000 + i, rows[3][1]) for i in range(40)]
    got = run(spark, rows, words=words, num=num, den=den)
    assert got == sorted(brute_classes(rows, num, den, words))
    assert sum(c != d for d, _, c in got) > 60


def test_links_of_strangers_in_a_bucket(spark):
    """Groups whose members are near the threshold: hubs link to some of them only."""
    rnd = random.Random(5)
    rows = near_copies(rnd, [f"w{i}" for i in range(5000)], 8, 60, (60, 61), 9)
    assert run(spark, rows) == sorted(brute_classes(rows, 80, 100, 2))


@pytest.mark.parametrize("n", [1, 2, 5, 30, 300, 3000])
def test_signatures_estimate_similarity(n):
    """Equal bins are an unbiased share whatever the size of the sets."""
    rng = np.random.default_rng(n)
    shares = []
    for _ in range(60):
        both = rng.integers(0, 2 ** 63, n, dtype=np.uint64)
        own = [rng.integers(0, 2 ** 63, max(1, n // 4), dtype=np.uint64) for _ in range(2)]
        sets = [np.unique(minhash.mix(np.concatenate([both, x]))) for x in own]
        a, b = minhash.signatures(sets, 512)
        shares.append((a == b).mean())
    want = n / (n + 2 * max(1, n // 4))
    assert abs(np.mean(shares) - want) < 0.04
    same = minhash.signatures([sets[0], sets[0]], 512)
    assert (same[0] == same[1]).all() and np.isin(same[0], sets[0]).all()


def test_band_collisions_follow_the_curve():
    """Pairs of 0.8 share about 64 * 0.8 ** 8 buckets and hardly ever none."""
    rng = np.random.default_rng(2)
    shared = []
    for _ in range(300):
        both = rng.integers(0, 2 ** 63, 80, dtype=np.uint64)
        sets = [np.unique(minhash.mix(np.concatenate([both, rng.integers(0, 2 ** 63, 10, dtype=np.uint64)])))
                for _ in range(2)]
        k = minhash.band_keys(minhash.signatures(sets, 512), 64, 8)
        shared.append(int((k[0] == k[1]).sum()))
    assert abs(np.mean(shared) - 64 * 0.8 ** 8) < 1 and min(shared) > 0


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in op11_minhash_dedup(spark, SF).collect())
    assert got == sorted(brute_classes(rows, 80, 100, 2))


def test_edge_cases(spark):
    assert run(spark, []) == []
    text = " ".join(f"w{i % 977}x{i % 31}" for i in range(150_000))
    rows = [(1, text), (2, text + " end"), (None, "a b c"), (3, "a b c"), (3, "a b c"), (3, "other words here"),
            (4, "other words here"), (5, None), (5, None)]
    got = run(spark, rows)
    n = len({(a, b) for a, b in zip(text.split(), text.split()[1:])})
    assert got == [(1, n, 1), (2, n + 1, 1), (3, 2, 3), (3, 2, 3), (3, 2, 3), (4, 2, 3), (5, 0, 5), (5, 0, 5)]
    df = spark.createDataFrame([(1, "a b", 7, "x", [1])],
                               "doc_id long, text string, n long, cls string, keys array<int>")
    assert minhash.minhash_classes(df).columns == ["doc_id", "n_shingles", "component_id", "kept"]
