import random

import numpy as np

from ferrolake.llm import decontam
from ferrolake.llm.queries import op6_decontamination

SF = "/root/testdata/sf0.001"


def brute(docs, items, threshold=0.75):
    """Every item-sized window of every document against every item."""
    out = {}
    for d, t in docs:
        w = (t or "").encode().lower().split()
        for i, it in items:
            x = (it or "").encode().lower().split()
            n = min(len(x), len(w))
            if not n:
                continue
            k = min(5, len(x))
            grams = {tuple(x[j:j + k]) for j in range(len(x) - k + 1)}
            near = [p for p in range(len(w) - k + 1) if tuple(w[p:p + k]) in grams]
            starts = {s for p in near for s in range(max(0, p - n + k), min(p, len(w) - n) + 1)}
            for s in sorted(starts):
                v = decontam.similarity(b" ".join(w[s:s + n]), b" ".join(x))
                if v >= threshold and v > out.get((d, i), (-1, 0))[0]:
                    out[d, i] = (v, s)
    return sorted((d, i, s, round(v, 9)) for (d, i), (v, s) in out.items())


def run(spark, docs, items, **kw):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    return sorted((r.doc_id, r.item_id, r.start, round(r.similarity, 9))
                  for r in decontam.find_leaks(d, b, **kw).collect())


def test_planted_passages(spark):
    rnd = random.Random(4)
    vocab = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rnd.choices(vocab, k=rnd.choice([8, 12, 20, 37, 60])))) for i in range(30)]
    docs = []
    for d in range(120):
        parts = [" ".join(rnd.choices(vocab, k=rnd.randrange(0, 80)))]
        if d % 2:
            w = rnd.choice(items)[1].split()
            if d % 4 == 1:
                for _ in range(rnd.randrange(0, 2)):
                    w[rnd.randrange(len(w))] = "Changed"
            if d % 6 == 1:
                w = w[1:]
            parts.append(" ".join(w).upper() if d % 8 == 1 else " ".join(w))
        parts.append(" ".join(rnd.choices(vocab, k=rnd.randrange(0, 80))))
        docs.append((d, "\n".join(parts)))
    got, want = run(spark, docs, items), brute(docs, items)
    assert len(want) > 40
    # Whatever is returned is right; fingerprints may miss windows at the very
    # threshold only (distance over the radius).
    assert {x[:2] for x in got} <= {x[:2] for x in want}
    sure = {x[:2] for x in want if x[3] >= 0.8}
    assert sure <= {x[:2] for x in got}
    exact = [x for x in want if x[3] == 1.0]
    assert set(exact) <= set(got)


def test_multi_index_is_complete(spark):
    """Every pair of fingerprints within the radius meets in a block."""
    rnd = random.Random(1)
    for _ in range(300):
        a = rnd.getrandbits(64)
        x = 0
        for b in rnd.sample(range(64), rnd.randrange(0, 21)):
            x |= 1 << b
        diff = [bin((x >> f) & ((1 << n) - 1)).count("1") for f, n in decontam._spans()]
        assert min(diff) <= 20 // decontam.BLOCKS
        assert a ^ (a ^ x) == x
    assert sum(n for _, n in decontam._spans()) == 64


def test_prints():
    g = np.array([1, 2 ** 63, 5, 7], np.uint64)
    want = []
    for i in range(2):
        s = decontam._bits(g[i:i + 3]).sum(axis=0)
        want.append(sum(1 << j for j in range(64) if s[j] > 0))
    assert [x % 2 ** 64 for x in decontam.window_prints(g, 3).tolist()] == want


def test_query_on_documents(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = sorted((r.doc_id, r.item_id, r.start, round(r.similarity, 9))
                 for r in op6_decontamination(spark, SF).collect())
    assert got == brute(docs, items) and got


def test_slices_and_edges(spark, monkeypatch):
    docs = [(1, None), (2, ""), (3, "a b c"), (4, "x a b c y"), (5, "one two three four five six"),
            (5, "one two three four five six"), (6, "one two three four five")]
    items = [(1, "A b c"), (2, ""), (3, None), (4, "one two three four five six"), (4, "zz yy"),
             (5, "one two three four five six")]
    want = brute(docs, items)
    assert run(spark, docs, items) == want
    monkeypatch.setattr(decontam, "SLICE", 8)
    assert run(spark, docs, items) == want
    assert run(spark, [], items) == [] and run(spark, docs, []) == []
    d = spark.createDataFrame([(None, "a b c", 1), (3, "a b c", 2), (7, "q", 3)],
                              "doc_id long, text string, item_id int")
    b = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    left = decontam.drop_leaks(d, b)
    assert left.columns == d.columns
    assert sorted(r.text for r in left.collect()) == ["a b c", "q"]
