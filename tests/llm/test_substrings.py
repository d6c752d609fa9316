import hashlib
import random
import re

import numpy as np
import pytest

from ferrolake.llm import substrings
from ferrolake.llm.queries import op10_substring_dedup

SF = "/root/testdata/sf0.001"


def brute(rows, window):
    docs = [(d, re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())) for d, t in rows]
    least = {}
    for d, w in docs:
        for i in range(len(w) - window + 1):
            k = tuple(w[i:i + window])
            least[k] = min(d, least.get(k, d))
    out = []
    for d, w in docs:
        gone = set()
        for i in range(len(w) - window + 1):
            if least[tuple(w[i:i + window])] < d:
                gone.update(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), kept.decode()))
    return sorted(out)


def run(spark, rows, window, parts=4):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    return sorted(map(tuple, substrings.drop_repeats(df, window).collect()))


@pytest.mark.parametrize("window,seed", [(10, 1), (7, 2), (50, 3), (2, 4), (3, 5)])
def test_random(spark, window, seed):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    shared = [" ".join(rnd.choices(vocab, k=rnd.randrange(window - 1, 4 * window))) for _ in range(12)]
    rows = []
    for d in range(150):
        parts = []
        for _ in range(rnd.randrange(0, 6)):
            parts.append(rnd.choice(shared) if rnd.random() < 0.5 else
                         " ".join(rnd.choices(vocab, k=rnd.randrange(1, 40))))
        rows.append((d, rnd.choice([" ", "\n", "\t "]).join(parts)))
    rows += [(200 + i, rows[3][1]) for i in range(20)]  # copies
    rows += [(300 + i, "a " * rnd.randrange(1, 200)) for i in range(10)]  # low entropy
    rows += [(400 + i, "a b " * rnd.randrange(1, 100)) for i in range(10)]
    rnd.shuffle(rows)
    assert run(spark, rows, window) == brute(rows, window)


def test_query_on_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = [(d, n, g, hashlib.sha256(k.encode()).hexdigest()) for d, n, g, k in brute(rows, 50)]
    assert sum(g for _, _, g, _ in want) > 0
    assert sorted(map(tuple, op10_substring_dedup(spark, SF).collect())) == want


def test_edge_cases(spark):
    text = " ".join(f"w{i}" for i in range(9))
    rows = [(1, None), (2, ""), (3, " \n"), (5, text), (4, text), (4, text), (6, "x " + text),
            (6, "x x " + text + " y"), (7, "é" + text)]
    assert run(spark, rows, 5) == brute(rows, 5)
    assert run(spark, [], 5) == []
    df = spark.createDataFrame([(None, text), (1, text), (2, text)], "doc_id long, text string")
    res = sorted(((r.doc_id is None, r.doc_id or 0), r.n_removed) for r in
                 substrings.drop_repeats(df, 5).collect())
    assert res == [((False, 1), 0), ((False, 2), 9), ((True, 0), 0)]
    wide = spark.createDataFrame([(1, text, 3, "a")], "doc_id long, text string, at int, doc string")
    assert substrings.drop_repeats(wide, 5).columns == ["doc_id", "n_words", "n_removed", "kept"]
    long = " ".join(f"t{i}" for i in range(60000))
    got = run(spark, [(1, long), (2, "a " + long)], 50)
    assert got[1][1:] == (60001, 60000, "a")


def test_slide():
    x = np.array([5, 1, 4, 9, 2, 8, 3], np.uint64)
    for n in range(1, 8):
        assert substrings._slide(x, n, np.minimum).tolist() == \
            [min(x[i:i + n].tolist()) for i in range(len(x) - n + 1)]
