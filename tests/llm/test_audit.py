import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import pyarrow as pa
import pytest

from ferrolake.llm import audit
from ferrolake.llm.queries import op12_filter_audit

COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
           "good_lost", "toxic_lost", "shapley"]


def fails(text, smaller):
    t = text or ""
    w = [x for x in re.split("[\x20\x09-\x0D]+", t) if x]
    out = "A" * (len(w) < 100) + "B" * (100 * len(set(w)) < 80 * len(w))
    out += "C" * (100 * len(re.findall("[A-Z]", t)) > 10 * len(t))
    return out + "D" * bool(re.search(r"[#$%&*|]", t)) + "E" * smaller


def brute(docs, labels):
    """Every order applied step by step; ``docs``: (id, text, part)."""
    ids = defaultdict(list)
    for d, t, _ in docs:
        if d is not None:
            ids[t or ""].append(d)
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, x in labels if x == 1 and d is not None}
    parts = defaultdict(list)
    for d, t, p in docs:
        smaller = d is not None and min(ids[t or ""]) < d
        parts[p or ""].append((d, fails(t, smaller)))
    out, share = {}, Counter()
    for part, rows in parts.items():
        for order in map("".join, permutations("ABCDE")):
            left, gone = rows, []
            for k, f in enumerate(order, 1):
                now = [r for r in left if f in r[1]]
                out[part, order, k] = [
                    len(left) - len(now), len(now), sum(f in r[1] for r in gone),
                    sum(r[1] == f for r in rows), sum(r[0] in good for r in now),
                    sum(r[0] in toxic for r in now)]
                share[part, f] += len(now)
                left, gone = [r for r in left if f not in r[1]], gone + now
    return {k: (*v, share[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def same(out, want):
    rows = [tuple(r[c] for c in COLUMNS) for r in out.collect()]
    assert {r[:3]: r[3:] for r in rows} == want and len(rows) == len(want)


def corpus(rnd, n=300):
    vocab = [f"w{i}" for i in range(400)]
    texts = [None, "", " \n", "ABC DEF", "a # b"]
    for _ in range(40):
        w = rnd.choices(vocab[:rnd.choice([60, 400])], k=rnd.choice([5, 99, 100, 130, 600]))
        if rnd.random() < 0.3:
            w = [x.upper() * 3 for x in w]
        if rnd.random() < 0.3:
            w[rnd.randrange(len(w))] += rnd.choice("#$%&*|")
        texts.append(" ".join(w))
    rows = [(rnd.randrange(10_000), rnd.choice(texts), rnd.choice(["en", "de", None, ""]))
            for _ in range(n)]
    # Repeated rows, one id in two parts, rows without an id.
    return rows + rows[:5] + [(rows[0][0], rows[0][1], "fr")] + [(None, texts[8], "en")] * 3


@pytest.mark.parametrize("files,batches", [(1, 1), (6, 6), (5, 2)])
def test_against_every_order(spark, tmp_path, files, batches):
    rnd = random.Random(files)
    rows = corpus(rnd)
    rows.sort(key=lambda r: -(r[0] or 0))  # smaller ids arrive in later files: retractions
    labels = [(r[0], rnd.choice([0, 1, None]), rnd.choice([0, 1])) for r in rows[::2]] + [(None, 1, 1)]
    path = f"{tmp_path}/documents.parquet"
    for i in range(files):
        part = rows[i * len(rows) // files:(i + 1) * len(rows) // files]
        spark.createDataFrame([(*r, 0) for r in part], "doc_id long, text string, lang string, n long") \
            .coalesce(1).write.mode("append").parquet(path)
    given = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    same(audit.audit(spark, path, given, batches=batches), brute(rows, labels))


def test_state_retracts_and_recounts():
    state = None

    def step(*rows):
        nonlocal state
        new = pa.Table.from_pylist([dict(zip(audit._OUT.names, (b"k", i, True, *r)))
                                    for i, *r in rows], audit._OUT)
        state, changes = audit.merge(state, new)
        return {tuple(r.values())[:4]: r["n"] for r in changes.to_pylist() if r["n"]}

    assert step((9, "en", 1, 1, 0, 1)) == {("en", 1, 1, 0): 1}
    assert step((12, "de", 1, 0, 0, 1)) == {("de", 1 | audit.E, 0, 0): 1}
    assert step((9, "de", 1, 1, 0, 2)) == {("de", 1, 1, 0): 2}
    assert step((4, "fr", 1, 0, 1, 1), (5, "fr", 1, 0, 1, 1)) == {
        ("fr", 1, 0, 1): 1, ("fr", 1 | audit.E, 0, 1): 1, ("en", 1, 1, 0): -1,
        ("en", 1 | audit.E, 1, 0): 1, ("de", 1, 1, 0): -2, ("de", 1 | audit.E, 1, 0): 2}
    assert state["id"].to_pylist() == [4]


def test_hot_text_leaves_a_row_per_task():
    n = 50_000
    cols = [pa.array([b"k"] * n), pa.array(range(n)), pa.array(["en"] * n),
            *[pa.array([0] * n, pa.int32())] * 3]
    out = pa.Table.from_batches(audit.settle(iter([pa.record_batch(
        cols, names=["key", "id", "part", "mask", "good", "toxic"])])))
    assert sorted(zip(out["keyed"].to_pylist(), out["mask"].to_pylist(), out["n"].to_pylist())) == \
        [(False, audit.E, n - 1), (True, 0, 1)]


def test_empty_table(spark, tmp_path):
    path = f"{tmp_path}/documents.parquet"
    spark.createDataFrame([], "doc_id long, text string, lang string").write.parquet(path)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = audit.audit(spark, path, none)
    assert out.columns == COLUMNS and out.count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()]
    same(op12_filter_audit(spark, sf), brute(docs, labels))
