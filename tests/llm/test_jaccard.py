import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ferrolake.llm import jaccard
from ferrolake.llm.components import components
from ferrolake.llm.queries import op7_ngram_jaccard

SF = "/root/testdata/sf0.001"


def shingles(text, k=5):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1)))


def test_large_ids_stay_exact(spark):
    """Ids that a double cannot hold, in partitions that also hold keys."""
    text = " ".join(f"w{i}" for i in range(40))
    rows = [((1 << 60) + 1, text), ((1 << 60) + 3, text + " x"), ((1 << 60) + 7, "else alone")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(df).collect()}
    first = (1 << 60) + 1
    assert got == {first: first, first + 2: first, first + 6: first + 6}


def brute(rows, num=75, den=100, k=5):
    """doc -> (size, component) by comparing every pair that shares a shingle."""
    sets = [(d, shingles(t, k)) for d, t in rows]
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    where = defaultdict(list)
    for i, (_, s) in enumerate(sets):
        for x in s:
            where[x].append(i)
    seen = set()
    for ids in where.values():
        for a in ids:
            for b in ids:
                if a < b and (a, b) not in seen:
                    seen.add((a, b))
                    s, t = sets[a][1], sets[b][1]
                    n = len(s & t)
                    if den * n >= num * (len(s) + len(t) - n):
                        parent[find(a)] = find(b)
    low = {}
    for i, (d, _) in enumerate(sets):
        low[find(i)] = min(d, low.get(find(i), d))
    return sorted((d, len(s), low[find(i)]) for i, (d, s) in enumerate(sets))


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return sorted(map(tuple, jaccard.jaccard_components(df, **kw).collect()))


def family(rnd, n_words, copies, edits, vocab=5000):
    base = [f"w{rnd.randrange(vocab)}" for _ in range(n_words)]
    out = [" ".join(base)]
    for _ in range(copies):
        w = list(base)
        for _ in range(rnd.randrange(edits + 1)):
            w[rnd.randrange(len(w))] = f"x{rnd.randrange(vocab)}"
        if rnd.random() < 0.3:
            w = w[: max(1, int(len(w) * rnd.uniform(0.7, 1)))]
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_random_families(spark, seed):
    rnd = random.Random(seed)
    texts = []
    for n in (1, 2, 3, 5, 6, 7, 8, 10, 12, 20, 33, 64, 65, 130, 300):
        texts += family(rnd, n, 12, max(1, n // 25))
    passage = " ".join(f"p{i}" for i in range(60))  # strangers that share a passage
    texts += [passage + " " + " ".join(f"s{rnd.randrange(9999)}" for _ in range(rnd.randrange(5, 120)))
              for _ in range(40)]
    chain = [f"c{i}" for i in range(80)]  # neighbours are similar, ends are not
    for i in range(30):
        chain = chain[2:] + [f"d{i}", f"e{i}"]
        texts.append(" ".join(chain))
    rnd.shuffle(texts)
    rows = list(enumerate(texts))
    assert run(spark, rows) == brute(rows)


def test_large_group_with_fringe(spark):
    """One group of near copies far over SMALL_GROUP whose fringe is similar to
    some members but not to the smallest one."""
    rnd = random.Random(5)
    base = [f"w{i}" for i in range(100)]
    rows = []
    for d in range(60):
        w = list(base)
        for p in rnd.sample(range(100), rnd.choice([0, 1, 2, 3])):
            w[p] = f"y{rnd.randrange(4)}"
        rows.append((d, " ".join(w)))
    assert run(spark, rows) == brute(rows)


def test_allocation_is_complete():
    """Any two similar enough sets share more keys than the band's extra."""
    rnd = random.Random(11)
    import numpy as np
    for _ in range(400):
        n = rnd.choice([1, 2, 3, 4, 5, 7, 8, 15, 16, 17, 31, 32, 40, 63, 64, 100, 127, 128, 200])
        a = np.array([rnd.getrandbits(64) for _ in range(n)], np.uint64)
        cut = rnd.randrange(0, n // 4 + 1)
        b = a[: n - cut]
        if len(b) and rnd.random() < 0.7:
            add = [rnd.getrandbits(64) for _ in range(rnd.randrange(0, n // 5 + 1))]
            b = np.r_[b, np.array(add, np.uint64)]
        common = len(set(a.tolist()) & set(b.tolist()))
        if not 100 * common >= 75 * (len(a) + len(b) - common):
            continue
        ka, ba = jaccard.set_keys(np.sort(a), 3, 4)
        kb, bb = jaccard.set_keys(np.sort(b), 3, 4)
        shared = defaultdict(int)
        level = dict(zip(ka.tolist(), ba.tolist()))
        for k in set(ka.tolist()) & set(kb.tolist()):
            shared[level[k]] += 1
        assert any(m > jaccard.band(k, 3, 4).extra for k, m in shared.items()), (len(a), len(b), common)


def test_query_on_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted(map(tuple, op7_ngram_jaccard(spark, SF).collect())) == brute(rows)


def test_edge_cases(spark):
    rows = [(5, None), (4, ""), (3, " \t\n"), (9, "One two"), (8, "one TWO"), (7, "one"),
            (2, "a b c d e f"), (2, "a b c d e f"), (-1, "A B C D E F"), (11, "é É"), (12, "É É")]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []
    df = spark.createDataFrame([(1, "a b", "x", 2)], "doc_id long, text string, cls string, key int")
    assert jaccard.jaccard_components(df).columns == ["doc_id", "n_shingles", "component_id"]
    none = spark.createDataFrame([(None, "a")], "doc_id long, text string")
    assert jaccard.jaccard_components(none).count() == 0
    long = " ".join(f"t{i}" for i in range(30000))
    assert run(spark, [(1, long), (2, long + " x"), (3, long)]) == \
        [(1, 29996, 1), (2, 29997, 1), (3, 29996, 1)]


def test_components(spark):
    rnd = random.Random(2)
    edges = [(rnd.randrange(400), rnd.randrange(400)) for _ in range(300)] + [(1000 + i, 1001 + i)
                                                                            for i in range(200)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = dict(map(tuple, components(df).collect()))
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    assert got == {x: find(x) for x in nodes}
    assert components(df.where("a < 0")).count() == 0


def test_sketch_is_a_lower_bound():
    import numpy as np
    rnd = np.random.default_rng(3)
    for _ in range(200):
        n = int(rnd.integers(1, 400))
        a = rnd.integers(0, 2 ** 63, n).astype(np.uint64)
        b = np.concatenate([a[: n - int(rnd.integers(0, n // 4 + 1))],
                            rnd.integers(0, 2 ** 63, int(rnd.integers(0, n // 4 + 1))).astype(np.uint64)])
        x, y = jaccard.sketch(a), jaccard.sketch(b)
        if len(x) > len(y):
            x, y = y, x
        if len(y) > len(x):
            y = y[: len(y) // 2] ^ y[len(y) // 2:]
        if len(x) == len(y):
            apart = sum(bin(int(v)).count("1") for v in x ^ y)
            assert apart <= len(set(a.tolist()) ^ set(b.tolist()))


def test_groups_make_no_pairs():
    """A block's links stay one per class and component: rows for 300 near copies that all
    meet one another do not grow with the square of the group."""
    import numpy as np
    import pyarrow as pa

    from ferrolake.llm import minhash
    rnd = np.random.default_rng(9)
    base = rnd.integers(1, 2 ** 62, 200).astype(np.uint64)
    sets = [np.sort(np.concatenate([base, rnd.integers(1, 2 ** 62, i % 5).astype(np.uint64)]))
            for i in range(300)]
    lens = np.array([len(s) for s in sets])
    bits = [jaccard.sketch(s) for s in sets]
    offsets = lambda rows: pa.array(np.r_[0, np.cumsum([len(r) for r in rows])].astype(np.int32))
    column = lambda rows: pa.ListArray.from_arrays(
        offsets(rows), pa.array(np.concatenate(rows).view(np.int64)))
    cls = np.arange(300)
    batch = pa.RecordBatch.from_arrays(
        [pa.array(np.zeros(300, np.int64)), pa.array(np.zeros(300, np.int32)), pa.array(np.zeros(300, np.int32)),
         pa.array(cls >= 150), pa.array(cls), pa.array(np.where(cls < 150, 0, cls)), pa.array(lens),
         column(bits), column(sets)],
        names=["grp", "i", "j", "outer", "cls", "root", "n", "bits", "grams"])
    most = lambda n, others: (n + others) // 7
    links = pa.Table.from_batches(list(minhash._blocks([batch], 3, 4, most)))
    assert links.num_rows == 150
    kept = pa.Table.from_batches(list(minhash._blocks([batch], 3, 4, most, sift=True)))
    assert sorted(kept["cls"].to_pylist()) == list(range(300))
