import hashlib
import random
import re
import zlib

import pytest

from ferrolake.llm import periods
from ferrolake.llm.queries import op13_periodic_runs

SF = "/root/testdata/sf0.001"


def brute(w, least=12):
    """Sorted (start, length, period) by trying every period at every place."""
    found = {}
    n = len(w)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j - i >= q and j - i + q >= least:
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def collapse(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def words(t):
    return [x for x in re.split("[\x20\x09-\x0D]+", t or "") if x]


def check(texts, least=12):
    runs, rest = periods.runs_and_rest([None if t is None else t.encode() for t in texts], least)
    for t, r, c in zip(texts, runs, rest):
        want = brute(words(t), least)
        assert sorted(map(tuple, r.tolist())) == want, t
        assert c.decode() == collapse(words(t), want)


@pytest.mark.parametrize("least", [2, 5, 12])
def test_random_words(least):
    rnd = random.Random(least)
    texts = [None, "", "  \n", "a", "a a", "a " * 50, "a b " * 40, "é  ü\x0bé ü " * 9]
    for _ in range(400):
        k = rnd.choice([1, 2, 2, 2, 3, 5])
        texts.append(" ".join(rnd.choices("abcde"[:k], k=rnd.randrange(0, 70))))
    check(texts, least)


def test_structured_words():
    """Runs of runs, Fibonacci words, periods that are no powers of two, cut repetitions."""
    rnd = random.Random(7)
    fib = ["a", "b"]
    while len(fib[-1]) < 300:
        fib.append(fib[-1] + fib[-2])
    texts = [" ".join(x) for x in fib]
    for _ in range(150):
        base = rnd.choices("ab", k=rnd.randrange(1, 25))
        text = []
        for _ in range(rnd.randrange(1, 5)):
            text += base * rnd.randrange(1, 6) + base[:rnd.randrange(len(base) + 1)]
            if rnd.random() < 0.5:
                text.insert(rnd.randrange(len(text)), rnd.choice("abc"))
        texts.append(" ".join(text))
    check(texts)


def test_every_short_binary_word():
    check([" ".join(format(i, f"0{n}b")) for n in (4, 9, 11) for i in range(2 ** n)], 2)


def test_factor_cut_at_both_ends():
    # The factors of a period's first half all recur inside it.
    for x in ("aabaaba", "abaababaabaab", "aabaabaabaabaab" "b", "abababababa" "ab" "b"):
        for a in range(len(x)):
            y = x[a:] + x[:a]
            check([" ".join(y + y), " ".join("c" + y + y + "c"), " ".join(y[-3:] + y + y + y[:2])], 2)


def planted(doc, w):
    h = zlib.crc32(str(doc).encode())
    g, n = h // 10, len(w)
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r.doc_id: r for r in op13_periodic_runs(spark, SF).collect()}
    assert len(got) == len(docs)
    changed = 0
    for d in docs:
        w = planted(d.doc_id, words(d.text))
        changed += w != words(d.text)
        runs = brute(w) if len(w) < 4000 else sorted(
            map(tuple, periods.runs_and_rest([" ".join(w).encode()], 12)[0][0].tolist()))
        runs.sort(key=lambda r: (r[0], r[2]))
        r = got[d.doc_id]
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None,) * 3
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        assert r.runs_sha256 == sha("".join("%d,%d,%d\n" % x for x in runs))
        assert r.collapsed_sha256 == sha(collapse(w, runs))
    assert changed > 5


def test_long_text():
    rnd = random.Random(3)
    w = [f"w{rnd.randrange(2000)}" for _ in range(150_000)]
    w[50_000:90_000] = (w[50_000:50_777] * 60)[:40_000]
    runs, rest = periods.runs_and_rest([" ".join(w).encode()], 12)
    top = max(runs[0].tolist(), key=lambda r: r[1])
    assert top[2] == 777 and top[0] <= 50_000 and top[1] >= 40_000
    assert len(rest[0].split()) == 150_000 - (top[1] - 777)
    runs, rest = periods.runs_and_rest([b"x " * 400_000], 12)
    assert runs[0].tolist() == [[0, 400_000, 1]] and rest[0] == b"x"


def test_edge_cases(spark):
    rows = [(1, None, "r"), (None, "a b " * 8, "r"), (2, "", None), (2, "a b " * 8, "x"), (2, "a b " * 8, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    out = periods.periodic_runs(df)
    assert out.columns == ["doc_id", "text", "n_words", "runs", "collapsed"]
    got = sorted((r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in out.collect())
    assert got == [(0, [], "")] * 2 + [(16, [(0, 16, 2)], "a b")] * 3
    assert periods.digests(out).where("start is null").count() == 2
    assert periods.periodic_runs(df.limit(0)).count() == 0
    assert periods.plant_periods(df).count() == 5 and periods.plant_periods(df).columns == df.columns
    with pytest.raises(ValueError):
        periods.periodic_runs(df, least=1)


def test_projection_only(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = periods.digests(periods.periodic_runs(docs))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
