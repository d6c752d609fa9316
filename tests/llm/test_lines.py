from collections import defaultdict

from ferrolake.llm import lines
from ferrolake.llm.queries import op9_line_dedup

SF = "/root/testdata/sf0.001"


def brute(rows, depth=4, min_docs=3, constant=0.7, equal_docs=2):
    """(doc, n_lines, n_dropped, kept text) by plain loops: a template's constants are
    real tokens, and counts are of documents. Rows without an id hold and lose nothing."""
    holders, equal = defaultdict(set), defaultdict(set)
    for d, t in [r for r in rows if None not in r]:
        for x in t.encode().split(b"\n"):
            holders[lines.masked(x)].add(d)
            equal[tuple(x.split())].add(d)
    holders.pop(b"", None)
    words = {m: m.split(b" ") for m in holders}
    leaf = {m: (len(w), tuple(w[:depth])) for m, w in words.items()}
    at = defaultdict(set)
    for m, ds in holders.items():
        for i, w in enumerate(words[m]):
            at[leaf[m], i, w] |= ds
    enough = {m for m, w in words.items() if sum(x != lines.WILD for x in w) / len(w) >= constant}
    held, template = defaultdict(set), {}
    for m, ds in holders.items():
        shape = tuple(w if w != lines.WILD and len(at[leaf[m], i, w]) >= min_docs else None
                      for i, w in enumerate(words[m]))
        if sum(x is not None for x in shape) / len(shape) >= constant:
            k = template[m] = leaf[m], shape
            held[k] |= ds
    out = []
    for d, t in rows:
        if t is None:
            out.append((d, 0, 0, None))
            continue
        kept, gone, n = [], 0, 0
        for x in t.split("\n"):
            m, own = lines.masked(x.encode()), equal[tuple(x.encode().split())]
            n += bool(m)
            if not m or d is None:
                kept.append(x)
                continue
            old = d
            if len(own) >= (equal_docs if m in enough else min_docs):
                old = min(own)
            if m in enough and len(holders[m]) >= min_docs:
                old = min(holders[m])
            elif m in template and len(held[template[m]]) >= min_docs:
                old = min(old, *held[template[m]])
            gone += d > old
            if d <= old:
                kept.append(x)
        out.append((d, n, gone, "\n".join(kept)))
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[3] or ""))


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = lines.drop_recurring(df, **kw).select("doc_id", "n_lines", "n_dropped", "kept").collect()
    return sorted(map(tuple, got), key=lambda r: (r[0] is None, r[0] or 0, r[3] or ""))


def test_variable_fields_without_digits(spark):
    rows = [(d, f"job started by {n} on the main cluster today") for d, n in
            enumerate(["ann", "bob", "cid", "dan", "eve"])] + [(9, "something else altogether here")]
    got = {r[0]: r[2] for r in run(spark, rows, depth=3)}
    assert got == {0: 0, 1: 1, 2: 1, 3: 1, 4: 1, 9: 0}


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "\n\n"), (4, "a\na\na"), (5, "a"), (5, "a\nb"), (6, "a"),
            (None, "a\nb"), (7, " a  \r"), (8, "é ü\n" * 3)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []
    df = spark.createDataFrame([(1, "a", 7, "x")], "doc_id long, text string, n_lines int, gone string")
    assert lines.drop_recurring(df).columns == ["doc_id", "text", "gone", "n_lines", "n_dropped", "kept"]
    long = "\n".join(f"line {'x' * (i % 90)} w{i}" for i in range(20000))
    got = run(spark, [(i, long) for i in range(4)])
    assert [r[1] for r in got] == [20000] * 4 and got[0][2] == 0 and got[3][2] == 20000
