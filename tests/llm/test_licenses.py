import random
import re

import pytest

from ferrolake.llm import licenses
from ferrolake.llm.queries import op8_license_scan

SF = "/root/testdata/sf0.001"


def brute(rows, phrases=licenses.PHRASES, notices=licenses.NOTICES):
    out = []
    for d, t in rows:
        t = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)
        places, labels, score = [], set(), 0.0
        for label, p in phrases:
            x = p.split()
            for i in range(len(w)):
                if w[i:i + len(x)] == x:
                    places.append((i, label))
        for label, p in notices:
            x = [y for y in re.split(licenses._NOT_WORD, p) if y]
            n = len(x) - 2
            diag = {}
            for j in range(n):
                for i in range(len(w) - 2):
                    if w[i:i + 3] == x[j:j + 3]:
                        diag.setdefault(i - j, []).append((i, j))
            for g in diag:
                hits = [i for h in range(g, g + licenses.SLACK + 1) for i in diag.get(h, [])]
                at = [i for i, _ in hits]
                if max(at) - min(at) + 3 <= len(x) + licenses.SLACK:
                    share = len({j for _, j in hits}) / n
                    score = max(score, share)
                    if share >= licenses.SHARE:
                        labels.add(label)
        base = {l for _, l in places}
        at = [i for i, _ in places]
        out.append((d, len(w), len(places), min(at) if at else None, max(at) if at else None,
                    ",".join(sorted(base)), ",".join(sorted(base | labels)),
                    round(1.0 if at else score, 9)))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r)[:-1] + (round(r.score, 9),) for r in df.collect()), key=str)


def run(spark, rows):
    return rows_of(licenses.scan(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)))


def test_random(spark):
    rnd = random.Random(8)
    vocab = ["the", "License", "MIT", "cc", "BY", "by-nc", "4.0", "apache", "gnu", "GENERAL", "public",
             "of", "this", "é", "work", "Licenses"]
    rows = []
    for d in range(200):
        parts = []
        for _ in range(rnd.randrange(0, 5)):
            if rnd.random() < 0.5:
                w = rnd.choice(licenses.PHRASES + licenses.NOTICES)[1].split()
                for _ in range(rnd.randrange(0, 3)):
                    k = rnd.randrange(len(w))
                    w[k:k + 1] = rnd.choice([[], ["extra", w[k]], ["Zz"], [w[k].upper()]])
                    w = w or ["a"]
                parts.append(rnd.choice([" ", ", ", "\n", "-"]).join(w))
            else:
                parts.append(" ".join(rnd.choices(vocab, k=rnd.randrange(1, 20))))
        rows.append((d, rnd.choice(["", "..", " "]) + " ".join(parts) + rnd.choice(["", ".", " \n"])))
    got = run(spark, rows)
    assert got == brute(rows)
    assert sum(r[2] for r in got) > 50


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "..."), (4, "mit"), (5, "MIT License"), (5, "MIT License"),
            (None, "cc by"), (7, "\u212Aelvin mit licen\u017Fe"), (8, "cc-by cc  by ccby"),
            (9, "mit license " * 3000), (10, "MİT License mit\u00a0license")]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []
    wide = spark.createDataFrame([(1, "a", 3, "x")], "doc_id long, text string, w int, tpl string")
    assert licenses.scan(wide).count() == 1
    with pytest.raises(ValueError):
        licenses.scan(wide, phrases=[("x", "one")])


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = rows_of(op8_license_scan(spark, SF))
    assert got == brute(rows) and sum(r[2] for r in got) > 0


def test_no_python_in_the_plan(spark):
    plan = op8_license_scan(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_a_repeated_gram_counts_once(spark):
    text = "released under the released under the new name"
    got = run(spark, [(1, text)])
    assert got == brute([(1, text)])
    assert got[0][6] == "" and got[0][7] == pytest.approx(1 / 3, abs=1e-9)
