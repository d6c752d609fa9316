import random
import re

from ferrolake.llm import urls
from ferrolake.llm.queries import op1_url_filter

SF = "/root/testdata/sf0.01"


def lower(s):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in s)


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    return lower(host), re.match(r"[^?#]*", rest[len(host):]).group()


def canon(url):
    h, p = parts(url)
    return (re.sub(r"^(www|m)\.", "", h) + re.sub("/$", "", p)) if h else None


def brute(rows, rules, listed):
    out = []
    for i, u in rows:
        h, p = parts(u)
        fit = [(len(rh + rp), rh + rp, v) for v, rh, rp in rules
               if (h == rh or h.endswith("." + rh)) and p.startswith(rp)]
        best = max(fit) if fit else None
        on = canon(u) in listed and canon(u) is not None
        out.append((i, h, p, best and best[1], best[2] if best else "block" if on else "allow", on))
    return sorted(out, key=str)


def run(spark, rows, rules, listed, blocks=1 << 10):
    df = spark.createDataFrame(rows, "page_id long, url string")
    known = spark.createDataFrame([(x,) for x in listed], "url string")
    got = urls.judge(df, rules, known, blocks).select("page_id", "host", "path", "rule", "verdict",
                                                      "listed")
    return sorted(map(tuple, got.collect()), key=str)


def test_random_against_brute_force(spark):
    rnd = random.Random(9)
    hosts = ["a.example.org", "WWW.b.com", "m.b.com", "example.org", "notexample.org", "c.net", "Org", ""]
    rows = []
    for i in range(600):
        u = f"http{rnd.choice(['', 's'])}://{rnd.choice(hosts)}" + rnd.choice(
            ["", "/", f"/en/{rnd.randrange(30)}", "/es/x", "/fr/", "/de/1/", "/de", "?q=://x", "#a/b",
             "/en/1?x#y"])
        rows.append((i, u))
    rows += [(1000, None), (1001, ""), (1002, "no scheme"), (1003, "://"), (1003, "://"), (None, "a://b/"),
             (1004, "x://y://z/de/"), (1005, "http://É.com/de/"), (1006, "http://" + "h" * 50000 + ".com/fr/x")]
    listed = {canon(u) for _, u in rows[:200:3]} - {None}
    for blocks in (1, 16, 1 << 10):  # a full filter only passes more false hits
        assert run(spark, rows, urls.RULES, [*listed, *listed, None], blocks) == \
            brute(rows, urls.RULES, listed)
    assert run(spark, rows, [], []) == brute(rows, [], set())
    assert run(spark, [], urls.RULES, listed) == []


def test_bloom_filter_has_no_false_negatives(spark):
    df = spark.range(5000).selectExpr("id", "concat('host', id, '/p') AS url")
    got = urls.on_list(df, df.where("id % 2 = 0"), "url", blocks=64)
    assert got.where("listed <> (id % 2 = 0)").count() == 0
    passed = urls.bloom_filter(df.where("id % 2 = 0"), 1 << 10)
    assert passed.count() <= 1 << 10


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "http://a.org/x", "p", 2, "z")],
                               "page_id long, url string, host string, block int, w0 string")
    known = spark.createDataFrame([], "url string")
    out = urls.judge(df, urls.RULES, known)
    assert out.columns == ["page_id", "url", "block", "w0", "host", "path", "rule", "verdict", "listed"]
    assert out.first().verdict == "allow" and out.first().rule == "org/"


def test_query(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    bad = re.compile(r"\b(" + "|".join(urls.INSULTS) + r")\b")
    listed = {canon(p.url) for p in pages if p.html and bad.search(p.html)} - {None}
    want = [x[:5] for x in brute([(p.page_id, p.url) for p in pages], urls.RULES, listed)]
    assert sorted(map(tuple, op1_url_filter(spark, SF).collect()), key=str) == want
    assert listed
