"""URL filters: prefix rules, and a blocked Bloom filter in front of an exact hash join.

A URL's verdict is that of its longest fitting rule; without one it is blocked
if its canonical form is on the list.

The list of canonical URLs (distinct, any size) is folded into a blocked Bloom
filter: xxhash64 of a URL names one block of 256 bits and eight bits in it, one
in each of eight 32-bit words. The filter is a table of (block, words), built
by a bit-or aggregation. Its size is fixed by ``blocks``, not by the list, so it
may be broadcast; a fuller filter only passes more false hits. URLs that pass
are joined with the list itself by an equi-join on the canonical URL, which
removes the false hits; the rest never meets the list.

All of it is DataFrame expressions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Blocks of a filter: 2**16 of 32 bytes are 2 MB, for two hundred thousand URLs at
#: about ten bits each.
BLOCKS = 1 << 16
#: Most blocks that are broadcast (64 MB of bits at 32 bytes a block).
BROADCAST_BLOCKS = 1 << 21
WORDS = 8


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty for null or without it."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """Host without ``www.`` or ``m.``, path without a final slash; null for no host."""
    return F.when(host != "", F.concat(F.regexp_replace(host, r"^(www|m)\.", ""),
                                       F.regexp_replace(path, "/$", "")))


def best_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """struct(size, rule, verdict) of the longest fitting rule, or null.

    ``rules``: (verdict, host, path), a policy list that is part of the plan. A
    rule fits its host and the host's subdomains where the path starts with the
    rule's. Of equally long rules the alphabetically last wins, block before allow.
    """
    if not rules:
        return F.lit(None).cast("struct<size:int,rule:string,verdict:string>")
    tried = [F.when(((host == h) | host.endswith("." + h)) & path.startswith(p),
                    F.struct(F.lit(len(h + p)).alias("size"), F.lit(h + p).alias("rule"),
                             F.lit(v).alias("verdict"))) for v, h, p in rules]
    return tried[0] if len(tried) == 1 else F.greatest(*tried)


def _block(hash_: Column, blocks: int) -> Column:
    return F.pmod(F.shiftright(hash_, 20), F.lit(blocks))


def _masks(url: Column) -> list[Column]:
    """One bit in each of the block's eight words, from a second hash."""
    h = F.xxhash64(url, F.lit(1))
    return [F.call_function("shiftleft", F.lit(1),
                            F.shiftrightunsigned(h, 5 * i).bitwiseAND(31).cast("int"))
            for i in range(WORDS)]


def bloom_filter(listed: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """(block, w0..w7) of the non-null canonical URLs in column ``url``."""
    bits = listed.where("url IS NOT NULL").select(
        _block(F.xxhash64("url"), blocks).alias("block"),
        *[m.alias(f"w{i}") for i, m in enumerate(_masks(F.col("url")))])
    return bits.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def on_list(urls: DataFrame, listed: DataFrame, url_col: str, blocks: int = BLOCKS) -> DataFrame:
    """``urls`` with boolean ``listed``: is its ``url_col`` among the list's ``url``?

    Null is never listed. Repeated list entries count once; rows are kept as
    they are. A column named ``listed`` is replaced.
    """
    urls = urls.drop("listed")
    names = urls.columns
    listed = listed.select("url").where("url IS NOT NULL").distinct()
    bloom = bloom_filter(listed, blocks)
    bloom = bloom.select(F.col("block").alias("__b"),
                         *[F.col(f"w{i}").alias(f"__w{i}") for i in range(WORDS)])
    if blocks <= BROADCAST_BLOCKS:  # bounded by the filter's own size
        bloom = F.broadcast(bloom)
    probe = urls.withColumn("__block", _block(F.xxhash64(F.col(url_col)), blocks)).join(
        bloom, F.col("__block") == F.col("__b"), "left")
    hit = reduce(lambda a, b: a & b, [
        F.coalesce(F.col(f"__w{i}"), F.lit(0)).bitwiseAND(m) != 0
        for i, m in enumerate(_masks(F.col(url_col)))])
    probed = probe.withColumn("__hit", hit & F.col(url_col).isNotNull())
    clear = probed.where("NOT __hit").select(*names, F.lit(False).alias("listed"))
    known = listed.select(F.col("url").alias("__url"))
    maybe = probed.where("__hit").select(*names).join(
        known, F.col(url_col) == F.col("__url"), "left")
    return clear.unionAll(maybe.select(*names, F.col("__url").isNotNull().alias("listed")))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], listed: DataFrame,
          blocks: int = BLOCKS, url_col: str = "url") -> DataFrame:
    """``pages`` with host, path, rule, verdict (allow or block) and listed.

    Columns of these names are replaced. Null or malformed URLs have empty host
    and path, no rule, and are allowed.
    """
    pages = pages.drop(*[c for c in ("host", "path", "rule", "verdict", "listed") if c != url_col])
    names = pages.columns
    parsed = pages.withColumn("host", host_of(F.col(url_col))) \
        .withColumn("path", path_of(F.col(url_col))) \
        .withColumn("__canonical", canonical(F.col("host"), F.col("path")))
    found = on_list(parsed, listed, "__canonical", blocks)
    best = best_rule(F.col("host"), F.col("path"), rules)
    return found.withColumn("__best", best).select(
        *names, "host", "path", F.col("__best.rule").alias("rule"),
        F.coalesce(F.col("__best.verdict"), F.when(F.col("listed"), "block").otherwise("allow"))
        .alias("verdict"), "listed")


#: Words whose pages are put on the block list (fixed values of the query).
INSULTS = ["clown", "disgusting", "idiot", "loser", "moron", "pathetic", "scum", "stupid", "trash",
           "worthless"]
#: Rules of the query: verdict, host, path.
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def insult_list(pages: DataFrame) -> DataFrame:
    """Canonical URLs of the pages whose markup holds one of the listed words."""
    bad = F.col("html").rlike(r"\b(" + "|".join(INSULTS) + r")\b")
    return pages.where(bad).select(canonical(host_of(F.col("url")), path_of(F.col("url"))).alias("url"))
