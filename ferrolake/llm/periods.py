"""Periodic run detection over word sequences by a dictionary of basic factors.

A *run* is a stretch of consecutive words with smallest period q and length of
at least ``max(least, 2 * q)`` that no neighbouring word extends keeping period
q. Everything in it after its first q words repeats what stood q words before.

Per text, for every power of two L the dictionary names each factor of L words
(equal names: equal words); level 2L names pairs of level-L names. A run with
period q, L <= q < 2L, holds the factor at its start again q words later, so it
is met among a factor's occurrences less than 2L apart:

* successor occurrences that overlap (p <= L apart) form an arithmetic
  progression: their factor has period p, and all but the first occurrence of a
  progression continue it to the left;
* a run's start cannot be continued to the left, so at least one of its two
  occurrences begins a progression. Only those propose periods (to both sides),
  which keeps the proposals linear in the words of the text per level;
* a proposal is extended to the right over the levels, longest factor first,
  and proposals of one stretch are reduced to the smallest period.

Names are exact (ranks of pairs, no hashes). All texts of a bounded slice go
through one set of numpy steps; positions whose factor does not recur in their
text leave the dictionary's sorts. The operator is a projection: no shuffle, and
a task holds one slice of texts (or one text, if longer).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binary, flatten, starts_of

#: Words handled in one set of numpy steps (a longer text is a slice of its own).
SLICE_WORDS = 120_000

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def _rank(a: np.ndarray) -> np.ndarray:
    """Dense names of the values of ``a``."""
    order = np.argsort(a, kind="stable")
    s = a[order]
    new = np.empty(len(a), np.int64)
    if len(a):
        new[order] = np.cumsum(np.concatenate(([0], s[1:] != s[:-1])))
    return new


class Factors:
    """Names of the factors of 1, 2, 4, ... words of several texts laid end to end.

    ``words``: word ids, ``text``: the text of each word. Level j has one name per
    position, -1 - position (a name of its own) where no other position of the text
    has the factor or where the factor does not fit.
    """

    def __init__(self, words: np.ndarray, text: np.ndarray):
        n = len(words)
        self.n, at = n, np.arange(n)
        own = -1 - at
        self.levels: list[np.ndarray] = []
        key = text * (int(words.max(initial=0)) + 1) + words
        active = at
        while len(active):
            name = _rank(key)
            many = np.bincount(name)[name] > 1
            active, name = active[many], name[many]
            level = own.copy()
            level[active] = name
            if not len(active) and self.levels:
                break
            self.levels.append(level)
            step = 1 << (len(self.levels) - 1)
            # The next level is named where both halves recur; names hold the text.
            right = active + step
            ok = right < n
            active, right, name = active[ok], right[ok], name[ok]
            ok = level[right] >= 0
            active, right, name = active[ok], right[ok], name[ok]
            ok = text[active] == text[right]
            active, right, name = active[ok], right[ok], name[ok]
            key = name * n + level[right]

    def extent(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words by which the texts agree from positions a and b (a < b) on."""
        out = np.zeros(len(a), np.int64)
        for j in range(len(self.levels) - 1, -1, -1):
            level, size = self.levels[j], 1 << j
            # Longer than the longest level allows more than one step of it.
            todo = np.arange(len(a))
            while len(todo):
                y = b[todo] + out[todo]
                inside = y < self.n
                todo, y = todo[inside], y[inside]
                x = a[todo] + out[todo]
                todo = todo[level[x] == level[y]]
                out[todo] += size
                if j + 1 < len(self.levels):
                    break
        return out


def _ranges(values: np.ndarray, low: np.ndarray, high: np.ndarray):
    """(query, index) of every sorted value in [low, high) of each query."""
    a, b = np.searchsorted(values, low), np.searchsorted(values, high)
    lens = np.maximum(b - a, 0)
    return np.repeat(np.arange(len(low)), lens), flatten(a, lens)


def _proposals(words: np.ndarray, text: np.ndarray, level: np.ndarray, size: int):
    """(a, b): positions with equal factors of ``size`` words, size <= b - a < 2 * size,
    that the word to the left does not continue."""
    n = len(words)
    active = np.flatnonzero(level >= 0)
    if not len(active):
        return active, active
    spot = np.sort(level[active] * n + active)
    name, at = spot // n, spot % n
    gap = np.where(name[1:] == name[:-1], at[1:] - at[:-1], n + size + 1)
    close = gap <= size
    # The progression's step of a name: its least gap, if occurrences overlap.
    step = np.full(int(name[-1]) + 1, n + size + 1)
    np.minimum.at(step, name[1:][close], gap[close])
    p = step[name]
    # Occurrences that their progression continues to the left propose nothing
    # themselves: two of those have the same word before them.
    # Names hold the text, so p words further is still inside the factor's text.
    before = at - 1
    same = (p <= size) & (before >= 0)
    same[same] &= (text[before[same]] == text[at[same]]) & \
        (words[before[same]] == words[before[same] + p[same]])
    first = ~same
    base = name[first] * n
    head = at[first]
    # Later occurrences of each, then earlier ones; names keep the ranges apart.
    top = base + n
    i, j = _ranges(spot, np.minimum(base + head + size, top), np.minimum(base + head + 2 * size, top))
    k, m = _ranges(spot, np.maximum(base + head - 2 * size + 1, base),
                   np.maximum(base + head - size + 1, base))
    a = np.concatenate([head[i], at[m]])
    b = np.concatenate([at[j], head[k]])
    left = (a == 0)
    inner = ~left
    left[inner] = (text[a[inner] - 1] != text[a[inner]]) | (words[a[inner] - 1] != words[b[inner] - 1])
    return a[left], b[left]


def find_runs(words: np.ndarray, lens: np.ndarray, least: int):
    """(text, start, length, period) arrays of all runs, by text, start and period.

    ``words``: ids of the words of several texts laid end to end, ``lens``: words per
    text; start counts from the text's first word.
    """
    text = np.repeat(np.arange(len(lens)), lens)
    f = Factors(words, text)
    found = []
    for j, level in enumerate(f.levels):
        a, b = _proposals(words, text, level, 1 << j)
        if not len(a):
            continue
        q = b - a
        common = f.extent(a, b)
        ok = (common >= q) & (common + q >= least)
        found.append((a[ok], common[ok] + q[ok], q[ok]))
    if not found:
        z = np.empty(0, np.int64)
        return z, z, z, z
    start, length, period = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    # One stretch, one run: a multiple of its smallest period proposes it again.
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[new], length[new], period[new]
    of = text[start]
    start = start - starts_of(lens)[of]
    order = np.lexsort((period, start, of))
    return of[order], start[order], length[order], period[order]


def _slices(texts: list):
    """Lists of words per text, in slices of a bounded number of words."""
    out, held = [], 0
    for t in texts:
        w = t.split() if t else []
        if out and held + len(w) > SLICE_WORDS:
            yield out
            out, held = [], 0
        out.append(w)
        held += len(w)
    if out:
        yield out


def _ids(words: list[list]) -> tuple[np.ndarray, np.ndarray]:
    known: dict = {}
    lens = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.empty(int(lens.sum()), np.int64)
    at = 0
    for w in words:
        flat[at:at + len(w)] = [known.setdefault(x, len(known)) for x in w]
        at += len(w)
    return flat, lens


def runs_and_rest(texts: list, least: int) -> tuple[list, list]:
    """Per text: its (start, length, period) runs, and the words that no run covers
    after its first period, joined by one space (as bytes)."""
    runs, rest = [], []
    for words in _slices(texts):
        flat, lens = _ids(words)
        of, start, length, period = find_runs(flat, lens, least)
        begin = starts_of(lens)
        # +1 where a run's repetition begins, -1 behind it: covered words count > 0.
        depth = np.zeros(len(flat) + 1, np.int64)
        np.add.at(depth, begin[of] + start + period, 1)
        np.add.at(depth, begin[of] + start + length, -1)
        covered = np.cumsum(depth)[:-1] > 0
        cut = np.searchsorted(of, np.arange(len(words) + 1))
        for i, w in enumerate(words):
            a, z = cut[i], cut[i + 1]
            runs.append(np.stack([start[a:z], length[a:z], period[a:z]], 1))
            if a < z:
                keep = np.flatnonzero(~covered[begin[i]:begin[i + 1]]).tolist()
                w = [w[k] for k in keep]
            rest.append(b" ".join(w))
    return runs, rest


def periodic_runs(docs: DataFrame, least: int = 12, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` (array of start, length, period by start and
    period) and ``collapsed``: the text's words without those that a run contains
    after its first period, joined by one space.

    Words are ``[^\\x20\\x09-\\x0D]+``. Null, empty and blank texts have no words, no
    runs and an empty ``collapsed``; every row is judged by itself, so repeated
    rows give repeated results. Columns of these names are replaced. ``least``: the
    least length of a run in words (2 or more).
    """
    if least < 2:
        raise ValueError("a run has two words at least")
    docs = docs.drop("n_words", "runs", "collapsed")

    def judge(text: pa.Array) -> pa.Array:
        texts = binary(text)
        found, rest = runs_and_rest(texts, least)
        lens = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.concatenate(found) if len(found) else np.empty((0, 3), np.int64)
        cols = [pa.array(np.ascontiguousarray(flat[:, i])) for i in range(3)]
        each = pa.StructArray.from_arrays(cols, names=["start", "length", "period"])
        listed = pa.ListArray.from_arrays(pa.array(starts_of(lens), pa.int32()), each)
        n = pa.array([len(t.split()) if t else 0 for t in texts], pa.int64())
        joined = pa.array(rest, pa.binary()).cast(pa.string())
        return pa.StructArray.from_arrays([n, listed, joined],
                                          names=["n_words", "runs", "collapsed"])

    found = F.arrow_udf(judge, f"n_words bigint, runs {RUNS}, collapsed string")
    out = docs.withColumn("__r", found(F.col(text_col)))
    return out.select(*docs.columns, "__r.n_words", "__r.runs", "__r.collapsed")


def longest(runs):
    """The run of greatest length of a ``runs`` column (ties: smallest start, then period)."""
    best = F.sort_array(F.transform(runs, lambda r: F.struct(
        (-r["length"]).alias("by"), r["start"].alias("start"), r["period"].alias("period"),
        r["length"].alias("length"))))
    return F.try_element_at(best, F.lit(1))


def digests(found: DataFrame) -> DataFrame:
    """(doc_id, n_runs, start, length, period, exponent_milli, runs_sha256,
    collapsed_sha256) of a ``periodic_runs`` result."""
    lines = F.transform("runs", lambda r: F.concat_ws(
        ",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    top = found.withColumn("__top", longest(F.col("runs")))
    return top.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        F.col("__top.start").alias("start"), F.col("__top.length").alias("length"),
        F.col("__top.period").alias("period"),
        F.floor(F.col("__top.length") * 1000 / F.col("__top.period")).cast("long")
        .alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def plant_periods(docs: DataFrame) -> DataFrame:
    """``docs`` in which every tenth document (by the crc32 of its id) repeats itself.

    h = crc32(decimal doc_id), g = floor(h / 10); where h % 10 = 0 and the text has
    n > 0 words, word i >= a becomes word a + (i - a) % p, with a = g % n and
    p = 1 + floor((n - a) / (3 + g % 8)). Other texts, null ids and null texts stay.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    cols = docs.columns
    w = F.filter(F.split(F.col("text"), "[\\x20\\x09-\\x0D]+"), lambda x: x != "")
    chosen = docs.withColumn("__g", F.when((h % 10 == 0) & F.col("text").isNotNull(),
                                           F.floor(h / 10)))
    # Words are only split for the chosen tenth.
    words = chosen.withColumn("__w", F.when(F.col("__g").isNotNull(), w))
    n = F.size("__w")
    a = F.col("__g") % n
    p = F.floor((n - F.col("__a")) / (3 + F.col("__g") % 8)) + 1
    some = F.col("__g").isNotNull() & (n > 0)
    words = words.withColumn("__a", F.when(some, a)).withColumn("__p", F.when(some, p))
    again = F.transform("__w", lambda x, i: F.when(i < F.col("__a"), x).otherwise(F.get(
        F.col("__w"), (F.col("__a") + (i - F.col("__a")) % F.col("__p")).cast("int"))))
    text = F.when(F.col("__p").isNotNull(), F.array_join(again, " ")).otherwise(F.col("text"))
    return words.withColumn("text", text).select(*cols)
