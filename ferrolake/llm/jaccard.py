"""Exact n-gram Jaccard self-join by universe-partition pigeonhole.

A document's set holds the 64-bit hashes of its distinct k-word shingles. Sets
fall into size bands (powers of two). For a band the shingle universe is hashed
into ``m`` segments. Two sets of sizes a, b with Jaccard >= t differ in at most
H = (1-t)/(1+t) * (a+b) shingles, so at least m - H segments are *equal*. Each
set is indexed under keys of (segment, subset of its shingles there); partners
from the next larger band probe the smaller band's segments too.

Cost-based allocation, per band and per set:

* a band takes either plain segment subsets, or, where too few segments would
  be filled (tiny sets), half as many segments with their one-deletion
  neighbourhoods, whichever is estimated cheaper (``Band``);
* a set drops its most expensive subsets (fewest shingles first, as those are
  shared most) as long as the pigeonhole leaves ``extra + 1`` common keys.

A set meets others under its shared keys less the ``extra`` most frequent ones
(``_members``): similar sets still meet in one, documents that merely share a
passage do not. No pairs inside a key's group are enumerated as rows: all members
meet the group's hub, and groups whose members are then still in several
components are closed in blocks inside tasks (``minhash.link_buckets``). Every
link is verified on the whole sets; sizes and parity bits only refuse pairs that
cannot be similar.

Scale: one pass over the texts, one shuffle of 24-byte key rows; a key that is
frequent within a task is dealt by member instead of by key, so no reducer
holds a hot key's members. Later steps see only sets that share a key.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import minhash
from .common import (U64, WordHash, checkpoint, gather, hash_words, list_array, mix, signed, sized,
                     starts_of, tasks_for, text_pieces, tidy, window_hash, worker_state)

#: Members of a key within a task, or within a reducer, from which the key is hot.
SMALL_GROUP = 32
#: Characters of text handled at once inside a task.
CHUNK = 2 << 20
MEMBER, HOT, MARK, DOC = 0, 1, 2, 3


class Band:
    """Allocation for sets of 2**k .. 2**(k+1)-1 shingles, and larger partners."""

    def __init__(self, k: int, num: int, den: int):
        self.k, self.lo, self.hi = k, 1 << k, (2 << k) - 1
        self.num, self.den = num, den  # threshold num/den
        top = self.differ(self.hi, self.hi * den // num)
        self.extra = top // 5
        self.segments = math.ceil(1.8 * (top + 1 + self.extra))
        need = self.differ(self.lo, self.lo * den // num) + 1 + self.extra
        plain = top + 1 + self.extra + 1000 * self._deficit(self.lo, self.segments, need)
        half = (top + 2) // 2
        thin = 1 - self._occupied(self.lo, half) if half > 1 else 0.0
        self.deletion = top > 0 and half + self.hi + 1000 * thin < plain
        if self.deletion:
            self.segments, self.extra = half, 0

    def differ(self, a: int, b: int) -> int:
        """Most shingles two sets of these sizes may differ in."""
        return (self.den - self.num) * (a + b) // (self.den + self.num)

    @staticmethod
    def _deficit(n: int, m: int, need: int) -> float:
        """Chance that n shingles fill fewer than ``need`` of m segments."""
        if n > 64:
            return 0.0
        p = np.zeros(m + 1)
        p[0] = 1.0
        j = np.arange(m + 1)
        for _ in range(n):
            p = p * j / m + np.r_[0.0, (p * (m - j) / m)[:-1]]
        return float(p[:need].sum())

    @staticmethod
    def _occupied(n: int, m: int) -> float:
        """Chance, about, that every one of m segments has two shingles or more."""
        s = n / m
        return max(0.0, 1 - m * math.exp(-s) * (1 + s))

    def keys(self, g: np.ndarray, spread: np.ndarray, need: int) -> np.ndarray:
        """Index keys of a set; ``need`` of them unless deletions are used."""
        m = self.segments
        salt = U64((self.k + 1) * 0x9E3779B9)
        seg = (((spread ^ salt) & U64(0xFFFFFFFF)) * U64(m) >> U64(32)).astype(np.int64)
        size = np.bincount(seg, minlength=m)
        total = np.zeros(m, U64)
        np.add.at(total, seg, g)
        tag = (np.arange(m, dtype=U64) << U64(8)) + U64(self.k)
        key = mix(total * U64(0xD6E8FEB86659FD93) + tag)
        if self.deletion:
            less = mix((total[seg] - g) * U64(0xD6E8FEB86659FD93) + tag[seg])
            return np.unique(np.concatenate([key, less]))
        if need >= m:
            return key
        return key[np.lexsort((key, -size))[:need]]


@lru_cache(maxsize=None)
def band(k: int, num: int, den: int) -> Band:
    return Band(k, num, den)


def set_keys(g: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, band of each) under which a set of distinct hashes is indexed."""
    n = len(g)
    k = n.bit_length() - 1
    own = band(k, num, den)
    spread = mix(g)
    parts = [own.keys(g, spread, own.differ(n, n * den // num) + 1 + own.extra)]
    bands = [k]
    if k and -(-n * num // den) <= own.lo - 1:  # a smaller partner may be one band below
        low = band(k - 1, num, den)
        parts.append(low.keys(g, spread, low.differ(n, own.lo - 1) + 1 + low.extra))
        bands.append(k - 1)
    return np.concatenate(parts), np.repeat(np.array(bands), [len(p) for p in parts])


def shingle_sets(texts: list, cache: WordHash, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes per text (fewer than k words: one shingle)."""
    h, lens, _ = hash_words(texts, cache, lower=True)
    g = window_hash(h, k)
    at = starts_of(lens)
    out = []
    for i, n in enumerate(lens.tolist()):
        a = at[i]
        if n >= k:
            s = np.sort(g[a:a + n - k + 1])
            out.append(s[np.concatenate(([True], s[1:] != s[:-1]))])
        else:
            out.append(window_hash(h[a:a + n], n) if n else np.empty(0, U64))
    return out


def sketch(g: np.ndarray) -> np.ndarray:
    """Parity bits of a set: every hash flips one of 2**(k+2) bits (64 at least).

    Two sets differ in at least as many hashes as their parity bits do, and the
    bits of a larger set fold (xor of the halves) to those of a smaller size.
    """
    bits = max(64, 4 << (len(g).bit_length() - 1)) if len(g) else 64
    at = mix(g) & U64(bits - 1)
    odd = (np.bincount(at.astype(np.int64), minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view("<u8")


def _chunks(batches, size: int = CHUNK):
    """(ids, texts) of bounded total length."""
    for b, texts in text_pieces(batches, size):
        yield b.column(0).to_numpy(zero_copy_only=False), texts


KEYS = "key long, cls long, doc long"


def _index(batches, k: int, num: int, den: int):
    worker_state("jaccard")
    cache = WordHash()
    for ids, texts in _chunks(batches):
        keys, cls, docs, done = [], [], [], set()
        local: dict = {"key": [], "cls": []}
        for doc, g in zip(ids.tolist(), shingle_sets(texts, cache, k)):
            c = minhash.class_of(g)
            keys.append((len(g) << 8) | DOC)
            cls.append(c)
            docs.append(doc)
            if len(g) and c not in done:
                done.add(c)
                kk, bb = set_keys(g, num, den)
                local["key"].append((kk & ~U64(0xFF)) | (bb.astype(U64) << U64(2)))
                local["cls"].append(np.full(len(kk), c, np.int64))
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.array(cls, pa.int64()), pa.array(docs, pa.int64())],
            names=["key", "cls", "doc"])
        if not local["key"]:
            continue
        key, member = np.concatenate(local["key"]), np.concatenate(local["cls"])
        # Keys frequent here already: their members are dealt by member, and
        # one marker tells the key's reducer that it is hot.
        order = np.argsort(key, kind="stable")
        key, member = key[order], member[order]
        head = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        size = np.diff(np.append(head, len(key)))
        hot = np.repeat(size > SMALL_GROUP, size)
        marks = head[size > SMALL_GROUP]
        key = np.where(hot, key | U64(HOT), key)
        key = np.concatenate([key, (key[marks] & ~U64(3)) | U64(MARK)])
        member = np.concatenate([member, member[marks]])
        for a in range(0, len(key), 200_000):
            kk = signed(key[a:a + 200_000])
            yield pa.RecordBatch.from_arrays(
                [pa.array(kk), pa.array(member[a:a + 200_000]), pa.array(np.zeros(len(kk), np.int64))],
                names=["key", "cls", "doc"])


GROUPS = "kind int, grp long, cls long, doc long"


def _group(batches):
    """Keys of one hash partition: passes documents and hot members, groups the rest."""
    cols = gather(batches)
    if not cols:
        return
    key, cls, doc = cols.pop("key").view(U64), cols.pop("cls"), cols.pop("doc")
    kind = (key & U64(3)).astype(np.int64)

    def rows(code, grp, member, doc=None):
        n = len(member)
        for a in range(0, n, 200_000):
            z = slice(a, a + 200_000)
            m = len(member[z])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(m, code, np.int32)), pa.array(grp[z]), pa.array(member[z]),
                 pa.nulls(m, pa.int64()) if doc is None else pa.array(doc[z])],
                names=["kind", "grp", "cls", "doc"])

    d = kind == DOC
    if d.any():
        yield from rows(DOC, signed(key[d] >> U64(8)), cls[d], doc[d])
    del doc
    h = kind == HOT
    if h.any():
        yield from rows(HOT, signed(key[h] & ~U64(3)), cls[h])
    m = (kind == MEMBER) | (kind == MARK)
    if not m.any():
        return
    marked = kind[m] == MARK
    key, cls = key[m] & ~U64(3), cls[m]
    del kind, d, h, m
    order = np.lexsort((cls, key))
    key, cls, marked = key[order], cls[order], marked[order]
    hot_keys = np.unique(key[marked])
    keep = ~marked
    key, cls = key[keep], cls[keep]
    if not len(key):
        return
    new = np.concatenate(([True], (key[1:] != key[:-1]) | (cls[1:] != cls[:-1])))
    key, cls = key[new], cls[new]
    head = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    size = np.diff(np.append(head, len(key)))
    is_hot = (size > SMALL_GROUP) | np.isin(key[head], hot_keys)
    hot = np.repeat(is_hot, size)
    yield from rows(HOT, signed(key[hot]), cls[hot])
    small = ~is_hot & (size > 1)
    row = np.repeat(small, size)
    # Keys of a band with the same members are one group, named by them; the
    # last column holds the band and the number of keys.
    s = size[small]
    member = cls[row]
    begin = starts_of(s)[:-1]
    level = (key[head][small] >> U64(2)) & U64(63)
    name = np.add.reduceat(mix(member.view(U64)), begin) if len(s) else np.empty(0, U64)
    name = mix(name + (s.astype(U64) << U64(8)) + level)
    _, first, many = np.unique(name, return_index=True, return_counts=True)
    pick, count = np.zeros(len(s), bool), np.zeros(len(s), U64)
    pick[first], count[first] = True, many
    take = np.repeat(pick, s)
    info = np.repeat(signed((level << U64(32)) | count), s)
    yield from rows(MEMBER, signed(np.repeat(name, s)[take]), member[take], info[take])


class _Confirm(minhash.Confirm):
    """Exact test of class pairs. Before any whole set moves, pairs go whose sizes differ too
    much or whose parity bits differ in more places than the sets may (both necessary)."""

    sift = True

    def __init__(self, sets: DataFrame, num: int, den: int, tasks: int):
        super().__init__(sets, num, den, None, tasks)

    def aligned(self, a: str, b: str) -> list:
        def folded(c: str, other: str):
            # At most one band lies between two sets that can be similar.
            half = (F.size(c) / 2).cast("int")
            return F.when(F.size(c) > F.size(other), F.zip_with(
                F.slice(c, 1, half), F.slice(c, half + 1, half),
                lambda x, y: x.bitwiseXOR(y))).otherwise(F.col(c))

        return [folded(a, b), folded(b, a)]

    def limit(self, na, nb):
        """Most shingles, so also parity bits, that sets of these sizes may differ in."""
        return F.floor((self.den - self.num) * (na + nb) / (self.den + self.num))

    def block_limit(self):
        num, den = self.num, self.den
        return lambda n, others: (den - num) * (n + others) // (den + num)


def _level(grp):
    """The band in a group's (a key's) low bits."""
    return F.shiftrightunsigned(grp, 2).bitwiseAND(63).cast("int")


def _extra(num: int, den: int, level):
    return F.element_at(F.array(*[F.lit(band(k, num, den).extra) for k in range(40)]), level + 1)


def _sets_of(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(cls, n, bits, grams) of the wanted (doc, cls) rows; of repeated ids the fitting text."""
    text = docs.join(sized(wanted, wanted.count()), docs["doc_id"] == wanted["doc"]) \
        .select("cls", "text")

    def grams(batches):
        worker_state("jaccard")
        cache = WordHash()
        for want, texts in _chunks(batches):
            sets = shingle_sets(texts, cache, k)
            fits = [i for i, g in enumerate(sets) if minhash.class_of(g) == want[i]]
            sets = [sets[i] for i in fits]
            lens = np.fromiter(map(len, sets), np.int64, len(sets))
            flat = np.concatenate(sets) if sets else np.empty(0, U64)
            bits = [sketch(g) for g in sets]
            words = np.fromiter(map(len, bits), np.int64, len(bits))
            yield pa.RecordBatch.from_arrays(
                [pa.array(want[fits]), pa.array(lens),
                 list_array(signed(np.concatenate([*bits, np.empty(0, U64)])), words, pa.int64()),
                 list_array(signed(flat), lens, pa.int64())], names=["cls", "n", "bits", "grams"])

    return checkpoint(text.mapInArrow(
        lambda it: tidy(grams(it)), "cls long, n long, bits array<long>, grams array<long>"))


def _members(found: DataFrame, num: int, den: int) -> DataFrame:
    """(key, cls) under which classes meet: for each class and band its keys that other
    classes have too, less the ``extra`` most frequent ones.

    Similar sets share more than ``extra`` keys of a band. All classes order keys alike
    (frequency, name), so the first key that two such sets share is never among the
    ``extra`` last ones of either: they still meet, while documents that merely share a
    passage lose the keys they would meet in.
    """
    few = found.where(f"kind = {MEMBER}").select(
        "grp", "cls", F.shiftright("doc", 32).cast("int").alias("k"),
        F.col("doc").bitwiseAND((1 << 32) - 1).alias("w"))
    hot = found.where(f"kind = {HOT}").select(
        "grp", "cls", _level(F.col("grp")).alias("k"), F.lit(1).cast("long").alias("w")).distinct()
    every = few.unionAll(hot).groupBy("grp", "cls", "k").agg(F.sum("w").alias("w"))
    size = every.groupBy("grp").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    rest = Window.partitionBy("cls", "k").orderBy(F.desc("size"), F.desc("grp")) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    kept = every.join(size, "grp").withColumn("up", F.sum("w").over(rest)) \
        .where(F.col("up") > _extra(num, den, F.col("k"))).select(F.col("grp").alias("key"), "cls")
    return checkpoint(kept)


def jaccard_components(docs: DataFrame, words: int = 5, num: int = 75, den: int = 100,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document.

    Documents link when den * |intersection| >= num * |union| of their shingle
    sets; component_id is the smallest doc_id reachable. Null or blank texts
    have n_shingles 0 and are alone. Repeated doc_id rows are kept as rows.
    Rows with a null id are dropped (a component needs a name).
    """
    docs = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    if math.gcd(num, den) > 1:
        num, den = num // math.gcd(num, den), den // math.gcd(num, den)
    index = docs.mapInArrow(lambda it: tidy(_index(it, words, num, den)), KEYS)
    dealt = index.repartition(F.expr(
        f"if((key & 3) = {HOT}, xxhash64(cls, key), if((key & 3) = {DOC}, xxhash64(doc), key))"))
    found = checkpoint(dealt.mapInArrow(lambda it: tidy(_group(it)), GROUPS))
    rows = found.where(f"kind = {DOC}").select("doc", F.col("grp").alias("n"), "cls")
    first = rows.where("n > 0").groupBy("cls").agg(F.min("doc").alias("doc"))
    members = _members(found, num, den)
    tasks = tasks_for(members.count())
    wanted = checkpoint(first.join(members.select("cls").distinct(), "cls", "left_semi")
                        .select("doc", "cls").coalesce(tasks))
    confirm = _Confirm(_sets_of(docs, wanted, words), num, den, tasks)
    comp = minhash.link_buckets(members.coalesce(tasks), confirm)
    # Components of classes -> smallest document of any member class.
    named = checkpoint(first.join(comp.withColumnRenamed("node", "cls"), "cls", "left")
                       .select("cls", "doc", F.coalesce("root", "cls").alias("root")))
    least = named.groupBy("root").agg(F.min("doc").alias("component_id"))
    label = named.join(least, "root").select("cls", "component_id")
    return rows.join(label, "cls", "left").select(
        F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc").alias("component_id"))
