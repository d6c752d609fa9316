"""Benchmark decontamination: SimHash over item-sized windows, multi-index Hamming join.

An item of n words is looked for in windows of n consecutive words. Items and
windows are multisets of 5-word shingles (fewer words: the whole sequence);
similarity is the weighted Jaccard of the shingle counts, sum of minima over
sum of maxima.

1. Only windows that share a shingle with an item can reach any similarity, so
   each task looks the shingles of whole texts up in the items' shingle table
   and fingerprints the item-sized windows around the places found (SimHash,
   64 bits, by running sums).
2. Fingerprints meet by multi-index hashing: 64 bits in ``BLOCKS`` blocks; two
   of Hamming distance <= radius agree in some block up to radius // BLOCKS
   bits, so items are indexed under every block value within that many flips
   and a window probes each block once. No pair within the radius is missed.
3. Candidates are verified on the words themselves.

The benchmark is the stated query set: it is taken in slices of at most
``SLICE`` shingles, each a pass over the documents, so that what is broadcast
stays bounded whatever its size. Rows that leave a task are windows that share
a shingle with an item, never documents.
"""

from __future__ import annotations

from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (WordHash, checkpoint, flatten, hash_words, sized, starts_of, text_pieces, tidy,
                     window_hash)

WORDS = 5
BLOCKS = 7
#: Benchmark shingles looked up in one pass over the documents.
SLICE = 500_000
CHUNK = 6_000_000
WINDOWS = "doc_id long, n int, start int, print long, words binary"


def _spans(blocks: int = BLOCKS) -> list[tuple[int, int]]:
    """(first bit, bits) of each block of the 64."""
    cut = np.linspace(0, 64, blocks + 1).round().astype(int)
    return [(int(a), int(b - a)) for a, b in zip(cut, cut[1:])]


def _bits(h: np.ndarray) -> np.ndarray:
    """+1 / -1 per bit (lowest first) of each hash."""
    b = np.unpackbits(np.ascontiguousarray(h.astype("<u8")).view(np.uint8).reshape(-1, 8), axis=1,
                      bitorder="little")
    return b.astype(np.int32) * 2 - 1


def _pack(sums: np.ndarray) -> np.ndarray:
    """Fingerprints of rows of 64 sums: a bit is set where the sum is positive."""
    return np.packbits(sums > 0, axis=1, bitorder="little").view("<u8").ravel().astype(np.int64)


def window_prints(g: np.ndarray, m: int) -> np.ndarray:
    """SimHash of every m consecutive shingle hashes."""
    run = np.zeros((len(g) + 1, 64), np.int32)
    np.cumsum(_bits(g), axis=0, out=run[1:])
    return _pack(run[m:] - run[:-m])


class Items:
    """A slice of the benchmark: shingle table and the sizes to window by."""

    def __init__(self, rows: list[tuple]):
        cache = WordHash()
        h, lens, _ = hash_words([t for _, t in rows], cache, lower=True)
        at = starts_of(lens)
        self.prints, keys, sizes = [], [], []
        for i, n in enumerate(lens.tolist()):
            if not n:
                continue
            k = min(WORDS, n)
            g = window_hash(h[at[i]:at[i] + n], k)
            self.prints.append((rows[i][0], n, int(window_prints(g, len(g))[0]), rows[i][1]))
            keys.append(g)
            sizes.append(np.full(len(g), n))
        self.by_k: dict[int, tuple] = {}
        if keys:
            key, size = np.concatenate(keys), np.concatenate(sizes)
            for k in sorted({min(WORDS, int(s)) for s in size}):
                here = np.minimum(size, WORDS) == k
                order = np.lexsort((size[here], key[here]))
                a, b = key[here][order], size[here][order]
                new = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
                a, b = a[new], b[new]
                head = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1])))
                self.by_k[k] = (a[head], np.append(head, len(a)), b)

    def places(self, h: np.ndarray, lens: np.ndarray):
        """(k, shingle hashes, word position, item size) of every shared shingle."""
        begin = starts_of(lens)
        left = np.repeat(begin[1:], lens) - np.arange(len(h))
        for k, (key, head, size) in self.by_k.items():
            g = window_hash(h, k)
            i = np.minimum(np.searchsorted(key, g), len(key) - 1)
            at = np.flatnonzero((key[i] == g) & (left[:len(g)] >= k))
            many = head[i[at] + 1] - head[i[at]]
            yield k, g, np.repeat(at, many), size[flatten(head[i[at]], many)]


def _windows(batches, items: Items):
    """Fingerprints of the item-sized windows that share a shingle with an item."""
    cache = WordHash()
    for b, texts in text_pieces(batches, CHUNK):
        yield from _chunk_windows(b.column(0).to_numpy(zero_copy_only=False), texts, items, cache)


def _chunk_windows(ids, texts, items: Items, cache: WordHash):
    h, lens, words = hash_words(texts, cache, lower=True)
    begin = starts_of(lens)
    for k, g, at, size in items.places(h, lens):
        if not len(at):
            continue
        row = np.searchsorted(begin, at, "right") - 1
        order = np.lexsort((at, size, row))
        row, at, size = row[order], at[order], size[order]
        head = np.flatnonzero(np.concatenate(
            ([True], (row[1:] != row[:-1]) | (size[1:] != size[:-1]))))
        out: list = [[], [], [], [], []]
        for a, z in zip(head, np.append(head[1:], len(row))):
            r, n = int(row[a]), int(size[a])
            p = at[a:z] - begin[r]
            wide = min(n, int(lens[r]))  # a shorter text is one window
            last = int(lens[r]) - wide
            # Starts whose window holds one of the places, as merged ranges.
            lo, hi = np.clip(p - (wide - k), 0, last), np.clip(p, 0, last)
            new = np.concatenate(([True], lo[1:] > np.maximum.accumulate(hi)[:-1] + 1))
            first = lo[new]
            end = np.maximum.reduceat(hi, np.flatnonzero(new))
            m = wide - k + 1
            for f, e in zip(first.tolist(), end.tolist()):
                s = begin[r] + f
                fp = window_prints(g[s:s + (e - f) + m], m)
                for j in range(f, e + 1):
                    out[0].append(ids[r])
                    out[1].append(n)
                    out[2].append(j)
                    out[4].append(b" ".join(words[r][j:j + wide]))
                out[3].append(fp)
            if len(out[0]) > 20_000:
                yield _batch(out)
                out = [[], [], [], [], []]
        if out[0]:
            yield _batch(out)


def _batch(out: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int32()),
         pa.array(np.concatenate(out[3])), pa.array(out[4], pa.binary())],
        names=["doc_id", "n", "start", "print", "words"])


def similarity(a: bytes, b: bytes, k: int = WORDS) -> float:
    """Weighted Jaccard of the shingle counts of two word sequences."""
    x, y = a.split(), b.split()
    if not x or not y:
        return 0.0
    k = min(k, len(x), len(y))
    p = Counter(tuple(x[i:i + k]) for i in range(len(x) - k + 1))
    q = Counter(tuple(y[i:i + k]) for i in range(len(y) - k + 1))
    low = sum((p & q).values())
    return low / (len(x) + len(y) - 2 * k + 2 - low)


def _block_value(col, first: int, bits: int):
    return F.shiftrightunsigned(col, first).bitwiseAND((1 << bits) - 1)


def _index(spark, items: Items, radius: int) -> DataFrame:
    """(n, block, value, item_id, item_print): every block value within the flips."""
    flips = radius // BLOCKS
    item, n, bits, _ = zip(*items.prints)
    # From Arrow: rows of Python objects would take Python workers of their own.
    rows = spark.createDataFrame(pa.table({"item_id": pa.array(item, pa.int64()),
                                           "n": pa.array(n, pa.int32()),
                                           "item_print": pa.array(bits, pa.int64())}))
    near = []
    for j, (first, bits) in enumerate(_spans()):
        masks = [sum(1 << c for c in cs) for f in range(min(flips, bits) + 1)
                 for cs in combinations(range(bits), f)]
        near.append(rows.select(
            "n", F.lit(j).alias("block"), "item_id", "item_print",
            F.explode(F.array(*[F.lit(x).cast("long") for x in masks])).alias("mask"))
            .select("n", "block", _block_value(F.col("item_print"), first, bits)
                    .bitwiseXOR(F.col("mask")).alias("value"), "item_id", "item_print"))
    out = near[0]
    for x in near[1:]:
        out = out.unionAll(x)
    return out


def find_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.75, radius: int = 20,
               id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
               item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, start, similarity): each document's best window per item found.

    Words are lower-cased (A-Z). ``start`` counts words from 0; ties go to the
    first window. Null or blank texts and items, and rows without an id, never
    match. A text shorter than the item is one window. Repeated rows give one
    result per id pair. No items or no documents give no rows.
    """
    spark = docs.sparkSession
    docs = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    items = benchmark.where(F.col(item_col).isNotNull() & F.col(item_text).isNotNull()).select(
        F.col(item_col).cast("long").alias("item_id"), F.col(item_text).alias("text")).distinct()
    # Bytes bound the shingles from above.
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = max(1, -(-total // (2 * SLICE)))
    found = None
    for i in range(slices):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)) == i)
        part = Items([(r.item_id, r.text.encode()) for r in part.collect()])
        if not part.prints:
            continue
        hits = _matches(spark, docs, part, threshold, radius)
        found = hits if found is None else found.unionAll(hits)
    if found is None:
        return spark.createDataFrame([], "doc_id long, item_id long, start int, similarity double")
    best = found.groupBy("doc_id", "item_id").agg(
        F.max(F.struct("similarity", (-F.col("start")).alias("back"))).alias("b"))
    return best.select("doc_id", "item_id", (-F.col("b.back")).alias("start"),
                       F.col("b.similarity").alias("similarity"))


def _matches(spark, docs: DataFrame, part: Items, threshold: float, radius: int) -> DataFrame:
    sent = spark.sparkContext.broadcast(part)
    windows = docs.mapInArrow(lambda it: tidy(_windows(it, sent.value)), WINDOWS)
    probes = windows.select("*", F.posexplode(F.array(*[
        _block_value(F.col("print"), f, b) for f, b in _spans()])).alias("block", "value"))
    index = _index(spark, part, radius)
    flips = radius // BLOCKS
    per_item = sum(sum(1 for f in range(min(flips, b) + 1) for _ in combinations(range(b), f))
                   for _, b in _spans())
    pairs = probes.join(sized(index, per_item * len(part.prints)), ["n", "block", "value"])
    differ = F.col("print").bitwiseXOR(F.col("item_print"))
    # A pair that agrees in several blocks is taken in the first of them.
    first = F.coalesce(*[F.when(F.bit_count(_block_value(differ, f, b)) <= flips, F.lit(j))
                         for j, (f, b) in enumerate(_spans())])
    near = pairs.where((F.bit_count(differ) <= radius) & (F.col("block") == first))
    item, n, _, text = zip(*part.prints)
    texts = spark.createDataFrame(pa.table({"item_id": pa.array(item, pa.int64()),
                                            "n": pa.array(n, pa.int32()),
                                            "item": pa.array(text, pa.binary())})).distinct()
    both = near.join(sized(texts, len(part.prints)), ["item_id", "n"])

    def compare(words: pa.Array, item: pa.Array) -> pa.Array:
        return pa.array([similarity(w, i.lower()) for w, i in
                         zip(words.to_pylist(), item.to_pylist())], pa.float64())

    alike = F.arrow_udf(compare, "double")
    return both.select("doc_id", "item_id", "start", alike("words", "item").alias("similarity")) \
        .where(F.col("similarity") >= threshold)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, **kw) -> DataFrame:
    """The rows of ``docs`` whose id has no match (rows without an id stay)."""
    leaked = checkpoint(find_leaks(docs, benchmark, **kw).select("doc_id").distinct())
    return docs.join(sized(leaked, leaked.count()), "doc_id", "left_anti").select(*docs.columns)


