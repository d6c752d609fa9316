"""Substring dedup by level-wise doubling of repeated word windows.

A word goes when a window of ``window`` consecutive words covers it and the
same sequence also starts in a document with a smaller doc_id. Windows are
judged on the input.

Level 1 looks at windows of half the length, at content-chosen places only: in
each full window the half window of least hash (ties: all). Equal full windows
choose equal halves, so a full window can only be repeated if its chosen half
is. Level 2 extends the halves that were met in two documents or more to twice
their length, the full windows around them, and asks for each whether a smaller
document holds it. Removal needs no longer level: a longer repeated window only
covers what its full windows cover already.

Every level is one shuffle of (hash, document, place) rows. A hash met in
several documents of one task is settled there: only its smallest document is
asked about in the shuffle, so a passage that a third of the corpus shares
costs one row a task. Texts themselves are not shuffled unless the table of
removed runs is too large to broadcast.
"""

from __future__ import annotations


import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (U64, WordHash, binary, checkpoint, distinct, gather, hash_words, inside, pair,
                     signed, sized, starts_of, window_hash)

CHUNK = 6_000_000
ASK, KNOWN, MARK = 0, 1, 2
#: ``at``: the text's CRC-32 and the word position, so that rows of one doc_id
#: with different texts stay apart.
ROWS = "hash long, doc long, at long, kind int"
PLACE = (1 << 32) - 1


def _tagged(texts: list) -> np.ndarray:
    crc = np.fromiter((zlib.crc32(t) if t else 0 for t in texts), np.uint32, len(texts))
    return crc.astype(np.int64) << 32


def _slide(x: np.ndarray, n: int, op) -> np.ndarray:
    """op over every n consecutive entries (n >= 1)."""
    done, out = 1, x
    while done * 2 <= n:
        out = op(out[:-done], out[done:])
        done *= 2
    rest = n - done
    return op(out[:len(out) - rest], out[rest:]) if rest else out


def _chunks(batches, extra: int = 0):
    for b in batches:
        cols = [b.column(0).to_numpy(zero_copy_only=False), binary(b.column(1))]
        cols += [b.column(2 + i) for i in range(extra)]
        start = held = 0
        for i, t in enumerate(cols[1]):
            held += len(t) if t else 0
            if held >= CHUNK or i + 1 == len(cols[1]):
                yield [c[start:i + 1] if isinstance(c, (list, np.ndarray)) else
                       c.slice(start, i + 1 - start) for c in cols]
                start, held = i + 1, 0


def _emit(h: np.ndarray, doc: np.ndarray, at: np.ndarray, kind: np.ndarray):
    for a in range(0, len(h), 200_000):
        z = slice(a, a + 200_000)
        yield pa.RecordBatch.from_arrays(
            [pa.array(signed(h[z])), pa.array(doc[z]), pa.array(at[z]),
             pa.array(kind[z].astype(np.int32))], names=["hash", "doc", "at", "kind"])


def _by_hash(h: np.ndarray, doc: np.ndarray):
    """Order by (hash, doc), and per row: its hash's smallest doc and whether
    the hash is met in another document too."""
    order = np.lexsort((doc, h))
    h, doc = h[order], doc[order]
    head = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
    size = np.diff(np.append(head, len(h)))
    least = np.repeat(doc[head], size)
    several = np.repeat(doc[head] != doc[head + size - 1], size)
    return order, least, several


def _halves(batches, window: int):
    """Level 1 rows: the chosen half windows of each document."""
    half = window // 2
    wide = window - half + 1  # half windows inside a full one
    cache = WordHash()
    for ids, texts in _chunks(batches):
        h, lens, _ = hash_words(texts, cache)
        if len(h) < window:
            continue
        full = inside(lens, window)
        g = window_hash(h, half)
        low = _slide(g, wide, np.minimum)  # per full window start
        low = np.where(full, low, U64(0))
        pad = np.zeros(wide - 1, U64)
        # A place is chosen if it is the least of some full window around it.
        high = _slide(np.concatenate([pad, low, pad]), wide, np.maximum)
        at = np.flatnonzero((high == g) & (high > 0))
        if not len(at):
            continue
        begin = starts_of(lens)
        row = np.searchsorted(begin, at, "right") - 1
        doc, place, g = ids[row], _tagged(texts)[row] | (at - begin[row]), g[at]
        order, least, several = _by_hash(g, doc)
        g, doc, place = g[order], doc[order], place[order]
        kind = np.where(several, KNOWN, ASK)
        first = several & np.concatenate(([True], g[1:] != g[:-1]))
        yield from _emit(np.concatenate([g, g[first]]), np.concatenate([doc, doc[first]]),
                         np.concatenate([place, place[first]]),
                         np.concatenate([kind, np.full(int(first.sum()), MARK)]))


def _repeated(batches):
    """(doc, at) of the rows whose hash is met in two documents or more."""
    c = gather(batches)
    if not c:
        return
    h, doc, at, kind = c["hash"].view(U64), c["doc"], c["at"], c["kind"]
    known = kind == KNOWN
    yield from _places(doc[known], at[known])
    h, doc, at, kind = h[~known], doc[~known], at[~known], kind[~known]
    if not len(h):
        return
    order, _, several = _by_hash(h, doc)
    marked = distinct(h[kind == MARK])
    yes = (several | np.isin(h[order], marked)) & (kind[order] == ASK)
    yield from _places(doc[order][yes], at[order][yes])


def _places(doc: np.ndarray, at: np.ndarray):
    for a in range(0, len(doc), 200_000):
        yield pa.RecordBatch.from_arrays([pa.array(doc[a:a + 200_000]),
                                          pa.array(at[a:a + 200_000])],
                                         names=["doc", "at"])


def _fulls(batches, window: int):
    """Level 2 rows: full windows around the repeated halves.

    What a smaller document of the same task already settles is KNOWN (to be
    removed); only the smallest document's places ask the shuffle.
    """
    half = window // 2
    cache = WordHash()
    for ids, texts, places in _chunks(batches, 1):
        h, lens, _ = hash_words(texts, cache)
        n = len(h) - window + 1
        if n < 1:
            continue
        begin = starts_of(lens)
        at = places.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        at = at + np.repeat(begin[:-1], places.value_lengths().to_numpy(zero_copy_only=False))
        cover = np.zeros(len(h) + window + 1, np.int64)  # starts s with s <= place <= s + window - half
        np.add.at(cover, np.maximum(at - (window - half), 0), 1)
        np.add.at(cover, at + 1, -1)
        s = np.flatnonzero((np.cumsum(cover)[:n] > 0) & inside(lens, window))
        if not len(s):
            continue
        g = window_hash(h, half)
        if window % 2:
            full = window_hash(h, window)[s]
        else:
            full = pair(g[s], g[s + half])
        row = np.searchsorted(begin, s, "right") - 1
        doc, place = ids[row], _tagged(texts)[row] | (s - begin[row])
        order, least, several = _by_hash(full, doc)
        full, doc, place = full[order], doc[order], place[order]
        yield from _emit(full, doc, place, np.where(doc > least, KNOWN, ASK))


def _removed(batches):
    """(doc, at) of the full windows that a smaller document holds too."""
    c = gather(batches)
    if not c:
        return
    h, doc, at, kind = c["hash"].view(U64), c["doc"], c["at"], c["kind"]
    known = kind == KNOWN
    yield from _places(doc[known], at[known])
    h, doc, at = h[~known], doc[~known], at[~known]
    if not len(h):
        return
    order, least, _ = _by_hash(h, doc)
    yes = doc[order] > least
    yield from _places(doc[order][yes], at[order][yes])


def _dealt(rows: DataFrame) -> DataFrame:
    """By hash; rows settled already by document (they are only passed on)."""
    return rows.repartition(F.expr(f"if(kind = {KNOWN}, xxhash64(doc, at), hash)"))


def repeated_runs(docs: DataFrame, window: int = 50) -> DataFrame:
    """(doc, tag, starts, ends): merged word runs to be removed, per document that has any."""
    if window < 2:
        raise ValueError("a window has two words at least")
    halves = docs.mapInArrow(lambda it: _halves(it, window), ROWS)
    met = checkpoint(_per_text(_dealt(halves).mapInArrow(_repeated, "doc long, at long")))
    near = with_text(docs, met).select("doc_id", "text", "at")
    fulls = near.mapInArrow(lambda it: _fulls(it, window), ROWS)
    gone = _per_text(_dealt(fulls).mapInArrow(_removed, "doc long, at long"))

    def runs(at: pa.Array) -> pa.Array:
        starts, ends = [], []
        flat = at.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        b = starts_of(at.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
        for i in range(len(at)):
            s = distinct(flat[b[i]:b[i + 1]])
            new = np.concatenate(([True], s[1:] > s[:-1] + window))
            starts.append(s[new])
            ends.append(s[np.concatenate((new[1:], [True]))] + window)
        return pa.StructArray.from_arrays(
            [pa.array(starts, pa.list_(pa.int64())), pa.array(ends, pa.list_(pa.int64()))],
            names=["starts", "ends"])

    merged = F.arrow_udf(runs, "starts array<long>, ends array<long>")
    return gone.select("doc", "tag", merged("at").alias("r")) \
        .select("doc", "tag", "r.starts", "r.ends")


def _per_text(rows: DataFrame) -> DataFrame:
    """(doc, tag, at): the places of each text, as bounded by its length."""
    return (rows.groupBy("doc", F.shiftrightunsigned("at", 32).alias("tag"))
            .agg(F.collect_list(F.col("at").bitwiseAND(PLACE)).alias("at")))


def with_text(docs: DataFrame, side: DataFrame, how: str = "inner") -> DataFrame:
    """``docs`` joined to per-text rows; broadcast only if these are few."""
    same = (docs["doc_id"] == side["doc"]) & (F.crc32(docs["text"].cast("binary")) == side["tag"])
    return docs.join(sized(side, side.count()), same, how)


def drop_repeats(docs: DataFrame, window: int = 50, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept) for every row of ``docs``.

    ``kept`` are the words left, joined by one blank. Null text has no words
    and keeps the empty text. Rows of one doc_id count as one document: they are
    each cut against smaller ids, never against each other. Rows without an id
    keep their whole text and are a source for nobody.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    runs = checkpoint(repeated_runs(docs.where("doc_id IS NOT NULL"), window))
    both = with_text(docs, runs, "left").select("doc_id", "text", "starts", "ends")

    def keep(text: pa.Array, starts: pa.Array, ends: pa.Array) -> pa.Array:
        n, gone, kept = [], [], []
        for t, s, e in zip(binary(text), starts.to_pylist(), ends.to_pylist()):
            w = t.split() if t else []
            n.append(len(w))
            if s:
                left, at = [], 0
                for a, b in zip(s, e):
                    left += w[at:a]
                    at = b
                left += w[at:]
                gone.append(len(w) - len(left))
                w = left
            else:
                gone.append(0)
            kept.append(b" ".join(w))
        return pa.StructArray.from_arrays(
            [pa.array(n, pa.int64()), pa.array(gone, pa.int64()),
             pa.array(kept, pa.binary()).cast(pa.string())], names=["n", "gone", "kept"])

    cut = F.arrow_udf(keep, "n long, gone long, kept string")
    return both.select("doc_id", cut("text", "starts", "ends").alias("r")).select(
        "doc_id", F.col("r.n").alias("n_words"), F.col("r.gone").alias("n_removed"),
        F.col("r.kept").alias("kept"))


def kept_digest(df: DataFrame) -> DataFrame:
    return df.select("doc_id", "n_words", "n_removed",
                     F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


