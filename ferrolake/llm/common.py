"""Shared helpers of the training-data operators.

Conventions used by all of them:

* Text is taken to Python as raw UTF-8 bytes (Arrow binary), never per row.
  ``bytes.split()`` splits on exactly ``[\\x20\\x09-\\x0D]+`` and
  ``bytes.lower()`` lower-cases exactly A-Z.
* Arrow batches are bounded by Spark (records and bytes), so a task holds one
  batch of documents at a time, whatever the corpus size.
* Lineage is cut with reliable ``checkpoint()`` into ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import ctypes
import tempfile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.driver_views import read_table  # noqa: F401  (re-exported)

U64 = np.uint64
_A = U64(0x9E3779B97F4A7C15)  # odd multipliers of the splitmix64 finaliser
_B = U64(0xBF58476D1CE4E5B9)
_C = U64(0x94D049BB133111EB)

#: A side may be broadcast up to this many rows (a few dozen MB at most for the
#: narrow tables passed here); beyond it the same join is a shuffle join.
BROADCAST_ROWS = 400_000
#: Narrow rows (keys, links) that a task takes, where a step is sized by counted rows.
TASK_ROWS = 250_000
#: As ``BROADCAST_ROWS`` for a side with list columns, by rows and list entries together (16 MB
#: of 64-bit values).
BROADCAST_VALUES = 2_000_000


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names, also set as checkpoint folder.

    A folder of our own is used only for a local session that names none.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
        d = tempfile.mkdtemp(prefix="llm-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def checkpoint(df: DataFrame) -> DataFrame:
    """Eager reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def sized(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only behind a check of the measured row count."""
    return F.broadcast(df) if rows <= limit else df


def tasks_for(rows: int) -> int:
    """Tasks for so many narrow rows: small tables stay in few files and shuffle blocks."""
    return max(1, -(-rows // TASK_ROWS))


def sized_lists(df: DataFrame, *lists: str, limit: int = BROADCAST_VALUES) -> DataFrame:
    """Broadcast hint only behind a check of the rows and list entries of a (checkpointed) side."""
    size = sum((F.greatest(F.size(c), F.lit(0)).cast("long") for c in lists), F.lit(1).cast("long"))
    held = df.agg(F.sum(size)).first()[0] or 0
    return F.broadcast(df) if held <= limit else df


_KEPT: list = [None, {}]


def worker_state(owner: str) -> dict:
    """What an operator keeps between the tasks of a Python worker. Workers outlive a
    stage: the state of another operator is dropped first, and the Arrow memory and heap
    that are free are given back."""
    if _KEPT[0] != owner:
        _KEPT[1].clear()
        _KEPT[0] = owner
        give_back()
    return _KEPT[1]


def give_back() -> None:
    """Gives free Arrow memory and heap back. Spark deals tasks to all of an executor's
    Python workers in turn, so those that wait would hold what their last task needed."""
    pa.default_memory_pool().release_unused()
    if (trim := getattr(ctypes.CDLL(None), "malloc_trim", None)) is not None:  # glibc
        trim(0)


def tidy(rows):
    """The rows of a task, after which its memory is given back."""
    try:
        yield from rows
    finally:
        give_back()


def mix(h: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser, elementwise over uint64."""
    h = (h ^ (h >> U64(30))) * _B
    h = (h ^ (h >> U64(27))) * _C
    return h ^ (h >> U64(31))


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Ordered 64-bit combination of two hash arrays."""
    return mix(a * _A + b)


class WordHash(dict):
    """word bytes -> 64-bit hash, filled on demand; cleared when it grows large."""

    LIMIT = 150_000

    def __missing__(self, w: bytes) -> int:
        h = self[w] = xxhash.xxh64_intdigest(w)
        return h

    def trim(self) -> None:
        if len(self) > self.LIMIT:
            self.clear()


def binary(col) -> list:
    """Python bytes (None for null) of an Arrow string/binary array."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return col.cast(pa.large_binary()).to_pylist()


def text_pieces(batches, size: int):
    """(rows, texts) of the batches, whose second column is the text, in pieces of about
    ``size`` bytes: only a piece's texts become Python objects at a time."""
    for b in batches:
        long = pc.fill_null(pc.binary_length(b.column(1)), 0).to_numpy(zero_copy_only=False)
        # A piece ends with the text that fills it.
        full = np.cumsum(long, dtype=np.int64) // size
        ends = np.flatnonzero(full[1:] != full[:-1]) + 1
        for start, end in zip([0, *ends.tolist()], [*ends.tolist(), len(b)]):
            if end > start:
                part = b.slice(start, end - start)
                yield part, binary(part.column(1))


def hash_words(texts: list, cache: WordHash, lower: bool = False):
    """(flat uint64 word hashes, words per text, the word lists)."""
    words = [(t.lower() if lower else t).split() if t else [] for t in texts]
    lens = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.empty(int(lens.sum()), U64)
    at, get = 0, cache.__getitem__
    for w in words:
        n = len(w)
        if n:
            flat[at:at + n] = np.fromiter(map(get, w), U64, n)
            at += n
    cache.trim()
    return flat, lens, words


def starts_of(lens: np.ndarray) -> np.ndarray:
    out = np.zeros(len(lens) + 1, np.int64)
    np.cumsum(lens, out=out[1:])
    return out


def window_hash(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive entries (by binary doubling).

    Entry i covers h[i:i+k]; the result has max(0, len(h) - k + 1) entries.
    Runs over text borders are the caller's to mask.
    """
    if len(h) < k:
        return np.empty(0, U64)
    out, done = None, 0
    level, size = h, 1
    while True:
        if k & size:
            n = len(h) - (done + size) + 1
            out = level[done:done + n] if out is None else pair(out[:n], level[done:done + n])
            done += size
        if done == k:
            return mix(out + U64(k))
        nxt = len(level) - size
        level = pair(level[:nxt], level[size:size + nxt])
        size *= 2


def inside(lens: np.ndarray, k: int) -> np.ndarray:
    """Mask over window starts: True where the k-window stays in one text."""
    total = int(lens.sum())
    if total < k:
        return np.zeros(0, bool)
    left = np.repeat(starts_of(lens)[1:], lens) - np.arange(total)  # words left in the text
    return left[:total - k + 1] >= k


def flatten(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Indices of the concatenated ranges [start, start + len)."""
    total = int(lens.sum())
    if not total:
        return np.empty(0, np.int64)
    out = np.arange(total, dtype=np.int64)
    return out + np.repeat(starts - (np.cumsum(lens) - lens), lens)


def distinct(a: np.ndarray) -> np.ndarray:
    """Sorted distinct values (by sorting: faster than hashing them here)."""
    if len(a) < 2:
        return a
    a = np.sort(a)
    return a[np.concatenate(([True], a[1:] != a[:-1]))]


def signed(a: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(a).view(np.int64)


def list_array(values: np.ndarray, lens: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Arrow list column from flat values and one length per row."""
    return pa.ListArray.from_arrays(pa.array(starts_of(lens), pa.int32()), pa.array(values, kind))


def gather(batches) -> dict:
    """All columns of a (hash-partitioned, bounded) partition as numpy arrays."""
    cols: dict = {}
    for b in batches:
        for name, c in zip(b.schema.names, b.columns):
            cols.setdefault(name, []).append(c.to_numpy(zero_copy_only=False))
    return {k: np.concatenate(v) for k, v in cols.items()}


def text_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")
