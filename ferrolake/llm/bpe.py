"""Byte-level BPE encoding and decoding by corpus-level merge replay.

A batch of documents (a bounded slice of the corpus) is split into pieces by
the tokenizer's pattern; all *distinct* pieces not met before by the worker are
laid out in one flat symbol array. An inverted index maps each mergeable token
pair (by the rank of the token it makes) to the positions where it stands in
any word. Ranks are popped in increasing order; one step applies a merge at all
its positions at once and re-examines only the touched neighbours, whose new
pairs enter the index. Documents are then looked up piece by piece.

Nothing is shuffled: the vocabulary (a fixed, bounded file) is the only thing
sent to the executors, the index lives as long as its batch, and known pieces
are kept in a bounded cache.

Defined results: null or empty text encodes to an empty list; lone surrogates
cannot occur (Spark strings are UTF-8); repeated rows and extra columns are
kept as they are; a null id list decodes to null.
"""

from __future__ import annotations

import base64
import functools
import heapq
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType

from .common import distinct, flatten, starts_of, tidy, worker_state

#: Known chunks kept per worker before the cache starts anew.
CACHE_CHUNKS = 300_000
#: Ranks handled together; within a block each word still merges in rank order.
RANK_BLOCK = 512
#: Token ids decoded at once inside a task.
CHUNK_IDS = 500_000
#: Bytes of text encoded at once inside a task.
CHUNK_BYTES = 1_500_000


# A blank or line end after white space that no other character follows.
_INSIDE = re.compile(r"\s[ \n](?!\S)").search
# Bytes that may begin a white-space character, and those that may end one.
_SPACE = np.isin(np.arange(256), [*range(9, 14), *range(28, 33)])
_BEGINS, _ENDS = _SPACE | np.isin(np.arange(256), [0xC2, 0xE1, 0xE2, 0xE3]), _SPACE.copy()
_ENDS[0x80:] = True


def _slices(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The bytes cut at ``starts`` (the first is 0), as one binary array."""
    offsets = np.append(starts, len(values)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts),
                                 [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a ``.tiktoken`` file: base64 token, blank, rank per line."""
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, f) if t}


@functools.cache
def foreign_letters() -> str:
    """The code points that ``regex`` counts as letters or numbers and the
    tokenizer library, with older Unicode tables, does not."""
    chars = [chr(i) for i in range(128, 0x110000) if not 0xD800 <= i < 0xE000]
    single = {bytes([b]): b for b in range(256)}
    text, ranges = "".join(chars), []
    for cls in (r"\p{L}", r"\p{N}"):
        lib = tiktoken.Encoding("probe", pat_str=cls, mergeable_ranks=single, special_tokens={})
        known = set(lib.decode(lib.encode_ordinary(text)))
        ranges += [ord(c) for c in regex.findall(cls, text) if c not in known]
    return "".join(map(chr, sorted(ranges)))


class Splitter:
    """The pattern's matches in a text, with the library's view of letters."""

    def __init__(self, pattern: str, foreign: str):
        self.plain = regex.compile(pattern).findall
        self.foreign = frozenset(foreign)
        if min(foreign, default="\u0540") < "\u0540":
            raise ValueError("the pattern library's older letters differ too")
        if foreign:
            for cls in (r"\p{L}", r"\p{N}"):
                pattern = pattern.replace(cls, f"[{cls}--[{foreign}]]")
            self.exact = regex.compile(f"(?V1){pattern}").findall

    def __call__(self, text: str) -> list[str]:
        if self.foreign and not text.isascii() and not self.foreign.isdisjoint(text):
            return self.exact(text)
        return self.plain(text)


class Merges:
    """Vocabulary tables and the merge replay over distinct pieces."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.size = max(ranks.values(), default=-1) + 1
        self.tokens = [b""] * self.size
        for t, r in ranks.items():
            self.tokens[r] = t
        self.byte_id = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
        if (self.byte_id < 0).any():
            raise ValueError("a byte-level vocabulary must hold all 256 single bytes")
        # Every way to make a token of two tokens: a pair merges by the rank
        # of the bytes it makes, whichever halves they are.
        keys, made = [], []
        for t, r in ranks.items():
            for i in range(1, len(t)):
                a, b = ranks.get(t[:i]), ranks.get(t[i:])
                if a is not None and b is not None:
                    keys.append(a * self.size + b)
                    made.append(r)
        order = np.argsort(np.array(keys, np.int64), kind="stable")
        self.keys = np.array(keys, np.int64)[order]
        self.made = np.array(made, np.int64)[order]
        # A token that can take part in a merge of lower rank than its own:
        # after making one, that lower merge comes first (see replay).
        self.risky = np.zeros(self.size, bool)
        left, right = self.keys // max(self.size, 1), self.keys % max(self.size, 1)
        self.risky[left[self.made < left]] = True
        self.risky[right[self.made < right]] = True
        lens = np.fromiter(map(len, self.tokens), np.int64, self.size)
        self.token_len = lens
        self.table = pa.array(self.tokens, pa.binary())
        # A pair's slot names its key; keys that share a slot are searched for.
        self.bits = max(1, (4 * len(self.keys)).bit_length())
        at = self._slot(self.keys)
        self.slot = np.full(1 << self.bits, -1, np.int32)
        self.slot[at] = np.arange(len(at), dtype=np.int32)
        self.crowded = np.bincount(at, minlength=1 << self.bits) > 1

    def pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank made by each pair of token ids; -1 where they do not merge."""
        if not len(self.keys):
            return np.full(len(a), -1, np.int64)
        k = a * self.size + b
        at = self._slot(k)
        i = self.slot[at]
        out = np.where((i >= 0) & (self.keys[i] == k), self.made[i], -1)
        rest = np.flatnonzero((out < 0) & self.crowded[at])
        if len(rest):
            k = k[rest]
            i = np.minimum(np.searchsorted(self.keys, k), len(self.keys) - 1)
            out[rest] = np.where(self.keys[i] == k, self.made[i], -1)
        return out

    def _slot(self, key: np.ndarray) -> np.ndarray:
        odd = np.uint64(0x9E3779B97F4A7C15)
        return (key.view(np.uint64) * odd >> np.uint64(64 - self.bits)).astype(np.int64)

    def replay(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, ids per piece) of distinct non-empty pieces."""
        lens = np.fromiter(map(len, pieces), np.int64, len(pieces))
        n = int(lens.sum())
        if not n:
            return np.empty(0, np.int64), lens
        sym = self.byte_id[np.frombuffer(b"".join(pieces), np.uint8)]
        word = np.repeat(np.arange(len(pieces), dtype=np.int32), lens)
        nxt = np.arange(1, n + 1, dtype=np.int32)
        prv = np.arange(-1, n - 1, dtype=np.int32)
        ends = np.cumsum(lens)
        nxt[ends - 1] = -1
        prv[ends - lens] = -1
        alive = np.ones(n, bool)
        rank = np.full(n, -1, np.int32)  # of the pair that starts here
        index: dict[int, list] = {}  # block of ranks -> positions of its pairs
        heap: list[int] = []

        def put(block: int, pos: np.ndarray) -> None:
            if block not in index:
                index[block] = []
                heapq.heappush(heap, block)
            index[block].append(pos)

        def enter(pos: np.ndarray) -> None:
            """Re-rank the pairs that start at ``pos`` and index them."""
            after = nxt[pos]
            has = after >= 0
            new = np.full(len(pos), -1, np.int32)
            new[has] = self.pair_rank(sym[pos[has]], sym[after[has]])
            rank[pos] = new
            live = new >= 0
            pos, block = pos[live], new[live] // RANK_BLOCK
            if not len(pos):
                return
            order = np.argsort(block, kind="stable")
            pos, block = pos[order], block[order]
            cuts = np.flatnonzero(np.diff(block)) + 1
            for b, part in zip(block[np.r_[0, cuts]].tolist(), np.split(pos, cuts)):
                put(b, part)

        enter(np.flatnonzero(nxt >= 0))
        while heap:
            block = heapq.heappop(heap)
            pos = distinct(np.concatenate(index.pop(block)))
            pos = pos[alive[pos] & (rank[pos] >= 0) & (rank[pos] // RANK_BLOCK == block)]
            if not len(pos):
                continue
            # No word has a pair in a lower block: the lowest rank of a word
            # in this block comes next in that word; the rest waits.
            head = np.flatnonzero(np.r_[True, word[pos[1:]] != word[pos[:-1]]])
            size = np.diff(np.r_[head, len(pos)])
            lowest = rank[pos] == np.repeat(np.minimum.reduceat(rank[pos], head), size)
            now, later = pos[lowest], [pos[~lowest]]
            again = np.r_[False, word[now[1:]] == word[now[:-1]]]
            if again.any():
                risky = self.risky[rank[now]]
                if (wait := again & risky).any():  # one at a time, leftmost first
                    later.append(now[wait])
                    now, risky = now[~wait], risky[~wait]
                # Overlapping places (as in "aaa") merge from the left: every
                # other one of a chain.
                chained = np.r_[False, nxt[now[:-1]] == now[1:]]
                if chained.any():
                    begin = np.maximum.accumulate(np.where(chained, 0, np.arange(len(now))))
                    now = now[(np.arange(len(now)) - begin) % 2 == 0]
            for x in later:
                if len(x):
                    put(block, x)
            right = nxt[now]
            after = nxt[right]
            sym[now] = rank[now]
            alive[right] = False
            rank[right] = -1
            nxt[now] = after
            has = after >= 0
            prv[after[has]] = now[has]
            before = prv[now]
            enter(distinct(np.concatenate([now, before[before >= 0]])))
        return sym[alive], np.bincount(word[alive], minlength=len(pieces))

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of the concatenated tokens."""
        return self.decode_lists(ids, np.array([0, len(ids)]))[0].as_py()

    def decode_lists(self, ids: np.ndarray, starts: np.ndarray) -> pa.Array:
        """The same for each of several lists; ``starts``: where they begin, and the end."""
        found = self.table.take(pa.array(ids))
        _, offsets, raw = found.buffers()
        at = np.frombuffer(offsets, np.int32)[starts]
        return pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer(at), raw])

    def texts(self, ids: pa.Array):
        """The bytes that the lists of an array decode to, in arrays of bounded size."""
        ends = starts_of(ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                         .astype(np.int64))
        flat, i = ids.flatten(), 0
        if flat.null_count:
            raise ValueError("a list of token ids holds a null")
        flat = flat.to_numpy()
        while i < len(ids) or not i:
            j = min(max(i + 1, int(np.searchsorted(ends, ends[i] + CHUNK_IDS)) - 1), len(ids))
            out = self.decode_lists(flat[ends[i]:ends[j]], ends[i:j + 1] - ends[i])
            null = ids.slice(i, j - i).is_null()
            yield pc.if_else(null, pa.scalar(None, pa.binary()), out) if ids.null_count else out
            i = max(j, 1)


class Encoder:
    """Encodes arrays of texts; keeps the ids of chunks it has met.

    Under ``public_tokenizers.PATTERN`` a text is cut before every blank and line
    end into chunks (" word,"). Its matches do not cross such a cut unless white
    space stands before it and white space or the end after it, so a chunk's ids
    can be kept and reused; texts with such places are matched as a whole, and
    so are all texts under other patterns.

    Texts stay one run of bytes: numpy finds the cuts, Arrow the distinct chunks
    of a batch; only those become Python objects.
    """

    def __init__(self, merges: Merges, pattern: str, foreign: str | None = None):
        self.merges = merges
        self.cuts = pattern == public_tokenizers.PATTERN
        self.find = Splitter(pattern, foreign_letters() if foreign is None else foreign)
        self._clear()

    def _clear(self) -> None:
        self.code: dict[bytes, int] = {}
        self.ids, self.lens = np.empty(0, np.int32), np.empty(0, np.int64)

    def _pieces(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, ids per piece) of distinct pieces."""
        get = self.merges.ranks.get
        whole = np.fromiter((get(b, -1) for b in raw), np.int64, len(raw))
        split = whole < 0  # a piece that is a token is that token
        flat, lens = self.merges.replay([b for b, s in zip(raw, split.tolist()) if s])
        n = np.ones(len(raw), np.int64)
        n[split] = lens
        out = np.empty(int(n.sum()), np.int32)
        at = starts_of(n)[:-1]
        out[at[~split]] = whole[~split]
        out[flatten(at[split], lens)] = flat
        return out, n

    def _joinable(self, joined: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Chunks (from ``at`` on) that can be matched in one text: a blank or line end,
        then no white space, so no match crosses where they begin. All their code points
        are below U+0540, where both libraries' tables of letters agree."""
        if not self.cuts:
            return np.zeros(len(at) - 1, bool)
        begin, size = at[:-1], np.diff(at)
        first, second = joined[begin], joined[np.minimum(begin + 1, len(joined) - 1)]
        return (size > 1) & ((first == 32) | (first == 10)) & ~_BEGINS[second] \
            & (np.maximum.reduceat(joined, begin) < 0xD5)

    def _matches(self, chunks: list[bytes]) -> tuple[pa.Array, np.ndarray]:
        """(all matches of the joinable chunks, matches per chunk)."""
        joined = b"".join(chunks)
        text = joined.decode()
        chars = np.fromiter(map(len, self.find.plain(text)), np.int64)
        joined = np.frombuffer(joined, np.uint8)
        begin = starts_of(chars)  # in characters, then in bytes
        if len(text) < len(joined):
            begin = np.append(np.flatnonzero((joined & 0xC0) != 0x80), len(joined))[begin]
        ends = starts_of(np.fromiter(map(len, chunks), np.int64, len(chunks)))
        return _slices(joined, begin[:-1]), np.diff(np.searchsorted(begin, ends))

    def _learn(self, chunks: list[bytes]) -> None:
        at = starts_of(np.fromiter(map(len, chunks), np.int64, len(chunks)))
        together = self._joinable(np.frombuffer(b"".join(chunks), np.uint8), at)
        alone = [c for c, j in zip(chunks, together.tolist()) if not j]
        joint = [c for c, j in zip(chunks, together.tolist()) if j]
        found = [self.find(c.decode()) for c in alone]
        pieces = pa.array([p.encode() for p in chain.from_iterable(found)], pa.binary())
        per = np.fromiter(map(len, found), np.int64, len(found))
        if joint:
            more, each = self._matches(joint)
            pieces, per = pa.concat_arrays([pieces, more]), np.concatenate([per, each])
        number = pieces.dictionary_encode()
        flat, lens = self._pieces(number.dictionary.to_pylist())
        piece = number.indices.to_numpy()
        n = lens[piece]
        ids = flat[flatten(starts_of(lens)[:-1][piece], n)]
        base = len(self.code)
        self.code.update(zip(chain(alone, joint), range(base, base + len(chunks))))
        self.ids = np.concatenate([self.ids, ids])
        self.lens = np.concatenate([self.lens, np.diff(starts_of(n)[starts_of(per)])])

    def _cut(self, joined: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where the chunks of the texts (from ``at`` on) begin."""
        begins = at[:-1][at[1:] > at[:-1]]
        if not self.cuts:
            return begins
        cut = (joined == 32) | (joined == 10)
        # Where a cut may have white space on both sides the text itself is looked at.
        blank = np.flatnonzero(cut)
        last = np.zeros(len(joined) + 1, bool)
        last[at] = True
        after = _BEGINS[joined[np.minimum(blank + 1, len(joined) - 1)]] | last[blank + 1]
        before = _ENDS[joined[np.maximum(blank - 1, 0)]] & ~last[blank]
        for i in distinct(np.searchsorted(at, blank[after & before], "right") - 1).tolist():
            if _INSIDE(joined[at[i]:at[i + 1]].tobytes().decode()):
                cut[at[i]:at[i + 1]] = False
        cut[begins] = True
        return np.flatnonzero(cut)

    def _encode(self, joined: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(joined):
            return np.empty(0, np.int32), np.zeros(len(at) - 1, np.int64)
        if len(self.code) > CACHE_CHUNKS:
            self._clear()
        begin = self._cut(joined, at)
        number = _slices(joined, begin).dictionary_encode()
        chunks = number.dictionary.to_pylist()
        fresh = [c for c in chunks if c not in self.code]
        if fresh:
            self._learn(fresh)
        code = np.fromiter(map(self.code.__getitem__, chunks), np.int64, len(chunks))
        code = code[number.indices.to_numpy()]
        lens = self.lens[code]
        flat = self.ids[flatten(starts_of(self.lens)[:-1][code], lens)]
        return flat, np.diff(starts_of(lens)[np.searchsorted(begin, at)])

    def encode(self, texts: list | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, ids per text)."""
        lists = pa.concat_arrays(list(self.lists(
            texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))))
        return lists.flatten().to_numpy(), lists.value_lengths().to_numpy().astype(np.int64)

    def lists(self, texts: pa.Array):
        """The lists of ids of the texts, in arrays of bounded size."""
        if texts.null_count:
            texts = texts.fill_null("")
        texts = texts.cast(pa.large_binary())
        _, offsets, data = texts.buffers()
        at = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1] \
            if len(texts) else np.zeros(1, np.int64)
        data = np.frombuffer(data or b"", np.uint8)
        i = 0
        while i < len(texts) or not i:
            j = min(max(i + 1, int(np.searchsorted(at, at[i] + CHUNK_BYTES, "right")) - 1), len(texts))
            flat, lens = self._encode(data[at[i]:at[j]], at[i:j + 1] - at[i])
            yield pa.ListArray.from_arrays(pa.array(starts_of(lens), pa.int32()),
                                           pa.array(flat, pa.int32()))
            i = max(j, 1)


def _merges(shared) -> Merges:
    loaded = worker_state("bpe")
    if ("m", shared.id) not in loaded:
        loaded.clear()
        loaded["m", shared.id] = Merges(shared.ranks.value)
    return loaded["m", shared.id]


def _encoder(shared) -> Encoder:
    key = ("e", shared.id, shared.pattern)
    loaded = worker_state("bpe")
    if key not in loaded:
        m = _merges(shared)
        loaded[key] = Encoder(m, shared.pattern, shared.foreign)
    return loaded[key]


class _Shared:
    """The broadcast vocabulary (a file of bounded size) and the pattern."""

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        self.ranks = spark.sparkContext.broadcast(read_ranks(path))
        self.pattern = pattern
        self.foreign = foreign_letters() if pattern else ""
        self.id = f"{spark.sparkContext.applicationId}-{path}"


class BytePairCodec:
    """``encode``: text column -> array<int>; ``decode``: array<int> -> binary;
    ``both``: text -> struct of the ids and the bytes decoded from them."""

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        shared = self.shared = _Shared(spark, path, pattern)

        # Iterators: a batch of thousands of whole texts is answered in pieces.
        def encode(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
            return tidy(chain.from_iterable(map(_encoder(shared).lists, texts)))

        def decode(lists: Iterator[pa.Array]) -> Iterator[pa.Array]:
            return tidy(chain.from_iterable(map(_merges(shared).texts, lists)))

        def both(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
            m, enc = _merges(shared), _encoder(shared)
            return tidy(pa.StructArray.from_arrays([ids, pa.concat_arrays(list(m.texts(ids)))],
                                                   names=["ids", "decoded"])
                        for text in texts for ids in enc.lists(text))

        self._both = F.arrow_udf(both, "ids array<int>, decoded binary")
        self._encode = F.arrow_udf(encode, ArrayType(IntegerType()))
        self._decode = F.arrow_udf(decode, BinaryType())

    def encode(self, text: Column) -> Column:
        return self._encode(text)

    def decode(self, ids: Column) -> Column:
        return self._decode(ids)

    def both(self, text: Column) -> Column:
        return self._both(text)


def encode_documents(df: DataFrame, path: str, pattern: str, text: str = "text",
                     ids: str = "token_ids", decoded: str | None = None) -> DataFrame:
    """``df`` with the token ids of its whole ``text`` column (null text: no ids).

    ``decoded`` names a column for the bytes that the ids decode to, made in the same
    pass: as ``decode_documents`` after it Spark would encode every text twice, once
    for the ids and once inside the decoder's argument.
    """
    codec = BytePairCodec(df.sparkSession, path, pattern)
    if decoded is None:
        return df.withColumn(ids, codec.encode(F.col(text)))
    both = codec.both(F.col(text))
    return df.withColumns({ids: both["ids"], decoded: both["decoded"]})


def decode_documents(df: DataFrame, path: str, ids: str = "token_ids",
                     out: str = "decoded") -> DataFrame:
    """``df`` with the bytes its token ids stand for."""
    codec = BytePairCodec(df.sparkSession, path, "")
    return df.withColumn(out, codec.decode(F.col(ids)))


def digests(df: DataFrame, ids: str = "token_ids", decoded: str = "decoded") -> DataFrame:
    """n_tokens and SHA-256 digests of the ids and the decoded bytes."""
    joined = F.concat_ws(",", F.col(ids).cast("array<string>"))
    return df.select(
        "doc_id",
        F.size(F.coalesce(F.col(ids), F.array().cast("array<int>"))).cast("long").alias("n_tokens"),
        F.sha2(joined.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.coalesce(F.col(decoded), F.lit(b"")), 256).alias("decoded_sha256"))
