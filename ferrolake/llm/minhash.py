"""MinHash near-duplicate classes by one-permutation hashing.

A document's set holds the 64-bit hashes of its distinct k-word shingles. Texts
with equal sets are one *class* from the start, however many they are.

* Signature: one hash per shingle. Its high bits choose one of ``bands * rows``
  bins, the least hash of a bin is the bin's value. An empty bin takes the value
  of the first filled bin on its own random walk over the bins (optimal
  densification: walks of different bins are independent, and the same for all
  texts), so sets of any size have full signatures with unbiased collisions.
* Banding: ``rows`` consecutive bins make a band key. Two sets of similarity J
  share a bucket unless all bands miss: (1 - J ** rows) ** bands, 8e-6 at 0.8 for
  the 64 x 8 bins used here.
* Star: of a bucket only edges to one hub are candidates, members - 1 of them. All
  bands draw hubs in one order of classes, so a group that fills many buckets has
  few distinct edges.
* Candidates whose sizes or signature bits (one per bin) are too far apart go; of a
  class's others, the nearest hub by bits and the first in the order of hubs are
  confirmed on the full sets. Bits refuse a pair at the threshold itself with a
  chance of about 1e-5.
* Buckets whose members are then still in several components are closed: members
  outside a bucket's largest component meet that component's members, once for all
  their buckets, and then one another, in blocks of bounded size inside a task
  (bits first, then full sets). A block returns its links, one for each class and
  component, so strangers that share a bucket make no rows, and no link is lost.

Scale: one pass over the texts writes one row per document, with the keys of its
class where the task meets the class first. Band rows are shuffled twice (partial
least and greatest class per key, then the semi join with the shared keys); hubs
are partial aggregates joined back, so a hot bucket is split by AQE and never
sorted in one task. Full sets are made again only for classes that share a bucket
with another class.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (U64, WordHash, binary, checkpoint, flatten, hash_words, list_array, mix, pair,
                     shared_folder, signed, sized, starts_of, tasks_for, tidy, window_hash)
from .components import components

BANDS, ROWS = 64, 8
#: Bytes of text taken through one set of numpy steps.
CHUNK = 2 << 20
#: Texts whose signatures are made together (64 x 8 bins of 8 bytes each).
SIGNED = 256
#: Filled bins up to which an empty bin finds its first by ranks, not by walking.
FEW = 24

_SEED = U64(0xA0761D6478BD642F)


class Walks:
    """For every bin its own random order of all bins."""

    def __init__(self, bins: int):
        rng = np.random.default_rng(20_240_607)
        self.order = np.argsort(rng.random((bins, bins)), axis=1).astype(np.int32)
        self.rank = np.empty_like(self.order)
        np.put_along_axis(self.rank, self.order, np.arange(bins, dtype=np.int32)[None, :], 1)

    def fill(self, values: np.ndarray, filled: np.ndarray) -> None:
        """Gives each empty bin of each row the value of its first filled bin."""
        size = filled.sum(axis=1)
        for r in np.flatnonzero((size > 0) & (size <= FEW)):
            at = np.flatnonzero(filled[r])
            first = at[np.argmin(self.rank[:, at], axis=1)]
            values[r] = np.where(filled[r], values[r], values[r][first])
        row, bin_ = np.nonzero(~filled & (size > FEW)[:, None])
        step = 0
        while len(row):
            to = self.order[bin_, step]
            hit = filled[row, to]
            values[row[hit], bin_[hit]] = values[row[hit], to[hit]]
            row, bin_ = row[~hit], bin_[~hit]
            step += 1


_WALKS: dict[int, Walks] = {}


def walks(bins: int) -> Walks:
    if bins not in _WALKS:
        _WALKS[bins] = Walks(bins)
    return _WALKS[bins]


def signatures(sets: list[np.ndarray], bins: int) -> np.ndarray:
    """One row of ``bins`` values per set of sorted distinct hashes (none may be empty)."""
    lens = np.fromiter(map(len, sets), np.int64, len(sets))
    row = np.repeat(np.arange(len(sets)), lens)
    h = np.concatenate(sets)
    # Sets are sorted by hash and bins follow the high bits: the first hash of a
    # bin is its least.
    bin_ = ((h >> U64(32)) * U64(bins) >> U64(32)).astype(np.int64)
    cell = row * bins + bin_
    first = np.concatenate(([True], cell[1:] != cell[:-1]))
    values = np.zeros(len(sets) * bins, U64)
    filled = np.zeros(len(sets) * bins, bool)
    values[cell[first]] = h[first]
    filled[cell[first]] = True
    values, filled = values.reshape(-1, bins), filled.reshape(-1, bins)
    walks(bins).fill(values, filled)
    return values


def band_keys(values: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One key per band of each signature; the band is part of it."""
    v = values.reshape(len(values), bands, rows)
    key = np.broadcast_to(mix(np.arange(bands, dtype=U64) + _SEED), (len(values), bands))
    for r in range(rows):
        key = pair(key, v[:, :, r])
    return key


def signature_bits(values: np.ndarray) -> np.ndarray:
    """One bit per bin of each signature, packed to 64-bit words: equal values agree,
    others in every second bin."""
    bins = values.shape[1]
    bit = mix(values + np.arange(1, bins + 1, dtype=U64) * _SEED) >> U64(63)
    return np.packbits(bit.astype(np.uint8), axis=1, bitorder="little").view("<u8")


def most_apart(bins: int, num: int, den: int) -> int:
    """Bits in which two sets at the threshold differ at most (4.3 standard deviations)."""
    p = (1 - num / den) / 2
    return math.ceil(bins * p + 4.3 * math.sqrt(bins * p * (1 - p)))


def shingle_sets(texts: list, cache: WordHash, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes per text (fewer than k words: one shingle)."""
    h, lens, _ = hash_words(texts, cache, lower=True)
    g = window_hash(h, k)
    at = starts_of(lens)
    # All shingles inside their text, sorted by (text, hash) in one go.
    many = np.maximum(lens - k + 1, 0)
    s = g[flatten(at[:-1], many)]
    row = np.repeat(np.arange(len(lens)), many)
    order = np.lexsort((s, row))
    s, row = s[order], row[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (row[1:] != row[:-1])
    s, row = s[new], row[new]
    cut = np.searchsorted(row, np.arange(len(lens) + 1))
    out = [s[cut[i]:cut[i + 1]] for i in range(len(lens))]
    for i in np.flatnonzero((lens > 0) & (lens < k)):
        out[i] = window_hash(h[at[i]:at[i + 1]], int(lens[i]))
    return out


def _chunks(batches):
    """(ids, texts) of bounded total length."""
    for b in batches:
        ids, texts = b.column(0).to_numpy(zero_copy_only=False), binary(b.column(1))
        start = held = 0
        for i, t in enumerate(texts):
            held += len(t) if t else 0
            if held >= CHUNK or i + 1 == len(texts):
                yield ids[start:i + 1], texts[start:i + 1]
                start, held = i + 1, 0


def class_of(g: np.ndarray) -> int:
    """Name of a set: a signed 64-bit hash of its sorted hashes (0 for the empty set)."""
    if not len(g):
        return 0
    c = xxhash.xxh64_intdigest(g.tobytes())
    return c - (1 << 64) if c >= 1 << 63 else c


#: One row per document; ``keys`` only where its task met the class first.
INDEX = "cls long, doc long, n long, keys array<long>"


def _index(batches, k: int, bands: int, rows: int):
    cache, known = WordHash(), set()
    for ids, texts in _chunks(batches):
        sets = shingle_sets(texts, cache, k)
        cls = [class_of(g) for g in sets]
        fresh = []
        for i, (c, g) in enumerate(zip(cls, sets)):
            if len(g) and c not in known:
                known.add(c)
                fresh.append(i)
        if len(known) > 500_000:
            known.clear()  # a class may be emitted again: rows are made distinct later
        keys = [band_keys(signatures([sets[i] for i in fresh[a:a + SIGNED]], bands * rows), bands, rows)
                for a in range(0, len(fresh), SIGNED)]
        flat = signed(np.concatenate(keys).reshape(-1)) if keys else np.empty(0, np.int64)
        has = np.zeros(len(cls), bool)
        has[fresh] = True
        at = starts_of(np.where(has, bands, 0)).astype(np.int32)
        listed = pa.ListArray.from_arrays(pa.array(at), pa.array(flat), mask=pa.array(~has))
        yield pa.RecordBatch.from_arrays(
            [pa.array(cls, pa.int64()), pa.array(ids, pa.int64()),
             pa.array([len(g) for g in sets], pa.int64()), listed], names=["cls", "doc", "n", "keys"])


def _sets_of(docs: DataFrame, wanted: DataFrame, k: int, bins: int) -> DataFrame:
    """(cls, n, bits, grams) of the wanted (doc, cls) rows; of repeated ids the fitting text."""
    text = docs.join(sized(wanted, wanted.count()), docs["doc_id"] == wanted["doc"]) \
        .select("cls", "text")

    def grams(batches):
        cache = WordHash()
        for want, texts in _chunks(batches):
            sets = shingle_sets(texts, cache, k)
            fits = [i for i, g in enumerate(sets) if class_of(g) == want[i]]
            sets = [sets[i] for i in fits]
            lens = np.fromiter(map(len, sets), np.int64, len(sets))
            flat = np.concatenate(sets) if sets else np.empty(0, U64)
            bits = [signature_bits(signatures(sets[a:a + SIGNED], bins))
                    for a in range(0, len(sets), SIGNED)]
            words = signed(np.concatenate(bits).reshape(-1)) if bits else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(want[fits]), pa.array(lens),
                 list_array(words, np.full(len(sets), bins // 64), pa.int64()),
                 list_array(signed(flat), lens, pa.int64())], names=["cls", "n", "bits", "grams"])

    return checkpoint(text.mapInArrow(
        grams, "cls long, n long, bits array<long>, grams array<long>"))


class Confirm:
    """Exact test of class pairs on their full sets: den * common >= num * union.

    ``sets``: (cls, n, bits, grams). Sizes and bits refuse most strangers before any
    set moves. ``sift``: blocks of the closing pass are judged by sizes and bits alone
    first, and only classes that may have a link take their sets to a second pass.
    """

    sift = False

    def __init__(self, sets: DataFrame, num: int, den: int, apart: int, tasks: int):
        self.sets, self.num, self.den, self.apart, self.tasks = sets, num, den, apart, tasks
        self.sketches = checkpoint(sets.select("cls", "n", "bits").distinct().coalesce(tasks))

    def aligned(self, a: str, b: str) -> list:
        """The bits of two sets, as columns of one length."""
        return [F.col(a), F.col(b)]

    def limit(self, na, nb):
        """Most bits in which sets of these sizes may differ, as a column."""
        return F.lit(self.apart)

    def block_limit(self):
        """The same for a set of a block and the others' sizes."""
        apart = self.apart
        return lambda n, others: apart

    def near(self, pairs: DataFrame) -> DataFrame:
        """Of each a's pairs (a, b) that may be links: to the nearest b and to the first."""
        side = lambda c: self.sketches.select(F.col("cls").alias(c), F.col("n").alias(f"n{c}"),
                                              F.col("bits").alias(f"bits{c}"))
        differ = F.aggregate(F.zip_with(*self.aligned("bitsa", "bitsb"),
                                        lambda x, y: F.bit_count(x.bitwiseXOR(y))),
                             F.lit(0), lambda t, x: t + x)
        near = (pairs.select("a", "b").distinct().coalesce(self.tasks)
                .join(side("a"), "a").coalesce(self.tasks).join(side("b"), "b")
                .where(self.den * F.least("na", "nb") >= self.num * F.greatest("na", "nb"))
                .select("a", "b", differ.alias("differ"), self.limit(F.col("na"), F.col("nb")).alias("most"))
                .where("differ <= most").drop("most"))
        order = F.xxhash64("b"), F.col("b")
        two = near.groupBy("a").agg(F.array_distinct(F.array(
            F.min_by("b", F.struct("differ", *order)), F.min_by("b", F.struct(*order)))).alias("b"))
        return two.select("a", F.explode("b").alias("b")).coalesce(self.tasks)

    def exact(self, pairs: DataFrame) -> DataFrame:
        a = self.sets.select(F.col("cls").alias("a"), F.col("grams").alias("ga"))
        b = self.sets.select(F.col("cls").alias("b"), F.col("grams").alias("gb"))
        common = F.size(F.array_intersect("ga", "gb"))
        union = F.size("ga") + F.size("gb") - common
        return checkpoint(pairs.join(a, "a").join(b, "b")
                          .where(self.den * common >= self.num * union).select("a", "b"))

    def __call__(self, pairs: DataFrame) -> DataFrame:
        return self.exact(self.near(pairs))


#: Classes that meet in one block of the closing pass: outer and inner ones.
OUTER, INNER = 2048, 1024


def _differ(rows: dict, i: int, others: np.ndarray) -> np.ndarray:
    """Bits in which row ``i`` of a block and each of the others differ. Bits have a power
    of two of words; the longer ones are folded to the shorter ones' length."""
    at, words = rows["bits_at"], np.diff(rows["bits_at"])
    mine = rows["bits"][at[i]:at[i + 1]]
    out = np.empty(len(others), np.int64)
    for w in np.unique(words[others]).tolist():
        same = words[others] == w
        theirs = rows["bits"][at[others[same]][:, None] + np.arange(w)]
        own = mine
        while theirs.shape[1] > len(own):
            theirs = theirs[:, :theirs.shape[1] // 2] ^ theirs[:, theirs.shape[1] // 2:]
        while len(own) > theirs.shape[1]:
            own = own[:len(own) // 2] ^ own[len(own) // 2:]
        out[same] = np.bitwise_count(theirs ^ own).sum(axis=1)
    return out


def _near(rows: dict, num: int, den: int, apart):
    """For each outer row of a block its number, the inner rows of other components that
    sizes and bits allow, nearest first."""
    inner = np.flatnonzero(~rows["outer"])
    n_in, root = rows["n"][inner], rows["root"][inner]
    for i in np.flatnonzero(rows["outer"]):
        n = int(rows["n"][i])
        ok = np.flatnonzero((root != rows["root"][i])
                            & (den * np.minimum(n, n_in) >= num * np.maximum(n, n_in)))
        if len(ok):
            differ = _differ(rows, i, inner[ok])
            fits = differ <= apart(n, n_in[ok])
            ok, differ = ok[fits], differ[fits]
            yield i, inner[ok[np.argsort(differ, kind="stable")]]


def _first_links(rows: dict, num: int, den: int, apart) -> list:
    """For each outer class of a block the exact link to its nearest inner class of
    another component that has one, nearest by bits first; one per outer and component."""
    found = []
    at, root = rows["grams_at"], rows["root"]
    gram = lambda r: rows["grams"][at[r]:at[r + 1]]
    for i, near in _near(rows, num, den, apart):
        n = int(rows["n"][i])
        own, met = gram(i), set()
        for k in near.tolist():
            if root[k] in met:
                continue
            other = gram(k)
            if len(other) < len(own):
                spot = np.searchsorted(own, other)
                common = int((own[np.minimum(spot, n - 1)] == other).sum())
            else:
                spot = np.searchsorted(other, own)
                common = int((other[np.minimum(spot, len(other) - 1)] == own).sum())
            if den * common >= num * (n + len(other) - common):
                found.append((rows["cls"][i], rows["cls"][k]))
                met.add(root[k])
    return found


def _possible(rows: dict, num: int, den: int, apart) -> np.ndarray:
    """Rows of a block that sizes and bits allow a link to a class of another component."""
    has = np.zeros(len(rows["n"]), bool)
    for i, near in _near(rows, num, den, apart):
        if len(near):
            has[i] = has[near] = True
    return has


def _blocks(batches, num: int, den: int, apart, sift: bool = False):
    """Links of all blocks of a task, whose rows come sorted by block; a block is a
    few thousand sets, so a task holds one of them and one Arrow batch. ``sift``: instead
    of links (grp, outer, cls) of the rows that may have one; no whole sets are needed."""
    names = ("grp", "i", "j", "outer", "cls", "root", "n")
    lists = ("bits",) if sift else ("bits", "grams")
    held: list = []  # pieces of the block that the last batch ended in
    found: list = []

    def judge() -> None:
        rows = {c: np.concatenate([p[c] for p in held]) if len(held) > 1 else held[0][c]
                for c in names}
        for c in lists:
            rows[c] = np.concatenate([p[c][p[f"{c}_at"][0]:p[f"{c}_at"][-1]] for p in held])
            rows[f"{c}_at"] = starts_of(np.concatenate([np.diff(p[f"{c}_at"]) for p in held]))
        if sift:
            has = _possible(rows, num, den, apart)
            if has.any():
                found.append(np.stack([rows[c][has].astype(np.int64) for c in ("grp", "outer", "cls")]))
            return
        if links := _first_links(rows, num, den, apart):
            pairs = np.array(links, np.int64)
            found.append(np.stack([pairs.max(axis=1), pairs.min(axis=1)]))

    def emit():
        if found:
            cols = list(np.concatenate(found, axis=1))
            found.clear()
            if sift:
                cols[1] = cols[1].astype(bool)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols],
                                             names=["grp", "outer", "cls"] if sift else ["a", "b"])

    last = None
    for batch in batches:
        if not len(batch):
            continue
        cols = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in names}
        whole = {c: batch.column(c).flatten().to_numpy().view(U64) for c in lists}
        ends = {c: batch.column(c).offsets.to_numpy() - batch.column(c).offsets[0].as_py() for c in lists}
        block = np.stack([cols[c] for c in names[:3]], axis=1)
        cut = np.flatnonzero((block[1:] != block[:-1]).any(axis=1)) + 1
        start = 0
        for end in [*cut.tolist(), len(batch)]:
            if held and tuple(block[start]) != last:
                judge()
                held = []
            piece = {c: v[start:end] for c, v in cols.items()}
            for c in lists:
                piece[c], piece[f"{c}_at"] = whole[c], ends[c][start:end + 1]
            held.append(piece)
            last = tuple(block[start])
            start = end
        yield from emit()
    if held:
        judge()
    yield from emit()


def _dealt(outer: DataFrame, inner: DataFrame, sets: DataFrame) -> DataFrame:
    """The rows of all blocks with the columns of ``sets``, block by block."""
    lanes = lambda df, c, size: df.groupBy("grp").agg(
        F.ceil(F.count(F.lit(1)) / size).cast("int").alias(c))
    size = checkpoint(lanes(outer, "outers", OUTER).join(lanes(inner, "inners", INNER), "grp"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("cls"), F.col(n)).cast("int")
    sides = [(inner, False, "j", own("inners"), "i", every("outers")),
             (outer, True, "i", own("outers"), "j", every("inners"))]
    rows = None
    for df, flag, fixed, lane, spread, each in sides:
        side = df.join(size, "grp").withColumns({"outer": F.lit(flag), fixed: lane}) \
            .withColumn(spread, each).select("grp", "i", "j", "outer", "cls", "root")
        rows = side if rows is None else rows.unionAll(side)
    rest = [c for c in sets.columns if c != "cls"]
    return rows.join(sets, "cls").select("grp", "i", "j", "outer", "cls", "root", *rest) \
        .repartition("grp", "i", "j").sortWithinPartitions("grp", "i", "j")


def _close(outer: DataFrame, inner: DataFrame, confirm: Confirm) -> DataFrame:
    """(a, b) links of outer to inner (grp, cls, root) rows of one group that lie in
    different components: one at least for every outer class and component linked."""
    outer, inner = outer.distinct(), inner.distinct()
    limits = confirm.num, confirm.den, confirm.block_limit()
    if confirm.sift:
        left = checkpoint(_dealt(outer, inner, confirm.sketches)
                          .mapInArrow(lambda it: tidy(_blocks(it, *limits, sift=True)),
                                      "grp long, outer boolean, cls long").distinct())
        outer = checkpoint(outer.join(left.where("outer"), ["grp", "cls"], "left_semi"))
        inner = checkpoint(inner.join(left.where("not outer"), ["grp", "cls"], "left_semi"))
    return checkpoint(_dealt(outer, inner, confirm.sets)
                      .mapInArrow(lambda it: tidy(_blocks(it, *limits)), "a long, b long").distinct())


def _pairs(a: str, b: str) -> list:
    return [F.greatest(a, b).alias("a"), F.least(a, b).alias("b")]


def _open(members: DataFrame, comp: DataFrame, tasks: int) -> DataFrame:
    """(key, cls, root, main) of the buckets with several components; main: the largest."""
    root = comp.select(F.col("node").alias("cls"), "root")
    rooted = members.join(root, "cls", "left") \
        .select("key", "cls", F.coalesce("root", "cls").alias("root")).coalesce(tasks)
    size = rooted.groupBy("key", "root").agg(F.count(F.lit(1)).alias("c"))
    main = size.groupBy("key").agg(F.max_by("root", F.struct("c", "root")).alias("main"),
                                   F.count(F.lit(1)).alias("roots")).where("roots > 1")
    return checkpoint(rooted.join(main.drop("roots"), "key").coalesce(tasks))


def link_buckets(members: DataFrame, confirm: Confirm) -> DataFrame:
    """(node, root) of the components that the confirmed links within buckets make.

    ``members``: distinct (key, cls) of buckets with two members or more. All members
    meet their bucket's first hub. Closing: the members outside a bucket's largest
    component meet, once for all buckets, all of that component that share open
    buckets, and each other, bucket by bucket.
    """
    hub = F.min_by("cls", F.struct(F.xxhash64("cls"), "cls")).alias("hub")
    star = members.join(members.groupBy("key").agg(hub), "key").where("cls <> hub")
    star = star.select(F.col("cls").alias("a"), F.col("hub").alias("b")).coalesce(confirm.tasks)
    links = confirm(star).select(*_pairs("a", "b"))
    left = _open(members, components(links), confirm.tasks)
    outer = left.where("root <> main")
    grp = F.col("main").alias("grp")
    main = _close(outer.select(grp, "cls", "root"),
                  left.where("root = main").select(grp, "cls", "root"), confirm)
    rest = outer.select(F.col("key").alias("grp"), "cls", "root")
    return components(links.unionAll(main).unionAll(_close(rest, rest, confirm)))


def minhash_classes(docs: DataFrame, words: int = 2, num: int = 80, den: int = 100,
                    bands: int = BANDS, rows: int = ROWS, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document.

    Documents link when den * |intersection| >= num * |union| of their sets of
    ``words``-word shingles (A-Z lower-cased; fewer words: the whole sequence as
    one). ``bands * rows`` must be a multiple of 64. component_id is the smallest doc_id reachable by links, kept whether it
    is the document's own. Every link is exact; a pair at the threshold itself
    is missed with a chance of (1 - (num/den) ** rows) ** bands. Null, empty and
    blank texts have no shingles and are alone. Repeated rows stay rows; rows of
    one id with several texts are judged one by one. Rows without an id are dropped
    (a class needs a name). Other columns do not matter.
    """
    docs = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/minhash-{uuid.uuid4().hex}"
    docs.mapInArrow(lambda it: _index(it, words, bands, rows), INDEX).write.parquet(folder)
    found = spark.read.schema(INDEX).parquet(folder)
    rows_ = found.select("cls", "doc", "n")
    # Buckets of several classes.
    listed = found.where("keys is not null")
    tasks = tasks_for(listed.count() * bands)
    keyed = listed.select(F.explode("keys").alias("key"), "cls")
    shared = keyed.groupBy("key").agg(F.min("cls").alias("x"), F.max("cls").alias("y")) \
        .where("x <> y").select("key")
    members = checkpoint(keyed.join(shared, "key", "left_semi").distinct().coalesce(tasks))
    first = rows_.where("n > 0").groupBy("cls").agg(F.min("doc").alias("doc"))
    wanted = checkpoint(first.join(members.select("cls").distinct(), "cls", "left_semi")
                        .select("doc", "cls").coalesce(tasks))
    bins = bands * rows
    confirm = Confirm(_sets_of(docs, wanted, words, bins), num, den, most_apart(bins, num, den), tasks)
    comp = link_buckets(members, confirm)
    named = checkpoint(first.join(comp.withColumnRenamed("node", "cls"), "cls", "left")
                       .select("cls", "doc", F.coalesce("root", "cls").alias("root")).coalesce(tasks))
    least = named.groupBy("root").agg(F.min("doc").alias("component_id"))
    label = named.join(least, "root").select("cls", "component_id")
    return rows_.join(label, "cls", "left").select(
        F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc").alias("component_id"),
        (F.coalesce("component_id", "doc") == F.col("doc")).alias("kept"))
