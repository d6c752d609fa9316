"""Quality classifier: ordinal cumulative-link regression on hashed text features.

Ratings are ordered grades 0 < 1 < ... < K. One weight vector w over hashed
text features is shared by all grades, with ordered thresholds t_1 < ... < t_K:

    P(grade >= k) = sigmoid(w . x - t_k)

The expected grade is the sum of these; a document is selected by its tail
probability P(grade >= keep_grade).

Features of a text (all of it): its distinct lower-cased words and their byte
prefixes, and the shares of capitals, symbols, digits, distinct words and the line
lengths in steps, each with all steps below it; hashed to ``BUCKETS``. Presence
counts once.

The fit reads a bounded sample (``sample`` labelled documents, those of least
hash) in one task, to which only their extracted features move: features that tell grades apart (chi-square) are kept, then
the penalised likelihood is climbed. The model is a table of at most
``FEATURES`` weights. Scoring is one pass over the documents without a shuffle.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binary, flatten, give_back, sized, starts_of, tidy, worker_state

BUCKETS = 1 << 18
FEATURES = 4096
SAMPLE = 12_000
PREFIXES = (5, 6, 7)
#: Texts scored at once.
PIECE = 256
#: Least chi-square (1 degree of freedom) of a kept feature, and its least documents.
SIGNIFICANT, SUPPORT = 11.0, 3

_SYMBOLS = b"!\"#$%&*+/<=>?@[\\]^_`{|}~"
_PUNCT = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256))
_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))


def _bucket(x: bytes) -> int:
    return xxhash.xxh64_intdigest(x) & (BUCKETS - 1)


class WordFeatures(dict):
    """word -> buckets of the word and its prefixes (those in ``only``, if given)."""

    def __init__(self, only: frozenset | None = None):
        super().__init__()
        self.only = only

    def __missing__(self, w: bytes) -> tuple:
        f = [_bucket(b"w" + w)] + [_bucket(b"%d" % n + w[:n]) for n in PREFIXES if len(w) >= n]
        if self.only is not None:
            f = [x for x in f if x in self.only]
        self[w] = f = tuple(f)
        return f

    def trim(self) -> None:
        if len(self) > 100_000:
            self.clear()


def _bin(part: int, whole: int) -> int:
    """0 for none, else a step for each doubling of the share from 1/256 up."""
    if not part or not whole:
        return 0
    return 1 + max(0, 8 + math.floor(math.log2(part / whole)))


def shape_features(text: bytes, n_words: int, n_distinct: int) -> list[int]:
    n = len(text)
    lines = text.count(b"\n") + 1
    shares = {b"upper": _bin(n - len(text.translate(None, _UPPER)), n),
              b"symbol": _bin(n - len(text.translate(None, _SYMBOLS)), n),
              b"digit": _bin(n - len(text.translate(None, _DIGITS)), n),
              b"distinct": int(8 * n_distinct / n_words) if n_words else -1,
              b"line": min(12, int(math.log2(1 + n_words / lines)))}
    return [f for kv in shares.items() for f in _steps(*kv)]


_STEPS: dict = {}


def _steps(name: bytes, step: int) -> list[int]:
    """Buckets of a share's step and of all steps below it, so that documents of
    neighbouring steps tell about each other."""
    found = _STEPS.get((name, step))
    if found is None:
        found = _STEPS[name, step] = [_bucket(b"s:%s:%d" % (name, i)) for i in range(step + 1)]
    return found


def features(text: bytes | None, known: WordFeatures) -> set:
    """Buckets present in a text (null: those of the empty text)."""
    text = text or b""
    words = text.lower().translate(_PUNCT).split()
    seen = set(words)
    out = set(shape_features(text, len(words), len(seen)))
    for f in map(known.__getitem__, seen):
        if f:
            out.update(f)
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


def fit_ordinal(x: np.ndarray, lens: np.ndarray, y: np.ndarray, n_features: int, grades: int,
                penalty: float = 1e-3, steps: int = 400) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) by Adam on the mean cumulative-link log likelihood.

    ``x``: concatenated feature indices of the rows, ``lens`` per row. Thresholds
    are t_1 and positive steps, so they stay ordered.
    """
    row = np.repeat(np.arange(len(lens)), lens)
    w = np.zeros(n_features)
    tail = np.array([np.clip((y >= k).mean(), 1e-3, 1 - 1e-3) for k in range(1, grades)])
    t = -np.log(tail / (1 - tail))
    gap = np.log(np.maximum(np.diff(t), 1e-2))
    p = np.concatenate([w, t[:1], gap])
    m, v = np.zeros_like(p), np.zeros_like(p)
    n = len(y)
    for step in range(1, steps + 1):
        w, first, gap = p[:n_features], p[n_features], p[n_features + 1:]
        t = np.concatenate([[first], first + np.cumsum(np.exp(gap))])
        s = np.bincount(row, w[x], n)
        up = np.concatenate([np.ones((n, 1)), _sigmoid(s[:, None] - t[None, :]), np.zeros((n, 1))],
                            axis=1)  # P(grade >= k), k = 0..grades
        a, b = up[np.arange(n), y], up[np.arange(n), y + 1]
        like = np.maximum(a - b, 1e-12)
        da, db = a * (1 - a) / like, b * (1 - b) / like
        gs = -(da - db) / n
        gw = np.bincount(x, gs[row], n_features) + penalty * w
        gt = np.zeros(grades)  # by threshold index 1..grades-1 (0 and the end are fixed)
        np.add.at(gt, y, np.where(y > 0, da, 0) / n)
        hit = y + 1 < grades
        np.add.at(gt, (y + 1)[hit], -db[hit] / n)
        gt = gt[1:]
        back = np.cumsum(gt[::-1])[::-1]
        g = np.concatenate([gw, back[:1], back[1:] * np.exp(gap)])
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        rate = 0.1 * (1 - step / (steps + 1))
        p = p - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    w, first, gap = p[:n_features], p[n_features], p[n_features + 1:]
    return w, np.concatenate([[first], first + np.cumsum(np.exp(gap))])


def choose_features(x: np.ndarray, lens: np.ndarray, y: np.ndarray, grades: int) -> np.ndarray:
    """Buckets whose presence depends on some split of the grades, strongest first."""
    row = np.repeat(np.arange(len(lens)), lens)
    have = np.bincount(x, minlength=BUCKETS).astype(float)
    n, best = len(y), np.zeros(BUCKETS)
    for k in range(1, grades):
        high = float((y >= k).sum())
        if not 0 < high < n:
            continue
        both = np.bincount(x, (y[row] >= k).astype(float), BUCKETS)
        want = have * high / n
        with np.errstate(divide="ignore", invalid="ignore"):
            chi = (both - want) ** 2 * n / (want * (1 - high / n) * (n - have) + 1e-12)
        best = np.maximum(best, np.nan_to_num(chi))
    keep = np.flatnonzero((best >= SIGNIFICANT) & (have >= SUPPORT))
    return keep[np.argsort(-best[keep], kind="stable")][:FEATURES]


class OrdinalModel:
    """Weights by bucket and ordered thresholds; grades 0..len(thresholds)."""

    def __init__(self, weights: dict[int, float], thresholds: list[float]):
        self.weights, self.thresholds = weights, list(thresholds)

    def tails(self, score: float) -> list[float]:
        return [0.5 * (1 + math.tanh(0.5 * (score - t))) for t in self.thresholds]

    def score(self, text: bytes | None, known: WordFeatures) -> float:
        w = self.weights
        # Summed in a fixed order: equal texts get equal scores to the last bit.
        return sum(w[f] for f in sorted(features(text, known)) if f in w)


def train(docs: DataFrame, ratings: DataFrame, grades: int, sample: int = SAMPLE,
          id_col: str = "doc_id", text_col: str = "text") -> OrdinalModel | None:
    """Fit on at most ``sample`` rated documents; ``ratings``: (doc_id, grade).

    Several ratings of a document count as its lowest; null and out-of-range
    ones are left out. None if fewer than two grades occur.
    """
    rated = (ratings.where(F.col("grade").between(0, grades - 1) & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.min("grade").cast("int").alias("grade"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    text = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = text.join(sized(rated, sample), "doc_id").select("text", "doc_id", "grade")

    def extract(batches):
        worker_state("ordinal")
        known = WordFeatures()
        for b in batches:
            found = []
            for t in binary(b.column(0)):
                found.append(np.fromiter(sorted(features(t, known)), np.int32))
                known.trim()
            flat = np.concatenate(found) if found else np.empty(0, np.int32)
            at = starts_of(np.fromiter(map(len, found), np.int64, len(found)))
            yield pa.RecordBatch.from_arrays(
                [b.column(1), b.column(2), pa.ListArray.from_arrays(pa.array(at, pa.int32()),
                                                                    pa.array(flat))],
                names=["doc_id", "grade", "x"])

    def fit(batches):
        ids, y, x, lens = [], [], [], []
        for b in batches:
            ids.append(b.column(0).to_numpy(zero_copy_only=False))
            y.append(b.column(1).to_numpy(zero_copy_only=False))
            x.append(b.column(2).flatten().to_numpy())
            lens.append(b.column(2).value_lengths().to_numpy())
        if not y:
            return
        ids, y, x, lens = (np.concatenate(v) for v in (ids, y, x, lens))
        # The same order whatever the partitioning was.
        order = np.lexsort((lens, y, ids))
        at = starts_of(lens)[:-1]
        x, y, lens = x[flatten(at[order], lens[order].astype(np.int64))], y[order], lens[order]
        if len(set(y.tolist())) < 2:
            return
        keep = np.sort(choose_features(x, lens, y, grades))
        where = np.full(BUCKETS, -1, np.int64)
        where[keep] = np.arange(len(keep))
        row = np.repeat(np.arange(len(lens)), lens)
        used = where[x] >= 0
        w, t = fit_ordinal(where[x[used]], np.bincount(row[used], minlength=len(y)), y, len(keep),
                           grades)
        yield pa.RecordBatch.from_arrays(
            [pa.array([keep.tolist()], pa.list_(pa.int32())),
             pa.array([w.tolist()], pa.list_(pa.float64())),
             pa.array([t.tolist()], pa.list_(pa.float64()))], names=["bucket", "weight", "threshold"])

    found = rows.mapInArrow(
        lambda it: tidy(extract(it)), "doc_id long, grade int, x array<int>").repartition(1).mapInArrow(
        lambda it: tidy(fit(it)), "bucket array<int>, weight array<double>, threshold array<double>").collect()
    if not found:
        return None
    m = found[0]
    return OrdinalModel(dict(zip(m.bucket, m.weight)), m.threshold)


def rate(docs: DataFrame, model: OrdinalModel | None, keep_grade: int, text_col: str = "text") -> DataFrame:
    """``docs`` with ``expected_grade`` and ``tail_probability`` P(grade >= keep_grade).

    Both are null without a model. Columns of these names are replaced.
    """
    docs = docs.drop("expected_grade", "tail_probability")
    if model is None:
        return docs.withColumn("expected_grade", F.lit(None).cast("double")) \
            .withColumn("tail_probability", F.lit(None).cast("double"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def score(text: pa.Array) -> pa.Array:
        m = sent.value
        known = _known(m)
        give_back()
        grade, tail = [], []
        for at in range(0, len(text), PIECE):
            for t in binary(text.slice(at, PIECE)):
                p = m.tails(m.score(t, known))
                grade.append(sum(p))
                tail.append(p[keep_grade - 1])
            known.trim()
        return pa.StructArray.from_arrays([pa.array(grade, pa.float64()), pa.array(tail, pa.float64())],
                                          names=["grade", "tail"])

    rated = F.arrow_udf(score, "grade double, tail double")
    out = docs.withColumn("__r", rated(F.col(text_col)))
    return out.select(*docs.columns, F.col("__r.grade").alias("expected_grade"),
                      F.col("__r.tail").alias("tail_probability"))


def _known(model: OrdinalModel) -> WordFeatures:
    """The worker's word cache for a model."""
    kept = worker_state("ordinal")
    if kept.get("model") is not model:
        kept.update(model=model, words=WordFeatures(frozenset(model.weights)))
    return kept["words"]


def select(rated: DataFrame, least: float = 0.5) -> DataFrame:
    """Rows whose tail probability is at least ``least`` (all rows without a model)."""
    return rated.where(F.col("tail_probability").isNull() | (F.col("tail_probability") >= least))


def document_grades(labels: DataFrame) -> DataFrame:
    """(doc_id, grade) of the labels: 0 toxic, 1 not toxic but of low quality, 2 good."""
    return labels.select("doc_id", F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1)
                         .when((F.col("quality") == 1) & (F.col("toxic") == 0), 2).alias("grade"))
