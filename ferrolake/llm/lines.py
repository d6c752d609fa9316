"""Line dedup by a log-template tree.

Every non-blank line is parsed to a fixed depth: its token count and its first
``depth`` tokens name a leaf (tokens with a digit are variable fields, ``<*>``).
Inside a leaf, a token is a constant of its position if enough documents have
it there; other positions are variable fields too. The line with its variable
fields replaced is its template, if at least ``constant`` of its positions are
constants. A template that stands in ``min_docs`` documents or more is
recurring: its lines are dropped from every document but the first (smallest
doc_id) that holds the template, so the text itself survives once.

A line of enough constants (tokens without a digit) whose unmasked tokens are
equal in ``equal_docs`` documents recurs too, whatever its template does; it
stays in the first of those.

A ``<*>`` is no constant, whatever recurs. A line whose tokens without a digit
are fewer than ``constant`` of its positions (a row of numbers) has no template;
it recurs only where its unmasked tokens are equal in ``min_docs`` documents.

Two levels keep this cheap and exact. Lines whose masked text alone recurs are
templates at once (all their tokens without a digit are constant). Only the
other lines of leaves that many documents reach are opened token by token.

All counts are Spark aggregates with map-side combining over (leaf, line) and
(leaf, position, token) hashes, over all documents; no leaf is ever collected.
Counting follows documents, not rows or lines: a task hands on each line of a
document once. A line that ``min_docs`` documents hold settles its constants and
its template alone; the others have fewer documents, which are carried along and
counted distinctly.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, give_back, sized, sized_lists, text_pieces, tidy, worker_state

DEPTH = 4
MIN_DOCS = 3
EQUAL_DOCS = 2
CONSTANT = 0.7
#: Bytes of text handled at once inside a task.
CHUNK = 1_000_000
_DIGITS = b"0123456789"
_HAS_DIGIT = re.compile(rb"[0-9]").search
WILD = b"<*>"
#: From the first visible character of a line to its end.
LINE = r"\S[^\n]*"
#: No number of documents makes the masked line alone a template.
NEVER = (1 << 31) - 1


def _hash(x: bytes, seed: int = 0) -> int:
    h = xxhash.xxh64_intdigest(x, seed)
    return h - (1 << 64) if h >= 1 << 63 else h


def masked(line: bytes) -> bytes:
    """The line's tokens joined by one blank, fields with a digit as ``<*>``."""
    tokens = line.split()
    if len(line.translate(None, _DIGITS)) < len(line):
        tokens = [WILD if _HAS_DIGIT(t) else t for t in tokens]
    return b" ".join(tokens)


def parse(line: bytes, depth: int, min_docs: int, constant: float, equal_docs: int) -> tuple:
    """The line's (leaf, key, documents from which the key alone recurs); none for a
    blank line. First its masked text; one with a ``<*>`` also has its unmasked text,
    outside the tree (leaf None)."""
    m = masked(line)
    if not m:
        return ()
    tokens = m.split(b" ")
    n = len(tokens)
    leaf = _hash(b"%d %s" % (n, b" ".join(tokens[:depth])))
    if WILD not in m:
        return (leaf, _hash(m), equal_docs),
    own = _hash(b" ".join(line.split()), 1)
    if (n - tokens.count(WILD)) / n >= constant:
        return (leaf, _hash(m), min_docs), (None, own, equal_docs)
    return (leaf, _hash(m), NEVER), (None, own, min_docs)


def _texts(batches):
    """(rows, texts) in pieces of bounded text length."""
    return text_pieces(batches, CHUNK)


class _Parsed(dict):
    """line bytes -> its keys by ``parse``, filled on demand and cleared when large."""

    def __init__(self, *rule):
        super().__init__()
        self.rule = rule

    def __missing__(self, line: bytes):
        p = self[line] = parse(line, *self.rule)
        return p

    def trim(self) -> None:
        if len(self) > 20_000:  # lines that recur often are back at once
            self.clear()


def _lines(batches, *rule):
    """(doc, leaf, line, need): each distinct key of a document's lines once."""
    worker_state("lines")
    known = _Parsed(*rule)
    for b, texts in _texts(batches):
        docs, leaf, line, need = [], [], [], []
        for d, t in zip(b.column(0).to_pylist(), texts):
            if not t:
                continue
            for p in {k for x in set(t.split(b"\n")) for k in known[x]}:
                docs.append(d)
                leaf.append(p[0])
                line.append(p[1])
                need.append(p[2])
        known.trim()
        yield pa.RecordBatch.from_arrays(
            [pa.array(docs, pa.int64()), pa.array(leaf, pa.int64()), pa.array(line, pa.int64()),
             pa.array(need, pa.int32())], names=["doc", "leaf", "line", "need"])


def _opened(batches, *rule):
    """(line, masked text) of the wanted line hashes of each document."""
    worker_state("lines")
    known = _Parsed(*rule)
    for b, texts in _texts(batches):
        line, text = [], []
        for want, t in zip(b.column(0).to_pylist(), texts):
            want = set(want)
            for x in t.split(b"\n"):
                p = known[x]
                if p and p[0][1] in want:
                    want.discard(p[0][1])
                    line.append(p[0][1])
                    text.append(masked(x))
        known.trim()
        yield pa.RecordBatch.from_arrays([pa.array(line, pa.int64()), pa.array(text, pa.binary())],
                                         names=["line", "masked"])


def recurring_lines(docs: DataFrame, depth: int = DEPTH, min_docs: int = MIN_DOCS,
                    constant: float = CONSTANT,
                    equal_docs: int = EQUAL_DOCS) -> tuple[DataFrame, DataFrame]:
    """(rows, dropped): all (doc, leaf, line, need) rows, and (line, first) of the lines
    that recur, with the smallest document that holds the template or the equal line."""
    equal_docs = min(equal_docs, min_docs)
    rule = depth, min_docs, constant, equal_docs
    rows = checkpoint(docs.select("doc_id", "text").mapInArrow(
        lambda it: tidy(_lines(it, *rule)), "doc long, leaf long, line long, need int"))
    lines = checkpoint(rows.groupBy("leaf", "line").agg(
        F.countDistinct("doc").alias("n") if _repeats(docs) else F.count(F.lit(1)).alias("n"),
        F.min("doc").alias("first"), F.max("need").alias("need")))
    exact = lines.where(F.col("n") >= F.col("need"))
    tree = lines.where("leaf IS NOT NULL").drop("need")
    rare = tree.where(F.col("n") < min_docs)
    # A template of rare lines needs a leaf that enough documents reach; the sum over
    # its lines is never less than its documents.
    reach = tree.groupBy("leaf").agg(F.sum("n").alias("reach"), F.min("n").alias("least")) \
        .where((F.col("reach") >= min_docs) & (F.col("least") < min_docs)).select("leaf")
    opened = _open(docs, tree.join(reach, "leaf"), rule)
    few = checkpoint(rare.join(reach, "leaf", "left_semi").select("line"))
    holders = rows.where("leaf IS NOT NULL").join(sized(few, few.count()), "line") \
        .groupBy("line").agg(F.collect_set("doc").alias("docs"))
    opened = checkpoint(opened.join(holders, "line", "left"))
    general = _general(opened, rare, min_docs, constant)
    return rows, exact.select("line", "first").unionAll(general)


def _repeats(docs: DataFrame) -> bool:
    """Whether some doc_id has several rows (then documents are counted distinctly)."""
    return bool(docs.groupBy("doc_id").count().where("count > 1").limit(1).count())


def _open(docs: DataFrame, lines: DataFrame, rule: tuple) -> DataFrame:
    """(leaf, line, n, first, masked): one masked text per line, read from its
    smallest document (the only one that has to be read)."""
    lines = checkpoint(lines)
    wanted = lines.groupBy(F.col("first").alias("doc")).agg(F.collect_list("line").alias("want"))
    wanted = checkpoint(wanted)
    near = docs.join(sized_lists(wanted, "want"), docs["doc_id"] == wanted["doc"]) \
        .select("want", "text").where("text IS NOT NULL")
    text = near.mapInArrow(lambda it: tidy(_opened(it, *rule)), "line long, masked binary")
    return lines.join(text.groupBy("line").agg(F.first("masked").alias("masked")), "line")


def _general(opened: DataFrame, rare: DataFrame, min_docs: int, constant: float) -> DataFrame:
    """(line, first) of the rare lines whose generalised template recurs."""
    token = opened.select("leaf", "line", "n", "first", "docs",
                          F.posexplode(F.split(F.col("masked").cast("string"), " "))
                          .alias("pos", "tok")) \
        .select("leaf", "line", "n", "first", "docs", "pos", F.xxhash64("tok").alias("tok"))
    fixed = _enough(token.where(F.col("tok") != F.xxhash64(F.lit(WILD.decode()))),
                    ["leaf", "pos", "tok"], min_docs) \
        .select("leaf", "pos", "tok", F.lit(1).alias("fixed"))
    shown = token.drop("docs").join(fixed, ["leaf", "pos", "tok"], "left")
    # The template's hash: constants by value and place, all else alike.
    template = shown.groupBy("leaf", "line").agg(
        F.first("n").alias("n"), F.first("first").alias("first"),
        F.avg(F.coalesce("fixed", F.lit(0))).alias("share"),
        F.sum(F.when(F.col("fixed") == 1, F.xxhash64("pos", "tok")).otherwise(0)
              .cast("decimal(38,0)")).alias("template")) \
        .where(F.col("share") >= constant)
    template = template.join(opened.select("leaf", "line", "docs"), ["leaf", "line"])
    recurring = _enough(template, ["leaf", "template"], min_docs)
    again = template.join(recurring, ["leaf", "template"]).select("leaf", "line", "oldest")
    return again.join(rare.select("leaf", "line"), ["leaf", "line"]).select(
        "line", F.col("oldest").alias("first"))


def _enough(df: DataFrame, key: list[str], min_docs: int) -> DataFrame:
    """(key, most, held, oldest) of the keys that ``min_docs`` documents hold: by one
    line (``n``), or counted over the ``docs`` of the lines that fewer hold."""
    return df.select(*key, "n", "first", F.explode_outer("docs").alias("doc")) \
        .groupBy(*key).agg(F.max("n").alias("most"), F.countDistinct("doc").alias("held"),
                           F.min("first").alias("oldest")) \
        .where((F.col("most") >= min_docs) | (F.col("held") >= min_docs))


def drop_recurring(docs: DataFrame, depth: int = DEPTH, min_docs: int = MIN_DOCS,
                   constant: float = CONSTANT, id_col: str = "doc_id",
                   text_col: str = "text", equal_docs: int = EQUAL_DOCS) -> DataFrame:
    """``docs`` with ``n_lines``, ``n_dropped`` and the text left in ``kept``.

    Lines end at ``\\n``; blank lines are never dropped and do not count as
    lines. A null text has no lines and stays null in ``kept``. Rows without an
    id lose nothing and count nowhere. Several rows of a doc_id are one
    document. Other columns are kept; the three new ones replace columns of the
    same name.
    """
    base = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows, dropped = recurring_lines(base, depth, min_docs, constant, equal_docs)
    hit = (rows.join(dropped, "line").where(F.col("doc") > F.col("first"))
           .groupBy("doc").agg(F.collect_set("line").alias("gone")))
    hit = checkpoint(hit)
    side = hit.select(F.col("doc").alias("__doc"), F.col("gone").alias("__gone"))
    left = docs.drop("n_lines", "n_dropped", "kept")
    both = left.join(sized_lists(side, "__gone"), F.col(id_col).cast("long") == F.col("__doc"), "left")

    def cut(text: pa.Array, gone: pa.Array) -> pa.Array:
        worker_state("lines")
        give_back()
        known = _Parsed(depth, min_docs, constant, min(equal_docs, min_docs))
        done = [pa.array([], pa.struct([("less", pa.int64()), ("kept", pa.string())]))]
        for part, texts in _texts([pa.RecordBatch.from_arrays([gone, text], names=["gone", "text"])]):
            less, kept = [], []
            for t, g in zip(texts, part.column(0).to_pylist()):
                if t is None:
                    less.append(0)
                    kept.append(None)
                    continue
                g, lines = set(g), t.split(b"\n")
                stay = [x for x in lines if not any(p[1] in g for p in known[x])]
                less.append(len(lines) - len(stay))
                kept.append(b"\n".join(stay))
                known.trim()
            done.append(pa.StructArray.from_arrays(
                [pa.array(less, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                names=["less", "kept"]))
        return pa.concat_arrays(done)

    # Only texts that lose lines go to Python.
    trimmed = F.arrow_udf(cut, "less long, kept string")
    text, loses = F.col(text_col), F.col("__gone").isNotNull()
    out = both.withColumn("__r", trimmed(F.when(loses, text), F.col("__gone")))
    return out.select(*left.columns,
                      F.coalesce(F.regexp_count(text, F.lit(LINE)), F.lit(0)).cast("long").alias("n_lines"),
                      F.when(loses, F.col("__r.less")).otherwise(F.lit(0)).alias("n_dropped"),
                      F.when(loses, F.col("__r.kept")).otherwise(text).alias("kept"))
