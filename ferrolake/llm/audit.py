"""Filter interaction audit: what each filter removes after every order of the others.

Five filters judge a document by its whole text: A few words, B repeated words,
C capitals, D markup signs, E equal to the text of a document with a smaller id.
A document's *mask* says which filters it fails. All counts of all orders follow
from one small table: documents per (part, mask, good, toxic).

That table is kept by a stream over the files of the corpus (available-now
micro-batches). A to D are column expressions; E needs memory across files:

* each task first settles its own rows: of equal texts only those with the
  smallest id can still be first, the others fail E for certain and are counted
  at once. A text that makes up a third of all rows thus leaves one row per task;
* keyed state holds, per text (by its SHA-256), the smallest id so far and where its
  rows were counted. When a smaller id arrives, the old rows are retracted (-n
  under the mask without E, +n under the mask with E) and the new ones counted.
  Texts share a state value with about ``TEXTS`` others (a hash bucket; their number
  follows the counted rows), so that Python is called per bucket, not per text;
* every micro-batch writes its summed changes to the folder of its batch number,
  so a replayed batch replaces them; the part counters are the sum of all folders.

State lives in the session's state store and is checkpointed in the shared folder, so
it is not lost with an executor. The default store holds it in executor memory (about
100 bytes a text); where that is too much, the platform names the RocksDB store in
``spark.sql.streaming.stateStore.providerClass``.
"""

from __future__ import annotations

import math
import uuid
from itertools import permutations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .common import checkpoint, shared_folder, sized

FILTERS = "ABCDE"
E = 1 << FILTERS.index("E")
ORDERS = ["".join(p) for p in permutations(FILTERS)]

#: Rows that a task settles at once.
SETTLE_ROWS = 200_000

#: Texts, about, of one state value.
TEXTS = 1024

_ROWS = "key binary, id long, keyed boolean, part string, mask int, good int, toxic int, n long"
CHANGES = "part string, mask int, good int, toxic int, n long"


def words_of(text):
    return F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def own_mask(text, words):
    """Bits of the filters A to D that a text with these words fails."""
    n = F.size(words)
    upper = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = [n < 100, 100 * F.size(F.array_distinct(words)) < 80 * n,
             100 * upper > 10 * F.length(text), text.rlike("[#$%&*|]")]
    return sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(fails)), F.lit(0)).cast("int")


def masked(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           part_col: str = "lang") -> DataFrame:
    """(key, id, part, mask, good, toxic) per document; ``labels``: (id, good, toxic)."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"),
                       F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("words", words_of(F.col("text"))).select(
        "id", "part", own_mask(F.col("text"), F.col("words")).alias("mask"),
        F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("key"))
    return rows.join(labels, "id", "left").select(
        "key", "id", "part", "mask", F.coalesce("good", F.lit(0)).alias("good"),
        F.coalesce("toxic", F.lit(0)).alias("toxic"))


def label_flags(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, good, toxic) as 0 or 1, one row per id (of several labels the greater)."""
    flag = lambda c: F.max(F.when(F.col(c) == 1, 1).otherwise(0))
    return labels.where(F.col(id_col).isNotNull()).groupBy(
        F.col(id_col).cast("long").alias("id")).agg(flag("quality").alias("good"),
                                                    flag("toxic").alias("toxic"))


_OUT = pa.schema([("key", pa.binary()), ("id", pa.int64()), ("keyed", pa.bool_()),
                  ("part", pa.string()), ("mask", pa.int32()), ("good", pa.int32()),
                  ("toxic", pa.int32()), ("n", pa.int64())])
_SUMS = ["part", "mask", "good", "toxic"]


def _failing(t: pa.Table) -> pa.Table:
    """The rows with filter E among those that they fail."""
    mask = pc.bit_wise_or(t["mask"], pa.scalar(E, pa.int32()))
    return t.set_column(t.column_names.index("mask"), "mask", mask)


def _summed(tables: list[pa.Table], by: list[str]) -> pa.Table:
    t = pa.concat_tables([t.select([*by, "n"]) for t in tables])
    return t.group_by(by).aggregate([("n", "sum")]).rename_columns([*by, "n"])


def _split(t: pa.Table) -> tuple[pa.Table, pa.Table]:
    """Rows with the smallest id of their text, and all others."""
    least = t.group_by("key").aggregate([("id", "min")])
    both = t.join(least, "key")
    first = pc.equal(both["id"], both["id_min"])
    return both.filter(first), both.filter(pc.invert(first))


def _settled(t: pa.Table):
    """Rows of one task: the smallest id of each text stays keyed, all others are counted."""
    t = t.append_column("n", pa.array([1] * len(t), pa.int64()))
    t = t.cast(pa.schema([_OUT.field(c) for c in t.column_names]))
    first, late = _split(t.filter(pc.is_valid(t["id"])))
    keyed = _summed([first], ["key", "id", *_SUMS])
    yield keyed.append_column("keyed", pa.array([True] * len(keyed))).select(_OUT.names).cast(_OUT)
    # Certain to fail E: this task holds a smaller id. Rows without an id compare with none.
    rest = _summed([_failing(late), t.filter(pc.is_null(t["id"]))], _SUMS)
    # A key of its own per counter, so that the counters of all tasks meet spread.
    name = pc.binary_join_element_wise(rest["part"], *[pc.cast(rest[c], pa.string())
                                                       for c in _SUMS[1:]], "|")
    for c, v in (("key", name.cast(pa.binary())), ("id", pa.array([0] * len(rest), pa.int64())),
                 ("keyed", pa.array([False] * len(rest)))):
        rest = rest.append_column(c, v)
    yield rest.select(_OUT.names).cast(_OUT)


def settle(batches):
    held, rows = [], 0
    for b in batches:
        held.append(b)
        rows += len(b)
        if rows >= SETTLE_ROWS:
            for t in _settled(pa.Table.from_batches(held)):
                yield from t.to_batches()
            held, rows = [], 0
    if rows:
        for t in _settled(pa.Table.from_batches(held)):
            yield from t.to_batches()


_STATE = pa.schema([f for f in _OUT if f.name != "keyed"])


def merge(old: pa.Table | None, new: pa.Table) -> tuple[pa.Table, pa.Table]:
    """(state, changes): the first rows of each text, and what the new rows change.

    ``old``: the state so far, ``new``: rows that their tasks settled.
    """
    counted = new.filter(pc.invert(new["keyed"]))
    new = new.filter(new["keyed"]).select(_STATE.names)
    old = _STATE.empty_table() if old is None else old
    both = pa.concat_tables([t.append_column("old", pa.array([o] * len(t), pa.bool_()))
                             for t, o in ((old, True), (new, False))])
    first, late = _split(both)
    # Rows that are no longer first were counted without E.
    back = late.filter(late["old"])
    back = back.set_column(back.column_names.index("n"), "n", pc.negate(back["n"]))
    changes = [counted, first.filter(pc.invert(first["old"])), _failing(late), back]
    return _summed([first], ["key", "id", *_SUMS]).select(_STATE.names), _summed(changes, _SUMS)


def _update(key: tuple, frames, state: GroupState):
    """Changes of the part counters by the rows of one bucket of texts."""
    new = pa.concat_tables([pa.Table.from_pandas(f[_OUT.names], _OUT, preserve_index=False)
                            for f in frames])
    old = pa.ipc.open_stream(state.get[0]).read_all() if state.exists else None
    kept, changes = merge(old, new)
    if len(kept):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, kept.schema) as out:
            out.write_table(kept)
        state.update((sink.getvalue().to_pybytes(),))
    yield changes.to_pandas()


def stream_changes(stream: DataFrame, labels: DataFrame, buckets: int, **columns) -> DataFrame:
    """The changes (part, mask, good, toxic, n) that a stream of documents makes."""
    settled = masked(stream, labels, **columns).mapInArrow(settle, _ROWS)
    bucket = F.pmod(F.xxhash64("key"), F.lit(buckets))
    return (settled.withColumn("bucket", bucket).groupBy("bucket")
            .applyInPandasWithState(_update, CHANGES, "texts binary", "append",
                                    GroupStateTimeout.NoTimeout))


def count_masks(spark: SparkSession, path: str, labels: DataFrame, batches: int = 4,
                **columns) -> DataFrame:
    """(part, mask, good, toxic, n) of the Parquet files under ``path``, counted by a
    stream of about ``batches`` micro-batches."""
    flags = checkpoint(label_flags(labels))
    flags = sized(flags, flags.count())
    path = path.rstrip("/")
    base = spark.read.parquet(path)
    files = max(1, len(base.inputFiles()))
    buckets = 1 + base.count() // TEXTS
    folder = f"{shared_folder(spark)}/audit-{uuid.uuid4().hex}"
    # The folder is there even if no batch has a row.
    spark.createDataFrame([], CHANGES).write.parquet(f"{folder}/changes/batch=-1")

    def save(changes: DataFrame, number: int) -> None:
        (changes.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))
         .write.mode("overwrite").parquet(f"{folder}/changes/batch={number}"))

    # As a pattern (of one name), so that the path may be a folder or a single file.
    source = (spark.readStream.schema(base.schema)
              .option("maxFilesPerTrigger", math.ceil(files / batches))
              .parquet(f"{path[:-1]}[{path[-1]}]"))
    query = (stream_changes(source, flags, buckets, **columns).writeStream.foreachBatch(save)
             .option("checkpointLocation", f"{folder}/stream")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return (spark.read.schema(CHANGES).parquet(f"{folder}/changes")
            .groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n")))


def interactions(counts: DataFrame) -> DataFrame:
    """One row per part, order of the five filters and step, from the part counters."""
    orders = F.explode(F.split(F.lit(" ".join(ORDERS)), " ")).alias("filter_order")
    rows = counts.select("*", orders).select("*", F.posexplode(F.filter(
        F.split("filter_order", ""), lambda x: x != "")).alias("at", "letter"))
    own = F.expr("shiftleft(1, ascii(letter) - ascii('A'))")
    rows = rows.withColumn("own", own).withColumn("before", F.expr(
        "aggregate(filter(split(substr(filter_order, 1, at), ''), x -> x <> ''), 0, "
        "(s, x) -> s + shiftleft(1, ascii(x) - ascii('A')))"))
    fails = F.col("mask").bitwiseAND(F.col("own")) != 0
    gone = F.col("mask").bitwiseAND(F.col("before")) != 0
    count = lambda c, n="n": F.sum(F.when(c, F.col(n)).otherwise(0)).cast("long")
    removed = fails & ~gone
    out = rows.groupBy("part", "filter_order", (F.col("at") + 1).cast("int").alias("step"),
                       "letter").agg(
        count(~fails & ~gone).alias("kept"), count(removed).alias("removed"),
        count(fails & gone).alias("redundant"),
        count(F.col("mask") == F.col("own")).alias("unique_fails"),
        count(removed & (F.col("good") == 1)).alias("good_lost"),
        count(removed & (F.col("toxic") == 1)).alias("toxic_lost"))
    # 120 rows per part and filter.
    share = F.sum("removed").over(Window.partitionBy("part", "letter")).cast("long")
    return out.withColumn("shapley", share).drop("letter")


def audit(spark: SparkSession, path: str, labels: DataFrame, batches: int = 4,
          **columns) -> DataFrame:
    """The interaction table of the documents in the Parquet files under ``path``.

    One row per part (null: empty string), order and step: kept, removed,
    redundant, unique_fails, good_lost, toxic_lost, shapley. Null texts count as
    empty. Rows without an id are equal to none and make none equal. Repeated rows
    of one id count each; neither is removed for the other. Of several labels of an
    id any 1 counts. No files or rows give no rows. Other columns do not matter.
    """
    return interactions(count_masks(spark, path, labels, batches, **columns))
