"""Corpus pipeline: five training-data operators in a row over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``documents``. Rows of one doc_id are one document; rows
without an id pass every stage but the classifier's.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrolake.llm import bpe, decontam, jaccard, lines, ordinal
from ferrolake.llm.common import checkpoint, read_table, shared_folder, sized

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

#: Not expressible in SQL (trained model, SimHash, merges): see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of the best grade is at least one half."""
    grades = ordinal.document_grades(read_table(spark, sf_dir, "labels"))
    model = ordinal.train(docs, grades, grades=3, sample=ordinal.SAMPLE)
    return ordinal.select(ordinal.rate(docs, model, keep_grade=2), least=0.5).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their recurring lines; one that loses all its lines goes."""
    out = lines.drop_recurring(docs)
    left = out.where((F.col("n_dropped") == 0) | (F.col("n_dropped") < F.col("n_lines")))
    text = F.when(F.col("n_dropped") > 0, F.col("kept")).otherwise(F.col("text"))
    size = F.when(F.col("n_dropped") > 0, F.length("kept").cast("long")).otherwise(F.col("n_chars"))
    return left.withColumns({"text": text, "n_chars": size}).select(*docs.columns)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates."""
    found = jaccard.jaccard_components(docs, words=5, num=75, den=100)
    gone = checkpoint(found.where("component_id <> doc_id").select("doc_id").distinct())
    return docs.join(sized(gone, gone.count()), "doc_id", "left_anti").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontam.drop_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, token_ids, n_tokens, exact): the tokens of each document,
    and whether they decode to its text again."""
    back = bpe.encode_documents(docs, VOCABULARY, public_tokenizers.PATTERN, decoded="decoded")
    return back.select("doc_id", "lang", "source", "token_ids",
                       F.size("token_ids").cast("long").alias("n_tokens"),
                       (F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary"))
                       .alias("exact"))


STAGES = [("quality classifier", quality_classifier), ("line dedup", line_dedup),
          ("n-gram Jaccard join", ngram_jaccard), ("benchmark decontamination", decontamination),
          ("byte-level BPE", byte_bpe)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` of ``sf_dir``; each is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return docs
