"""Registered queries of the training-data operators, with their SQL twins.

Each query applies its operator with production parameters to the whole of its
table. Where SQL is practical on whole tables, ``ORACLE`` holds it; the others
are held against brute force in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (ann, audit, bpe, chat, decontam, jaccard, licenses, lines, minhash, oracle, ordinal,
               periods, substrings, urls)
from .common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@register("op2_bpe")
def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(bpe.encode_documents(docs, VOCABULARY, public_tokenizers.PATTERN,
                                            decoded="decoded"))


@register("op7_ngram_jaccard", oracle.jaccard_sql())
def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(read_table(spark, sf_dir, "documents"), words=5, num=75,
                                      den=100)


@register("op10_substring_dedup", oracle.substrings_sql())
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.kept_digest(
        substrings.drop_repeats(read_table(spark, sf_dir, "documents"), window=50))


@register("op6_decontamination")
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(read_table(spark, sf_dir, "documents"),
                               read_table(spark, sf_dir, "benchmark"), threshold=0.75, radius=20)


@register("op9_line_dedup")
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = lines.drop_recurring(docs, depth=4, min_docs=3, constant=0.7)
    return out.select("doc_id", "n_lines", "n_dropped",
                      F.sha2(F.coalesce("kept", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


@register("op5_quality_classifier")
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The selected documents with their expected grade and P(good)."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    grades = ordinal.document_grades(read_table(spark, sf_dir, "labels"))
    model = ordinal.train(docs, grades, grades=3, sample=ordinal.SAMPLE)
    return ordinal.select(ordinal.rate(docs, model, keep_grade=2), least=0.5).drop("text")


@register("op1_url_filter", oracle.urls_sql())
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judges every page's url: the rules, else the list of insulting pages' urls."""
    pages = read_table(spark, sf_dir, "pages")
    judged = urls.judge(pages.select("page_id", "url"), urls.RULES, urls.insult_list(pages))
    return judged.select("page_id", "host", "path", "rule", "verdict")


@register("op4_chat_format", oracle.chat_sql())
def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)],
                                "conv_id long, turn long, role string, text string")
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(chat.format_chats(turns.unionByName(own)))


@register("op8_license_scan", oracle.licenses_sql())
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


@register("op3_nearest_neighbours")
def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@register("op13_periodic_runs")
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return periods.digests(periods.periodic_runs(periods.plant_periods(docs), least=12))


@register("op12_filter_audit", oracle.audit_sql())
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(spark, f"{sf_dir}/documents.parquet", read_table(spark, sf_dir, "labels"),
                       batches=4)


@register("op11_minhash_dedup", oracle.minhash_sql())
def op11_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.minhash_classes(read_table(spark, sf_dir, "documents"), words=2, num=80, den=100)
