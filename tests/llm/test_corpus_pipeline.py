"""Every stage of the pipeline against brute force on what its predecessor kept."""

import importlib

import corpus_pipeline
import tiktoken
from pyspark.sql import functions as F
from test_bpe import tiktoken_encoding
from test_decontam import brute as brute_leaks
from test_jaccard import brute as brute_groups
from test_lines import brute as brute_lines

from ferrolake.llm import bpe, ordinal

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = dict(rows)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name == "quality classifier":
            model = ordinal.train(docs, ordinal.document_grades(
                spark.read.parquet(f"{SF}/labels.parquet")), 3)
            known = ordinal.WordFeatures()
            want = {d: r.text for d, r in kept.items()
                    if model.tails(model.score(r.text.encode(), known))[1] >= 0.5}
            clean = [d for d, x in labels.items() if x.quality == 1 and x.toxic == 0]
            assert sum(d in want for d in clean) / len(clean) > 0.95
        elif name == "line dedup":
            want = {d: t for d, n, gone, t in brute_lines(list(texts.items())) if not gone or gone < n}
        elif name == "n-gram Jaccard join":
            want = {d: texts[d] for d, _, c in brute_groups(list(texts.items())) if c == d}
        elif name == "benchmark decontamination":
            leaked = {d for d, *_ in brute_leaks(list(texts.items()), items)}
            want = {d: t for d, t in texts.items() if d not in leaked}
        else:
            tk = tiktoken_encoding(bpe.read_ranks(corpus_pipeline.VOCABULARY))
            got = {r.doc_id: r for r in out.collect()}
            assert {d: r.token_ids for d, r in got.items()} == \
                {d: tk.encode_ordinary(t) for d, t in texts.items()}
            assert all(r.exact and r.n_tokens == len(r.token_ids) for r in got.values())
            return
        assert out.columns == COLUMNS
        got = {r.doc_id: r for r in out.collect()}
        assert {d: r.text for d, r in got.items()} == want, name
        assert all(r.n_chars == len(r.text) for r in got.values())
        texts = want
        docs = spark.createDataFrame([tuple(r) for r in got.values()], out.schema)


def test_run_equals_the_stages(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "lang", "source", "token_ids", "n_tokens", "exact"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    got = [r.doc_id for r in out.collect()]
    assert len(got) == len(set(got)) and set(got) < ids and len(got) > 50


def test_edges_of_every_stage(spark):
    docs = spark.createDataFrame(
        [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "some text here", "en", "s", 14),
         (3, "one two three four five six", "en", "s", 27), (3, "one two three four five six", "en", "s", 27),
         (4, "one two three four five six", None, "s", 27)],
        "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0
        out = stage(spark, docs, SF)
        assert out.where(F.col("doc_id").isNull()).count() <= 1
        assert out.count() >= 1
    left = corpus_pipeline.ngram_jaccard(spark, docs, SF).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in left) == \
        [(False, 1), (False, 2), (False, 3), (False, 3), (True, 0)]


def test_registered():
    entry = importlib.import_module("__spark_entry__")
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert tiktoken
