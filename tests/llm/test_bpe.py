import base64
import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from ferrolake.llm import bpe
from ferrolake.llm.queries import VOCABULARY, op2_bpe

SF = "/root/testdata/sf0.001"


def tiktoken_encoding(ranks, pattern=public_tokenizers.PATTERN):
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(VOCABULARY)


def check(enc, tk, texts):
    flat, lens = enc.encode(texts)
    at = 0
    for t, n in zip(texts, lens.tolist()):
        ids = flat[at:at + n].tolist()
        at += n
        assert ids == tk.encode_ordinary(t), repr(t[:80])
        assert bytes(enc.merges.decode(flat[at - n:at])).decode() == t


@pytest.mark.parametrize("name", ["byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken"])
def test_matches_library(name):
    ranks = bpe.read_ranks(public_tokenizers.path(name))
    enc = bpe.Encoder(bpe.Merges(ranks), public_tokenizers.PATTERN)
    rnd = random.Random(7)
    alphabet = list("aabbcceett  \n\t'sd123.,!é漢字 \u0085\x1c\x1f \U0001F600ßœЖ١²")
    texts = ["", " ", "   a", "a" * 3000, "ab" * 500, " " * 300 + "x", "foo  ", "a \n", "a\n\n", "x\n \ny", "don't we'll I'M", "\r\n\r\n x"]
    texts += ["".join(rnd.choices(alphabet, k=rnd.randrange(1, 60))) for _ in range(3000)]
    texts += ["".join(rnd.choices([" ", "  ", "\n", " \n", "\t", "a", "b,", "\0", "'ll", "\u2003", "1"],
                                  k=rnd.randrange(1, 25))) for _ in range(4000)]
    texts += ["".join(chr(rnd.choice([rnd.randrange(32, 0x250), rnd.randrange(0x370, 0xD7FF),
                                      rnd.randrange(0x10000, 0x1FFFF)])) for _ in range(40))
              for _ in range(500)]
    check(enc, tiktoken_encoding(ranks), texts)


def test_random_small_vocabularies():
    """Vocabularies in which merges are not in order of length, also odd ones."""
    rnd = random.Random(3)
    for _ in range(60):
        ranks = {bytes([b]): b for b in range(256)}
        extra = {bytes(rnd.choices(b"abc", k=rnd.randrange(2, 5))) for _ in range(12)}
        for t in rnd.sample(sorted(extra), len(extra)):
            ranks[t] = len(ranks)
        enc = bpe.Encoder(bpe.Merges(ranks), r"\S+|\s+")
        check(enc, tiktoken_encoding(ranks, r"\S+|\s+"),
              ["".join(rnd.choices("abc ", k=rnd.randrange(1, 40))) for _ in range(60)])


def test_arrow_slices(ranks):
    """A slice of an Arrow array, nulls in it, is encoded as it is."""
    enc = bpe.Encoder(bpe.Merges(ranks), public_tokenizers.PATTERN)
    texts = ["left out", " one two\n\n three", None, "", "größe  \t x é\u3000 漢", "a \n", "z"]
    for kind in (pa.string(), pa.large_string()):
        flat, lens = enc.encode(pa.array(texts, kind).slice(1, 5))
        tk = tiktoken_encoding(ranks)
        want = [tk.encode_ordinary(t or "") for t in texts[1:6]]
        assert lens.tolist() == [len(w) for w in want]
        assert flat.tolist() == [i for w in want for i in w]


def test_new_words_are_matched_in_one_text(ranks):
    """One call of the pattern for all plain words of a batch, not one a word."""
    enc, calls = bpe.Encoder(bpe.Merges(ranks), public_tokenizers.PATTERN), []
    plain = enc.find.plain
    enc.find.plain = lambda text: calls.append(text) or plain(text)
    check(enc, tiktoken_encoding(ranks), [" ".join(f"w{i},ß" for i in range(2000)) + "\t \n"])
    calls.clear()
    check(enc, tiktoken_encoding(ranks), [" " + " ".join(f"v{i}\té" for i in range(2000))])
    assert len(calls) == 1


def test_query_against_library(spark, ranks):
    tk = tiktoken_encoding(ranks)
    got = {r.doc_id: r for r in op2_bpe(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = tk.encode_ordinary(d.text or "")
        r = got[d.doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()


def test_nulls_empty_tables_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, "", "y"), (2, "hello hello", None)],
                               "doc_id long, text string, ids string")
    out = bpe.encode_documents(df, VOCABULARY, public_tokenizers.PATTERN)
    assert out.columns == ["doc_id", "text", "ids", "token_ids"]
    rows = out.collect()
    assert [len(r.token_ids) > 0 for r in rows] == [False, False, True]
    back = bpe.decode_documents(out, VOCABULARY).where("text = 'hello hello'").first()
    assert bytes(back.decoded) == b"hello hello"
    assert bpe.digests(bpe.decode_documents(out.limit(0), VOCABULARY)).count() == 0
    null = spark.createDataFrame([(None,)], "token_ids array<int>")
    assert bpe.decode_documents(null, VOCABULARY).first().decoded is None


def test_ids_and_bytes_in_one_pass(spark):
    """Each text is encoded once, not once more inside the decoder's argument."""
    df = spark.createDataFrame([(1, "größe of it\n\n x"), (2, None), (3, "")], "doc_id long, text string")
    both = bpe.encode_documents(df, VOCABULARY, public_tokenizers.PATTERN, decoded="decoded")
    steps = bpe.decode_documents(bpe.encode_documents(df, VOCABULARY, public_tokenizers.PATTERN), VOCABULARY)
    assert both.columns == steps.columns
    assert sorted(map(str, both.collect())) == sorted(map(str, steps.collect()))
    plan = op2_bpe(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "both(text" in plan and "encode(text" not in plan


def test_rank_file(ranks):
    assert ranks[b"a"] >= 0 and all(isinstance(k, bytes) for k in list(ranks)[:5])
    assert base64.b64encode(b"a")
