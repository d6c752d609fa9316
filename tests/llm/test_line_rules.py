"""What line dedup takes for recurring: constants, documents and equal lines."""

import hashlib
import random

import pytest
from test_lines import SF, brute, run

from ferrolake.llm import lines
from ferrolake.llm.queries import op9_line_dedup


def dropped(spark, rows, **kw):
    return {r[0]: r[2] for r in run(spark, rows, **kw)}


@pytest.mark.parametrize("depth,min_docs,constant", [(4, 3, 0.7), (2, 2, 0.5), (1, 4, 0.9)])
def test_random(spark, depth, min_docs, constant):
    rnd = random.Random(depth)
    vocab = [f"{c}{c}" for c in "abcdef"]
    shapes = [lambda: f"Page {rnd.randrange(9)} of 99 at 10:{rnd.randrange(20)}",
              lambda: f"this is the page number {rnd.randrange(60)}",
              lambda: f"the user {rnd.choice(vocab)} signed in from {rnd.choice(vocab)} today",
              lambda: " ".join(str(rnd.randrange(5)) for _ in range(rnd.randrange(4))),
              lambda: " ".join(rnd.choices(vocab + ["7", "<*>"], k=rnd.randrange(1, 8)))]
    rows = [(d, "\n".join(rnd.choice(shapes)() for _ in range(rnd.randrange(1, 7)))) for d in range(120)]
    got = run(spark, rows, depth=depth, min_docs=min_docs, constant=constant)
    assert got == brute(rows, depth, min_docs, constant)
    assert sum(r[2] for r in got) > 20


def test_lines_of_numbers_are_no_template(spark):
    rows = [(d, f"{d} {d + 1} {d * 7}\n19{d}\n+49 30 {d}\nRow {d} {d + 2} {d + 3} sum")
            for d in range(10, 20)]
    assert set(dropped(spark, rows).values()) == {0}
    # Equal ones recur, and enough constants make a template.
    rows = [(d, f"12 34  56 \npage number {d} of this long book") for d in range(5)]
    assert dropped(spark, rows) == {0: 0, 1: 2, 2: 2, 3: 2, 4: 2}


def test_fields_with_a_digit_are_no_constants(spark):
    # Four of seven positions hold constants, two fields have digits, one varies.
    rows = [(d, f"from 1{d} to 2{d} came {w} home") for d, w in enumerate(["ann", "bob", "cid", "dan"])]
    assert set(dropped(spark, rows, depth=2).values()) == {0}


def test_lines_of_one_document_are_no_template(spark):
    price = "the price per kilo of {} is low today".format
    rows = [(1, "\n".join(map(price, ["apples", "pears", "plums", "figs"]))), (2, price("leeks")),
            (3, "something else")]
    assert dropped(spark, rows) == {1: 0, 2: 0, 3: 0}
    # Nor do its tokens become constants for the lines of others.
    rows = [(1, "the old man of all {0} x{0} is here\nthe old man of all k{0} is gone now".format("a")),
            (2, "the old man of all b is here now")]
    assert dropped(spark, rows) == {1: 0, 2: 0}
    # A third document makes the template recur.
    rows = [(1, "\n".join(map(price, ["apples", "pears"]))), (2, price("leeks")), (3, price("kale"))]
    assert dropped(spark, rows) == {1: 0, 2: 1, 3: 1}


def test_equal_lines_of_two_documents(spark):
    rows = [(1, "a long line that stands in two\npage 7 of this long book\n1 2 3"),
            (2, "a long  line that stands in two \npage 7 of this long book\n1 2 3\nown words"),
            (3, "page 8 of that long book\nother words")]
    assert dropped(spark, rows) == {1: 0, 2: 2, 3: 0}
    # The higher minimum stays for templates.
    rows = [(1, "page 7 of this long book"), (2, "page 8 of this long book")]
    assert dropped(spark, rows) == {1: 0, 2: 0}


def test_query_on_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = [(d, n, g, hashlib.sha256(k.encode()).hexdigest()) for d, n, g, k in brute(rows)]
    assert sorted(map(tuple, op9_line_dedup(spark, SF).collect())) == want
