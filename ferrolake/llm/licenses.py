"""License scan by diagonal voting, in DataFrame operations only.

Every text is split into words; each rolling word k-gram is hashed and joined
with the template positions of the same hash. A hit votes for the diagonal
(word position - template position) it lies on; votes are counted per text,
template and diagonal, neighbouring diagonals (words put in or left out) are
merged, and the merged span is verified: its grams are compared word by word,
each template position counts once however often the text repeats it, and the
span may not be much longer than the template.

Phrases are voted for by bigrams and must be complete on one diagonal, so their
places are exact. Longer notices are voted for by trigrams and need a share of
their grams.

Only rows that hit a template leave the scan, besides one row per text. The
templates are a fixed list inside the program, so their table is broadcast.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# --- Fixed values: phrases with their labels, and notices the scan knows -------
PHRASES = [("gpl", "gnu general public license"), ("apache", "apache license"), ("cc-by", "cc by"),
           ("mit", "mit license")]
NOTICES = [
    ("all-rights-reserved", "all rights reserved"),
    ("apache-2.0", "licensed under the apache license version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are "
            "permitted provided that the following conditions are met"),
    ("cc-by-nc-4.0", "licensed under cc by-nc 4.0"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("mit-notice", "permission is hereby granted free of charge to any person obtaining a copy of "
                   "this software and associated documentation files"),
    ("mit-notice", "released under the mit license"),
]
# --- End of fixed values --------------------------------------------------------

#: Share of a notice's grams that must be found, and words a span may be off.
SHARE, SLACK = 0.6, 3
_NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # before lower-casing A-Z
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def template_words(text: str) -> list[str]:
    return [w for w in re.split(_NOT_WORD, text) if w]


def template_table(spark: SparkSession, phrases: list, notices: list) -> DataFrame:
    """(tpl, base, label, tpos, grams, words, gram, third): one row per template position."""
    rows = []
    for base, items in ((True, phrases), (False, notices)):
        for label, text in items:
            w = template_words(text)
            k = 2 if base else 3
            if len(w) < k:
                raise ValueError(f"a template needs {k} words or more: {text!r}")
            n = len(w) - k + 1
            rows += [(f"{'base' if base else 'note'}:{text}", base, label, i, n, len(w),
                      " ".join(w[i:i + 2]), None if base else w[i + 2]) for i in range(n)]
    return spark.createDataFrame(
        rows, "tpl string, base boolean, label string, tpos int, grams int, words int, "
              "gram string, third string")


def _ascii_lower(c: Column) -> Column:
    return F.translate(c, _UPPER, _LOWER)


def scan(docs: DataFrame, phrases: list = PHRASES, notices: list = NOTICES, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) per row.

    Null text is empty. ``score`` is the best share of a template found (1 for a
    phrase), 0 without any. Overlapping places all count. Rows of a repeated or
    null id are separate.
    """
    spark = docs.sparkSession
    words = docs.select(F.monotonically_increasing_id().alias("row"),
                        F.col(id_col).alias("doc_id"),
                        F.split(F.coalesce(F.col(text_col), F.lit("")), _NOT_WORD).alias("w"))
    # The split leaves an empty word where a text starts or ends with none.
    front = F.when(F.element_at("w", 1) == "", 1).otherwise(0)
    back = F.when((F.size("w") > 1) & (F.element_at("w", -1) == ""), 1).otherwise(0)
    each = words.select("row", "doc_id", "w", front.alias("front"),
                        (F.size("w") - front - back).alias("n_words"),
                        F.posexplode("w").alias("i", "w1"))
    w2 = F.get(F.col("w"), F.col("i") + 1)
    w3 = F.get(F.col("w"), F.col("i") + 2)
    each = each.select("row", "doc_id", "n_words", "i", (F.col("i") - F.col("front")).alias("at"),
                       "w1", w2.alias("w2"), w3.alias("w3"),
                       F.xxhash64(F.lower("w1"), F.lower(w2)).alias("h"))
    tpl = template_table(spark, phrases, notices)
    tpl = tpl.withColumn("th", F.xxhash64(F.split_part("gram", F.lit(" "), F.lit(1)),
                                          F.split_part("gram", F.lit(" "), F.lit(2))))
    same = ((F.col("h") == F.col("th"))
            & (_ascii_lower(F.concat_ws(" ", "w1", "w2")) == F.col("gram"))
            & (F.col("third").isNull() | (_ascii_lower(F.col("w3")) == F.col("third"))))
    # Each text's first word stays as the row that carries the text itself.
    hits = each.join(F.broadcast(tpl), same, "left") \
        .where(F.col("tpl").isNotNull() | (F.col("i") == 0)) \
        .select("row", "doc_id", "n_words", "tpl", "base", "label", "grams", "words",
                (F.col("at") - F.col("tpos")).alias("diagonal"), "at", "tpos")
    hits = hits.repartition("row")  # the three steps below need no further shuffle
    votes = hits.groupBy("row", "tpl", "diagonal").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.first("base").alias("base"), F.first("label").alias("label"),
        F.first("grams").alias("grams"), F.first("words").alias("words"),
        F.count("tpl").alias("votes"), F.collect_set("tpos").alias("seen"),
        F.min("at").alias("lo"), F.max("at").alias("hi"))
    # Counted from the diagonal itself and the few after it: a span is met at
    # its first diagonal. A diagonal's positions are no more than its template's.
    near = Window.partitionBy("row", "tpl").orderBy("diagonal").rangeBetween(0, SLACK)
    merged = votes.select(
        "*", F.size(F.array_distinct(F.flatten(F.collect_list("seen").over(near)))).alias("found"),
        F.min("lo").over(near).alias("from"),
        F.max("hi").over(near).alias("to"))
    place = F.col("base") & (F.col("votes") == F.col("grams"))
    share = F.col("found") / F.col("grams")
    fits = F.col("to") - F.col("from") + 3 <= F.col("words") + SLACK
    note = ~F.col("base") & fits & (share >= SHARE)
    found = merged.select(
        "row", "doc_id", "n_words", "diagonal", place.alias("place"),
        F.when(place, F.col("label")).alias("base_label"),
        F.when(place | note, F.col("label")).alias("any_label"),
        F.when(place, 1.0).when(~F.col("base") & fits, share).alias("found_share"))
    return found.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").cast("long").alias("n_words"),
        F.count_if("place").alias("n_base"),
        F.min(F.when(F.col("place"), F.col("diagonal"))).cast("long").alias("first_word"),
        F.max(F.when(F.col("place"), F.col("diagonal"))).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set("base_label")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("any_label")), ",").alias("labels"),
        F.coalesce(F.max("found_share"), F.lit(0.0)).alias("score")).drop("row")
