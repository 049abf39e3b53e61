"""License scan by diagonal voting, native Spark only.

A document's words (A-Z lower-cased; letters, digits and all that is not ASCII)
are exploded with their places, and the hash of the rolling word k-gram at every
place is joined to the table of all k-grams of the templates with their places
there. A hit at place p of template place t votes for the diagonal p - t, the
place at which the template would start. Votes are aggregated by document,
template and diagonal into a bit mask of the template places hit; neighbouring
diagonals (at most `SHIFT` apart: words left out, put in or changed) merge around
their strongest one, and a span is verified by the share of the template's words
that its equal k-grams cover: all of them for a phrase, `NEED` for a notice.
Equal hashes alone do not vote: the join compares the words too.

A text is read and exploded once, in the tasks that scan it; only hits (and one
row a document) are shuffled, once, by row. The k-gram table is a constant of
some hundred rows and is the only thing broadcast. Documents that share a line
share no key.

Defined cases: null or empty texts have no words, labels or spans, and score 0;
a text of any length is taken whole; templates that tie on a diagonal are
separate rows, of equally strong neighbours the smaller diagonal stays; repeated
rows are scanned as rows of their own, rows without an id too; further columns
are ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sizing import local_frame

BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GRAM = 3
#: words of a template, at most, so that its places fit into one long; longer notices go in pieces
MOST_WORDS = 60
SHIFT = 4
NEED = 0.6

# The phrases of the contract, whose places are counted.
BASE = [
    ("cc-by", "cc by"),
    ("gpl", "general public license"),
    ("reserved", "all rights reserved"),
]
# Names of licenses, found where all their words stand together.
PHRASES = [
    ("agpl", "affero general public license"),
    ("apache-2.0", "apache license version 2 0"),
    ("apache-2.0", "apache 2 0 license"),
    ("bsd", "bsd license"),
    ("bsl-1.0", "boost software license"),
    ("cc-by-nc", "cc by nc"),
    ("cc-by-nd", "cc by nd"),
    ("cc-by-sa", "cc by sa"),
    ("cc0", "cc0 1 0"),
    ("epl", "eclipse public license"),
    ("gpl-2.0", "general public license version 2"),
    ("gpl-3.0", "general public license version 3"),
    ("isc", "isc license"),
    ("lgpl", "lesser general public license"),
    ("mit", "mit license"),
    ("mpl", "mozilla public license"),
    ("proprietary", "confidential and proprietary"),
    ("public-domain", "dedicated to the public domain"),
]
# Notices, found in part or edited too.
NOTICES = [
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license is "
                   "distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
            "the following conditions are met"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
            "public license as published by the free software foundation"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
            "granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("reserved", "no part of this publication may be reproduced distributed or transmitted in any form or by any means "
                 "without the prior written permission of the publisher"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be "
             "held liable for any damages arising from the use of this software"),
]


@dataclass(frozen=True)
class Template:
    """Words of one template, of which the share `need` must be found."""

    label: str
    words: tuple[str, ...]
    need: float
    base: bool = False

    @property
    def k(self) -> int:
        return min(GRAM, len(self.words))


def templates(base=BASE, phrases=PHRASES, notices=NOTICES) -> list[Template]:
    """All templates; a notice longer than MOST_WORDS is cut into templates of its label."""
    out = [Template(label, tuple(text.split()), 1.0, exact is base)
           for exact in (base, phrases) for label, text in exact]
    for label, text in notices:
        words = text.split()
        n = -(-len(words) // MOST_WORDS)
        size = -(-len(words) // n)
        out += [Template(label, tuple(words[i:i + size]), NEED) for i in range(0, len(words), size)]
    if any(not 2 <= len(t.words) <= MOST_WORDS for t in out):
        raise ValueError(f"a template has 2 to {MOST_WORDS} words")
    return out


def gram_table(spark, own: list[Template]) -> DataFrame:
    """(t_hash, g0, g1, g2, t_no, t_place): every k-gram of every template; g2
    is null for templates of two words."""
    rows = [(t.words[i], t.words[i + 1], t.words[i + 2] if t.k == 3 else None, no, i)
            for no, t in enumerate(own) for i in range(len(t.words) - t.k + 1)]
    grams = local_frame(spark, rows, "g0 string, g1 string, g2 string, t_no int, t_place int")
    return grams.withColumn("t_hash", F.xxhash64("g0", "g1"))


def word_list(text: Column) -> Column:
    low = F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER)
    return F.array_remove(F.split(low, BREAKS), "")


def diagonals(docs: DataFrame, own: list[Template], *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, id, n_words, t_no, diag, mask): the template places hit on each
    diagonal of each row, and one line with null t_no for every row."""
    listed = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                         word_list(F.col(text_col)).alias("words")).withColumn("n_words", F.size("words").cast("long"))
    # the outer form gives a row without words one line, at place null
    placed = listed.select("row", "id", "n_words", "words", F.posexplode_outer("words").alias("place", "w0"))
    placed = placed.withColumn("w1", F.get("words", F.col("place") + 1)).withColumn("w2", F.get("words", F.col("place") + 2))
    grams = gram_table(docs.sparkSession, own)
    same = (F.xxhash64("w0", "w1") == F.col("t_hash")) & (F.col("w0") == F.col("g0")) & (F.col("w1") == F.col("g1")) & (
        F.col("g2").isNull() | (F.col("w2") == F.col("g2")))
    hits = placed.join(F.broadcast(grams), same, "left").where("t_no IS NOT NULL OR coalesce(place, 0) = 0").select(
        "row", "id", "n_words", "t_no", (F.col("place") - F.col("t_place")).cast("long").alias("diag"), "t_place")
    # one shuffle, by row: what follows groups and sorts inside rows
    return hits.repartition("row").groupBy("row", "id", "n_words", "t_no", F.when(
        F.col("t_no").isNotNull(), F.col("diag")).alias("diag")).agg(
        F.bit_or(F.expr("shiftleft(1L, t_place)")).alias("mask"))


def _of(own: list[Template], value) -> Column:
    return F.get(F.lit([value(t) for t in own]), F.col("t_no"))


def license_spans(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  own: list[Template] | None = None) -> DataFrame:
    """(row, id, n_words, label, base, start, end, share): every verified span, in
    words from 0 (end exclusive), and one line with null label for every row.
    `row` numbers the rows of the input."""
    own = templates() if own is None else own
    found = diagonals(docs, own, id_col=id_col, text_col=text_col)
    size, exact = _of(own, lambda t: len(t.words)), _of(own, lambda t: t.need == 1.0)

    def covered(mask: Column) -> Column:
        # a k-gram covers the words at its place and the k - 1 after it
        two = mask.bitwiseOR(F.shiftleft(mask, 1))
        return F.bit_count(F.when(_of(own, lambda t: t.k) == 2, two).otherwise(two.bitwiseOR(F.shiftleft(mask, 2))))

    line = Window.partitionBy("row", "t_no").orderBy("diag")
    near = line.rangeBetween(-SHIFT, SHIFT)
    # the hit places in the text: the lowest and highest bit of a mask
    low = F.col("diag") + F.bit_count(F.expr("(mask & -mask) - 1"))
    high = F.col("diag") + F.floor(F.log2(F.col("mask").cast("double"))) + _of(own, lambda t: t.k)
    merged = found.withColumn("low", low).withColumn("high", high).withColumn("votes", F.bit_count("mask")).withColumn(
        "m_mask", F.when(exact, F.col("mask")).otherwise(F.bit_or("mask").over(near))).withColumn(
        "m_low", F.when(exact, F.col("low")).otherwise(F.min("low").over(near))).withColumn(
        "m_high", F.when(exact, F.col("high")).otherwise(F.max("high").over(near))).withColumn(
        "strongest", exact | (F.max(F.struct("votes", -F.col("diag"))).over(near) == F.struct("votes", -F.col("diag"))))
    share = F.when(F.col("t_no").isNotNull(), covered(F.col("m_mask")) / size)
    spans = merged.withColumn("share", share).where(
        F.col("t_no").isNull() | (F.col("strongest") & (F.col("share") >= _of(own, lambda t: t.need))))
    return spans.select("row", F.col("id").alias(id_col), "n_words", _of(own, lambda t: t.label).alias("label"),
                        _of(own, lambda t: t.base).alias("base"), F.col("m_low").cast("long").alias("start"),
                        F.col("m_high").cast("long").alias("end"), "share")


def scan_licenses(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  own: list[Template] | None = None) -> DataFrame:
    """One line for each row of `docs`: id, n_words, n_base (places of base
    phrases), first_word and last_word (their smallest and largest start),
    base_labels, labels (all) and score, the largest share of a template found."""
    spans = license_spans(docs, id_col=id_col, text_col=text_col, own=own)

    def joined(labels: Column) -> Column:
        # labels are few constants, so a row's set is bounded
        return F.array_join(F.array_sort(F.collect_set(labels)), ",")

    start = F.when(F.col("base"), F.col("start"))
    return spans.groupBy("row", id_col, "n_words").agg(
        F.count(start).alias("n_base"), F.min(start).alias("first_word"), F.max(start).alias("last_word"),
        joined(F.when(F.col("base"), F.col("label"))).alias("base_labels"), joined(F.col("label")).alias("labels"),
        F.round(F.coalesce(F.max("share"), F.lit(0.0)), 6).alias("score")).drop("row")
