"""Conflation learned from the vocabulary: which word forms are one term.

No list of suffixes is given, so it works for any language the texts are in:

1. every word is cut into a stem and an ending of at most `most_ending` characters;
   the endings that follow the most stems of a language are kept;
2. two endings form a class if they follow `least_stems` stems in common (as -s and
   the empty ending, or Greek -ος and -ου);
3. two words of one stem, with endings of a class, are linked if the texts bear it out:
   at least `least_together` documents hold both, `least_lift` times as many as if
   they were independent;
4. the connected components of the links are the terms, named by their most frequent form.

Classes are counted from each stem's list of kept endings, which is bounded. Documents
are counted by the pairs that each holds: words of one document that start alike are
put side by side there, so the work follows the documents' lengths, not the number of
pairs in the vocabulary times the documents of their words. Nothing is collected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.graph import components
from ..session import durable, scratch_path


@dataclass(frozen=True)
class Evidence:
    """What it takes to link two word forms."""

    least_stem: int = 4
    most_ending: int = 3
    endings: int = 30
    least_stems: int = 10
    least_together: int = 3
    least_lift: float = 2.0


def _cuts(words: DataFrame, e: Evidence) -> DataFrame:
    """(lang, stem, ending, word) of all cuts of (lang, word)."""
    n = F.length("word")
    lengths = F.sequence(F.lit(0), F.least(F.lit(e.most_ending), n - F.lit(e.least_stem)))
    return words.where(n >= e.least_stem).select("lang", "word", F.explode(lengths).alias("cut")).select(
        "lang", F.expr("substring(word, 1, length(word) - cut)").alias("stem"),
        F.expr("substring(word, length(word) - cut + 1)").alias("ending"), "word")


def ending_classes(cuts: DataFrame, e: Evidence) -> DataFrame:
    """(lang, x, y): the pairs of kept endings x < y that follow enough stems in common."""
    best = Window.partitionBy("lang").orderBy(F.desc("n"), F.asc("ending"))
    kept = cuts.groupBy("lang", "ending").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "r", F.row_number().over(best)).where(F.col("r") <= e.endings).select("lang", "ending")
    # at most `endings` rows a language, and so at most as many in a stem's list
    own = cuts.join(F.broadcast(kept), ["lang", "ending"]).groupBy("lang", "stem").agg(F.collect_list("ending").alias("all"))
    x = own.where(F.size("all") > 1).select("lang", "all", F.explode("all").alias("x"))
    pairs = x.select("lang", "x", F.explode("all").alias("y")).where("x < y")
    return pairs.groupBy("lang", "x", "y").agg(F.count(F.lit(1)).alias("stems")).where(
        F.col("stems") >= e.least_stems).select("lang", "x", "y")


def document_words(texts: DataFrame) -> DataFrame:
    """(lang, doc_id, words): the distinct words of every document in order, from rows
    (lang, doc_id, words), several a document or one; written once. Rows that are
    dealt by doc_id are not shuffled."""
    own = texts.where("lang IS NOT NULL AND doc_id IS NOT NULL").groupBy("lang", "doc_id").agg(
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("words")))).alias("words"))
    path = scratch_path(texts.sparkSession, "words")
    own.where(F.size("words") > 0).write.parquet(path)
    return texts.sparkSession.read.parquet(path)


def _pairs_together(own: DataFrame, e: Evidence) -> DataFrame:
    """(lang, a, b, together): words a < b that a common stem and endings of at most
    `most_ending` characters make, in at least `least_together` documents at once."""
    stem, most = e.least_stem, e.most_ending

    def run(batches):
        from itertools import groupby
        from operator import itemgetter

        import numpy as np
        import pyarrow as pa

        head = itemgetter(slice(stem))

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*rows)], names=["lang", "a", "b"])

        out = []
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            ends = batch.column(1).value_lengths().to_numpy().cumsum()
            for lang, words in zip(batch.column(0).to_pylist(), np.split(flat, ends[:-1])):
                # in order, words that start alike stand together
                for _, alike in groupby([w for w in words.tolist() if len(w) >= stem], key=head):
                    alike = list(alike)
                    for i, a in enumerate(alike):
                        for b in alike[i + 1:]:
                            k = max(stem, len(a) - most, len(b) - most)
                            if k <= len(a) and k <= len(b) and a[:k] == b[:k]:
                                out.append((lang, a, b))
                        if len(out) >= 50_000:
                            yield batch_of(out)
                            out = []
        if out:
            yield batch_of(out)

    pairs = own.select("lang", "words").mapInArrow(run, "lang string, a string, b string")
    return pairs.groupBy("lang", "a", "b").agg(F.count(F.lit(1)).alias("together")).where(F.col("together") >= e.least_together)


def word_links(own: DataFrame, words: DataFrame, e: Evidence = Evidence()) -> DataFrame:
    """(lang, a, b, together) of the linked word forms, from `document_words` and
    (lang, word, df) of all words."""
    docs = own.groupBy("lang").agg(F.count(F.lit(1)).alias("docs"))
    classes = ending_classes(_cuts(words.select("lang", "word"), e), e)
    # a pair's stems, the shortest first: one of them has endings of a class
    cuts = F.expr(f"sequence(greatest({int(e.least_stem)}, length(a) - {int(e.most_ending)}, length(b) - {int(e.most_ending)}), "
                  "least(length(a), length(b)))")
    cut = _pairs_together(own, e).select("*", F.explode(cuts).alias("cut")).where("left(a, cut) = left(b, cut)")
    ends = cut.select("lang", "a", "b", "together", F.expr("substring(a, cut + 1)").alias("x"), F.expr("substring(b, cut + 1)").alias("y"))
    asked = ends.join(F.broadcast(classes), ["lang", "x", "y"]).select("lang", "a", "b", "together").distinct()
    one = words.select("lang", F.col("word").alias("a"), F.col("df").alias("a_df"))
    two = words.select("lang", F.col("word").alias("b"), F.col("df").alias("b_df"))
    both = asked.join(one, ["lang", "a"]).join(two, ["lang", "b"])
    return both.join(F.broadcast(docs), "lang").where(
        F.col("together") * F.col("docs") >= F.lit(e.least_lift) * F.col("a_df") * F.col("b_df")).select(
        "lang", "a", "b", "together")


def learn_terms(held: DataFrame, e: Evidence = Evidence()) -> DataFrame:
    """`learn_terms_of` the words of documents, one to a row (lang, doc_id, word)."""
    return learn_terms_of(held.where("word IS NOT NULL").select("lang", "doc_id", F.array("word").alias("words")), e)


def learn_terms_of(texts: DataFrame, e: Evidence = Evidence()) -> DataFrame:
    """(lang, word, term, df): every word that shares its term with another, and the
    term, which is its most frequent form (of several the first in the alphabet), from
    the words of documents (lang, doc_id, words)."""
    docs = document_words(texts)
    df = durable(docs.select("lang", F.explode("words").alias("word")).groupBy("lang", "word").agg(F.count(F.lit(1)).alias("df")))
    links = durable(word_links(docs, df, e))
    node = lambda c: F.struct("lang", F.col(c).alias("word"))
    found = components(links.select(node("a").alias("a"), node("b").alias("b")))
    own = found.select("node.lang", "node.word", F.col("component.word").alias("least")).join(df, ["lang", "word"])
    names = own.groupBy("lang", "least").agg(F.min_by("word", F.struct(-F.col("df"), F.col("word"))).alias("term"))
    return own.join(names, ["lang", "least"]).select("lang", "word", "term", "df")


def conflate(tokens: DataFrame, terms: DataFrame) -> DataFrame:
    """(…, term): the learned term of each row of (lang, word, …), or the word itself."""
    own = terms.select("lang", "word", "term")
    return tokens.join(own, ["lang", "word"], "left").withColumn("term", F.coalesce("term", "word"))
