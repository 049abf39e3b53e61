"""Vocabulary terms near a misspelt word: a character-trigram index, exact.

A word's trigrams are those of the word with two blanks before and after it. An edit
(a character put in, left out or changed) destroys at most three of them, so a term
within `d` edits of a word keeps one of any 3 d + 1 of its trigrams. Only the
rarest 3 d + 1 are looked up, by a join with the index, and what they find is verified
by the edit distance. Words too short to have as many (3 d - 2 characters or less)
meet their terms through the variants of both with up to `d` characters left out,
which two words within `d` edits share; such words and terms are short, so they have few.

The index is a table (gram, term) and one of each trigram's terms: it grows with the vocabulary, of any
size, and is only joined. A trigram that very many terms share is looked up only for
words that have nothing rarer.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sizing import maybe_broadcast
from ..session import durable

MAX_EDITS = 2


def trigrams(word: Column) -> Column:
    """All trigrams of a padded word, repeated ones too: one more than twice its
    characters' reach, that is length + 2."""
    padded = F.concat(F.lit("  "), word, F.lit("  "))
    return F.transform(F.sequence(F.lit(1), F.length(word) + 2), lambda i: F.substring(padded, i, F.lit(3)))


def deletions(word: Column, edits: int) -> Column:
    """The different strings that are left of a word without up to `edits` characters."""
    out = F.array(word)
    for _ in range(edits):
        shorter = F.flatten(F.transform(out, lambda w: F.transform(
            F.sequence(F.lit(1), F.greatest(F.length(w), F.lit(1))),
            lambda i: F.concat(F.substring(w, F.lit(1), i - 1), F.substring(w, i + 1, F.length(w))))))
        out = F.array_distinct(F.concat(out, shorter))
    return out


@dataclass
class FuzzyIndex:
    terms: DataFrame    # term, df
    grams: DataFrame    # gram, term
    rarity: DataFrame   # gram, gram_df


def build_index(terms: DataFrame) -> FuzzyIndex:
    """The trigram index of (term, df)."""
    own = durable(terms.select("term", F.col("df").cast("long").alias("df")).where("term IS NOT NULL"))
    grams = durable(own.select("term", F.explode(F.array_distinct(trigrams(F.col("term")))).alias("gram")))
    return FuzzyIndex(own, grams, durable(grams.groupBy("gram").agg(F.count(F.lit(1)).alias("gram_df"))))


def near_terms(index: FuzzyIndex, words: DataFrame, edits: int = 1, word_col: str = "word") -> DataFrame:
    """(word, term, df, edits) for every word and every term within `edits` edits of it."""
    if not 1 <= edits <= MAX_EDITS:
        raise ValueError(f"edits lie between 1 and {MAX_EDITS}")
    asked = durable(words.select(F.col(word_col).alias("word")).where("word IS NOT NULL").distinct())
    short = 3 * edits - 2
    # the rarest trigrams of a long word; one that no term has is the rarest of all
    grams = asked.where(F.length("word") > short).select("word", F.posexplode(trigrams(F.col("word"))).alias("place", "gram"))
    rare = Window.partitionBy("word").orderBy("gram_df", "gram", "place")
    picked = grams.join(index.rarity, "gram", "left").fillna(0, ["gram_df"]).withColumn("r", F.row_number().over(rare)).where(
        F.col("r") <= 3 * edits + 1).where("gram_df > 0").select("word", "gram").distinct()
    side, _ = maybe_broadcast(picked)
    fits = F.abs(F.length("word") - F.length("term")) <= edits
    found = index.grams.select("gram", "term").join(side, "gram").where(fits).select("word", "term")
    # short words and the terms they can reach, by what is left without a few characters
    left = asked.where(F.length("word") <= short).select("word", F.explode(deletions(F.col("word"), edits)).alias("left"))
    reach = index.terms.where(F.length("term") <= short + edits).select("term", F.explode(deletions(F.col("term"), edits)).alias("left"))
    brief, _ = maybe_broadcast(left)
    found = found.unionByName(reach.join(brief, "left").where(fits).select("word", "term")).distinct()
    near = found.withColumn("edits", F.levenshtein("word", "term", edits)).where("edits >= 0")
    return near.join(index.terms, "term").select("word", "term", "df", F.col("edits").cast("int").alias("edits"))


def suggest_fuzzy(index: FuzzyIndex, words: DataFrame, edits: int = 1, limit: int = 5, word_col: str = "word") -> DataFrame:
    """(word, rank, term, df, edits): the `limit` best terms of each word, by edits,
    then documents, then term."""
    if limit < 1:
        raise ValueError("limit must be at least 1")
    order = Window.partitionBy("word").orderBy("edits", F.desc("df"), "term")
    return near_terms(index, words, edits, word_col).withColumn("rank", F.row_number().over(order)).where(
        F.col("rank") <= limit).select("word", F.col("rank").cast("int").alias("rank"), "term", "df", "edits")
