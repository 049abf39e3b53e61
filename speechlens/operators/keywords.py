"""Top keywords per speech, per member and per party, and their course in time.

Per speech: the 10 terms of highest weight (ties: word descending), fewer if
the speech has fewer terms; a speech without vocabulary terms has none.
Per member / party: the 10 best (tfidf, word, date) items over the per-speech
lists of the group's speeches, ordered by tfidf, then word, then date text,
all descending — a word may appear more than once.

Both rankings are `row_number() <= 10` windows. Spark plans them with a
partial `WindowGroupLimit` before the shuffle, so a member with a third of
all speeches sends at most 10 rows per map partition, and the per-speech
lists already cut the input to 10 rows per speech.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import parse_date
from ..schema import DATE, MEMBER, PARTY, SCORE_DIGITS

NO_KEYWORDS = 10


def keywords_per_doc(weights: DataFrame, docs: DataFrame, n: int = NO_KEYWORDS,
                     carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, rank, word, tfidf, date) plus the document columns in `carry`
    (e.g. member and party, so later rankings need no second join)."""
    w = weights.select("doc_id", F.col("term").alias("word"),
                       F.round("weight", SCORE_DIGITS).alias("tfidf"))
    order = Window.partitionBy("doc_id").orderBy(F.desc("tfidf"), F.desc("word"))
    top = w.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)
    dated = top.join(docs.select("doc_id", F.col(DATE).alias("date"), *carry), "doc_id")
    return dated.select("doc_id", F.col("rank").cast("int"), "word", "tfidf", "date", *carry)


def keywords_per_group(per_doc: DataFrame, docs: DataFrame, group_col: str,
                       n: int = NO_KEYWORDS) -> DataFrame:
    """(group_col, rank, tfidf, word, date) from the per-speech keyword lists."""
    j = per_doc if group_col in per_doc.columns else per_doc.join(
        docs.select("doc_id", group_col), "doc_id")
    order = Window.partitionBy(group_col).orderBy(
        F.desc("tfidf"), F.desc("word"), F.desc("date"))
    top = j.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)
    return top.select(group_col, F.col("rank").cast("int"), "tfidf", "word", "date")


def keywords_per_member(per_doc: DataFrame, docs: DataFrame, n: int = NO_KEYWORDS) -> DataFrame:
    return keywords_per_group(per_doc, docs, MEMBER, n)


def keywords_per_party(per_doc: DataFrame, docs: DataFrame, n: int = NO_KEYWORDS) -> DataFrame:
    return keywords_per_group(per_doc, docs, PARTY, n)


# ------------------------------------------------------------------ JSON form

_WORD = "struct<word:string,tfidf:double,date:string>"
SPEECH_JSON_SCHEMA = f"speech_id long, top_words array<{_WORD}>"
GROUP_JSON_SCHEMA = "name string, top_words array<struct<tfidf:double,word:string,date:string>>"


def write_keywords_json(per_doc: DataFrame, per_member: DataFrame, per_party: DataFrame,
                        path: str, mode: str = "overwrite") -> None:
    """Nested keyword lists as JSON lines, one line per speech / member / party.

    Every nested list holds at most `n` items, so building it is bounded
    per row; the three lists are written as three folders."""
    speech = per_doc.groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.struct("rank", "word", "tfidf", "date"))).alias("l"))
    speech = speech.select(
        F.col("doc_id").alias("speech_id"),
        F.transform("l", lambda s: F.struct(s["word"].alias("word"), s["tfidf"].alias("tfidf"),
                                            s["date"].alias("date"))).alias("top_words"))
    speech.write.mode(mode).json(f"{path}/top_speeches")
    for name, frame, col in (("top_speeches_per_member", per_member, MEMBER),
                             ("top_speeches_political_party", per_party, PARTY)):
        g = frame.groupBy(col).agg(
            F.sort_array(F.collect_list(F.struct("rank", "tfidf", "word", "date"))).alias("l"))
        g = g.select(F.col(col).alias("name"), F.transform(
            "l", lambda s: F.struct(s["tfidf"].alias("tfidf"), s["word"].alias("word"),
                                    s["date"].alias("date"))).alias("top_words"))
        g.write.mode(mode).json(f"{path}/{name}")


def read_keywords_json(spark, path: str) -> DataFrame:
    """Read the three JSON folders back as one long table:
    (kind, key, rank, word, tfidf, date)."""
    speech = spark.read.schema(SPEECH_JSON_SCHEMA).json(f"{path}/top_speeches")
    out = speech.select(F.lit("speech").alias("kind"), F.col("speech_id").cast("string").alias("key"),
                        F.posexplode("top_words").alias("pos", "w"))
    frames = [out]
    for kind, name in (("member", "top_speeches_per_member"),
                       ("party", "top_speeches_political_party")):
        g = spark.read.schema(GROUP_JSON_SCHEMA).json(f"{path}/{name}")
        frames.append(g.select(F.lit(kind).alias("kind"), F.col("name").alias("key"),
                               F.posexplode("top_words").alias("pos", "w")))
    allk = frames[0].unionByName(frames[1]).unionByName(frames[2])
    return allk.select("kind", "key", (F.col("pos") + 1).cast("int").alias("rank"),
                       F.col("w.word").alias("word"), F.col("w.tfidf").alias("tfidf"),
                       F.col("w.date").alias("date"))


# --------------------------------------------------------------------- time

def keyword_timeline(per_doc: DataFrame, per_member: DataFrame, per_party: DataFrame) -> DataFrame:
    """(series_kind, series, rank, word, date DATE): the points the reference
    plots, one row per (series, keyword); bad date text gives a null date."""
    per_doc = per_doc.select("doc_id", "rank", "word", "tfidf", "date")
    s = per_doc.select(F.lit("speech").alias("series_kind"),
                       F.col("doc_id").cast("string").alias("series"), "rank", "word", "date")
    m = per_member.select(F.lit("member").alias("series_kind"), F.col(MEMBER).alias("series"),
                          "rank", "word", "date")
    p = per_party.select(F.lit("party").alias("series_kind"), F.col(PARTY).alias("series"),
                         "rank", "word", "date")
    u = s.unionByName(m).unionByName(p)
    return u.select("series_kind", "series", "rank", "word", parse_date(F.col("date")).alias("date"))


def keyword_trend(per_doc: DataFrame, docs: DataFrame, group_col: str = PARTY) -> DataFrame:
    """How keywords evolve: per group and year, how many speeches have the word
    among their top keywords, and its highest weight that year."""
    j = per_doc if group_col in per_doc.columns else per_doc.join(
        docs.select("doc_id", group_col), "doc_id")
    y = F.year(parse_date(F.col("date")))
    return (j.withColumn("year", y)
            .groupBy(group_col, "year", "word")
            .agg(F.count(F.lit(1)).alias("n_speeches"), F.max("tfidf").alias("max_tfidf"))
            .select(group_col, F.col("year").cast("int"), "word",
                    F.col("n_speeches").cast("long"), "max_tfidf"))
