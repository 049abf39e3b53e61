"""Ranked retrieval: cosine of query and document TF-IDF vectors.

One query and a batch of queries are the same plan (a `query_id` column):

    queries -> tokens -> weights under the model (vocabulary broadcast)
            -> join on term -> sum of products per (query, doc)
            -> floor -> top-k per query -> display fields of the hits

Queries are taken in blocks of bounded size, each broadcast to the weights. The
weights are bucketed by doc_id, so a document's sum is complete where its rows
lie: no (query, doc) pair crosses the network, and the top-k window gets a
partial `WindowGroupLimit` before its shuffle on `query_id`, so at most k rows
per query per partition move. Queries of a few terms in all read the postings
instead, whose scan takes the terms as a filter and skips row groups.

Display fields come from a narrow table (doc_id, snippet, name, party, date)
where there is one (`display_fields`), so no speech is read for a hit.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.lexicon import in_list
from ..functions.sizing import BROADCAST_ROWS, local_frame, maybe_broadcast
from ..functions.text import snippet
from ..schema import DATE, HITS, MEMBER, PARTY, SCORE_DIGITS, SPEECH
from ..session import durable
from .tfidf import TfidfModel

SEARCH_SIZE = 10
SCORE_FLOOR = 0.001
# query-term rows per broadcast block (some 50 bytes each)
BLOCK_ROWS = 500_000
# query-term rows read by the driver and inlined (some 50 bytes each)
INLINE_ROWS = 20_000
# up to so many different terms (Parquet pushes an IN list of ten values as
# such, a longer one as a range) the sorted postings are read instead
POINT_TERMS = 10


def query_weights(model: TfidfModel, queries: DataFrame, id_col: str = "query_id",
                  text_col: str = "text") -> DataFrame:
    return model.transform(queries, id_col, text_col).select(
        F.col(id_col).cast("long").alias("query_id"), "term", F.col("weight").alias("qw"))


@dataclass(frozen=True)
class _Weighed:
    """Query weights in broadcast blocks, the different terms if they are few, and
    the number of queries if it is known."""

    blocks: list
    terms: list | None
    n_queries: int | None


def _weighed(model: TfidfModel, queries: DataFrame, id_col: str, text_col: str) -> _Weighed:
    q = query_weights(model, queries, id_col, text_col)
    # the weights of few queries are read once and inlined: one job, no files
    few = q.limit(INLINE_ROWS + 1).collect()
    if len(few) <= INLINE_ROWS:
        own = local_frame(q.sparkSession, [tuple(r) for r in few], "query_id long, term string, qw double")
        terms = sorted({r["term"] for r in few})
        return _Weighed([own], terms if len(terms) <= POINT_TERMS else None, len({r["query_id"] for r in few}))
    q = durable(q)
    blocks = max(1, -(-q.count() // BLOCK_ROWS))
    block = F.pmod(F.xxhash64("query_id"), F.lit(blocks))
    return _Weighed([q if blocks == 1 else q.where(block == i) for i in range(blocks)], None, None)


def _scores(model: TfidfModel, weighed: _Weighed) -> DataFrame:
    if weighed.terms is not None:
        docs = model.postings.select("term", "doc_id", "weight").filter(in_list("term", weighed.terms))
    else:
        docs = model.weights.select("term", "doc_id", "weight")
    return reduce(DataFrame.union, [docs.join(F.broadcast(p), "term").groupBy("query_id", "doc_id").agg(
        F.sum(F.col("weight") * F.col("qw")).alias("score")) for p in weighed.blocks])


def score(model: TfidfModel, queries: DataFrame, id_col: str = "query_id",
          text_col: str = "text") -> DataFrame:
    """(query_id, doc_id, score) for every document sharing a term with a query."""
    return _scores(model, _weighed(model, queries, id_col, text_col))


def top_hits(scores: DataFrame, k: int = SEARCH_SIZE, floor: float = SCORE_FLOOR) -> DataFrame:
    """Top-k per query by rounded score, then doc_id; scores below `floor` dropped."""
    if int(k) < 1:
        raise ValueError("k must be at least 1")
    s = scores.withColumn("score", F.round("score", SCORE_DIGITS)).filter(F.col("score") >= floor)
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("doc_id"))
    ranked = s.withColumn("rank", F.row_number().over(w))
    return ranked.filter(F.col("rank") <= k).select(
        "query_id", "doc_id", "score", F.col("rank").cast("int").alias("rank"))


def display_fields(docs: DataFrame) -> DataFrame:
    """The narrow table that hits are shown with; written once, it spares every
    search the reading of speeches."""
    return docs.select("doc_id", snippet(F.col(SPEECH)).alias("speech_start"), F.col(MEMBER).alias("name"),
                       F.col(PARTY), F.col(DATE).alias("date"))


def attach_display(hits: DataFrame, docs: DataFrame, most_hits: int | None = None) -> DataFrame:
    """Join hits with snippet, name, party and date, ordered by (query_id, rank).
    `docs` is either the documents or their `display_fields`; `most_hits` bounds
    the hits, where that is known, and spares counting them."""
    fields = docs if "speech_start" in docs.columns else display_fields(docs)
    if most_hits is not None and most_hits <= BROADCAST_ROWS:
        side = F.broadcast(hits)
    else:
        side, _ = maybe_broadcast(hits)
    return fields.join(side, "doc_id").select(
        F.col("query_id").cast("long").alias("query_id"), "rank", F.col("doc_id").cast("long"),
        "speech_start", "name", F.col(PARTY), "date", F.col("score").cast("double")).orderBy("query_id", "rank")


def search(model: TfidfModel, docs: DataFrame, queries: DataFrame, k: int = SEARCH_SIZE,
           floor: float = SCORE_FLOOR, id_col: str = "query_id",
           text_col: str = "text") -> DataFrame:
    """Ranked hits of each query with snippets: the HITS schema."""
    weighed = _weighed(model, queries, id_col, text_col)
    hits = top_hits(_scores(model, weighed), k, floor)
    return attach_display(hits, docs, None if weighed.n_queries is None else weighed.n_queries * int(k))


def search_text(spark: SparkSession, model: TfidfModel, docs: DataFrame, text: str | None,
                k: int = SEARCH_SIZE, floor: float = SCORE_FLOOR) -> DataFrame:
    """One query string. Empty text means no search: an empty HITS frame."""
    if not text or not text.strip():
        return spark.createDataFrame([], HITS)
    q = spark.range(1).select(F.lit(0).cast("long").alias("query_id"), F.lit(text).alias("text"))
    return search(model, docs, q, k, floor)


def fetch_hits(hits: DataFrame, docs: DataFrame) -> DataFrame:
    """Full records of the documents that appear in `hits` (left semi join)."""
    ids, _ = maybe_broadcast(hits.select("doc_id").distinct())
    return docs.join(ids, "doc_id", "left_semi")


def suggest_terms(model: TfidfModel, text: str, limit: int = 10) -> DataFrame:
    """Vocabulary terms containing `text` (case-insensitive), most documents first."""
    v = model.vocabulary
    hit = v.filter(F.lower(F.col("term")).contains(text.lower()))
    return hit.orderBy(F.desc("df"), F.asc("term")).limit(limit).select(
        "term", F.col("df").cast("long").alias("df"))
