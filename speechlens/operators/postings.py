"""Block-max postings: exact ranked search that reads few posting blocks.

Documents are cut into ranges of `RANGE_DOCS` consecutive ids. A block holds all
postings of one term in one range: document ids as differences from the range's
first id (two bytes each), their weights, and the largest weight. A query is
answered in four steps, all joins and aggregates:

1. a threshold from below: of the terms' champions (each term's `CHAMPIONS`
   heaviest postings) the `FIRST_DOCS` documents of the best partial scores are
   scored in full, with their ranges; the k-th of them is no more than the true one;
2. block maxima bound what any document of a range can score;
3. ranges whose bound stays under the threshold are skipped with all their blocks; in
   the others the weakest terms, whose maxima together stay under it, are
   non-essential (MaxScore): only the other blocks name candidates;
4. the non-essential blocks of ranges that still hold a candidate complete the
   scores.

The result equals the exhaustive search: bounds are compared with a slack that
covers rounding, and ties at the k-th place stay. Blocks are bucketed by range
and sorted by term, so bounds, candidates and scores of a range are summed where
its blocks lie, and the terms of a short query are pushed into the scan. What is
skipped is decoding, joining and summing postings: few for queries of some ten
terms or more, whose bounds add up, most for short ones. Ids should be dense (as
`consolidate` gives them); sparse ids only make blocks smaller.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.lexicon import in_list
from ..functions.sizing import marker, maybe_broadcast, partitions_for
from ..functions.tables import bucketed_table, write_bucketed
from ..schema import SCORE_DIGITS
from ..session import durable, path_exists
from .search import BLOCK_ROWS, POINT_TERMS, SCORE_FLOOR, SEARCH_SIZE, attach_display, query_weights, top_hits
from .tfidf import TfidfModel

RANGE_DOCS = 32
CHAMPIONS = 100
FIRST_DOCS = 100
#: scores are ranked rounded; a bound this far under the threshold cannot matter
SLACK = 2.0 * 10.0 ** -SCORE_DIGITS
_DDL = "range_id BIGINT, term STRING, n INT, top DOUBLE, deltas ARRAY<SMALLINT>, weights ARRAY<DOUBLE>"


@dataclass
class BlockIndex:
    blocks: DataFrame      # range_id, term, n, top, deltas, weights
    champions: DataFrame   # term, doc_id, weight
    range_docs: int


def posting_blocks(weights: DataFrame, range_docs: int = RANGE_DOCS, n: int = 0) -> DataFrame:
    """One row for each (range, term): its postings in id order. A block holds at
    most `range_docs` postings, so no group grows with the corpus. With `n` the
    weights are dealt to as many partitions by range first, and their blocks are
    made where they lie: the only shuffle."""
    range_id = F.floor(F.col("doc_id") / F.lit(range_docs)).cast("long")
    own = weights.select(range_id.alias("range_id"), "doc_id", "term", "weight")
    grouped = (own.repartition(n, "range_id") if n else own).groupBy("range_id", "term").agg(
        F.sort_array(F.collect_list(F.struct("doc_id", "weight"))).alias("p"), F.max("weight").alias("top"))
    return grouped.select(
        "range_id", "term", F.size("p").alias("n"), "top",
        F.transform("p", lambda x: (x["doc_id"] - F.col("range_id") * F.lit(range_docs)).cast("short")).alias("deltas"),
        F.col("p")["weight"].alias("weights"))


def build_index(model: TfidfModel, path: str, range_docs: int = RANGE_DOCS) -> BlockIndex:
    """The blocks and champions of a fitted model, written to `path` once."""
    if not 1 <= range_docs <= 32_767:
        raise ValueError("a range has 1 to 32767 documents")
    spark = model.weights.sparkSession
    if not path_exists(spark, f"{path}/_DONE"):
        n = partitions_for(model.weights)
        write_bucketed(posting_blocks(model.weights, range_docs, n), f"{path}/blocks", n, "range_id", ["term", "range_id"], dealt=True)
        # a hot term keeps only its champions in each task before they meet
        best = F.row_number().over(Window.partitionBy("term").orderBy(F.desc("weight"), F.asc("doc_id")))
        model.weights.select("term", "doc_id", "weight", best.alias("r")).where(F.col("r") <= CHAMPIONS).drop("r").repartition(
            "term").sortWithinPartitions("term").write.mode("overwrite").parquet(f"{path}/champions")
        spark.range(1).select(F.lit(range_docs).alias("range_docs"), F.lit(n).alias("n_buckets")).coalesce(1).write.mode(
            "overwrite").parquet(f"{path}/meta")
        marker(spark, f"{path}/_DONE")
    return load_index(spark, path)


def load_index(spark: SparkSession, path: str) -> BlockIndex:
    meta = spark.read.parquet(f"{path}/meta").first()
    blocks = bucketed_table(spark, f"{path}/blocks", _DDL, meta["n_buckets"], "range_id", ["term", "range_id"])
    return BlockIndex(blocks, spark.read.parquet(f"{path}/champions"), meta["range_docs"])


def _parts(index: BlockIndex, wanted: DataFrame) -> DataFrame:
    """The postings of the wanted (query_id, range_id, term, qw, ...) blocks, each
    with its part of the score."""
    side, _ = maybe_broadcast(wanted)
    rows = index.blocks.select("range_id", "term", "deltas", "weights").join(side, ["range_id", "term"])
    rows = rows.select(*wanted.columns, F.explode(F.arrays_zip("deltas", "weights")).alias("p"))
    return rows.withColumn("doc_id", F.col("range_id") * F.lit(index.range_docs) + F.col("p.deltas")).withColumn(
        "part", F.col("p.weights") * F.col("qw")).drop("p")


def _summed(parts: DataFrame) -> DataFrame:
    return parts.groupBy("query_id", "doc_id").agg(F.sum("part").alias("score"))


def _raised(theta: DataFrame, scores: DataFrame, k: int) -> DataFrame:
    """`theta` raised to the k-th best of `scores` where a query has k of them."""
    w = Window.partitionBy("query_id").orderBy(F.desc("score"))
    kth = scores.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k).groupBy("query_id").agg(
        F.max(F.when(F.col("r") == k, F.col("score"))).alias("kth"))
    return theta.join(kth, "query_id", "left").select(
        "query_id", F.greatest("theta", F.coalesce("kth", "theta")).alias("theta"))


@dataclass
class PrunedScores:
    scores: DataFrame   # query_id, doc_id, score: every document that can be among the k best
    read: DataFrame     # query_id, blocks, blocks_read


def pruned_scores(index: BlockIndex, q: DataFrame, k: int = SEARCH_SIZE, floor: float = SCORE_FLOOR) -> PrunedScores:
    """Scores of every document that can be among the k best of its query, for
    query weights (query_id, term, qw)."""
    q, _ = maybe_broadcast(q, BLOCK_ROWS)
    terms = [r[0] for r in q.select("term").distinct().limit(POINT_TERMS + 1).collect()]
    if len(terms) <= POINT_TERMS:
        index = replace(index, blocks=index.blocks.where(in_list("term", sorted(terms))),
                        champions=index.champions.where(in_list("term", sorted(terms))))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("doc_id"))
    promising = _summed(index.champions.join(q, "term").withColumn("part", F.col("weight") * F.col("qw"))).withColumn(
        "r", F.row_number().over(best)).where(F.col("r") <= FIRST_DOCS)
    ranges = promising.select("query_id", F.floor(F.col("doc_id") / F.lit(index.range_docs)).alias("range_id")).distinct()
    first = durable(ranges.join(q, "query_id"))
    first_ranges, _ = maybe_broadcast(first.select("query_id", "range_id").distinct())
    scored = durable(_summed(_parts(index, first)))
    lowest = F.lit(floor - 0.5 * 10.0 ** -SCORE_DIGITS)
    theta = F.broadcast(durable(_raised(q.select("query_id").distinct().withColumn("theta", lowest), scored, k)))

    # bounds are summed where a range's blocks lie; only narrow columns are read
    in_range = Window.partitionBy("query_id", "range_id")
    rising = in_range.orderBy("bound", "term").rowsBetween(Window.unboundedPreceding, 0)
    bounds = index.blocks.select("range_id", "term", "top").join(q, "term").join(theta, "query_id").join(
        first_ranges.withColumn("done", F.lit(True)), ["query_id", "range_id"], "left").withColumn(
        "bound", F.col("top") * F.col("qw")).withColumn("below", F.sum("bound").over(rising)).withColumn(
        "whole", F.max("below").over(in_range))
    reach = F.col("theta") - F.lit(SLACK)
    rest = F.coalesce(F.max(F.when(~F.col("essential"), F.col("below"))).over(in_range), F.lit(0.0))
    live = durable(bounds.where((F.col("whole") >= reach) & F.col("done").isNull()).withColumn(
        "essential", F.col("below") >= reach).withColumn("rest", rest).select(
        "query_id", "range_id", "term", "qw", "theta", "essential", "rest"))
    # candidates: documents of essential blocks which the rest could lift to the threshold
    candidates = durable(_parts(index, live.where("essential")).groupBy("query_id", "range_id", "doc_id").agg(
        F.sum("part").alias("part"), F.max("rest").alias("rest"), F.max("theta").alias("theta")).where(
        F.col("part") + F.col("rest") >= reach).select("query_id", "range_id", "doc_id", "part"))
    more = durable(live.where("NOT essential").join(candidates, ["query_id", "range_id"], "left_semi"))
    side, _ = maybe_broadcast(candidates.select("query_id", "doc_id"))
    completed = _parts(index, more).join(side, ["query_id", "doc_id"], "left_semi").select("query_id", "doc_id", "part")
    scores = scored.unionByName(_summed(candidates.select("query_id", "doc_id", "part").unionByName(completed)))
    narrow = index.blocks.select("range_id", "term").join(q, "term")
    read = narrow.join(first_ranges, ["query_id", "range_id"], "left_semi").select("query_id").union(
        live.where("essential").select("query_id")).union(more.select("query_id"))
    counts = narrow.groupBy("query_id").agg(F.count(F.lit(1)).alias("blocks")).join(
        read.groupBy("query_id").agg(F.count(F.lit(1)).alias("blocks_read")), "query_id", "left").select(
        "query_id", "blocks", F.coalesce("blocks_read", F.lit(0)).alias("blocks_read"))
    return PrunedScores(scores, counts)


def search_pruned(model: TfidfModel, index: BlockIndex, docs: DataFrame, queries: DataFrame, k: int = SEARCH_SIZE,
                  floor: float = SCORE_FLOOR, id_col: str = "query_id", text_col: str = "text") -> DataFrame:
    """`search` through the block index: the same hits from fewer postings."""
    found = pruned_scores(index, query_weights(model, queries, id_col, text_col), k, floor)
    return attach_display(top_hits(found.scores, k, floor), docs)
