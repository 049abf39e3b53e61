"""Clusters of speeches in topic space, and what the members of a cluster share.

* `fit_clusters`: k-means (Spark ML, seeded, Euclidean, unnormalised) on the
  documents' topic vectors ``U S``; labels are renumbered so that cluster 0
  holds the smallest doc_id, cluster 1 the next smallest first member, ...
* `assign_to_centres`: nearest centre for each vector, as one JVM-side
  expression over a literal centre matrix (k x d, bounded by k): no join.
* `cluster_examples`: the first 10 speeches of each cluster in doc order,
  empty clusters included (a `row_number() <= 10` window with a partial
  limit before its shuffle).
* `cluster_profile` / `cluster_top_terms`: size, cohesion (mean cosine of
  the members' TF-IDF vectors to the cluster centroid) and the centroid's
  top terms — for any assignment, e.g. k-means labels or given labels.
"""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sizing import collect_bounded, maybe_broadcast
from ..session import durable
from ..schema import SCORE_DIGITS, SPEECH

N_CLUSTERS = 10
EXAMPLES = 10
SEED = 42
MAX_CENTRES = 10_000
# topic vectors per partition of the k-means input
VECTORS_PER_PARTITION = 50_000


def checked_k(k: int) -> int:
    """The number of clusters as asked for; an error if it can't be had."""
    if not 1 <= int(k) <= MAX_CENTRES:
        raise ValueError(f"the number of clusters must be from 1 to {MAX_CENTRES}")
    return int(k)


def nearest_centre(vec: Column, centres: list[list[float]], ids: list[int] | None = None) -> Column:
    """Id of the closest centre (Euclidean; ties to the smaller id)."""
    ids = ids if ids is not None else list(range(len(centres)))
    dists = []
    for cid, c in zip(ids, centres):
        cl = F.array(*[F.lit(float(x)) for x in c])
        sq = F.aggregate(F.zip_with(vec, cl, lambda a, b: (a - b) * (a - b)), F.lit(0.0),
                         lambda acc, x: acc + x)
        dists.append(F.struct(F.sqrt(sq).alias("d"), F.lit(int(cid)).alias("id")))
    return F.array_min(F.array(*dists))


def assign_to_centres(vectors: DataFrame, vec_col: str, centres: list[list[float]],
                      ids: list[int] | None = None) -> DataFrame:
    """Adds `cluster_id` and `distance` for the nearest of the given centres."""
    if len(centres) > MAX_CENTRES:
        raise ValueError("too many centres to inline")
    best = nearest_centre(F.col(vec_col).cast("array<double>"), centres, ids)
    return vectors.withColumn("_best", best).withColumn(
        "cluster_id", F.col("_best.id").cast("int")).withColumn(
        "distance", F.col("_best.d")).drop("_best")


def label_means(df: DataFrame, vec_col: str, label_col: str) -> tuple[list[int], list[list[float]]]:
    """Mean vector per label (element-wise), as driver lists bounded by the label count."""
    ex = df.select(label_col, F.posexplode(vec_col).alias("i", "x"))
    means = ex.groupBy(label_col, "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    per = means.groupBy(label_col).agg(
        F.sort_array(F.collect_list(F.struct("i", "m"))).alias("v"))
    rows = collect_bounded(per.select(label_col, F.col("v.m").alias("m")), MAX_CENTRES, "centres")
    rows.sort(key=lambda r: r[0])
    return [int(r[0]) for r in rows], [list(r[1]) for r in rows]


def fit_clusters(topic_vectors: DataFrame, k: int = N_CLUSTERS, seed: int = SEED,
                 max_iter: int = 100) -> tuple[DataFrame, list[list[float]]]:
    """(doc_id, cluster_id, distance) and the centres, clusters renumbered by
    their smallest doc_id."""
    k = checked_k(k)
    # (docs x k) doubles, derived from all weights: materialised once, with
    # summation-order noise rounded away, hashed by doc_id into a number of
    # partitions that follows from the data alone and sorted there: the seeded
    # k-means|| sampling sees the same input whatever the session's settings
    rounded = durable(topic_vectors.select("doc_id", F.transform("topic", lambda x: F.round(x, 10)).alias("topic")))
    n_parts = max(1, -(-rounded.count() // VECTORS_PER_PARTITION))
    topic_vectors = durable(rounded.repartition(n_parts, "doc_id").sortWithinPartitions("doc_id"))
    data = topic_vectors.select("doc_id", array_to_vector("topic").alias("features")).cache()
    km = KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="features",
                predictionCol="raw_cluster").fit(data)
    centres = [list(map(float, c)) for c in km.clusterCenters()]
    assigned = assign_to_centres(topic_vectors, "topic", centres)
    firsts = collect_bounded(assigned.groupBy("cluster_id").agg(F.min("doc_id").alias("m")),
                             MAX_CENTRES, "cluster ids")
    order = sorted(firsts, key=lambda r: r["m"])
    new_id = {r["cluster_id"]: i for i, r in enumerate(order)}
    # clusters left empty keep the numbers after the populated ones
    for c in range(len(centres)):
        if c not in new_id:
            new_id[c] = len(new_id)
    renum = [None] * len(centres)
    for old, new in new_id.items():
        renum[new] = centres[old]
    out = assign_to_centres(topic_vectors, "topic", renum).select("doc_id", "cluster_id", "distance")
    data.unpersist()
    return out, renum


def cluster_examples(assignment: DataFrame, docs: DataFrame, k: int,
                     n: int = EXAMPLES) -> DataFrame:
    """(cluster_id, size, rank, doc_id, speech): first `n` speeches of each
    cluster by doc_id; an empty cluster gives one row with size 0."""
    spark = assignment.sparkSession
    sizes = assignment.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("size"))
    w = Window.partitionBy("cluster_id").orderBy("doc_id")
    first = assignment.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
    # at most n rows a cluster: they go to the speeches, so no speech moves
    ex = docs.select("doc_id", SPEECH).join(maybe_broadcast(first)[0], "doc_id").select(
        "cluster_id", "rank", "doc_id", F.col(SPEECH).alias("speech"))
    ids = spark.range(k).select(F.col("id").cast("int").alias("cluster_id"))
    # at most k rows go on, and k is at most MAX_CENTRES
    sizes = sizes.where((F.col("cluster_id") >= 0) & (F.col("cluster_id") < k))
    full = ids.join(F.broadcast(sizes), "cluster_id", "left").join(ex, "cluster_id", "left")
    return full.select(F.col("cluster_id").cast("int"),
                       F.coalesce(F.col("size"), F.lit(0)).cast("long").alias("size"),
                       F.col("rank").cast("int"), F.col("doc_id").cast("long"), "speech")


def _centroids(weights: DataFrame, assignment: DataFrame) -> tuple[DataFrame, DataFrame]:
    sizes = assignment.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n_docs"))
    sums = (weights.select("doc_id", "term", "weight").join(assignment.select("doc_id", "cluster_id"), "doc_id")
            .groupBy("cluster_id", "term").agg(F.sum("weight").alias("s")))
    sizes_side, _ = maybe_broadcast(sizes)
    cent = sums.join(sizes_side, "cluster_id").select(
        "cluster_id", "term", (F.col("s") / F.col("n_docs")).alias("c"))
    return cent, sizes


def cluster_profile(weights: DataFrame, assignment: DataFrame) -> DataFrame:
    """(cluster_id, n_docs, cohesion): cohesion = mean over the cluster's
    documents of cos(document, centroid); documents without terms count 0."""
    cent, sizes = _centroids(weights, assignment)
    # centroids are (clusters x vocabulary): computed once, reused three times
    cent = durable(cent)
    norms = cent.groupBy("cluster_id").agg(F.sqrt(F.sum(F.col("c") ** 2)).alias("cn"))
    cent_side, _ = maybe_broadcast(cent)
    dots = (weights.select("doc_id", "term", "weight")
            .join(assignment.select("doc_id", "cluster_id"), "doc_id")
            .join(cent_side, ["cluster_id", "term"])
            .groupBy("cluster_id", "doc_id").agg(F.sum(F.col("weight") * F.col("c")).alias("dot")))
    cos = dots.join(maybe_broadcast(norms)[0], "cluster_id").select(
        "cluster_id", (F.col("dot") / F.col("cn")).alias("cos"))
    tot = cos.groupBy("cluster_id").agg(F.sum("cos").alias("sc"))
    out = sizes.join(tot, "cluster_id", "left").select(
        F.col("cluster_id").cast("int"), F.col("n_docs").cast("long"),
        F.round(F.coalesce(F.col("sc"), F.lit(0.0)) / F.col("n_docs"), SCORE_DIGITS).alias("cohesion"))
    return out


def cluster_top_terms(weights: DataFrame, assignment: DataFrame, n: int = 10) -> DataFrame:
    """(cluster_id, rank, term, weight): the centroid's heaviest terms."""
    cent, _ = _centroids(weights, assignment)
    r = cent.select("cluster_id", "term", F.round("c", SCORE_DIGITS).alias("weight"))
    w = Window.partitionBy("cluster_id").orderBy(F.desc("weight"), F.asc("term"))
    top = r.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
    return top.select(F.col("cluster_id").cast("int"), F.col("rank").cast("int"), "term", "weight")
