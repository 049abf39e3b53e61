"""TF-IDF fit and transform as DataFrame operations.

Pipeline per document: clean -> tokens -> drop stop words -> stem -> count.
Model: document frequency `df` and corpus frequency `cf` per term; terms in
more than `max_df` of the documents are dropped; the `max_features` terms of
highest `cf` are kept (ties: term ascending); term ids are alphabetical;
``idf = ln((1 + n) / (1 + df)) + 1``; weights are ``tf * idf`` scaled to unit
L2 norm per document.

Physical plan, chosen for large corpora:

* documents are hash-partitioned by `doc_id` once, before tokenising (that
  shuffle carries raw text, cheaper than token rows); term counts, the L2 norm
  window and the weights then stay inside those partitions — no further
  shuffle on `doc_id`;
* `df`/`cf` is one partially aggregated shuffle on `term` (a term found in
  every document still yields one row per map partition);
* the vocabulary is bounded by `max_features`, so it is broadcast;
* weights are kept twice: document-clustered for per-document jobs, and
  range-partitioned and sorted on (term, doc_id) as postings for search, so a
  term filter skips row groups and a very frequent term spans several
  partitions instead of one;
* a written model whose vocabulary is not broadcast (`max_features=None`) takes as
  little disk as its rows need: the counts are written once in place of a cache, the
  weights and postings are made in `FIT_SLICES` parts, each with its share of the
  shuffles, and keep `tf`, `df` and the document's norm, from which the weight is
  computed as it is read.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import lexicon
from ..functions.ids import kth_largest, with_sequential_id
from ..functions.sizing import BROADCAST_ROWS, estimated_bytes, marker, partitions_for
from ..functions.text import tokens
from ..schema import SCORE_DIGITS
from ..session import drop_path, path_exists, scratch_path, shuffles_dropped

# vocabulary sizes up to this are broadcast (bounded by max_features)
VOCAB_BROADCAST_LIMIT = 2_000_000
# partitions x max_features rows a direct top-k may merge in one task
TOPK_DIRECT_ROWS = 2_000_000
# parts in which the weights of a large vocabulary are made, and bytes of counts that make one worth while
FIT_SLICES, SLICE_BYTES = 4, 8_000_000


@dataclass(frozen=True)
class TextOptions:
    """Resolved stop words and suffix rules applied to documents and queries."""

    stop_words: tuple[str, ...] = ()
    stem_rules: tuple[tuple[str, str, int], ...] = ()

    @staticmethod
    def build(stop_words=None, stem_rules=None, languages=lexicon.DEFAULT_LANGUAGES,
              remove_stop_words: bool = True, stemming: bool = True) -> "TextOptions":
        words = tuple(lexicon.as_word_list(stop_words, languages)) if remove_stop_words else ()
        rules = tuple(lexicon.as_rule_list(stem_rules)) if stemming else ()
        return TextOptions(words, rules)


DEFAULT_OPTIONS = None  # resolved lazily (asks Spark for its lists once)


def default_options() -> TextOptions:
    global DEFAULT_OPTIONS
    if DEFAULT_OPTIONS is None:
        DEFAULT_OPTIONS = TextOptions.build()
    return DEFAULT_OPTIONS


def doc_terms(src: DataFrame, id_col: str, text_col: str, opts: TextOptions) -> DataFrame:
    """One row per kept token occurrence: (id, term)."""
    tok = src.select(F.col(id_col), F.explode(tokens(F.col(text_col))).alias("token"))
    tok = tok.filter(lexicon.not_stop_word("token", opts.stop_words))
    t = tok.select(F.col(id_col), lexicon.stem("token", opts.stem_rules).alias("term"))
    # a stem must still be a token of two or more characters
    return t.filter(F.length("term") >= 2)


def text_term_counts(texts: DataFrame, id_col: str, text_col: str,
                     opts: TextOptions) -> DataFrame:
    """(id, term, tf) of free texts (queries): same pipeline as documents,
    one partially aggregated shuffle on (id, term)."""
    terms = doc_terms(texts.select(F.col(id_col), F.col(text_col)), id_col, text_col, opts)
    return terms.groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf"))


def term_frequencies(docs: DataFrame, opts: TextOptions | None = None, *,
                     id_col: str = "doc_id", text_col: str = "speech",
                     num_partitions: int | None = None, parts: bool = False, clustered: bool = False) -> DataFrame:
    """(doc_id, term, tf) for every term of every document.

    One row per document: rows are hash-partitioned by doc_id before
    tokenising, and everything after stays in place; documents that are read from
    a store bucketed by doc_id (`clustered`) are so already, and no text moves. Several rows per
    document (`parts=True`, e.g. the speeches of a consolidated group):
    rows are tokenised where they are and the counts are combined by a
    partially aggregated shuffle on (doc_id, term), so a document holding a
    third of all text is still spread over all tasks."""
    opts = opts or default_options()
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    if not parts and not clustered:
        src = src.repartition(num_partitions or partitions_for(src), "doc_id")
    terms = doc_terms(src, "doc_id", "text", opts)
    return terms.groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("tf"))


def term_statistics(tf: DataFrame) -> DataFrame:
    """(term, df, cf): documents containing the term, and its total count."""
    return tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))


def _idf(n_docs: int) -> Column:
    return F.log((F.lit(1.0) + F.lit(n_docs)) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)


def _broadcasts(max_features: int | None) -> bool:
    return max_features is not None and max_features <= VOCAB_BROADCAST_LIMIT


def select_vocabulary(stats: DataFrame, n_docs: int, max_df: float | int = 0.9,
                      max_features: int | None = 6000) -> DataFrame:
    """Apply max_df and max_features, number terms alphabetically, add idf."""
    limit = max_df if isinstance(max_df, int) and not isinstance(max_df, bool) else max_df * n_docs
    kept = stats.filter(F.col("df") <= F.lit(float(limit)))
    if max_features is not None:
        # a plain top-k merges k rows from every partition in one task; when
        # that product is large, the exact cf of the k-th term is found from
        # two small histograms first, so the final sort only sees the terms at
        # or above it (k plus ties). Numbering then runs over k rows.
        n_parts = int(stats.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        if n_parts * int(max_features) > TOPK_DIRECT_ROWS:
            cut = kth_largest(kept, "cf", int(max_features))
            if cut is not None:
                kept = kept.filter(F.col("cf") >= F.lit(cut))
        top = kept.orderBy(F.desc("cf"), F.asc("term")).limit(int(max_features))
        vocab = top.withColumn(
            "term_id", (F.row_number().over(Window.orderBy("term")) - 1).cast("int"))
    else:
        vocab = with_sequential_id(kept, ["term"], "term_id").withColumn(
            "term_id", F.col("term_id").cast("int"))
    idf = _idf(n_docs)
    return vocab.select("term", "term_id", F.col("df").cast("long").alias("df"),
                        F.col("cf").cast("long").alias("cf"), idf.alias("idf"))


def vocabulary_side(vocab: DataFrame, max_features: int | None) -> DataFrame:
    v = vocab.select("term", "term_id", "idf")
    return F.broadcast(v) if _broadcasts(max_features) else v


def weigh(tf: DataFrame, vocab_side: DataFrame, key: str = "doc_id") -> DataFrame:
    """tf rows -> (key, term, term_id, tf, weight) with unit L2 norm per key."""
    j = tf.join(vocab_side, "term")
    raw = F.col("tf") * F.col("idf")
    norm = F.sqrt(F.sum(raw * raw).over(Window.partitionBy(key)))
    return j.select(F.col(key), "term", "term_id", F.col("tf").cast("long").alias("tf"),
                    (raw / norm).alias("weight"))


@dataclass
class TfidfModel:
    vocabulary: DataFrame          # term, term_id, df, cf, idf
    n_docs: int
    weights: DataFrame             # doc_id, term, term_id, tf, weight (document-clustered)
    postings: DataFrame            # same rows, sorted by (term, doc_id)
    options: TextOptions = field(default_factory=default_options)
    max_df: float = 0.9
    max_features: int | None = 6000
    path: str | None = None
    parts: bool = False
    #: the weights as products (doc_id, term_id, weight * term_scale / doc_scale), if kept so
    factors: DataFrame | None = None

    def vocab_side(self) -> DataFrame:
        return vocabulary_side(self.vocabulary, self.max_features)

    def transform(self, texts: DataFrame, id_col: str = "query_id",
                  text_col: str = "text") -> DataFrame:
        """Weights of new texts under this model: (id, term, term_id, tf, weight).
        Unknown terms vanish (inner join); empty texts give no rows."""
        return weigh(text_term_counts(texts, id_col, text_col, self.options),
                     self.vocab_side(), key=id_col)


def fit_tfidf(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "speech",
              max_df: float | int = 0.9, max_features: int | None = 6000,
              options: TextOptions | None = None, path: str | None = None,
              num_partitions: int | None = None, parts: bool = False,
              n_docs: int | None = None, clustered: int = 0) -> TfidfModel:
    """Fit the model on `docs` and weigh every document.

    With `path`, the model, the document weights and the postings are
    written there (and reused if already present); without it they are
    persisted in executor memory/disk for this session. `parts=True` takes
    several text rows per document (see `term_frequencies`); `n_docs` then
    defaults to the number of distinct ids (pass the group count to include
    groups without any text). `clustered` is the number of buckets by doc_id that
    `docs` is read from (a document store's), which spares the shuffle of texts.
    """
    spark = docs.sparkSession
    opts = options or default_options()
    if path and path_exists(spark, f"{path}/_DONE"):
        found = load_tfidf(spark, path)
        asked = (float(max_df), max_features, opts, parts)
        if (found.max_df, found.max_features, found.options, found.parts) != asked:
            raise ValueError(f"{path} holds a model fitted with other parameters; give another path")
        return found

    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("speech"))
    if n_docs is None:
        n_docs = src.select("doc_id").distinct().count() if parts else src.count()
    n_text = clustered or num_partitions or partitions_for(src)
    tf = term_frequencies(src, opts, num_partitions=n_text, parts=parts, clustered=bool(clustered))
    if path and not _broadcasts(max_features):
        at = scratch_path(spark, "counts")
        with shuffles_dropped(spark):
            tf.write.option("compression", "zstd").parquet(at)
            tf = spark.read.parquet(at)
            model = fit_from_counts(tf, term_statistics(tf), n_docs, max_df=max_df, max_features=max_features, options=opts,
                                    path=path, num_partitions=num_partitions, n_buckets=n_text, parts=parts)
        drop_path(spark, at)
        return model
    tf = tf.persist(StorageLevel.MEMORY_AND_DISK)
    return fit_from_counts(tf, term_statistics(tf), n_docs, max_df=max_df, max_features=max_features, options=opts,
                           path=path, num_partitions=num_partitions, n_buckets=0 if parts else n_text, parts=parts)


def fit_from_counts(tf: DataFrame, stats: DataFrame, n_docs: int, *, max_df: float | int = 0.9,
                    max_features: int | None = 6000, options: TextOptions | None = None, path: str | None = None,
                    num_partitions: int | None = None, n_buckets: int = 0, parts: bool = False) -> TfidfModel:
    """The model of given term counts (doc_id, term, tf), a document's rows in one
    partition, and of their statistics (term, df, cf). `n_buckets` is their
    number of hash partitions by doc_id, 0 if they are not dealt so."""
    spark = tf.sparkSession
    opts = options or default_options()
    vocab = select_vocabulary(stats, n_docs, max_df, max_features)
    if path:
        vocab.write.mode("overwrite").parquet(f"{path}/model")
        vocab = spark.read.parquet(f"{path}/model")
        if not _broadcasts(max_features):
            with shuffles_dropped(spark):
                n_buckets = n_buckets or partitions_for(tf)
                _write_factored(spark, tf, vocab, path, n_buckets, num_partitions)
                _write_meta(spark, path, n_docs, max_df, max_features, n_buckets, parts, opts, factored=True)
            tf.unpersist()
            return _factored(spark, path, vocab, n_docs, opts, max_df, max_features, n_buckets, parts)
    else:
        vocab = vocab.persist(StorageLevel.MEMORY_AND_DISK)
    weights = weigh(tf, vocabulary_side(vocab, max_features))
    if path:
        # the weights are already hash-partitioned by doc_id: written as a table
        # bucketed on doc_id, later per-document joins, windows and groupings
        # read them without a shuffle
        weights, n_buckets = _write_weights(spark, weights, path, n_buckets)
        tf.unpersist()
        # sized from the written files (a plan estimate of a join is not a size)
        n_parts = num_partitions or partitions_for(weights)
        _sorted_postings(weights, n_parts).write.mode("overwrite").parquet(f"{path}/postings")
        postings = spark.read.parquet(f"{path}/postings")
        _write_meta(spark, path, n_docs, max_df, max_features, n_buckets, parts, opts)
    else:
        weights = weights.persist(StorageLevel.MEMORY_AND_DISK)
        weights.count()
        tf.unpersist()
        n_parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
        postings = _sorted_postings(weights, n_parts).persist(StorageLevel.MEMORY_AND_DISK)
    return TfidfModel(vocab, int(n_docs), weights, postings, opts, float(max_df), max_features, path, parts)


def _write_meta(spark: SparkSession, path: str, n_docs: int, max_df: float | int, max_features: int | None, n_buckets: int,
                parts: bool, opts: TextOptions, factored: bool = False) -> None:
    spark.range(1).select(
        F.lit(int(n_docs)).cast("long").alias("n_docs"), F.lit(float(max_df)).alias("max_df"),
        F.lit(max_features).cast("int").alias("max_features"),
        F.lit(int(n_buckets)).alias("n_buckets"), F.lit(bool(parts)).alias("parts"),
        F.lit(json.dumps(opts.stop_words)).alias("stop_words"),
        F.lit(json.dumps(opts.stem_rules)).alias("stem_rules"), F.lit(factored).alias("factored"),
    ).coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")
    marker(spark, f"{path}/_DONE")


def _write_factored(spark: SparkSession, tf: DataFrame, vocab: DataFrame, path: str, n_buckets: int, num_partitions: int | None) -> None:
    """Weights (doc_id, term, term_id, tf, df, norm) bucketed by doc_id, the norms of the
    documents, and postings (doc_id, term, term_id, tf, df) sorted by (term, doc_id)."""
    side = vocab.select("term", "term_id", "df", "idf")
    raw = F.col("tf") * F.col("idf")
    slices = min(FIT_SLICES, n_buckets, max(1, estimated_bytes(tf) // SLICE_BYTES))
    bucket = F.pmod(F.hash("doc_id"), F.lit(n_buckets))
    for s in range(slices):
        rows = tf.where(bucket % F.lit(slices) == s).join(side, "term").select(
            "doc_id", "term", "term_id", F.col("tf").cast("long").alias("tf"), "df",
            F.sqrt(F.sum(raw * raw).over(Window.partitionBy("doc_id"))).alias("norm"))
        rows.write.mode("append" if s else "overwrite").format("parquet").bucketBy(n_buckets, "doc_id").sortBy("doc_id").option(
            "path", f"{path}/weights").option("compression", "zstd").saveAsTable(_weights_table(path))
    weights = spark.table(_weights_table(path))
    weights.groupBy("doc_id").agg(F.first("norm").alias("norm")).write.mode("overwrite").parquet(f"{path}/norms")
    # term ids are alphabetical: ranges of them are ranges of terms
    cuts = sorted(set(weights.approxQuantile("term_id", [i / slices for i in range(1, slices)], 0.001))) if slices > 1 else []
    n_parts = -(-(num_partitions or partitions_for(weights)) // slices)
    for i, (lo, hi) in enumerate(zip([None, *cuts], [*cuts, None], strict=True)):
        some = weights.drop("norm")
        some = some if lo is None else some.where(F.col("term_id") > int(lo))
        some = some if hi is None else some.where(F.col("term_id") <= int(hi))
        _sorted_postings(some, n_parts).write.mode("append" if i else "overwrite").option("compression", "zstd").parquet(
            f"{path}/postings")


def _factored(spark: SparkSession, path: str, vocab: DataFrame, n_docs: int, opts: TextOptions, max_df: float | int,
              max_features: int | None, n_buckets: int, parts: bool) -> TfidfModel:
    """The model of weights that are written as their factors."""
    rows, norms = _read_weights(spark, path, n_buckets, _FACTORED_DDL), spark.read.parquet(f"{path}/norms")
    tf, weight = F.col("tf"), (F.col("tf") * _idf(n_docs) / F.col("norm")).alias("weight")
    small = int(n_docs) <= BROADCAST_ROWS
    of = norms.select(F.col("doc_id").alias("_id"), "norm")
    postings = spark.read.parquet(f"{path}/postings")
    n_parts = partitions_for(postings)
    postings = postings.join(F.broadcast(of) if small else of, F.col("doc_id").eqNullSafe(F.col("_id"))).select(
        "doc_id", "term", "term_id", "tf", weight)
    return TfidfModel(
        vocab, int(n_docs), rows.select("doc_id", "term", "term_id", "tf", weight),
        postings if small else _sorted_postings(postings, n_parts), opts, float(max_df), max_features, path, parts,
        rows.select("doc_id", "term_id", tf.alias("weight"), _idf(n_docs).alias("term_scale"), F.col("norm").alias("doc_scale")))


def _weights_table(path: str) -> str:
    return "speechlens_weights_" + hashlib.sha1(path.encode()).hexdigest()[:16]


_WEIGHTS_DDL = "doc_id BIGINT, term STRING, term_id INT, tf BIGINT, weight DOUBLE"
_FACTORED_DDL = "doc_id BIGINT, term STRING, term_id INT, tf BIGINT, df BIGINT, norm DOUBLE"


def _write_weights(spark: SparkSession, weights: DataFrame, path: str,
                   n_buckets: int) -> tuple[DataFrame, int]:
    """Write weights bucketed by doc_id, or as plain parquet for 0 buckets."""
    if n_buckets > 0:
        table = _weights_table(path)
        (weights.write.mode("overwrite").format("parquet")
         .bucketBy(n_buckets, "doc_id").sortBy("doc_id")
         .option("path", f"{path}/weights").saveAsTable(table))
        return spark.table(table), n_buckets
    weights.write.mode("overwrite").parquet(f"{path}/weights")
    return spark.read.parquet(f"{path}/weights"), 0


def _read_weights(spark: SparkSession, path: str, n_buckets: int, ddl: str = _WEIGHTS_DDL) -> DataFrame:
    """Weights of a written model; a bucketed table is registered again in a
    new session (its files carry the bucket ids)."""
    if n_buckets > 0:
        table = _weights_table(path)
        if not spark.catalog.tableExists(table):
            loc = f"{path}/weights".replace("'", "\\'")
            spark.sql(f"CREATE TABLE {table} ({ddl}) USING parquet "
                      f"CLUSTERED BY (doc_id) SORTED BY (doc_id) INTO {int(n_buckets)} BUCKETS "
                      f"LOCATION '{loc}'")
        return spark.table(table)
    return spark.read.parquet(f"{path}/weights")


def _sorted_postings(weights: DataFrame, n_parts: int) -> DataFrame:
    # range bounds are sampled on (term, doc_id): a hot term is split by doc_id
    return weights.repartitionByRange(n_parts, "term", "doc_id").sortWithinPartitions(
        "term", "doc_id")


def load_tfidf(spark: SparkSession, path: str) -> TfidfModel:
    """A written model with the text options and parameters it was fitted with."""
    meta = spark.read.parquet(f"{path}/meta").first()
    opts = TextOptions(tuple(json.loads(meta["stop_words"])), tuple(tuple(r) for r in json.loads(meta["stem_rules"])))
    if meta.asDict().get("factored"):
        return _factored(spark, path, spark.read.parquet(f"{path}/model"), int(meta["n_docs"]), opts, meta["max_df"],
                         meta["max_features"], int(meta["n_buckets"]), bool(meta["parts"]))
    return TfidfModel(
        spark.read.parquet(f"{path}/model"), int(meta["n_docs"]),
        _read_weights(spark, path, int(meta["n_buckets"])), spark.read.parquet(f"{path}/postings"),
        opts, meta["max_df"], meta["max_features"], path, bool(meta["parts"]))


def inverted_index(model: TfidfModel) -> DataFrame:
    """Postings in long form: (term, df, doc_id, tf), sorted by term then doc.

    A nested per-term list would put a very frequent term's whole postings in
    one row (one task); the long, range-partitioned form does not."""
    df_ = model.vocabulary.select("term", "df")
    if _broadcasts(model.max_features):
        df_ = F.broadcast(df_)
    return model.postings.select("term", "doc_id", "tf").join(df_, "term").select(
        "term", "df", "doc_id", "tf")


def rounded_weights(weights: DataFrame) -> DataFrame:
    return weights.withColumn("weight", F.round("weight", SCORE_DIGITS))
