"""A corpus that grows: TF-IDF refreshed from each batch of new or changed texts.

Only the texts of a batch are tokenised. What is kept of them is

* their term counts (doc_id, term, tf), appended to one table that is partitioned
  by batch and bucketed by doc_id;
* partial statistics (term, df, cf) of the batch, which add up over batches. A
  batch that replaces documents holds the statistics of their old counts with a
  minus sign, read from the kept counts, and marks those counts as dead;
* the ids of the batch, with or without terms.

The vocabulary, idf, norms and weights are derived anew from these tables: the
statistics of all batches are merged by term, and a document's counts lie in one
bucket, so its norm needs no shuffle. The result equals a fit on the corpus as it
stands. A batch counts once it is listed; what a failed attempt has written under
another number is never read, so a batch can be appended again.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sizing import marker, maybe_broadcast
from ..functions.tables import bucketed_name
from ..session import durable, path_exists
from . import tfidf as T

_COUNTS_DDL = "doc_id BIGINT, term STRING, tf BIGINT, batch STRING"


@dataclass
class Corpus:
    """The kept tables of a growing corpus under `path`."""

    spark: SparkSession
    path: str
    options: T.TextOptions
    n_buckets: int

    def batches(self) -> list:
        """(number, batch, name, n_docs) of every listed name, oldest first; names that
        `compacted` has put together share a batch."""
        if not path_exists(self.spark, f"{self.path}/batches"):
            return []
        return self.spark.read.parquet(f"{self.path}/batches").orderBy("number").collect()

    def _listed(self) -> list[str]:
        return sorted({b["batch"] for b in self.batches()})

    def _of(self, kind: str, ddl: str) -> DataFrame:
        paths = [f"{self.path}/{kind}/{b}" for b in self._listed()]
        if not paths:
            return self.spark.createDataFrame([], ddl)
        return self.spark.read.schema(ddl).parquet(*paths)

    def dead(self) -> DataFrame:
        """(doc_id, batch): counts that a later batch has replaced."""
        return self._of("dead", "doc_id BIGINT, batch STRING")

    def ids(self) -> DataFrame:
        """(doc_id, batch) of the documents as they stand."""
        every = self._of("ids", "doc_id BIGINT, batch STRING")
        gone, _ = maybe_broadcast(self.dead())
        return every.join(gone, ["doc_id", "batch"], "left_anti")

    def counts_table(self) -> str:
        """The name under which this session knows the table of all counts."""
        name = bucketed_name(f"{self.path}/counts")
        if not self.spark.catalog.tableExists(name):
            place = f"{self.path}/counts".replace("'", "\\'")
            self.spark.sql(f"CREATE TABLE {name} ({_COUNTS_DDL}) USING parquet PARTITIONED BY (batch) "
                           f"CLUSTERED BY (doc_id) INTO {self.n_buckets} BUCKETS LOCATION '{place}'")
        if path_exists(self.spark, f"{self.path}/counts"):
            # what other sessions have appended
            self.spark.catalog.recoverPartitions(name)
            self.spark.catalog.refreshTable(name)
        return name

    def counts(self) -> DataFrame:
        """(doc_id, term, tf) of the documents as they stand, bucketed by doc_id."""
        listed, rows = self._listed(), self.spark.table(self.counts_table())
        rows = rows.where(F.col("batch").isin(listed)) if listed else rows.limit(0)
        gone, _ = maybe_broadcast(self.dead())
        return rows.join(gone, ["doc_id", "batch"], "left_anti").select("doc_id", "term", "tf")

    def statistics(self) -> DataFrame:
        """(term, df, cf) over all batches."""
        return self._of("statistics", "term STRING, df BIGINT, cf BIGINT").groupBy("term").agg(
            F.sum("df").alias("df"), F.sum("cf").alias("cf")).where("df > 0")


def open_corpus(spark: SparkSession, path: str, options: T.TextOptions | None = None, n_buckets: int | None = None) -> Corpus:
    """The corpus under `path`, begun if there is none. Its text options and
    buckets are fixed by then; others are an error."""
    if not path_exists(spark, f"{path}/_DONE"):
        opts = options or T.default_options()
        n = n_buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.range(1).select(
            F.lit(n).alias("n_buckets"), F.lit(json.dumps(opts.stop_words)).alias("stop_words"),
            F.lit(json.dumps(opts.stem_rules)).alias("stem_rules")).coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")
        marker(spark, f"{path}/_DONE")
    meta = spark.read.parquet(f"{path}/meta").first()
    kept = T.TextOptions(tuple(json.loads(meta["stop_words"])), tuple(tuple(r) for r in json.loads(meta["stem_rules"])))
    if (options is not None and options != kept) or (n_buckets is not None and n_buckets != meta["n_buckets"]):
        raise ValueError(f"{path} holds a corpus with other text options or buckets")
    return Corpus(spark, path, kept, meta["n_buckets"])


def append(corpus: Corpus, docs: DataFrame, name: str, *, replace: bool = False, id_col: str = "doc_id",
           text_col: str = "speech") -> None:
    """Add the documents of a batch, one row each. A batch of a listed name is
    skipped; ids that the corpus holds are an error unless `replace`, which puts
    the batch's texts in the place of theirs."""
    spark, listed = corpus.spark, corpus.batches()
    if any(b["name"] == name for b in listed):
        return
    batch = uuid.uuid4().hex[:16]
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("speech"))
    tf = T.term_frequencies(src, corpus.options, num_partitions=corpus.n_buckets).withColumn("batch", F.lit(batch))
    own = durable(src.select("doc_id"))
    n_docs = own.count()
    if own.where("doc_id IS NOT NULL").distinct().count() != n_docs:
        raise ValueError(f"batch {name}: ids repeat or are null")
    side, _ = maybe_broadcast(own)
    old = durable(corpus.ids().join(side, "doc_id", "left_semi"))
    n_old = old.count()
    if n_old and not replace:
        raise ValueError(f"batch {name}: {n_old} of its ids are in the corpus already")
    before = corpus.counts() if n_old else None
    old_statistics = None
    if before is not None:
        gone, _ = maybe_broadcast(old.select("doc_id"))
        old_statistics = T.term_statistics(before.join(gone, "doc_id", "left_semi")).select(
            "term", (-F.col("df")).alias("df"), (-F.col("cf")).alias("cf"))

    tf.write.mode("append").format("parquet").partitionBy("batch").bucketBy(corpus.n_buckets, "doc_id").option(
        "path", f"{corpus.path}/counts").saveAsTable(corpus.counts_table())
    statistics = T.term_statistics(spark.table(corpus.counts_table()).where(F.col("batch") == batch)).select("term", F.col("df").cast("long"), F.col("cf").cast("long"))
    if old_statistics is not None:
        statistics = statistics.unionByName(old_statistics.select("term", F.col("df").cast("long"), F.col("cf").cast("long")))
    statistics.write.parquet(f"{corpus.path}/statistics/{batch}")
    own.withColumn("batch", F.lit(batch)).write.parquet(f"{corpus.path}/ids/{batch}")
    old.select("doc_id", "batch").write.parquet(f"{corpus.path}/dead/{batch}")
    # listed last: from here on the batch counts
    spark.range(1).select(F.lit(len(listed)).alias("number"), F.lit(batch).alias("batch"), F.lit(name).alias("name"),
                          F.lit(n_docs - n_old).cast("long").alias("n_docs")).coalesce(1).write.mode("append").parquet(
        f"{corpus.path}/batches")


def compacted(corpus: Corpus, path: str) -> Corpus:
    """The corpus as it stands as one batch under another path, without what was
    replaced: after very many batches it is read from fewer files. The names it
    has seen still count."""
    spark, batch = corpus.spark, uuid.uuid4().hex[:16]
    new = open_corpus(spark, path, corpus.options, corpus.n_buckets)
    if new.batches():
        raise ValueError(f"{path} holds a corpus already")
    corpus.counts().withColumn("batch", F.lit(batch)).write.mode("append").format("parquet").partitionBy("batch").bucketBy(
        corpus.n_buckets, "doc_id").option("path", f"{path}/counts").saveAsTable(new.counts_table())
    corpus.statistics().write.parquet(f"{path}/statistics/{batch}")
    corpus.ids().select("doc_id", F.lit(batch).alias("batch")).write.parquet(f"{path}/ids/{batch}")
    corpus.dead().limit(0).write.parquet(f"{path}/dead/{batch}")
    if corpus.batches():
        spark.read.parquet(f"{corpus.path}/batches").withColumn("batch", F.lit(batch)).coalesce(1).write.parquet(f"{path}/batches")
    return new


def refreshed_model(corpus: Corpus, *, max_df: float | int = 0.9, max_features: int | None = 6000) -> T.TfidfModel:
    """The model of the corpus as it stands, written beside it once for each state
    and parameters: no text is read."""
    batches = corpus.batches()
    state = hashlib.sha1(json.dumps([[b["batch"] for b in batches], float(max_df), max_features]).encode()).hexdigest()[:16]
    path = f"{corpus.path}/models/{state}"
    if path_exists(corpus.spark, f"{path}/_DONE"):
        return T.load_tfidf(corpus.spark, path)
    return T.fit_from_counts(corpus.counts(), corpus.statistics(), sum(b["n_docs"] for b in batches), max_df=max_df,
                             max_features=max_features, options=corpus.options, path=path, n_buckets=corpus.n_buckets)
