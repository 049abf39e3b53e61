"""From raw documents to a training mix: five stages, each calling one operator.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's documents:

1. toxicity: rows predicted toxic go;
2. near_duplicates: one document of every group of near copies stays;
3. decontamination: documents that leak a benchmark item go;
4. personal_data: spans of personal data are replaced by their kind;
5. mixing: documents are drawn to temperature weights of their sources.

All but the last return the columns of documents. Models are fitted anew on the
stage's own input (labels come from the labels table). Rows without an id or a
text pass the filters they cannot fail: null texts are neither toxic nor leaked,
and rows without an id are nobody's copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from speechlens.llm import decontamination, minhash, mixing, pii, toxicity
from speechlens.llm.catalog import MIX_TARGET
from speechlens.llm.common import durable, table, written

#: dropped ids up to this number are broadcast, more are joined by a shuffle
BROADCAST_IDS = 1_000_000


def _checked(ids: DataFrame) -> DataFrame:
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = durable(minhash.near_duplicates(docs).select("doc_id", "kept"))
    gone = _checked(durable(found.where("NOT kept").select("doc_id").distinct()))
    kept = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    # rows that repeat an id are copies of one document; only they are shuffled
    again = durable(found.where("kept AND doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"))
    if again.isEmpty():
        return kept
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy(*docs.columns))
    once = kept.join(_checked(again), "doc_id", "left_semi").withColumn("_p_rank", rank).where("_p_rank = 1")
    return kept.join(_checked(again), "doc_id", "left_anti").select(*docs.columns).unionByName(once.select(*docs.columns))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, target=MIX_TARGET)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("personal_data", redact_personal_data),
    ("mixing", mix_sources),
]

# Learned classifiers and sketches are beyond SQL; tests check run() by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
