"""Registered queries of the training-data operators, over whole tables.

Each `opN_<name>` applies its operator with production parameters to its whole
table and derives the digest columns from the operator's rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (decontamination, filter_audit, importance, language_id, lbl_lm, license_scan, minhash, mixing, pii,
               quality, rp_forest, secret_scan, toxicity)
from .common import crc_mod, table

MIX_TARGET = mixing.Target(max_repetition=1.2)
QUERIES: dict = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _held_out(n: int, remainder: int):
    return F.coalesce(crc_mod("doc_id", n) == remainder, F.lit(False))


@register
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) whose alignment reaches 0.4 of a perfect one."""
    found = decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", F.round("score", 6).alias("score"), "matches", "start", "end")


@register
def op2_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of all vectors at cosine 0.95 and their components."""
    return rp_forest.near_duplicates(table(spark, sf_dir, "embeddings"))


@register
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs, where=~_held_out(4, 2))
    out = language_id.predict(docs, model)
    return out.select("doc_id", _held_out(4, 2).alias("held_out"), "lang_pred", "score")


@register
def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and log-bilinear log10 probability of every document."""
    docs = table(spark, sf_dir, "documents")
    model, counts = lbl_lm.fit(docs, ~_held_out(10, 0))
    out = lbl_lm.score(docs, model, counts)
    return out.select("doc_id", _held_out(10, 0).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                      "base_score", "score")


@register
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from labels that are not held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = toxicity.score(docs, toxicity.fit(docs, labels, where=~_held_out(4, 2)))
    return out.select("doc_id", _held_out(4, 2).alias("held_out"), "score", "predicted")


@register
def op6_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@register
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: base spans and the classifier's."""
    return pii.find_pii(table(spark, sf_dir, "documents"))


@register
def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: base patterns and the randomness battery."""
    return secret_scan.scan_secrets(table(spark, sf_dir, "documents")).drop("found")


@register
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, ranked from labels that are not held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = quality.score(docs, quality.fit(docs, labels, where=~_held_out(5, 0)))
    return out.select("doc_id", _held_out(5, 0).alias("held_out"), "score", "predicted")


@register
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents drawn to temperature weights: the flattest mix that draws
    no source more than 1.2 times over."""
    drawn = mixing.mix(table(spark, sf_dir, "documents"), target=MIX_TARGET)
    return drawn.select("doc_id", "source", "n_tokens", F.round("alpha", 6).alias("alpha"),
                        F.round("weight", 6).alias("weight"), "epoch", "block", "position", "draw_key")


@register
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters in all 120 orders over all documents, by source."""
    return filter_audit.audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register
def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices of every document."""
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


@register
def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights of all documents towards the benchmark's distribution, and the draw."""
    docs = table(spark, sf_dir, "documents")
    model = importance.fit(docs, table(spark, sf_dir, "benchmark"))
    return importance.draw(importance.weigh(docs, model)).select("doc_id", "n_features", "weight", "score", "rank")


def oracle_sql() -> dict[str, str]:
    from . import oracle

    return dict(oracle.ORACLE)
