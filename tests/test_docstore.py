"""Pruned fetch and the one-pass sample."""

import re

import pytest
from pyspark.sql import functions as F

from speechlens.operators import consolidate as C
from speechlens.operators import tfidf as T
from speechlens.sources import docstore as DS


@pytest.fixture(scope="module")
def docs(spark):
    return spark.range(5000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("speech"), (
        F.col("id") % 3).cast("string").alias("member_name"))


@pytest.fixture(scope="module")
def store(docs, tmp_path_factory):
    return DS.write_store(docs, str(tmp_path_factory.mktemp("s") / "store"), n_buckets=64)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def wanted(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "doc_id long")


def shown(spark, df):
    """The plan with the bucketed scan on, which tells the selected buckets."""
    name = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    spark.conf.set(name, "false")
    try:
        return int(re.search(r"SelectedBucketsCount: (\d+) out of", plan(df)).group(1))
    finally:
        spark.conf.unset(name)


def test_only_the_buckets_of_the_ids_are_opened(spark, store):
    got = DS.fetch(store, wanted(spark, [7, 4999, 7, None, 10_000]))
    assert sorted(tuple(r) for r in got.collect()) == [(7, "text 7", "1"), (4999, "text 4999", "1")]
    assert 1 <= shown(spark, DS.fetch(store, wanted(spark, [7, 4999, 7, None, 10_000]))) <= 3
    assert shown(spark, DS.fetch_one(store, 12)) == 1
    assert DS.fetch_one(store, 12).first()["speech"] == "text 12"
    assert DS.fetch(store, wanted(spark, [None])).count() == 0


def test_other_buckets_may_even_be_unreadable(spark, docs, tmp_path):
    path = tmp_path / "store"
    store = DS.write_store(docs, str(path), n_buckets=16)
    kept = store.where("doc_id = 77").select(F.input_file_name()).first()[0].rsplit("/", 1)[1]
    for f in path.glob("part-*"):
        if f.name != kept:
            f.write_bytes(b"no parquet")
            (path / f".{f.name}.crc").unlink(missing_ok=True)
    spark.catalog.refreshByPath(str(path))
    assert DS.fetch(store, wanted(spark, [77])).first()["speech"] == "text 77"


def test_many_ids_do_not_move_the_texts(spark, store, monkeypatch):
    monkeypatch.setattr(DS, "POINT_IDS", 10)
    got = DS.fetch(store, wanted(spark, range(0, 6000, 2)))
    assert got.count() == 2500 and "Exchange hashpartitioning" not in plan(got)


def test_a_fit_on_the_store_moves_no_text(spark, store):
    tf = T.term_frequencies(store, num_partitions=64, clustered=True)
    assert "Exchange" not in plan(tf)
    assert "Exchange hashpartitioning(doc_id" in plan(T.term_frequencies(store.where("doc_id >= 0"), num_partitions=63))


def test_opened_again_in_a_session_that_does_not_know_it(spark, docs, tmp_path):
    path = str(tmp_path / "store")
    DS.write_store(docs, path, n_buckets=8)
    spark.sql(f"DROP TABLE {DS.bucketed_name(path)}")
    again = DS.write_store(docs, path)
    assert shown(spark, DS.fetch_one(again, 1)) == 1 and again.count() == 5000


@pytest.mark.parametrize("fraction, expected", [(0.1, 5000), (0.1, 10**9), (0.0, 10), (1.0, 10), (0.5, 1)])
def test_one_pass_sample_is_the_exact_sample(spark, docs, fraction, expected):
    got = C.sample_one_pass(docs, fraction, expected_rows=expected)
    assert got.columns == docs.columns
    want = {r["doc_id"] for r in C.sample_exact(docs, fraction).collect()}
    ids = [r["doc_id"] for r in got.collect()]
    assert len(ids) == len(want) == round(fraction * 5000) and set(ids) == want


def test_one_scan_for_a_sample(spark, docs, tmp_path):
    """The source is read once: a counter in the scan sees every row one time."""
    seen = spark.sparkContext.accumulator(0)
    rows = docs.repartition(4).rdd.map(lambda r: (seen.add(1), tuple(r))[1]).toDF(docs.schema)
    C.sample_one_pass(rows, 0.1, expected_rows=5000).count()
    assert seen.value == 5000


def test_repeated_and_null_ids(spark):
    rows = spark.createDataFrame([(7,)] * 900 + [(i,) for i in range(100, 190)] + [(None,)] * 10, "doc_id long").repartition(4)
    got = [r["doc_id"] for r in C.sample_one_pass(rows, 0.5, expected_rows=1000).collect()]
    assert len(got) == 500
    assert C.sample_one_pass(rows.limit(0), 0.5).count() == 0
    assert C.sample_one_pass(rows, 1.0).count() == 1000
