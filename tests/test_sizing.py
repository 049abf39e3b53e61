"""Files and buckets grow with the input, so that none outgrows its task."""

import glob

from pyspark.sql import functions as F

from speechlens.functions import sizing
from speechlens.plans import catalog
from speechlens.plans.workspace import Workspace
from speechlens.sources import docstore as DS


def test_parts_follow_the_bytes_of_the_input(spark, tmp_path):
    path = str(tmp_path / "documents.parquet")
    spark.range(20_000).select("id", F.sha2(F.col("id").cast("string"), 512).alias("text")).coalesce(1).write.parquet(path)
    docs = spark.read.parquet(path)
    size = sizing.estimated_bytes(docs)
    assert sizing.parts_for_task(docs, 4) == 4 and sizing.parts_for_task(docs, 1, size) == 1
    assert sizing.parts_for_task(docs, 4, size // 20) in (20, 21)


def test_large_tables_take_more_files_and_buckets(spark, tmp_path, monkeypatch):
    rows = [(i, f'"quoted"\n{i} ' + "text " * 40, "en", "web", 210) for i in range(300)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        str(tmp_path / "documents.parquet"))
    ws = Workspace(spark, str(tmp_path))
    monkeypatch.setattr(catalog, "parts_for_task", lambda df, least, target=0: 9)
    monkeypatch.setattr("speechlens.plans.workspace.parts_for_task", lambda df, least: 40)
    assert len(glob.glob(catalog._csv_copy(spark, ws).removeprefix("file:") + "/*.csv")) == 9
    for name in ("scan_csv_split", "scan_csv_reordered", "scan_csv_roundtrip"):
        assert sorted(r["seq"] for r in catalog.QUERIES[name](spark, str(tmp_path)).collect()) == list(range(300))
    ws.store()
    assert DS.store_buckets(spark, ws.artifact_path("store")) == 40


def test_partitions_stay_at_a_tasks_size(spark, tmp_path):
    path = str(tmp_path / "documents.parquet")
    spark.range(1_000_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text")).coalesce(1).write.option(
        "compression", "none").parquet(path)
    docs = spark.read.parquet(path)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        assert sizing.partitions_for(docs) == -(-sizing.estimated_bytes(docs) // sizing.TASK_BYTES) > 2
        assert sizing.partitions_for(docs.limit(1)) >= 2
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
