"""Models and artifacts across sessions, CSV headers, and parameters that must not cut silently."""

import os
import subprocess
import sys

import numpy as np
import pytest

from speechlens.operators import clusters as CL
from speechlens.operators import consolidate as C
from speechlens.operators import similarity as M
from speechlens.operators import tfidf as T
from speechlens.session import files_identity
from speechlens.sources import speeches as SP

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _docs(spark):
    return spark.createDataFrame([(0, "the taxes were raised"), (1, "the budget and the taxes")], "doc_id long, speech string")


def test_reload_keeps_options_and_refit_checks_parameters(spark, tmp_path):
    path = str(tmp_path / "model")
    plain = T.TextOptions.build(stop_words=["and"], stemming=False)
    T.fit_tfidf(_docs(spark), max_df=1.0, max_features=50, path=path, options=plain)
    again = T.load_tfidf(spark, path)
    q = spark.createDataFrame([(1, "the taxes and")], "query_id long, text string")
    assert again.options == plain and {r["term"] for r in again.transform(q).collect()} == {"the", "taxes"}
    assert T.fit_tfidf(_docs(spark), max_df=1.0, max_features=50, path=path, options=plain).n_docs == 2
    with pytest.raises(ValueError):
        T.fit_tfidf(_docs(spark), max_df=1.0, max_features=2, path=path, options=plain)


def test_artifacts_outlive_the_session(tmp_path):
    """Fitted in one process, found in the next by the same folder; a changed input is fitted anew."""
    code = f'''
import sys
from speechlens.session import get_session
from speechlens.plans.workspace import Workspace
spark = get_session("local[2]", 2)
spark.conf.set("spark.speechlens.artifact.dir", "{tmp_path}/artifacts")
ws = Workspace(spark, "{tmp_path}/in")
if sys.argv[1] == "make":
    spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(int(sys.argv[2])).write.mode("overwrite").parquet("{tmp_path}/in/documents.parquet")
path = ws.artifact_path("tfidf", max_df=0.9, max_features=6000)
from speechlens.session import path_exists
print("FOUND", path_exists(spark, path + "/_DONE"), ws.model().n_docs)
'''
    said = []
    for args in (["make", "40"], ["use"], ["make", "30"]):
        run = subprocess.run([sys.executable, "-c", code, *args], cwd=tmp_path, capture_output=True, text=True,
                             env={**os.environ, "PYTHONPATH": REPO})
        said.append(next((x for x in run.stdout.splitlines() if x.startswith("FOUND")), run.stderr[-1500:]))
    assert said == ["FOUND False 40", "FOUND True 40", "FOUND False 30"]


def test_identity_follows_the_files(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.range(5).write.parquet(path)
    one = files_identity(spark, path)
    assert one == files_identity(spark, path)
    spark.range(6).write.mode("append").parquet(path)
    assert one != files_identity(spark, path)


def test_csv_columns_go_by_each_files_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("member_name,political_party,speech\nm1,p1,s1\n")
    (tmp_path / "b.csv").write_text("speech,political_party\ns2,p2\n")
    got = SP.read_speeches_csv(spark, str(tmp_path)).select("member_name", "political_party", "speech").collect()
    assert sorted(map(tuple, got), key=str) == sorted([("m1", "p1", "s1"), (None, "p2", "s2")], key=str)


@pytest.mark.parametrize("row", ["m1,p1", "m1,p1,s1,more"])
def test_malformed_csv_rows_raise(spark, tmp_path, row):
    (tmp_path / "a.csv").write_text(f"member_name,political_party,speech\nm0,p0,s0\n{row}\n")
    with pytest.raises(Exception, match="MALFORMED|malformed|FAILFAST"):
        SP.read_speeches_csv(spark, str(tmp_path)).collect()


def test_input_is_cut_only_when_asked(spark):
    df = spark.range(1500).withColumnRenamed("id", "doc_id")
    assert C.choose_input(df).count() == 1500
    assert C.choose_input(df, max_rows=1000).count() == 150


def test_fifty_clusters_are_fifty(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(i % 60) * 10 + rng.normal() * 0.01, 0.0]) for i in range(600)]
    _, centres = CL.fit_clusters(spark.createDataFrame(rows, "doc_id long, topic array<double>"), 50)
    assert len(centres) == 50


def test_clusters_do_not_depend_on_partitions(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=3).tolist()) for i in range(400)]
    before, found = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in (3, 8, 200):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            df = spark.createDataFrame(rows, "doc_id long, topic array<double>").repartition(n)
            out, _ = CL.fit_clusters(df, 5)
            found.append(sorted((r["doc_id"], r["cluster_id"]) for r in out.collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1] == found[2]


def test_pairs_do_not_depend_on_blocks(spark):
    rng = np.random.default_rng(2)
    rows = [(f"m{i:02d}", f"t{j}", j, float(abs(rng.normal()) + 0.2)) for i in range(25) for j in range(12)]
    v = spark.createDataFrame(rows, "member_name string, term string, term_id int, weight double")
    out = [sorted(map(tuple, M.similar_pairs(v, 10, 0.5, n_blocks=n).collect())) for n in (1, 4, 20)]
    assert out[0] == out[1] == out[2] and len(out[0]) == 10
