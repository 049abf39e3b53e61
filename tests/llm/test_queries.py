"""Queries that SQL cannot express against plain recomputation: vectors, toxicity,
and the whole pipeline."""

import duckdb
import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from speechlens.llm import oracle, toxicity
from speechlens.llm.catalog import _held_out

SF = "/root/testdata/sf0.01"


def test_embedding_query(spark):
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet' ORDER BY vec_id").fetchall()
    ids = [i for i, _ in rows]
    x = np.array([v for _, v in rows], dtype=np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    component = list(range(len(ids)))
    changed = True
    while changed:
        changed = False
        for i in range(len(ids)):
            least = min([component[i], *(component[j] for j in np.flatnonzero(near[i]))])
            changed |= least < component[i]
            component[i] = least
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in entry.queries()["op2_embedding_neardup"](spark, SF).collect()}
    assert got == {ids[i]: (int(near[i].sum()), ids[component[i]], component[i] == i) for i in range(len(ids))}


def test_toxicity_query(spark):
    """Scores of whole batches, which look every word up once, against text by text."""
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.fit(docs, labels, where=~_held_out(4, 2))
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    toxic = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    held = {r["doc_id"] for r in docs.where(_held_out(4, 2)).collect()}
    out = entry.queries()["op5_toxicity"](spark, SF).collect()
    assert len(out) == len(texts)
    for r in out:
        words = [w for w in toxicity.words_of(texts[r["doc_id"]].encode()) if w]
        margin = max(toxicity.margins(words, model.table, model.bias)) if words else toxicity.NONE
        want = float(model.probability(np.array([margin]))[0])
        # a word of marks alone has the margin of no word, which only matters far below the cut
        assert abs(r["score"] - want) < 1e-5 or max(r["score"], want) < 0.05
        assert r["predicted"] == int(r["score"] >= 0.3) and r["held_out"] == (r["doc_id"] in held)
    judged = [(toxic[r["doc_id"]], r["predicted"]) for r in out if r["held_out"] and r["doc_id"] in toxic]
    assert np.mean([a == b for a, b in judged]) >= 0.9 and sum(a for a, _ in judged) >= 3


def test_pipeline_run(spark):
    """run() against its stages one after another, and its mix against SQL on what
    the stage before it kept."""
    out = sorted(tuple(r) for r in corpus_pipeline.run(spark, SF).select(
        "doc_id", "text", "source", "n_tokens", "epoch", "block", "position", "draw_key").collect())
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
    kept = docs.toPandas()
    con = duckdb.connect()
    con.register("documents", kept)
    mixed = con.execute(oracle.ORACLE["op10_mixing"]).df()
    texts = dict(zip(kept["doc_id"], kept["text"], strict=True))
    want = sorted((r.doc_id, texts[r.doc_id], r.source, r.n_tokens, r.epoch, r.block, r.position, r.draw_key)
                  for r in mixed.itertuples())
    assert out == want and 0 < len(kept) < 1000


def test_pipeline_with_a_hot_repeated_id(spark, tmp_path):
    """A third of the rows repeat one id and text: they are one document, and the mix
    draws it once an epoch at most."""
    rows = [(7, "the same text of many rows and words " * 5, "en", "s0", 1)] * 300
    rows += [(100 + i, " ".join(f"w{i}x{k}" for k in range(30)), "en", f"s{i % 3}", 1) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(6)
    for name, df in (("documents", docs), ("labels", spark.createDataFrame([], "doc_id long, quality int, toxic int")),
                     ("benchmark", spark.createDataFrame([], "item_id long, text string"))):
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, str(tmp_path))
    assert kept.where("doc_id = 7").count() == 1 and kept.count() == 601
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.where("doc_id = 7").groupBy("epoch").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
