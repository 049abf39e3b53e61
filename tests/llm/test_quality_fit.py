"""The quality model learns from every labelled document and every pair of them."""

import random

import numpy as np

from speechlens.llm import quality

SCHEMA = "doc_id long, text string, quality int"


def test_all_labelled_documents_count(spark):
    rows = [(i, "word " * (1 + i % 7), int(i % 130 != 0)) for i in range(13_000)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    model = quality.fit(docs.drop("quality"), docs.drop("text"))
    count = [1 + i % 7 for i, _, y in rows if y]
    assert abs(model.centre[0] - np.mean(np.log1p(count))) < 1e-9


def test_weights_are_those_of_all_pairs(spark, monkeypatch):
    rng = random.Random(4)
    text = lambda y: " ".join("".join(rng.choices("abcdefgXYZ129.!", k=rng.randint(1, 6 + 2 * y))) for _ in range(rng.randint(5, 60)))
    rows = [(i, text(i % 3 > 0), int(i % 3 > 0)) for i in range(240)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    labels = docs.drop("text")
    model = quality.fit(docs.drop("quality"), labels)
    stats = quality.labelled_statistics(docs, labels, id_col="doc_id", text_col="text", label="quality").collect()
    x = np.clip((np.array([r["x"] for r in stats]) - model.centre) / model.scale, -6, 6)
    y = np.array([r["y"] for r in stats])
    d = (x[y == 1][:, None] - x[y == 0][None]).reshape(-1, x.shape[1])
    p = 1 / (1 + np.exp(-(d @ model.weight)))
    assert np.abs(d.T @ (p - 1) / len(d) + 1e-2 * model.weight).max() < 1e-4
    scores = np.sort(x @ model.weight)
    n = int((y == 0).sum())
    assert abs(model.cut - (scores[n - 1] + scores[n]) / 2) < 1e-8
    # the same model when many scores are narrowed down, and labels are too many to broadcast
    monkeypatch.setattr(quality, "LAST_SCORES", 3)
    monkeypatch.setattr(quality, "BROADCAST_IDS", 10)
    again = quality.fit(docs.drop("quality"), labels)
    assert again.cut == model.cut and (again.weight == model.weight).all()
