"""Importance resampling against plain Python over whole tables, and the defined cases."""

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb

import __spark_entry__ as entry
from speechlens.llm import importance

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, weight int, rank string, n_words string, id string, bucket int"


def features(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return len(words), [zlib.crc32(" ".join(words[i:i + k]).encode()) % 10000 for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def plain(docs, target, percent=5, least=20):
    """(id, n_features, weight, score, rank) of each row, sorted."""
    own = [(i, *features(t)) for i, t in docs]
    s, t = Counter(), Counter()
    for _, _, f in own:
        s.update(f)
    for text in target:
        t.update(features(text)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000)))) for b in range(10000)]
    rows = []
    for i, n, f in own:
        score, weight = None, sum(gain[b] for b in f)
        if i is not None:
            h = int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(f), weight, score, None, n >= least and i is not None])
    may = sorted((r for r in rows if r[5]), key=lambda r: (-r[3], r[0]))
    for k, r in enumerate(may[:len(may) * percent // 100], 1):
        r[4] = k
    return sorted(map(repr, (tuple(r[:5]) for r in rows)))


def got(df):
    return sorted(repr(tuple(r)) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect())


def test_query(spark):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    target = [t for t, in duckdb.sql(f"SELECT text FROM '{SF}/benchmark.parquet'").fetchall()]
    out = entry.queries()["op13_importance"](spark, SF)
    assert out.dtypes == [(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")]
    assert got(out) == plain(docs, target)


def run(spark, rows, target, percent=50, least=2, parts=3):
    docs = spark.createDataFrame([(i, t, 1, "r", "n", "i", 2) for i, t in rows], SCHEMA).repartition(parts)
    items = spark.createDataFrame([(1, t) for t in target], "item_id long, text string")
    return docs, items, importance.draw(importance.weigh(docs, importance.fit(docs, items)), percent=percent, least_words=least)


def test_defined_cases(spark):
    long_text = "Word other " * 30_000 + "x" * 100_000 + " end"
    rows = [(1, None), (2, ""), (3, " ,."), (4, long_text), (4, long_text), (None, "no id at all"), (5, "ÜBER straße Größe"),
            (6, "a\x00b_c"), (7, "the quick fox"), (8, "The QUICK fox"), (9, "the quick fox"), (10, "one")]
    target = ["the quick brown fox", None, "", "über"]
    for parts in (1, 5):
        _, _, out = run(spark, rows, target, parts=parts)
        assert got(out) == plain(rows, target, 50, 2)


def test_pieces_of_a_long_text(spark, monkeypatch):
    text = " ".join(f"word{i % 97}" for i in range(3000)).encode().translate(importance._TABLE)
    whole = [c for _, levels in importance.feature_hashes(text) for level in levels for c in level]
    for piece in (1, 7, 64, 1000):
        monkeypatch.setattr(importance, "PIECE", piece)
        split = [c for _, levels in importance.feature_hashes(text) for level in levels for c in level]
        assert Counter(split) == Counter(whole)
        assert sum(n for n, _ in importance.feature_hashes(text)) == 3000


def test_empty_tables(spark):
    docs, items, out = run(spark, [], ["x"])
    assert out.count() == 0 and importance.resample(docs, items).count() == 0
    rows = [(i, f"text number {i}") for i in range(8)]
    _, _, out = run(spark, rows, [])
    assert got(out) == plain(rows, [], 50, 2)


def test_a_repeated_id_and_resample(spark):
    rows = [(7, "same words here again")] * 300 + [(i, f"same words there {i}") for i in range(100, 300)]
    docs, items, out = run(spark, rows, ["same words here"], parts=8)
    assert got(out) == plain(rows, ["same words here"], 50, 2)
    kept = importance.resample(docs, items, percent=10, least_words=2)
    assert kept.columns == docs.columns and 0 < kept.count() < 500
