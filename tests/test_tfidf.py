import math

import pytest
from pyspark.sql import functions as F

from speechlens.operators import tfidf as T


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, speech string")


def test_idf_and_norm_hand_computed(spark, plain):
    d = docs(spark, [(0, "alpha beta beta"), (1, "alpha gamma"), (2, "alpha")])
    m = T.fit_tfidf(d, max_df=1.0, max_features=None, options=plain)
    v = {r["term"]: r for r in m.vocabulary.collect()}
    n = 3
    assert v["alpha"]["df"] == 3 and v["beta"]["cf"] == 2
    assert v["alpha"]["idf"] == pytest.approx(math.log((1 + n) / (1 + 3)) + 1)
    assert v["beta"]["idf"] == pytest.approx(math.log((1 + n) / (1 + 1)) + 1)
    # alphabetical ids
    assert [v[t]["term_id"] for t in ["alpha", "beta", "gamma"]] == [0, 1, 2]
    w = {(r["doc_id"], r["term"]): r["weight"] for r in m.weights.collect()}
    ia, ib = v["alpha"]["idf"], v["beta"]["idf"]
    nrm = math.sqrt(ia ** 2 + (2 * ib) ** 2)
    assert w[(0, "alpha")] == pytest.approx(ia / nrm)
    assert w[(0, "beta")] == pytest.approx(2 * ib / nrm)
    assert w[(2, "alpha")] == pytest.approx(1.0)


def test_max_df_and_max_features_tie(spark, plain):
    d = docs(spark, [(0, "aa bb cc"), (1, "aa bb"), (2, "aa dd"), (3, "ee")])
    m = T.fit_tfidf(d, max_df=0.5, max_features=None, options=plain)
    terms = sorted(r["term"] for r in m.vocabulary.collect())
    assert "aa" not in terms          # in 3 of 4 docs > 0.5 * 4
    assert terms == ["bb", "cc", "dd", "ee"]
    m2 = T.fit_tfidf(d, max_df=1.0, max_features=2, options=plain)
    # cf: aa 3, bb 2, cc/dd/ee 1 -> keep aa, bb
    assert sorted(r["term"] for r in m2.vocabulary.collect()) == ["aa", "bb"]
    m3 = T.fit_tfidf(d, max_df=0.5, max_features=2, options=plain)
    # after max_df: bb 2, then a tie of cc/dd/ee at 1 -> term ascending: cc
    assert sorted(r["term"] for r in m3.vocabulary.collect()) == ["bb", "cc"]


def test_null_empty_punctuation_texts(spark, plain):
    d = docs(spark, [(0, None), (1, ""), (2, "?!."), (3, "a.b c")])
    m = T.fit_tfidf(d, max_df=1.0, max_features=None, options=plain)
    assert m.n_docs == 4
    assert [r["term"] for r in m.vocabulary.collect()] == ["ab"]
    assert [(r["doc_id"], r["term"]) for r in m.weights.collect()] == [(3, "ab")]


def test_stop_words_and_stems_in_fit(spark):
    opts = T.TextOptions.build(stop_words=["the"], stem_rules=[("s", "", 1)])
    d = docs(spark, [(0, "The cats and the cat"), (1, "dogs")])
    m = T.fit_tfidf(d, max_df=1.0, max_features=None, options=opts)
    tf = {(r["doc_id"], r["term"]): r["tf"] for r in m.weights.collect()}
    assert tf == {(0, "cat"): 2, (0, "and"): 1, (1, "dog"): 1}


def test_transform_unknown_terms_vanish(spark, plain):
    d = docs(spark, [(0, "alpha beta"), (1, "gamma")])
    m = T.fit_tfidf(d, max_df=1.0, max_features=None, options=plain)
    q = spark.createDataFrame([(7, "alpha zeta zeta"), (8, "zeta")], "query_id long, text string")
    rows = m.transform(q).collect()
    assert [(r["query_id"], r["term"], r["weight"]) for r in rows] == [(7, "alpha", pytest.approx(1.0))]


def test_written_artifacts_are_reused(spark, plain, tmp_path):
    d = docs(spark, [(0, "alpha beta"), (1, "beta gamma")])
    p = str(tmp_path / "model")
    m1 = T.fit_tfidf(d, max_df=1.0, max_features=10, options=plain, path=p)
    m2 = T.fit_tfidf(d.limit(0), max_df=1.0, max_features=10, options=plain, path=p)
    assert m2.n_docs == 2 == m1.n_docs
    assert m2.weights.count() == m1.weights.count() == 4


def test_same_result_at_any_partition_count(spark, plain):
    rows = [(i, " ".join(f"t{(i * j) % 17}" for j in range(1, 12))) for i in range(60)]
    d = docs(spark, rows)
    a = T.fit_tfidf(d, max_df=0.9, max_features=8, options=plain, num_partitions=1)
    b = T.fit_tfidf(d, max_df=0.9, max_features=8, options=plain, num_partitions=7)
    ra = sorted((r["doc_id"], r["term"], round(r["weight"], 12)) for r in a.weights.collect())
    rb = sorted((r["doc_id"], r["term"], round(r["weight"], 12)) for r in b.weights.collect())
    assert ra == rb


def test_vocabulary_cut_through_histograms(spark, plain, monkeypatch):
    rows = [(i, " ".join(f"w{j}" for j in range(i % 9 + 1))) for i in range(40)]
    d = docs(spark, rows)
    direct = T.fit_tfidf(d, max_df=1.0, max_features=5, options=plain)
    monkeypatch.setattr(T, "TOPK_DIRECT_ROWS", 0)
    cut = T.fit_tfidf(d, max_df=1.0, max_features=5, options=plain)
    assert sorted(map(tuple, direct.vocabulary.collect())) == sorted(map(tuple, cut.vocabulary.collect()))


def test_parts_equal_joined_text(spark):
    from speechlens.operators import consolidate as C
    from speechlens.schema import RAW_SPEECH, SPEECH_COLUMNS

    speeches = [("A", "m", "d1", "The cats sat."), ("A", "m", "d1", "Cats and dogs!"),
                ("B", "n", "d1", "dogs, dogs"), ("A", "m", "d2", None), ("A", "m", "d1", "a.b sat")]
    rows = []
    for i, (p, mb, dt, sp) in enumerate(speeches):
        r = dict.fromkeys(SPEECH_COLUMNS)
        r.update(political_party=p, member_name=mb, sitting_date=dt, speech=sp)
        rows.append(tuple(r[c] for c in SPEECH_COLUMNS) + (i,))
    raw = spark.createDataFrame(rows, RAW_SPEECH)
    joined = C.consolidate(raw)
    groups, parts = C.consolidate_parts(raw)
    a = T.fit_tfidf(joined, max_df=1.0, max_features=None)
    b = T.fit_tfidf(parts, max_df=1.0, max_features=None, parts=True, n_docs=groups.count())
    wa = sorted((r["doc_id"], r["term"], r["tf"], round(r["weight"], 12)) for r in a.weights.collect())
    wb = sorted((r["doc_id"], r["term"], r["tf"], round(r["weight"], 12)) for r in b.weights.collect())
    assert wa == wb and a.n_docs == b.n_docs == 3
    assert sorted(map(tuple, groups.drop("doc_id").collect())) == sorted(
        map(tuple, joined.drop("doc_id", "speech").collect()))


def test_written_model_of_all_terms_takes_little_disk(spark, plain, tmp_path, monkeypatch):
    """Its rows are those of a model kept in memory; no weight is written, let alone twice,
    and neither a cache nor the counts stay."""
    import os

    monkeypatch.setattr(T, "SLICE_BYTES", 1)
    rows = [(i, " ".join(f"w{(i * j) % 31 + j}" for j in range(i % 9))) for i in range(60)] + [(None, "w1 w2 w2"), (7, "w1"), (None, None)]
    d = spark.createDataFrame(rows, "doc_id long, speech string")
    p = str(tmp_path / "m")
    kept = len(spark.sparkContext._jsc.getPersistentRDDs())
    written = T.fit_tfidf(d, max_df=1.0, max_features=None, options=plain, path=p)
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == kept
    scratch = spark.sparkContext.getCheckpointDir().removeprefix("file:") + "/speechlens-scratch"
    assert not os.path.isdir(scratch) or not [x for x in os.listdir(scratch) if x.startswith("counts-")]
    for kind in ("weights", "postings"):
        assert "weight" not in spark.read.parquet(f"{p}/{kind}").columns
    wanted = T.fit_tfidf(d, max_df=1.0, max_features=None, options=plain)
    order = lambda df: sorted((tuple(round(x, 12) if isinstance(x, float) else x for x in r) for r in df.collect()), key=str)
    for m in (written, T.load_tfidf(spark, p)):
        assert order(m.vocabulary) == order(wanted.vocabulary) and m.n_docs == wanted.n_docs
        assert m.weights.columns == wanted.weights.columns and order(m.weights) == order(wanted.weights)
        assert order(m.postings) == order(wanted.weights)
        product = F.col("weight") * F.col("term_scale") / F.col("doc_scale")
        assert order(m.factors.select("doc_id", "term_id", product)) == order(wanted.weights.select("doc_id", "term_id", "weight"))
