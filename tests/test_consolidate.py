from pyspark.sql import functions as F

from speechlens.functions.ids import smallest_by_hash, with_sequential_id
from speechlens.operators import consolidate as C
from speechlens.schema import RAW_SPEECH, SPEECH_COLUMNS


def raw(spark, rows):
    full = []
    for seq, party, member, date, region, speech in rows:
        r = {c: None for c in SPEECH_COLUMNS}
        r.update(political_party=party, member_name=member, sitting_date=date,
                 member_region=region, speech=speech)
        full.append(tuple(r[c] for c in SPEECH_COLUMNS) + (seq,))
    return spark.createDataFrame(full, RAW_SPEECH)


ROWS = [
    (1, "A", "x", "01/01/2000", None, "first"),
    (2, "A", "x", "01/01/2000", "north", "second"),
    (3, "A", "x", "01/01/2000", "south", None),
    (4, "A", "x", "01/01/2000", None, "third"),
    (5, None, "y", "01/01/2000", "east", "dropped"),
    (6, "B", "y", "02/01/2000", "west", "only"),
    (0, "A", "w", "01/01/2000", None, "zero"),
]


def test_groups_first_non_null_and_ordered_join(spark):
    out = C.consolidate(raw(spark, ROWS)).orderBy("doc_id").collect()
    assert [(r["doc_id"], r["political_party"], r["member_name"]) for r in out] == [
        (0, "A", "w"), (1, "A", "x"), (2, "B", "y")]
    x = out[1]
    assert x["member_region"] == "north"          # first non-null in row order
    assert x["speech"] == "first | second | third"  # null speech skipped
    assert out[0]["member_region"] is None          # all-null attribute stays null


def test_input_order_does_not_matter(spark):
    a = C.consolidate(raw(spark, ROWS)).collect()
    b = C.consolidate(raw(spark, list(reversed(ROWS))).repartition(3)).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_sequential_ids_dense_and_ordered(spark):
    df = spark.range(0, 997).select((F.col("id") * 7919 % 997).alias("k")).repartition(5)
    out = with_sequential_id(df, ["k"], "i").collect()
    assert sorted(r["i"] for r in out) == list(range(997))
    assert all(r["i"] == r["k"] for r in out)


def test_smallest_by_hash_matches_brute_force(spark):
    import hashlib

    df = spark.range(0, 5000).withColumnRenamed("id", "doc_id")
    for k in [0, 1, 37, 1234, 5000, 6000]:
        got = sorted(r[0] for r in smallest_by_hash(df, "doc_id", k, prefix_step=2,
                                                    final_bucket_rows=50).collect())
        want = sorted(sorted(range(5000), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())[:k])
        assert got == want, k


def test_sample_exact_size_and_choose_input(spark):
    df = spark.range(0, 25).withColumnRenamed("id", "doc_id")
    assert C.sample_exact(df, 0.1).count() == 2          # round(2.5) = 2, half to even
    assert C.choose_input(df, max_rows=30).count() == 25
    assert C.choose_input(df, max_rows=20).count() == 2
    assert C.choose_input(df, max_rows=None).count() == 25


def test_lookup_unknown_id_is_empty(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, speech string")
    assert C.lookup_one(docs, 3).count() == 0
    assert C.lookup_one(docs, 2).first()["speech"] == "b"
    ids = spark.createDataFrame([(2,), (2,), (9,)], "doc_id long")
    assert [r["doc_id"] for r in C.lookup(docs, ids).collect()] == [2]


def test_csv_without_order_column_uses_file_order(spark, tmp_path):
    p = tmp_path / "raw.csv"
    p.write_text('extra,political_party,member_name,sitting_date,speech\n'
                 'x,A,m,01/01/2000,"first\nline"\n'
                 'y,A,m,01/01/2000,"say ""hi"""\n'
                 'z,B,n,02/01/2000,other\n', encoding="utf-8")
    from speechlens.sources.speeches import read_speeches_csv

    raw = read_speeches_csv(spark, str(p))
    assert "source_file" in raw.columns and raw.count() == 3
    out = C.consolidate(raw).orderBy("doc_id").collect()
    assert out[0]["speech"] == 'first\nline | say "hi"'
    assert out[0]["member_region"] is None and out[1]["speech"] == "other"


def test_kth_largest_exact(spark):
    from speechlens.functions.ids import kth_largest

    vals = [1, 1, 2, 3, 3, 3, 7, 7, 8, 100, 1000, 1000]
    df = spark.createDataFrame([(v,) for v in vals], "cf long")
    desc = sorted(vals, reverse=True)
    for k in range(1, len(vals) + 1):
        assert kth_largest(df, "cf", k) == desc[k - 1], k
    assert kth_largest(df, "cf", len(vals) + 1) is None
