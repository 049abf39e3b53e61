from pyspark.sql import functions as F

from speechlens.functions import lexicon
from speechlens.functions import text as TX


def one(spark, expr, value):
    return spark.createDataFrame([(value,)], "t string").select(expr(F.col("t")).alias("x")).first()["x"]


def test_clean_deletes_punctuation_and_lowers(spark):
    assert one(spark, TX.clean_text, "A.b C!") == "ab c"
    assert one(spark, TX.clean_text, None) == ""
    assert one(spark, TX.clean_text, "!!!") == ""


def test_tokens_keep_runs_of_two_or_more(spark):
    assert one(spark, TX.tokens, "a.b c") == ["ab"]
    assert one(spark, TX.tokens, "") == []
    assert one(spark, TX.tokens, None) == []
    assert one(spark, TX.tokens, "Été 2020, x_y; Ωmega") == ["été", "2020", "xy", "ωmega"]


def test_snippet_ten_and_eleven_words(spark):
    ten = " ".join(f"w{i}" for i in range(10))
    eleven = ten + " w10"
    assert one(spark, TX.snippet, ten) == ten
    assert one(spark, TX.snippet, eleven) == ten + "..."
    assert one(spark, TX.snippet, "  lead\n\tand  trail  ") == "lead and trail"
    assert one(spark, TX.snippet, None) == ""
    assert one(spark, TX.snippet, "a b") == "a b"


def test_parse_date_bad_text_is_null(spark):
    df = spark.createDataFrame([("03/07/1989",), ("99/99/1999",), (None,)], "d string")
    got = [r[0] for r in df.select(TX.parse_date(F.col("d"))).collect()]
    assert str(got[0]) == "1989-07-03" and got[1] is None and got[2] is None


def test_stem_longest_suffix_wins(spark):
    rules = lexicon.as_rule_list(None)
    df = spark.createDataFrame(
        [(w,) for w in ["ponies", "ties", "caresses", "cats", "bus", "class", "goes", "is", "toes"]], "t string")
    got = {r[0]: r[1] for r in df.select("t", lexicon.stem("t", rules)).collect()}
    assert got == {"ponies": "pony", "ties": "ty", "caresses": "caresse", "cats": "cat", "bus": "bus",
                   "class": "class", "goes": "goe", "is": "i", "toes": "toe"}


def test_custom_rules_and_min_len(spark):
    rules = lexicon.as_rule_list([("ing", "", 3), ("s", "", 1)])
    df = spark.createDataFrame([("singing",), ("sing",), ("bring",)], "t string")
    got = {r[0]: r[1] for r in df.select("t", lexicon.stem("t", rules)).collect()}
    assert got == {"singing": "sing", "sing": "sing", "bring": "bring"}


def test_stop_words_from_spark_lists():
    words = set(lexicon.default_stop_words())
    assert {"the", "und", "les", "los"} <= words
    assert len(lexicon.spark_stop_words("en")) == 181


def test_stop_filter(spark):
    df = spark.createDataFrame([("the",), ("parliament",)], "t string")
    got = [r[0] for r in df.filter(lexicon.not_stop_word("t", ["the"])).collect()]
    assert got == ["parliament"]


def test_sql_literal_escaping(spark):
    words = ["it's", "back\\slash", "plain"]
    df = spark.createDataFrame([(w,) for w in words + ["other"]], "t string")
    got = [r[0] for r in df.filter(lexicon.not_stop_word("t", words)).collect()]
    assert got == ["other"]


def test_snippet_looks_at_the_head_of_a_text_only(spark):
    long = "word " * 200_000
    texts = [None, "", " ", "\n\n one", "a b", "　x y z ", long, " " * 50_000 + "late", "w" * 120_000, "w" * 100_000 + " end",
             " ".join("abcdefghij"), " ".join("abcdefghij") + " \n", " ".join("abcdefghijk"), "\t" + "  ".join("abcdefghijkl") + "\t", "é ü ß 😀 ñ"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", TX.snippet(F.col("t")).alias("s"))
    # what is split ends with the words: no list holds the rest of a text
    assert "split(regexp_extract(" in df._jdf.queryExecution().optimizedPlan().toString()
    for i, s in df.collect():
        w = (texts[i] or "").split()
        assert s == " ".join(w[:10]) + ("..." if len(w) > 10 else "")
