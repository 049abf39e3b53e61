"""The license scan against plain Python: base places, edited notices, defined cases."""

import random
import re

import duckdb
import pytest

import __spark_entry__ as entry
from speechlens.llm import license_scan

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, label string, row string, words string, t_no int, share string"


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def base_places(words):
    return sorted((i, label) for label, phrase in license_scan.BASE for p in [phrase.split()]
                  for i in range(len(words)) if words[i:i + len(p)] == p)


def check_base(row, text):
    words = words_of(text)
    places = base_places(words)
    assert (row["n_words"], row["n_base"]) == (len(words), len(places))
    assert (row["first_word"], row["last_word"]) == ((places[0][0], places[-1][0]) if places else (None, None))
    assert row["base_labels"] == ",".join(sorted({label for _, label in places}))
    assert set(filter(None, row["base_labels"].split(","))) <= set(filter(None, row["labels"].split(",")))
    assert 0 <= row["score"] <= 1 and (row["score"] == 1.0 or not places)


def test_query_base_places(spark):
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())
    got = entry.queries()["op12_license_scan"](spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        check_base(r, texts[r["doc_id"]])


def labels_of(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"]: r for r in license_scan.scan_licenses(docs).collect()}


def test_edited_notices_are_found(spark):
    """Notices with words changed, left out or put in, inside other words."""
    rng = random.Random(7)
    texts, want = [], []
    for label, notice in license_scan.NOTICES:
        for _ in range(4):
            words = notice.split()
            for _ in range(max(1, len(words) // 12)):
                i = rng.randrange(len(words))
                words[i:i + 1] = rng.choice([[], ["changed"], [words[i], "inserted"]])
            other = [f"w{rng.randrange(1000)}" for _ in range(80)]
            texts.append(" ".join(other[:40] + words + other[40:]))
            want.append(label)
    got = labels_of(spark, texts)
    found = sum(label in got[i]["labels"].split(",") for i, label in enumerate(want))
    assert found >= 0.9 * len(want)
    assert all(got[i]["score"] >= license_scan.NEED for i in got if got[i]["labels"])


def test_ordinary_and_shuffled_words_are_left_alone(spark):
    rng = random.Random(8)
    texts = []
    for _, notice in license_scan.NOTICES:
        words = notice.split()
        rng.shuffle(words)
        texts.append(" ".join(words))
    texts += [" ".join(notice.split()[:len(notice.split()) // 3]) for _, notice in license_scan.NOTICES]
    got = labels_of(spark, texts)
    assert {r["labels"] for r in got.values()} <= {"", "gpl", "mpl", "bsd"}
    assert sum(bool(r["labels"]) for r in got.values()) <= 2


def test_spans_tell_the_place(spark):
    notice = license_scan.NOTICES[1][1].split()
    text = " ".join(["x"] * 10 + notice[:8] + ["new"] + notice[8:] + ["y"] * 5)
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    spans = license_scan.license_spans(docs).where("label IS NOT NULL").collect()
    assert [(r["label"], r["start"], r["end"]) for r in spans] == [("bsd", 10, 10 + len(notice) + 1)]
    assert spans[0]["share"] == pytest.approx(1.0)


def test_defined_cases(spark):
    long_text = "all rights reserved " * 30_000 + "x" * 200_000
    rows = [(1, None), (2, ""), (3, " \n .,;"), (4, long_text), (4, long_text), (None, "CC BY-NC"), (5, "cc by cc by"),
            (6, "ALL rights\tReserved. general PUBLIC license"), (7, "çc by all rights"), (8, "\x00cc\x00by\x00"),
            (9, "cc"), (10, "Kelvin İ cc by")]
    docs = spark.createDataFrame([(i, t, "x", "r", "w", 1, "s") for i, t in rows], SCHEMA).repartition(3)
    got = license_scan.scan_licenses(docs).collect()
    assert len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        check_base(r, texts[r["doc_id"]])
    by = {r["doc_id"]: r for r in got}
    assert by[None]["labels"] == "cc-by,cc-by-nc" and by[4]["n_base"] == 30_000 and by[5]["last_word"] == 2
    assert by[1]["score"] == 0.0 and by[1]["labels"] == ""
    empty = spark.createDataFrame([], SCHEMA)
    assert license_scan.scan_licenses(empty).count() == 0


def test_long_notices_are_cut_into_templates():
    own = license_scan.templates(notices=[("x", " ".join(f"w{i}" for i in range(150)))])
    assert [len(t.words) for t in own if t.label == "x"] == [50, 50, 50]
    with pytest.raises(ValueError):
        license_scan.templates(phrases=[("y", "one")])
