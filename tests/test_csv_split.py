"""One multi-line CSV file read in many tasks equals the one-task read."""

import random

import pytest

from speechlens.sources import csv_split
from speechlens.sources.csv_split import read_speeches_csv_split
from speechlens.sources.speeches import read_speeches_csv, write_speeches_csv

COLUMNS = ["member_name", "speech", "roles", "seq"]


def table(df):
    cols = sorted(c for c in df.columns if c != "source_file")
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def write(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(text.encode() if isinstance(text, str) else text)
    return str(folder)


def rows(n, seed):
    """Speeches of quotes, line breaks, commas and letters, so that a chunk of any
    size starts inside quotes, at a doubled quote or on an empty line of a field."""
    rng = random.Random(seed)
    piece = ['"', '""', "\n", "\n\n", ",", "a", "ü ", "\\", '"\n"', "'", " "]
    return [(f"m{i}", "".join(rng.choice(piece) for _ in range(rng.randrange(12))) or None, rng.choice([None, "r", "x,\ny"]), str(i))
            for i in range(n)]


@pytest.mark.parametrize("chunk", [7, 40, 333, 1 << 20])
def test_equal_to_the_one_task_read(spark, tmp_path, chunk):
    path = str(tmp_path / "csv")
    df = spark.createDataFrame(rows(60, chunk), "member_name string, speech string, roles string, seq string")
    write_speeches_csv(df.coalesce(1), path, 1)
    want = table(read_speeches_csv(spark, path, COLUMNS))
    assert len(want) == 60
    assert table(read_speeches_csv_split(spark, path, COLUMNS, chunk_bytes=chunk)) == want


def test_chunks_are_tasks(spark, tmp_path):
    path = write(tmp_path / "c", "a.csv", "speech,seq\n" + "".join(f'"line\nof {i}",{i}\n' for i in range(200)))
    lines = csv_split._physical_lines(spark, path, 100)
    assert lines.rdd.getNumPartitions() >= 20
    got = read_speeches_csv_split(spark, path, ["speech", "seq"], chunk_bytes=100)
    assert table(got) == sorted(((i, f"line\nof {i}") for i in range(200)), key=repr)


def test_a_record_over_many_chunks(spark, tmp_path):
    long = "\n".join(f'line "{i}"' for i in range(100))
    path = write(tmp_path / "c", "a.csv", 'speech,seq\n"{}",1\nshort,2\n"{}",3\n'.format(*[long.replace('"', '""')] * 2))
    got = read_speeches_csv_split(spark, path, ["speech", "seq"], chunk_bytes=50)
    assert table(got) == sorted([(1, long), (2, "short"), (3, long)], key=repr)


def test_files_of_different_headers_and_line_ends(spark, tmp_path):
    folder = tmp_path / "c"
    write(folder, "a.csv", "seq,speech,extra\n1,one,x\n\n2,\"two\nlines\",y\n")
    write(folder, "b.csv", "﻿speech,seq\r\n\"three\r\nlines\",3\r\nfour,4\r\n")
    path = write(folder, "empty.csv", "")
    for chunk in (9, 1 << 20):
        got = read_speeches_csv_split(spark, path, ["speech", "roles", "seq"], chunk_bytes=max(chunk, 20))
        assert got.columns == ["speech", "roles", "seq"]
        assert table(got) == sorted([(None, 1, "one"), (None, 2, "two\nlines"), (None, 3, "three\nlines"), (None, 4, "four")], key=repr)


def test_row_order_without_a_seq_column(spark, tmp_path):
    path = write(tmp_path / "c", "a.csv", "speech\n" + "".join(f'"s\n{i}"\n' for i in range(100)))
    got = read_speeches_csv_split(spark, path, ["speech", "seq"], chunk_bytes=64).collect()
    assert [r["speech"] for r in sorted(got, key=lambda r: r["seq"])] == [f"s\n{i}" for i in range(100)]
    assert len({r["seq"] for r in got}) == 100 and got[0]["source_file"].endswith("a.csv")


def test_errors_are_loud(spark, tmp_path):
    unclosed = write(tmp_path / "u", "a.csv", 'speech,seq\nx,1\n"never closed,2\n')
    with pytest.raises(ValueError, match="never closed"):
        read_speeches_csv_split(spark, unclosed, ["speech"], chunk_bytes=12)
    header = write(tmp_path / "h", "a.csv", '"sp\neech\nlong",seq\nx,1\n')
    with pytest.raises(ValueError, match="header"):
        read_speeches_csv_split(spark, header, ["speech"], chunk_bytes=3)
    for bad in ("x\n", "x,1,2\n"):
        malformed = write(tmp_path / f"m{len(bad)}", "a.csv", "speech,seq\nok,1\n" + bad)
        with pytest.raises(Exception, match="(?i)malformed"):
            read_speeches_csv_split(spark, malformed, ["speech"]).collect()


def test_no_rows(spark, tmp_path):
    assert read_speeches_csv_split(spark, write(tmp_path / "e", "a.csv", ""), COLUMNS).count() == 0
    only = read_speeches_csv_split(spark, write(tmp_path / "f", "a.csv", "speech,seq\n"), COLUMNS)
    assert only.columns == COLUMNS and only.count() == 0
