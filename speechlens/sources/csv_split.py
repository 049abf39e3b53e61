"""One large multi-line CSV file read in many tasks.

A quoted field may hold line breaks, so a byte range of a CSV file does not tell
where its first record starts; Spark therefore reads a multi-line file in one
task. Here a file is cut into byte ranges of whole physical lines (chunks), and

1. a first scan counts the quotes of each chunk: their parity, and whether a line
   ends outside quotes if the chunk starts outside, or inside, of them;
2. a prefix sum of the parities over a file's chunks tells on which side each one
   starts (a row of some forty bytes a chunk, never text);
3. a second scan cuts each chunk into records, from its first true record end on,
   and parses them where they lie; what a border cuts through is kept as
   fragments, at most two a chunk;
4. the fragments of one record are joined, in order, and parsed as well.

The second scan's result is written once, with the wanted columns only: no text is
shuffled but the fragments. Files may order or leave out columns as they like;
each file's header is read in the task of its first chunk.

Files follow RFC 4180 as pandas and Spark (`escape='"'`) write it: a field that
holds a quote is quoted, quotes are doubled, UTF-8. An unclosed quote, and a row
of too few or too many fields, is an error, never a silent null or cut. Blank lines are
skipped; a file whose header ends in CR LF has CR LF line ends, which become LF
inside its fields.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.sizing import collect_bounded
from ..schema import SPEECH_COLUMNS
from ..session import durable, scratch_path
from .speeches import empty_like

CHUNK_BYTES = 128 * 1024 * 1024
MAX_HEADERS = 1_000
#: the table of chunks is broadcast (some 50 bytes each); more are an error: take larger chunks
MAX_CHUNKS = 4_000_000
PARSE_OPTIONS = {"quote": '"', "escape": '"', "mode": "FAILFAST", "multiLine": "true",
                 "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _physical_lines(spark: SparkSession, path: str, chunk_bytes: int) -> DataFrame:
    """(file_key, start, line): the physical lines of all files in file order
    inside each chunk. The scan belongs to a session of its own, whose file
    settings fix the chunks: every scan of it has the same ones, on any cluster."""
    own = spark.newSession()
    # one chunk a partition, whatever the number of cores
    own.conf.set("spark.sql.files.maxPartitionBytes", str(chunk_bytes))
    own.conf.set("spark.sql.files.openCostInBytes", str(chunk_bytes))
    lines = own.read.option("lineSep", "\n").text(path).select(
        F.xxhash64("_metadata.file_path").alias("file_key"), F.col("_metadata.file_block_start").alias("start"),
        F.col("value").alias("line"))
    name = "lines_" + scratch_path(spark, "v").rsplit("-", 1)[1]
    lines.createGlobalTempView(name)
    out = spark.table(f"global_temp.{name}")
    spark.catalog.dropGlobalTempView(name)
    return out


def _chunk_facts():
    def run(batches: Iterable) -> Iterator:
        """One row a chunk: parity of its quotes, whether a line ends outside quotes
        if it starts outside (or inside), and a file's first record."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def row(key, odd, closes, head):
            return pa.RecordBatch.from_arrays(
                [pa.array([x]) for x in (*key, bool(odd), *closes)] + [pa.array([head if key[1] == 0 else None], pa.string())],
                names=["file_key", "start", "odd", "closes_out", "closes_in", "header"])

        key, odd, closes, head = None, 0, [False, False], None
        for batch in batches:
            f, s = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = (np.flatnonzero((f[1:] != f[:-1]) | (s[1:] != s[:-1])) + 1).tolist()
            for a, b in zip([0, *cuts], [*cuts, len(f)], strict=True):
                if a == b:
                    continue
                if (f[a], s[a]) != key:
                    if key is not None:
                        yield row(key, odd, closes, head)
                    key, odd, closes, head = (f[a], s[a]), 0, [False, False], ""
                lines = batch.column(2).slice(a, b - a)
                after = (odd + np.cumsum(pc.count_substring(lines, '"').to_numpy())) & 1
                if s[a] == 0 and not closes[0]:
                    end = int(np.argmin(after)) + 1 if not after.all() else len(after)
                    head += "\n".join(lines.slice(0, end).to_pylist()) + ("\n" if after.all() else "")
                closes = [closes[0] or bool((after == 0).any()), closes[1] or bool((after == 1).any())]
                odd = int(after[-1])
        if key is not None:
            yield row(key, odd, closes, head)

    return run


def _assembled():
    def run(batches: Iterable) -> Iterator:
        """(file_key, start, place, kind, record) from (file_key, start, line, inside):
        kind 0 is a whole record, 1 the start of one that the chunk does not end,
        2 a piece (the end, or all of the chunk) of one that an earlier chunk starts."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def rows(key, first, kinds, records):
            n = len(records)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, key[0], dtype=np.int64)), pa.array(np.full(n, key[1], dtype=np.int64)),
                 pa.array(np.arange(first, first + n, dtype=np.int64)), pa.array(kinds, pa.int32()), records],
                names=["file_key", "start", "place", "kind", "record"])

        def rest():
            kind = 1 if started else 2
            return rows(key, place, [kind], pa.array(["\n".join(pending)], pa.string()))

        key, inside, place, pending, started = None, 0, 0, [], True
        for batch in batches:
            f, s = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = (np.flatnonzero((f[1:] != f[:-1]) | (s[1:] != s[:-1])) + 1).tolist()
            for a, b in zip([0, *cuts], [*cuts, len(f)], strict=True):
                if a == b:
                    continue
                if (f[a], s[a]) != key:
                    if pending:
                        yield rest()
                    # `started`: a record of this chunk's own has begun
                    key, inside, place, pending = (f[a], s[a]), int(batch.column(3)[a].as_py()), 0, []
                    started = not inside
                lines = batch.column(2).slice(a, b - a)
                after = (inside + np.cumsum(pc.count_substring(lines, '"').to_numpy())) & 1
                inside = int(after[-1])
                ends = np.flatnonzero(after == 0) + 1
                if not len(ends):
                    pending += lines.to_pylist()
                    continue
                last = int(ends[-1])
                whole = pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), lines.slice(0, last).cast(pa.string()))
                records = pc.binary_join(whole, "\n")
                if pending:
                    first = "\n".join([*pending, records[0].as_py()])
                    records = pa.concat_arrays([pa.array([first], pa.string()), records.slice(1)])
                kinds = np.zeros(len(records), dtype=np.int32)
                kinds[0] = 0 if started else 2
                yield rows(key, place, kinds, records)
                place, pending, started = place + len(records), lines.slice(last).to_pylist(), True
        if pending:
            yield rest()

    return run


def _chunks(lines: DataFrame, path: str) -> DataFrame:
    """(file_key, start, inside, owner, header): on which side of quotes each
    chunk starts, the chunk in which the record begins that crosses its start,
    and the file's header."""
    facts = durable(lines.mapInArrow(
        _chunk_facts(), "file_key long, start long, odd boolean, closes_out boolean, closes_in boolean, header string"))
    n = facts.count()
    if n > MAX_CHUNKS:
        raise ValueError(f"{path}: {n} chunks; take larger ones than now")
    in_file = Window.partitionBy("file_key").orderBy("start")
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    odd = F.col("odd").cast("int")
    sides = facts.withColumn("inside", F.coalesce(F.sum(odd).over(before) % 2, F.lit(0)) == 1).withColumn(
        "ends_inside", F.col("inside") != F.col("odd")).withColumn(
        "starts_record", F.col("ends_inside") & (~F.col("inside") | F.col("closes_in"))).withColumn(
        "owner", F.last(F.when(F.col("starts_record"), F.col("start")), ignorenulls=True).over(before)).withColumn(
        "header", F.max("header").over(Window.partitionBy("file_key")))
    sides = durable(sides)
    if not sides.where("start = 0 AND NOT closes_out").isEmpty():
        raise ValueError(f"{path}: a header does not end in its file's first chunk")
    open_end = sides.groupBy("file_key").agg(F.max_by("ends_inside", "start").alias("open")).where("open")
    if not open_end.isEmpty():
        raise ValueError(f"{path}: a quote is never closed in {open_end.count()} file(s)")
    return sides.select("file_key", "start", "inside", "owner", "header")


def _columns_of(header: str) -> list[str]:
    return next(csv.reader([header.removeprefix("\ufeff").removesuffix("\r").replace("\r\n", "\n")], strict=True))


def _parsed(record: Column, header: Column, headers: list[str], wanted: list[str]) -> Column:
    """The struct of the wanted columns of a record, by its file's header."""
    out = F.lit(None)
    for text in headers:
        names: dict[str, str] = {}
        fields = []
        for i, c in enumerate(_columns_of(text)):
            fields.append(f"`_c{i}` STRING")
            names.setdefault(c, f"_c{i}")
        crlf = text.endswith("\r")
        line = F.regexp_replace(F.regexp_replace(record, "\r$", ""), "\r\n", "\n") if crlf else record
        row = F.from_csv(line, ", ".join(fields), PARSE_OPTIONS)
        values = [(row[names[c]] if c in names else F.lit(None).cast("string")).alias(c) for c in wanted]
        out = F.when(header == F.lit(text), F.struct(*values, F.lit("seq" in names).alias("_has_seq"))).otherwise(out)
    return out


def read_speeches_csv_split(spark: SparkSession, path: str, columns: list[str] | None = None, *,
                            chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Raw speech CSV files by header name, every value as text, each file read
    by as many tasks as it has chunks of `chunk_bytes`.

    Columns beyond the speech columns are ignored, missing ones are null. Row
    order: the file's own `seq` column if it has one, else `seq` numbers a file's
    records by their chunk's first byte and their place in it (ascending, with gaps);
    `source_file` tells the file."""
    wanted = columns or SPEECH_COLUMNS + ["seq"]
    lines = _physical_lines(spark, path, chunk_bytes)
    chunks = _chunks(lines, path)
    headers = [r["header"] for r in collect_bounded(chunks.select("header").distinct(), MAX_HEADERS, f"{path}: headers")]
    if not headers:
        return empty_like(spark, T.StructType([T.StructField(c, T.LongType() if c == "seq" else T.StringType()) for c in wanted]))
    # order inside a chunk is the scan's: chunks are broadcast, lines never move
    sided = lines.join(F.broadcast(chunks.select("file_key", "start", "inside")), ["file_key", "start"])
    cut = sided.select("file_key", "start", "line", "inside").mapInArrow(
        _assembled(), "file_key long, start long, place long, kind int, record string")
    body = cut.where("(kind <> 0 OR record NOT IN ('', '\r')) AND NOT (start = 0 AND place = 0)")
    headed = body.join(F.broadcast(chunks.select("file_key", "start", "owner", "header")), ["file_key", "start"])
    row = F.when(F.col("kind") == 0, _parsed(F.col("record"), F.col("header"), headers, wanted))
    kept = headed.select(row.alias("row"), "file_key", "start", "place", "kind", "owner",
                         F.when(F.col("kind") != 0, F.struct("header", "record")).alias("piece"))
    target = scratch_path(spark, "csv-split")
    kept.write.parquet(target)
    kept = spark.read.schema(kept.schema).parquet(target)
    # pieces of a record: its start, then whole chunks inside it, then its end
    begun = F.when(F.col("kind") == 1, F.col("start")).otherwise(F.col("owner"))
    joined = kept.where("kind <> 0").groupBy("file_key", begun.alias("begun")).agg(
        F.sort_array(F.collect_list(F.struct("start", "kind", "place", "piece"))).alias("pieces")).select(
        "file_key", F.col("begun").alias("start"),
        F.filter("pieces", lambda p: p["kind"] == 1)[0]["place"].alias("place"),
        F.col("pieces")[0]["piece"]["header"].alias("header"),
        F.array_join(F.transform("pieces", lambda p: p["piece"]["record"]), "\n").alias("record"))
    stitched = joined.select(_parsed(F.col("record"), F.col("header"), headers, wanted).alias("row"),
                             "file_key", "start", "place")
    rows = kept.where("kind = 0").select("row", "file_key", "start", "place").unionByName(stitched)
    return _named(spark, rows, path, wanted, headers)


def _named(spark: SparkSession, rows: DataFrame, path: str, wanted: list[str], headers: list[str]) -> DataFrame:
    if "seq" not in wanted:
        return rows.select(*(F.col("row")[c].alias(c) for c in wanted))
    place = F.col("start") + F.col("place")
    out = [F.when(F.col("row")["_has_seq"], F.col("row")["seq"].cast("long")).otherwise(place).alias("seq")
           if c == "seq" else F.col("row")[c].alias(c) for c in wanted]
    if all("seq" in _columns_of(h) for h in headers):
        return rows.select(*out)
    listed = spark.read.format("binaryFile").load(path).select(
        F.xxhash64("_metadata.file_path").alias("file_key"), F.col("_metadata.file_path").alias("source_file"))
    return rows.join(listed, "file_key").select(*out, "source_file")
