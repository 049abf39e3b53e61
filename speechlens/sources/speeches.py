"""Raw speech sources and sinks (CSV), plus views of the test tables.

A raw speech file is a UTF-8 CSV with a header. Texts carry newlines and
quotes, so files are written with ``escape='"'`` and read with ``multiLine``
by header name, all values as text (no inference). A multi-line CSV file
cannot be split, so writers emit many files and the long-term store is
parquet.
"""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import ATTRIBUTES, DATE, MEMBER, PARTY, SPEECH, SPEECH_COLUMNS

CSV_OPTIONS = {
    "header": "true",
    "multiLine": "true",
    "quote": '"',
    "escape": '"',
    "encoding": "UTF-8",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    # a row with too few or too many fields is an error, never a silent null or cut
    "mode": "FAILFAST",
    "enforceSchema": "false",
}
# files whose headers the driver reads; more than this many different headers is an error
MAX_HEADERS = 1_000


def _headers(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """The files of `path` by their header, read through Hadoop's file systems
    (one line a file)."""
    files = sorted(r[0] for r in spark.read.format("binaryFile").load(path).select("path").collect())
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found: dict[tuple[str, ...], list[str]] = {}
    for f in files:
        p = jvm.org.apache.hadoop.fs.Path(f)
        lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(p.getFileSystem(conf).open(p), "UTF-8"))
        try:
            first = lines.readLine()
        finally:
            lines.close()
        if first is not None:
            found.setdefault(tuple(next(csv.reader([first.removeprefix("\ufeff")]))), []).append(f)
    if len(found) > MAX_HEADERS:
        raise ValueError(f"{path}: {len(found)} different headers")
    return found


def read_speeches_csv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Scan raw speech CSV files by header name, every value as text.

    Columns beyond the speech columns are ignored, missing ones are null;
    `columns` prunes the scan. Files may order or leave out columns as they
    like: files with the same header are one scan, mapped by name. Row order:
    the file's own `seq` column if it has one, else (`source_file`, position in
    the file) — a multi-line CSV file is never split, so positions follow it."""
    wanted = columns or SPEECH_COLUMNS + ["seq"]
    out = None
    for header, files in _headers(spark, path).items():
        schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
        part = _named(spark.read.options(**CSV_OPTIONS).schema(schema).csv(files), wanted)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out if out is not None else _named(empty_like(spark, T.StructType([])), wanted)


def _named(df: DataFrame, wanted: list[str]) -> DataFrame:
    have = set(df.columns)
    out = []
    for c in wanted:
        if c == "seq":
            if "seq" in have:
                out.append(F.col("seq").cast("long").alias("seq"))
            else:
                out.append(F.input_file_name().alias("source_file"))
                out.append(F.monotonically_increasing_id().alias("seq"))
        elif c in have:
            out.append(F.col(c).cast("string").alias(c))
        else:
            out.append(F.lit(None).cast("string").alias(c))
    return df.select(*out)


def write_speeches_csv(df: DataFrame, path: str, num_files: int | None = None,
                       mode: str = "errorifexists") -> None:
    """Write speeches as header CSV (no index column), quoting what needs it."""
    out = df.repartition(num_files) if num_files else df
    (out.write.mode(mode)
        .option("header", "true").option("quote", '"').option("escape", '"')
        .option("quoteAll", "false").option("encoding", "UTF-8")
        .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
        .csv(path))


# ---------------------------------------------------------------------------
# Views of the driver's test tables as raw speeches. They only rename and
# derive columns so the jobs see the schema they expect; no job relies on how
# these columns are formed.

_BASE_DATE = "1989-07-03"

# (column, prefix, null when doc_id % a == 0, value doc_id % b)
_ATTRIBUTE_PATTERN = [
    ("parliamentary_period", "period-", 7, 6),
    ("parliamentary_session", "session-", 4, 3),
    ("parliamentary_sitting", "sitting-", 5, 11),
    ("government", "government-", 6, 4),
    ("member_region", "region-", 3, 5),
    ("roles", "role-", 2, 7),
    ("member_gender", "gender-", 9, 2),
]


def _attribute(doc_id, prefix: str, null_mod: int, val_mod: int):
    return F.when(doc_id % null_mod == 0, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit(prefix), (doc_id % val_mod).cast("string")))


def documents_as_speeches(documents: DataFrame) -> DataFrame:
    """`documents` (doc_id, text, lang, source, n_chars) as raw speeches.

    party = lang, member = lang-source, date = a sitting date in dd/MM/yyyy,
    speech = text, seq = doc_id; `lang` is kept for reference.
    """
    d = F.col("doc_id")
    date = F.date_format(
        F.date_add(F.lit(_BASE_DATE).cast("date"), ((d % 40) * 280).cast("int")), "dd/MM/yyyy")
    attrs = [_attribute(d, p, a, b).alias(c) for c, p, a, b in _ATTRIBUTE_PATTERN]
    return documents.select(
        F.col("lang").alias(PARTY),
        F.concat(F.col("lang"), F.lit("-"), F.col("source")).alias(MEMBER),
        date.alias(DATE),
        *attrs,
        F.col("text").alias(SPEECH),
        d.alias("seq"),
    )


def documents_corpus(documents: DataFrame) -> DataFrame:
    """The analysis corpus: one speech per document, `doc_id` as identity."""
    sp = documents_as_speeches(documents)
    return sp.select(F.col("seq").alias("doc_id"), *SPEECH_COLUMNS)


def conversations_as_speeches(conversations: DataFrame) -> DataFrame:
    """`conversations` (conv_id, turn, role, text) as raw speeches: one sitting
    per conversation, the role as party, `seq` the turn order inside it."""
    return conversations.select(
        F.col("role").alias(PARTY),
        F.concat(F.lit("conv-"), F.col("conv_id").cast("string")).alias(MEMBER),
        F.lit("01/01/2000").alias(DATE),
        *[F.lit(None).cast("string").alias(c) for c in ATTRIBUTES],
        F.col("text").alias(SPEECH),
        F.col("turn").cast("long").alias("seq"),
    )


def union_sources(*frames: DataFrame) -> DataFrame:
    """Stack several raw speech sources by column name (missing columns null)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def empty_like(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
