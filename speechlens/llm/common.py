"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import durable, scratch_path

# words of a text, as a Java regex: runs without ASCII white space
WORD = r"[^\x20\x09-\x0D]+"


def crc_mod(col: str, n: int) -> Column:
    """crc32 of the column as text, modulo n (null for null)."""
    return F.crc32(F.col(col).cast("string")) % n


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once as Parquet beside the session's checkpoints and read it
    back: cuts lineage with files that outlive a lost executor, keeps column
    pruning, and can be read any number of times."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


ARROW_ROWS = 512


def lean(df: DataFrame) -> DataFrame:
    """`df`, whose Arrow batches to Python hold at most ARROW_ROWS rows from now
    on, so that a task has few texts in memory at a time."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(df.sparkSession.conf.get(name))
    if not 0 < now <= ARROW_ROWS:
        df.sparkSession.conf.set(name, str(ARROW_ROWS))
    return df


def collected(df: DataFrame):
    """A bounded result as a pandas frame, through Arrow whatever the session's settings."""
    return df.toArrow().to_pandas()


def sampled(df: DataFrame, id_col: str, bound: int, n: int | None = None, seed: int = 1) -> DataFrame:
    """All rows if there are at most `bound`, else about `bound` of them chosen by
    a hash of the id: the same rows for any partitioning."""
    n = df.count() if n is None else n
    if n <= bound:
        return df
    parts = 1 << 30
    return df.where(F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit(seed)), F.lit(parts)) < int(parts * bound / n))


def label_values(labels: DataFrame, label: str, *, id_col: str, where: Column | None = None) -> DataFrame:
    """(id, y): the 0 or 1 of every labelled id, the larger one of several."""
    own = labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull())
    own = own.where(where) if where is not None else own
    return own.groupBy(id_col).agg(F.max(F.col(label).cast("int")).alias("y")).where("y in (0, 1)")


def labelled(docs: DataFrame, labels: DataFrame, label: str, *, id_col: str, text_col: str, bound: int,
             where: Column | None = None) -> DataFrame:
    """(id, text, y): the texts of at most about `bound` labelled documents of
    each class, whose ids are broadcast (so texts are read, not shuffled)."""
    own = label_values(labels, label, id_col=id_col, where=where)
    per = {r["y"]: r["count"] for r in own.groupBy("y").count().collect()}
    picked = None
    for y, n in sorted(per.items()):
        some = sampled(own.where(F.col("y") == y), id_col, bound, n)
        picked = some if picked is None else picked.union(some)
    if picked is None:
        picked = own
    return docs.select(F.col(id_col), F.col(text_col).alias("text")).join(F.broadcast(picked), id_col).select(
        F.col(id_col).alias("id"), "text", "y")


__all__ = ["WORD", "collected", "crc_mod", "durable", "label_values", "labelled", "lean", "sampled", "scratch_path", "table", "written"]
