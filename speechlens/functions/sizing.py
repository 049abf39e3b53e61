"""Size checks that guard every broadcast and every driver-side read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import durable

# rows of a query-side table we are willing to broadcast to every executor
BROADCAST_ROWS = 2_000_000


def maybe_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> tuple[DataFrame, bool]:
    """Broadcast `df` only if it has at most `max_rows` rows; else leave it to
    a shuffle join (sort-merge, with AQE skew splitting). The side is computed
    once, into the checkpoint folder, and counted there."""
    df = durable(df)
    if df.count() <= max_rows:
        return F.broadcast(df), True
    return df, False


def collect_bounded(df: DataFrame, limit: int, what: str) -> list:
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{what}: more than {limit} rows; refusing to bring it to the driver")
    return rows


def local_frame(spark, rows: list, schema: str) -> DataFrame:
    """A small driver-side table as a DataFrame built through Arrow (a JVM-side
    relation), so later actions do not start Python workers to unpickle it."""
    import pandas as pd
    from pyspark.sql.types import _parse_datatype_string

    st = _parse_datatype_string(schema)
    names = [f.name for f in st.fields]
    pdf = pd.DataFrame.from_records([tuple(r) for r in rows], columns=names)
    if len(pdf) == 0:
        return spark.createDataFrame([], st)
    return spark.createDataFrame(pdf, st)


def marker(spark, path: str) -> None:
    """Write a one-row completion marker (JVM-side, no Python worker)."""
    spark.range(1).select(F.lit(1).alias("done")).coalesce(1).write.mode("overwrite").parquet(path)


# Catalyst reports Long.MaxValue (scaled by projections) when it cannot size
# a relation; anything beyond a few petabytes is treated as unknown
UNKNOWN_SIZE = 2 ** 52
#: bytes of (compressed) input per file, bucket or partition whose rows one task holds or reads whole
TASK_BYTES = 16 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a plan (file sizes for a scan)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def partitions_for(df: DataFrame, target_bytes: int = TASK_BYTES) -> int:
    """At least the session's shuffle partitions, more when the input is large: a
    task counts, sorts and writes what its partition holds, so a partition that
    grows with the input would spill."""
    spark = df.sparkSession
    base = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = estimated_bytes(df)
    if size <= 0 or size >= UNKNOWN_SIZE:
        return base
    return int(max(base, -(-size // target_bytes)))


def parts_for_task(df: DataFrame, least: int, target_bytes: int = TASK_BYTES) -> int:
    """How many parts a table read from files takes so that one stays under
    `target_bytes` of it; at least `least`."""
    size = estimated_bytes(df)
    return least if size >= UNKNOWN_SIZE else max(least, -(-size // target_bytes))
