"""Parquet tables bucketed by a column, found again by path in any session."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession


def bucketed_name(path: str) -> str:
    return "speechlens_bucketed_" + hashlib.sha1(path.encode()).hexdigest()[:16]


def write_bucketed(df: DataFrame, path: str, n: int, column: str, sort: list[str], dealt: bool = False) -> DataFrame:
    """Write `df` to `path` in `n` buckets of `column`, one file each, sorted inside;
    `dealt` if its rows lie in `n` partitions by `column` already."""
    (df if dealt else df.repartition(n, column)).write.mode("overwrite").format("parquet").bucketBy(n, column).sortBy(*sort).option(
        "path", path).saveAsTable(bucketed_name(path))
    return df.sparkSession.table(bucketed_name(path))


def bucketed_table(spark: SparkSession, path: str, ddl: str, n: int, column: str, sort: list[str]) -> DataFrame:
    """The table written to `path`, registered again where the session does not
    know it (its files carry the bucket ids)."""
    if not spark.catalog.tableExists(bucketed_name(path)):
        place = path.replace("'", "\\'")
        spark.sql(f"CREATE TABLE {bucketed_name(path)} ({ddl}) USING parquet CLUSTERED BY ({column}) SORTED BY ({', '.join(sort)}) "
                  f"INTO {int(n)} BUCKETS LOCATION '{place}'")
    return spark.table(bucketed_name(path))
