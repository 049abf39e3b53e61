"""Documents kept by id, so that a few of them are opened without a scan.

The store is a Parquet table bucketed by `doc_id`, each bucket sorted by it, with
a Bloom filter on it. A bounded set of wanted ids becomes an IN list: Spark
opens only the buckets those ids hash to, Parquet only the row groups whose
range (and, for up to ten ids, Bloom filter) can hold one. A larger set is joined
where the buckets lie, so the texts still do not move.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.sizing import maybe_broadcast, partitions_for
from ..functions.tables import bucketed_name, bucketed_table
from ..session import durable, path_exists

#: ids up to this number are read by the driver and pushed into the scan (16 bytes each)
POINT_IDS = 10_000
#: bytes of a row group: small ones, since a fetch wants single documents
ROW_GROUP_BYTES = 8 * 1024 * 1024


def write_store(docs: DataFrame, path: str, n_buckets: int | None = None) -> DataFrame:
    """Write `docs` (doc_id, ...) once as a store under `path`, and open it."""
    spark = docs.sparkSession
    if not path_exists(spark, f"{path}/_SUCCESS"):
        n = n_buckets or partitions_for(docs)
        docs.repartition(n, "doc_id").write.mode("overwrite").format("parquet").bucketBy(n, "doc_id").sortBy("doc_id").option(
            "parquet.bloom.filter.enabled#doc_id", "true").option("parquet.block.size", ROW_GROUP_BYTES).option(
            "path", path).saveAsTable(bucketed_name(path))
        schema = docs.schema.json()
        spark.range(1).select(F.lit(n).alias("n"), F.lit(schema).alias("schema")).coalesce(1).write.mode("overwrite").parquet(
            f"{path}-meta")
    return open_store(spark, path)


def store_buckets(spark: SparkSession, path: str) -> int:
    """The number of buckets of the store under `path`."""
    return int(spark.read.parquet(f"{path}-meta").first()["n"])


def open_store(spark: SparkSession, path: str) -> DataFrame:
    """The store under `path`, in any session."""
    import json

    meta = spark.read.parquet(f"{path}-meta").first()
    ddl = T.StructType.fromJson(json.loads(meta["schema"])).toDDL()
    return bucketed_table(spark, path, ddl, meta["n"], "doc_id", ["doc_id"])


def fetch(store: DataFrame, wanted: DataFrame) -> DataFrame:
    """All fields of the documents whose doc_id is in `wanted`; unknown and null
    ids give no row, repeated ones one."""
    ids = durable(wanted.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id IS NOT NULL").distinct())
    few = ids.limit(POINT_IDS + 1).collect()
    if len(few) <= POINT_IDS:
        return store.where(F.col("doc_id").isin([r[0] for r in few])) if few else store.limit(0)
    side, _ = maybe_broadcast(ids)
    return store.join(side, "doc_id", "left_semi")


def fetch_one(store: DataFrame, doc_id: int) -> DataFrame:
    """One document by id, from one bucket."""
    return store.where(F.col("doc_id") == F.lit(int(doc_id)))
