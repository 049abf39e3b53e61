"""Search as a stream: queries arrive over time, the model is fixed.

The reference answers one query per web request against files built once.
The Spark form is a Structured Streaming query whose source is a stream of
(query_id, text) rows and whose micro-batches are scored with the batch
search plan against the frozen model (a stream-static join in effect).

Top-k per query is a per-batch operation (a query's hits only depend on that
query), so no streaming state is needed. Each micro-batch's hits are written
to ``<sink>/epoch=<id>`` with overwrite: if a batch is replayed after a
failure it replaces its own output, which makes the sink exactly-once
together with the checkpointed source offsets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.search import SCORE_FLOOR, SEARCH_SIZE, search
from ..operators.tfidf import TfidfModel
from ..schema import QUERIES


def query_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream of queries from parquet files landing in `path`."""
    r = spark.readStream.schema(QUERIES)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.parquet(path)


def start_search_stream(queries: DataFrame, model: TfidfModel, docs: DataFrame, sink: str,
                        checkpoint: str, k: int = SEARCH_SIZE, floor: float = SCORE_FLOOR,
                        available_now: bool = False,
                        processing_time: str | None = None) -> StreamingQuery:
    """Score every micro-batch of `queries` and write its hits under `sink`."""

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        hits = search(model, docs, batch.select("query_id", "text"), k, floor)
        (hits.withColumn("epoch", F.lit(int(epoch_id)))
         .write.mode("overwrite").parquet(f"{sink.rstrip('/')}/epoch={int(epoch_id)}"))

    w = queries.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def read_stream_hits(spark: SparkSession, sink: str) -> DataFrame:
    """All hits written so far (the HITS schema plus the epoch)."""
    return spark.read.parquet(sink)
