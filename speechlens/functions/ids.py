"""Global numbering and exact hash-ordered selection without one-task steps.

* `with_sequential_id` numbers rows 0..n-1 in a total order using a range
  sort, per-partition counts and offsets (the ``zipWithIndex`` idea in
  DataFrame form) instead of an unpartitioned ``row_number()`` window.
* `smallest_by_hash` keeps exactly the k rows with the smallest md5 of a key,
  by narrowing a hash-prefix histogram; the data is only filtered and counted,
  never sorted into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import durable

_PID = "_sl_pid"
_MONO = "_sl_mono"


def with_sequential_id(df: DataFrame, order_cols: list, id_col: str = "doc_id",
                       start: int = 0) -> DataFrame:
    """Add `id_col` = position of the row in the order of `order_cols`.

    `order_cols` should be unique per row; ties get distinct ids in an order
    that is fixed once the sorted data has been checkpointed.
    """
    sorted_df = df.orderBy(*order_cols)
    tagged = durable(sorted_df.select(
        "*", F.spark_partition_id().alias(_PID), F.monotonically_increasing_id().alias(_MONO)))
    counts = tagged.groupBy(_PID).agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: the window below runs over #partitions rows only
    offsets = counts.select(
        _PID,
        (F.sum("_n").over(Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)))
        .alias("_off"))
    offsets = offsets.fillna(0, subset=["_off"])
    local_index = F.col(_MONO) - F.shiftleft(F.col(_PID).cast("long"), 33)
    out = tagged.join(F.broadcast(offsets), _PID).withColumn(
        id_col, (F.lit(start) + F.col("_off") + local_index).cast("long"))
    return out.drop(_PID, _MONO, "_off")


def md5_key(col: Column) -> Column:
    return F.md5(col.cast("string"))


def smallest_by_hash(df: DataFrame, key: str, k: int, *, prefix_step: int = 4,
                     final_bucket_rows: int = 200_000) -> DataFrame:
    """Rows whose md5(key) is among the k smallest (ties broken by key).

    Each round counts rows per hash prefix inside the current boundary bucket
    (at most 16**prefix_step groups, partially aggregated), moves the
    threshold past all full buckets, and descends into the bucket holding the
    k-th row. Once that bucket is small, its hashes (bounded by
    `final_bucket_rows`) are read to fix the exact threshold.
    """
    if k <= 0:
        return df.limit(0)
    h = md5_key(F.col(key))
    keyed = df.withColumn("_sl_h", h)
    prefix = ""
    need = k
    while True:
        width = len(prefix) + prefix_step
        bucket = keyed.filter(F.col("_sl_h").startswith(prefix)) if prefix else keyed
        hist = (bucket.groupBy(F.substring("_sl_h", 1, width).alias("p"))
                .agg(F.count(F.lit(1)).alias("n")).orderBy("p").collect())
        total = sum(r["n"] for r in hist)
        if need >= total:
            # everything at or below this bucket qualifies
            upper = prefix + "g"  # 'g' sorts after every hex digit
            return keyed.filter(F.col("_sl_h") < F.lit(upper)).drop("_sl_h")
        before = 0
        for r in hist:
            if before + r["n"] >= need:
                boundary, size = r["p"], r["n"]
                break
            before += r["n"]
        need -= before
        if size <= final_bucket_rows or width >= 32:
            rows = (keyed.filter(F.col("_sl_h").startswith(boundary))
                    .select("_sl_h", F.col(key).alias("_sl_k")).collect())
            rows.sort(key=lambda r: (r[0], r[1]))
            th, tk = rows[need - 1][0], rows[need - 1][1]
            cond = (F.col("_sl_h") < F.lit(th)) | (
                (F.col("_sl_h") == F.lit(th)) & (F.col(key) <= F.lit(tk)))
            return keyed.filter(cond).drop("_sl_h")
        prefix = boundary


# distinct values read back from the boundary bucket of `kth_largest`
KTH_BUCKET_VALUES = 5_000_000


def kth_largest(df: DataFrame, col: str, k: int) -> int | None:
    """Exact k-th largest value of a positive integer column, without sorting
    the column into one task: a histogram of log2 buckets (about 64 rows)
    finds the bucket holding the k-th value, then exact counts of the values
    inside that bucket fix it. Returns None if there are fewer than k rows."""
    if k <= 0:
        return None
    v = F.col(col)
    bucket = F.floor(F.log2(F.greatest(v, F.lit(1)).cast("double"))).cast("int")
    hist = df.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()
    above = 0
    target = None
    for r in sorted(hist, key=lambda r: -r["b"]):
        if above + r["n"] >= k:
            target = r["b"]
            break
        above += r["n"]
    if target is None:
        return None
    inside = (df.filter(bucket == target).groupBy(v.alias("x"))
              .agg(F.count(F.lit(1)).alias("n")))
    # values in one bucket [2^b, 2^(b+1)) that are held by at least one row;
    # their number is bounded by the rows in the bucket and by 2^b
    rows = inside.limit(KTH_BUCKET_VALUES + 1).collect()
    if len(rows) > KTH_BUCKET_VALUES:
        raise ValueError("too many distinct values in one histogram bucket")
    seen = above
    for r in sorted(rows, key=lambda r: -r["x"]):
        seen += r["n"]
        if seen >= k:
            return int(r["x"])
    return None
