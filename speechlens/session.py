"""Spark session defaults and the shared artifact folder.

Artifacts (fitted models, weight tables, sorted postings) live under the
folder the cluster names in ``spark.checkpoint.dir``. We only pick our own
folder when the session has none, which is the case in local tests.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "speechlens") -> SparkSession:
    """Build (or reuse) a session with the settings this library assumes.

    On a cluster, pass ``master=None`` and let the launcher decide; locally,
    ``local[N]`` with ``shuffle_partitions`` close to N.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # ranking windows with `row_number() <= k` get a partial top-k before
        # their shuffle (WindowGroupLimit); keep it on explicitly
        "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    # unset: only happens in local tests and benches
    local = tempfile.mkdtemp(prefix="speechlens-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def artifact_root(spark: SparkSession) -> str:
    """Folder for artifacts that outlive the session: the one named by
    ``spark.speechlens.artifact.dir``, else a folder in ``spark.checkpoint.dir``
    (without the session's own part), else one beside the session's checkpoints."""
    for name, suffix in (("spark.speechlens.artifact.dir", ""), ("spark.checkpoint.dir", "/speechlens-artifacts")):
        value = spark.conf.get(name, None) or spark.sparkContext.getConf().get(name, None)
        if value:
            return value.rstrip("/") + suffix
    return ensure_checkpoint_dir(spark).rstrip("/") + "/speechlens-artifacts"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path beside the session's checkpoint files."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/speechlens-scratch/{name}-{uuid.uuid4().hex[:12]}"


def files_identity(spark: SparkSession, path: str) -> str:
    """Digest of a table's files (path, size, modification time) by Spark's own
    listing, so it works for any store and notices rewritten parts."""
    from pyspark.sql import functions as F

    listed = spark.read.format("binaryFile").load(path).select(
        F.concat_ws("|", "path", F.col("length").cast("string"), F.unix_millis("modificationTime").cast("string")).alias("f"))
    row = listed.agg(F.count(F.lit(1)), F.sum(F.xxhash64("f").cast("decimal(38,0)"))).first()
    return f"{path}:{row[0]}:{row[1]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through Hadoop's FileSystem (works for any scheme)."""
    if not re.match(r"/|[A-Za-z][A-Za-z0-9+.-]*:", path):
        return os.path.exists(path)
    jvm = spark.sparkContext._jvm
    hconf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(hconf).exists(p)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a `scratch_path` that is no longer read."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Within, the shuffle files of a query are dropped when it is done."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def durable(df):
    """`df.checkpoint()` into the session's checkpoint folder: cuts lineage
    with files that outlive a lost executor (never a local checkpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
