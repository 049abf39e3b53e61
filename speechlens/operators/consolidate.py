"""Consolidation of raw speeches, exact sampling, input choice and lookup.

`consolidate` gives one row per (party, member, sitting date): the seven
attributes take their first non-null value in row order, and the speeches
are joined with ``' | '`` in row order. Rows with a null key are dropped.
Ids are dense, in key order, assigned without an unpartitioned window.

The attribute aggregates (`min_by ... FILTER`) are partial aggregates, so a
huge group costs one buffer row per map partition. The joined speech is by
definition one value per group, so its size follows the group's text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.ids import md5_key, smallest_by_hash, with_sequential_id
from ..functions.sizing import maybe_broadcast
from ..schema import ATTRIBUTES, GROUP_KEYS, SPEECH, SPEECH_COLUMNS
from ..session import durable

SEPARATOR = " | "
SAMPLE_FRACTION = 0.1
ROWS_LIMIT = 1000  # above this the reference's analysis pages take a sample


def consolidate(raw: DataFrame, order_cols: list[str] | None = None) -> DataFrame:
    """Raw speeches -> consolidated speeches with doc_id.

    `order_cols` give the row order (default: `source_file`, `seq` when the
    rows come from CSV files without their own order column, else `seq`)."""
    if order_cols is None:
        order_cols = ["source_file", "seq"] if "source_file" in raw.columns else ["seq"]
    if len(order_cols) == 1:
        order_key = f"`{order_cols[0]}`"
    else:
        order_key = "struct(" + ", ".join(f"`{c}`" for c in order_cols) + ")"
    firsts = [
        F.expr(f"min_by(`{c}`, {order_key}) FILTER (WHERE `{c}` IS NOT NULL)").alias(c)
        for c in ATTRIBUTES
    ]
    sep = SEPARATOR.replace("'", "\\'")
    joined = F.expr(f"listagg(`{SPEECH}`, '{sep}') WITHIN GROUP (ORDER BY {order_key})")
    keyed = raw.dropna(subset=GROUP_KEYS)
    grouped = keyed.groupBy(*GROUP_KEYS).agg(*firsts, joined.alias(SPEECH))
    # only the keys are sorted and numbered; the texts meet their ids where the
    # grouping has put them
    ids = with_sequential_id(keyed.select(*GROUP_KEYS).distinct(), GROUP_KEYS, "doc_id")
    return grouped.join(ids, GROUP_KEYS).select("doc_id", *SPEECH_COLUMNS)


def consolidate_parts(raw: DataFrame, order_cols: list[str] | None = None
                      ) -> tuple[DataFrame, DataFrame]:
    """Consolidation that never builds a group's joined text.

    Returns (groups, parts): groups = (doc_id, keys, first non-null
    attributes); parts = (doc_id, order columns..., speech), one row per raw
    speech. A group holding a third of all speeches stays spread over many
    partitions, and TF-IDF over the parts equals TF-IDF over the joined text
    (the separator is punctuation, i.e. a token boundary)."""
    if order_cols is None:
        order_cols = ["source_file", "seq"] if "source_file" in raw.columns else ["seq"]
    order_key = (f"`{order_cols[0]}`" if len(order_cols) == 1
                 else "struct(" + ", ".join(f"`{c}`" for c in order_cols) + ")")
    firsts = [
        F.expr(f"min_by(`{c}`, {order_key}) FILTER (WHERE `{c}` IS NOT NULL)").alias(c)
        for c in ATTRIBUTES
    ]
    keyed = raw.dropna(subset=GROUP_KEYS)
    groups = with_sequential_id(keyed.groupBy(*GROUP_KEYS).agg(*firsts), GROUP_KEYS, "doc_id")
    groups = groups.select("doc_id", *GROUP_KEYS, *ATTRIBUTES)
    # a hot key is one row on the groups side; AQE splits the skewed side
    parts = keyed.join(groups.select("doc_id", *GROUP_KEYS), GROUP_KEYS).select(
        "doc_id", *order_cols, SPEECH)
    return groups, parts


def sample_exact(df: DataFrame, fraction: float = SAMPLE_FRACTION, id_col: str = "doc_id") -> DataFrame:
    """Exactly round(fraction * n) rows, reproducible: the rows whose md5(id)
    is smallest. (The reference samples without a seed.)"""
    n = df.count()
    k = int(round(fraction * n))
    return smallest_by_hash(df, id_col, k)


#: standard errors by which the first cut of `sample_one_pass` lies above the fraction
CUT_ERRORS = 6.0


def sample_one_pass(df: DataFrame, fraction: float = SAMPLE_FRACTION, id_col: str = "doc_id",
                    expected_rows: int = 1_000_000) -> DataFrame:
    """Exactly round(fraction * n) rows, those of `sample_exact`, from one scan.

    The scan keeps the rows whose md5 lies below the fraction and a margin of
    CUT_ERRORS standard errors at `expected_rows` (more rows need less), and
    counts all rows as it goes; only what it kept is then ranked. Rows that
    repeat an id are ranked one after another, so their number is exact too. If
    the cut was too low (fewer rows than expected, or a hot id), it is raised and
    the scan repeated."""
    if not 0 <= fraction <= 1:
        raise ValueError("fraction lies between 0 and 1")
    spread = CUT_ERRORS * (max(fraction * (1 - fraction), 1e-12) / max(expected_rows, 1)) ** 0.5
    keyed = df.withColumn("_s_hash", md5_key(F.col(id_col)))
    while True:
        cut = min(1.0, fraction + spread)
        seen = Observation()
        counted = keyed.observe(seen, F.count(F.lit(1)).alias("n"))
        first = f"{min(int(cut * 16 ** 12), 16 ** 12 - 1):012x}"
        kept = durable(counted if cut >= 1 else counted.where(F.substring("_s_hash", 1, 12) <= F.lit(first)))
        k = int(round(fraction * seen.get["n"]))
        if cut >= 1 or kept.count() >= k:
            ranked = with_sequential_id(kept, [F.asc_nulls_last("_s_hash"), F.asc_nulls_last(id_col)], "_s_rank")
            return ranked.where(F.col("_s_rank") < k).select(*df.columns)
        spread *= 4


def sample_approx(df: DataFrame, fraction: float = SAMPLE_FRACTION, seed: int = 42) -> DataFrame:
    """Bernoulli sample: about fraction * n rows, one pass, no count."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def choose_input(df: DataFrame, max_rows: int | None = None, fraction: float = SAMPLE_FRACTION,
                 id_col: str = "doc_id") -> DataFrame:
    """The whole input; only with an explicit `max_rows`, and more rows than
    that, the exact sample (ROWS_LIMIT gives the reference's switch)."""
    if max_rows is None:
        return df
    return df if df.count() <= max_rows else sample_exact(df, fraction, id_col)


def lookup(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """All fields of the documents whose id is in `ids` (left semi join).
    Unknown ids give no row."""
    side, _ = maybe_broadcast(ids.select(F.col(id_col).alias("doc_id")).distinct())
    return docs.join(side, "doc_id", "left_semi")


def lookup_one(docs: DataFrame, doc_id: int) -> DataFrame:
    """One document by id (pushed to the scan as `doc_id = x`)."""
    return docs.filter(F.col("doc_id") == F.lit(int(doc_id)))
