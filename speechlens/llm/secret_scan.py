"""Secret scan: fixed patterns plus a battery of randomness tests, native Spark only.

Base spans come from three fixed patterns. The method then tests every run of
20 or more characters of `[A-Za-z0-9+/_-]` that touches no base span. From the
characters of a run its encoding is inferred (hex, base32, letters and digits,
base64); runs of digits alone and of letters of one case alone have no
encoding and are not tested. The battery per run of n characters over an alphabet of k:

* chi-squared uniformity: X2 = k/n * sum(c^2) - n. Ordinary text has a collision
  probability `kappa` well above 1/k, so under "ordinary" X2 is a non-central
  chi-squared; its lower tail gives p_uniform.
* runs: changes between digits, capitals and small letters; ordinary text
  changes class rarely (`SWITCH`), the upper tail gives p_runs.
* serial correlation of neighbouring character codes: a random string has none;
  beyond `SERIAL_Z` standard errors the run is not random.

The two p-values are combined by Fisher's method; Benjamini-Hochberg at rate
`fdr` runs within strata of length over a histogram of -log10 p, so the short
(weakly tested, many) runs do not spend the error budget of the long ones.

Positions without user code: the pieces between matches and the matches
alternate, so running sums of their lengths are the spans. Matches are rows, and sums
and overlaps are windows over a text's rows, so a text's work is in proportion to it.

Defined cases: null texts count as empty (no spans, the digest of the empty
text); texts of any length are scanned whole; spans that start alike are listed by
kind; repeated rows are scanned each; further columns are ignored, whatever their names;
an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import durable, written

# The three base patterns, their kinds in order and least lengths.
ASSIGN = (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")
ASSIGN_LEAST, ACCESS_LEAST = 6, 20

RUN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}"
SWITCH = 0.1
SERIAL_Z = 3.3
# inferred encoding: pattern, alphabet in code order, collision probability of ordinary text
ENCODINGS = (
    ("hex", r"^([0-9a-f]+|[0-9A-F]+)$", "0123456789abcdef", 0.125),
    ("base32", r"^[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 0.065),
    ("alnum", r"^[A-Za-z0-9]+$", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", 0.065),
    ("base64", r"^[A-Za-z0-9+/_-]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", 0.065),
)
# upper ends of the length strata
STRATA = (24, 32, 48, 96)
SCALE, TOP = 10, 300  # histogram of -log10 p: ten bins a decade, 30 decades


def _matches(text: Column, pattern: str, kind: str, group: int | None = None) -> Column:
    """array<struct<kind_no, place, gap, token, value>> of the matches of `pattern` in
    order, each with the length of the text between it and the one before; a last
    element, without token, is what follows them."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = found if group is None else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    pieces = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), found.alias("token"), value.alias("value"))
    rows = F.transform(pieces, lambda x, i: F.struct(
        F.lit(KINDS.index(kind)).alias("kind_no"), i.alias("place"), F.length(x["gap"]).cast("long").alias("gap"),
        x["token"].alias("token"), x["value"].alias("value")))
    none = F.array().cast("array<struct<kind_no:int,place:int,gap:bigint,token:string,value:string>>")
    return F.when(text.rlike(pattern), rows).otherwise(none)


def _placed(matches: DataFrame) -> DataFrame:
    """(row, start, kind_no, end, token, value) of all matches: running sums of the
    lengths of gaps and matches are the places."""
    n = F.length("token").cast("long")
    run = Window.partitionBy("row", "kind_no").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    return matches.where("token IS NOT NULL").withColumn("end", F.sum(F.col("gap") + n).over(run)).select(
        "row", (F.col("end") - n).alias("start"), "kind_no", "end", "token", "value")


def _apart(spans: DataFrame) -> DataFrame:
    """The random runs among the spans that touch no base span: none that starts
    before or with the run reaches into it, and the next one starts after its end."""
    base = F.col("kind_no") != KINDS.index("random")
    line = Window.partitionBy("row").orderBy("start")
    reach = F.max(F.when(base, F.col("end"))).over(line.rangeBetween(Window.unboundedPreceding, 0))
    following = F.min(F.when(base, F.col("start"))).over(line.rangeBetween(1, Window.unboundedFollowing))
    return spans.withColumn("_reach", reach).withColumn("_next", following).where(~base).where(
        "coalesce(_reach <= start, true) AND coalesce(_next >= end, true)").drop("_reach", "_next")


def _joined(spans: Column) -> Column:
    name = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(
        ":", F.get(name, x["kind_no"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def _normal_cdf(z: Column) -> Column:
    # logistic approximation of the normal distribution function, monotone and good to 1e-4
    z = F.greatest(F.lit(-8.0), F.least(F.lit(8.0), z))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-(z * 1.5976 + z * z * z * 0.07056)))


def randomness(tokens: DataFrame, token_col: str = "token") -> DataFrame:
    """Add encoding, n, p_uniform, p_runs, serial_z and p (Fisher's combination;
    1 for a run without encoding or beyond the serial limit) to a table of tokens."""
    t = F.col(token_col)
    testable = t.rlike(r"[0-9]") & t.rlike(r"[A-Za-z]") | (t.rlike(r"[A-Z]") & t.rlike(r"[a-z]") & t.rlike(r".[A-Z].*[A-Z]"))
    enc, alphabet, kappa = F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit(None).cast("double")
    for name, pattern, letters, collision in reversed(ENCODINGS):
        hit = testable & t.rlike(pattern)
        enc = F.when(hit, F.lit(name)).otherwise(enc)
        alphabet = F.when(hit, F.lit(letters)).otherwise(alphabet)
        kappa = F.when(hit, F.lit(collision)).otherwise(kappa)
    df = tokens.withColumns({"encoding": enc, "_r_alphabet": alphabet, "_r_kappa": kappa})
    plain = F.when(F.col("encoding") == "hex", F.lower(t)).otherwise(F.translate(t, "-_", "+/"))
    df = df.withColumns({
        "_r_chars": F.filter(F.split(plain, ""), lambda x: x != ""), "n": F.length(t).cast("double"),
        "_r_k": F.length("_r_alphabet").cast("double")})
    chars, n, k = F.col("_r_chars"), F.col("n"), F.col("_r_k")
    squares = F.aggregate(F.array_distinct(chars), F.lit(0.0), lambda acc, c: acc + F.pow(
        F.size(F.filter(chars, lambda x: x == c)).cast("double"), 2.0))
    df = df.withColumns({
        "_r_x2": k / n * squares - n,
        "_r_codes": F.transform(chars, lambda c: F.instr(F.col("_r_alphabet"), c).cast("double")),
        # separators between words are no change of class
        "_r_switches": F.regexp_count(F.regexp_replace(t, "[+/_-]", ""), F.lit(
            r"(?<=[a-z])[^a-z]|(?<=[A-Z])[^A-Z]|(?<=[0-9])[^0-9]")).cast("double")})
    excess = (n - 1) * (k * F.col("_r_kappa") - 1)
    mean = F.aggregate("_r_codes", F.lit(0.0), lambda acc, x: acc + x) / n
    df = df.withColumns({
        "p_uniform": _normal_cdf((F.col("_r_x2") - (k - 1) - excess) / F.sqrt(2 * (k - 1) + 4 * excess)),
        "p_runs": _normal_cdf(-(F.col("_r_switches") - (n - 1) * SWITCH) / F.sqrt((n - 1) * SWITCH * (1 - SWITCH))),
        "_r_dev": F.transform("_r_codes", lambda x: x - mean)})
    power = F.aggregate("_r_dev", F.lit(0.0), lambda acc, x: acc + x * x)
    lagged = F.aggregate(F.zip_with(F.slice("_r_dev", F.lit(1), (n - 1).cast("int")),
                                    F.slice("_r_dev", F.lit(2), (n - 1).cast("int")), lambda a, b: a * b),
                         F.lit(0.0), lambda acc, x: acc + x)
    df = df.withColumn("serial_z", F.when(power > 0, (lagged / power + 1 / n) * F.sqrt(n)).otherwise(F.lit(99.0)))
    x = -(F.log("p_uniform") + F.log("p_runs"))
    fisher = F.exp(-x) * (1 + x)
    df = df.withColumn("p", F.when(F.col("encoding").isNotNull() & (F.abs("serial_z") <= SERIAL_Z), fisher)
                       .otherwise(F.lit(1.0)))
    return df.drop(*(c for c in df.columns if c.startswith("_r_")))


def discoveries(tested: DataFrame, fdr: float) -> DataFrame:
    """The rows of `tested` (n, p) that Benjamini-Hochberg accepts within their
    stratum of length. p-values are binned upwards (ten bins a decade), so the
    cut is never looser than the exact one; the histogram has at most
    `len(STRATA) + 1` times `TOP + 1` rows, whatever the input."""
    stratum = F.lit(len(STRATA))
    for i in reversed(range(len(STRATA))):
        stratum = F.when(F.col("n") <= STRATA[i], F.lit(i)).otherwise(stratum)
    binned = tested.withColumns({
        "stratum": stratum,
        "_b": F.least(F.lit(TOP), F.floor(-F.log10(F.greatest("p", F.lit(1e-300))) * SCALE)).cast("int")})
    hist = binned.groupBy("stratum", "_b").agg(F.count(F.lit(1)).alias("c")).groupBy("stratum").agg(
        F.sum("c").alias("m"), F.collect_list(F.struct("_b", "c")).alias("h"))
    # the lowest bin b (largest p) with m * 10^(-b/SCALE) <= fdr * (number of p-values in bins >= b)
    above = lambda b: F.aggregate(F.filter("h", lambda y: y["_b"] >= b), F.lit(0).cast("long"),
                                  lambda acc, y: acc + y["c"])
    cut = hist.select("stratum", F.array_min(F.filter(F.transform("h", lambda y: y["_b"]), lambda b: (
        F.col("m") * F.pow(F.lit(10.0), -b / float(SCALE)) <= F.lit(fdr) * above(b)) & (b > 0))).alias("_cut"))
    return binned.join(F.broadcast(cut), "stratum").where("_b >= _cut").drop("_b", "_cut", "stratum")


def scan_secrets(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", fdr: float = 0.01) -> DataFrame:
    """One row per row of `docs`: its id, n_assign, n_access, n_hex, n_random,
    base_sha256, spans (text) and found (array of start, end, kind, token)."""
    text = F.col("text")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    every = F.concat(_matches(text, ASSIGN, "assign", 2), _matches(text, ACCESS, "access"), _matches(text, HEX, "hex"),
                     _matches(text, RUN, "random"))
    # only matches are written, never texts; a text without any has one line
    cut = written(rows.select("row", "id", F.explode_outer(every).alias("m")).select("row", "id", "m.*"), "secret-spans")
    long_enough = (F.col("kind_no") != 0) | (F.length("value") >= ASSIGN_LEAST)
    long_enough = long_enough & ((F.col("kind_no") != 1) | (F.length("token") >= ACCESS_LEAST))
    spans = durable(_placed(cut).where(long_enough))
    found = spans.where(F.col("kind_no") != KINDS.index("random")).unionByName(
        discoveries(randomness(_apart(spans)), fdr).select(*spans.columns))
    per = found.groupBy("row").agg(F.array_sort(F.collect_list(
        F.struct("start", "kind_no", "end", "token", "value"))).alias("found"))
    out = cut.select("row", "id").distinct().join(per, "row", "left").withColumn(
        "found", F.coalesce("found", F.array().cast("array<struct<start:bigint,kind_no:int,end:bigint,token:string,value:string>>")))
    base = F.filter("found", lambda x: x["kind_no"] != KINDS.index("random"))
    count = lambda k: F.size(F.filter("found", lambda x: x["kind_no"] == k)).cast("long")
    name = F.array(*(F.lit(k) for k in KINDS))
    return out.select(
        F.col("id").alias(id_col), count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        count(3).alias("n_random"), F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans"),
        F.transform("found", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.get(
            name, x["kind_no"]).alias("kind"), x["token"].alias("token"))).alias("found"))
