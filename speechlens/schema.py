"""Explicit schemas of every table the library reads or writes."""

from pyspark.sql import types as T

# Column names of the raw speech files
PARTY = "political_party"
MEMBER = "member_name"
DATE = "sitting_date"
SPEECH = "speech"

# attributes that take the first non-null value of their group, in row order
ATTRIBUTES = [
    "parliamentary_period",
    "parliamentary_session",
    "parliamentary_sitting",
    "government",
    "member_region",
    "roles",
    "member_gender",
]

GROUP_KEYS = [PARTY, MEMBER, DATE]

# column order of a consolidated speech record
SPEECH_COLUMNS = GROUP_KEYS + ATTRIBUTES + [SPEECH]

RAW_SPEECH = T.StructType(
    [T.StructField(c, T.StringType(), True) for c in SPEECH_COLUMNS]
    + [T.StructField("seq", T.LongType(), True)]
)

QUERIES = T.StructType([
    T.StructField("query_id", T.LongType(), False),
    T.StructField("text", T.StringType(), True),
])

HITS = T.StructType([
    T.StructField("query_id", T.LongType(), False),
    T.StructField("rank", T.IntegerType(), False),
    T.StructField("doc_id", T.LongType(), False),
    T.StructField("speech_start", T.StringType(), True),
    T.StructField("name", T.StringType(), True),
    T.StructField(PARTY, T.StringType(), True),
    T.StructField("date", T.StringType(), True),
    T.StructField("score", T.DoubleType(), False),
])

# scores and weights shown to users are rounded to this many decimals, and
# ranks are decided on the rounded value (ties then break on ids / words)
SCORE_DIGITS = 6
