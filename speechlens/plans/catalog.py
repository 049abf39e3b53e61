"""Registered queries: each is ``(spark, sf_dir) -> DataFrame`` over whole tables.

Every query reads the driver's test tables (or what Spark derives from
them) and runs the library's operators on all of it; parameters are the
reference's defaults unless the name says otherwise.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lexicon as LX
from ..functions import text as TX
from ..functions.sizing import TASK_BYTES, local_frame, partitions_for, parts_for_task
from ..operators import bursts as BU
from ..operators import clusters as CL
from ..operators import conflation as CF
from ..operators import consolidate as C
from ..operators import fuzzy as FZ
from ..operators import keywords as K
from ..operators import postings as PO
from ..operators import prefix_pairs as PP
from ..operators import refresh as R
from ..operators import search as S
from ..operators import similarity as M
from ..operators import tfidf as T
from ..operators import topics as TP
from ..operators import wide_topics as WT
from ..schema import SCORE_DIGITS
from ..session import scratch_path
from ..sources import csv_split as CSV
from ..sources import docstore as DS
from ..sources import speeches as SP
from ..streaming import search_stream as ST
from .workspace import Workspace

QUERIES: dict = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _ws(spark: SparkSession, sf_dir: str) -> Workspace:
    return Workspace(spark, sf_dir)


def _benchmark_queries(ws: Workspace) -> DataFrame:
    return ws.table("benchmark").select(F.col("item_id").alias("query_id"), "text")


# --------------------------------------------------------------------- TF-IDF

@register
def term_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, term, tf) for every term of every document (before the vocabulary cut)."""
    ws = _ws(spark, sf_dir)
    return T.term_frequencies(ws.docs()).select("doc_id", "term", F.col("tf").cast("long"))


@register
def document_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(term, df, cf) over all terms."""
    ws = _ws(spark, sf_dir)
    st = T.term_statistics(T.term_frequencies(ws.docs()))
    return st.select("term", F.col("df").cast("long"), F.col("cf").cast("long"))


@register
def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fitted vocabulary: max_df 0.9, 6000 terms, alphabetical term ids."""
    m = _ws(spark, sf_dir).model()
    return m.vocabulary.select("term", "term_id", "df", "cf")


@register
def build_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vocabulary of a model that is there already: a second fit to its path
    reads it back and does not look at the documents, of which it is given none."""
    docs, path = _ws(spark, sf_dir).docs(), scratch_path(spark, "model")
    T.fit_tfidf(docs, path=path)
    return T.fit_tfidf(docs.limit(0), path=path).vocabulary.select("term", "term_id", "df", "cf")


@register
def idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _ws(spark, sf_dir).model()
    return m.vocabulary.select("term", F.round("idf", SCORE_DIGITS).alias("idf"))


@register
def tfidf_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The L2-normalised document-term matrix in long form (read back from parquet)."""
    m = _ws(spark, sf_dir).model()
    return T.rounded_weights(m.weights).select("doc_id", "term", "term_id", "tf", "weight")


@register
def vocabulary_small(spark: SparkSession, sf_dir: str) -> DataFrame:
    """max_df 0.3 and 500 features: exercises the max_df cut and the cf tie at the cut."""
    m = _ws(spark, sf_dir).model(max_df=0.3, max_features=500)
    return m.vocabulary.select("term", "term_id", "df", "cf")


@register
def inverted_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _ws(spark, sf_dir).model()
    return T.inverted_index(m)


@register
def transform_new_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages weighed by the fitted model (unknown terms vanish)."""
    ws = _ws(spark, sf_dir)
    q = ws.model().transform(_benchmark_queries(ws))
    return q.select("query_id", "term", "term_id", "tf",
                    F.round("weight", SCORE_DIGITS).alias("weight"))


# --------------------------------------------------------------------- search

@register
def search_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark passage as a query: top-10 hits each, with snippets."""
    ws = _ws(spark, sf_dir)
    return S.search(ws.model(), ws.display(), _benchmark_queries(ws))


@register
def search_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three best hits of every benchmark passage, of a score of 0.2 or more."""
    ws = _ws(spark, sf_dir)
    return S.search(ws.model(), ws.display(), _benchmark_queries(ws), k=3, floor=0.2)


@register
def search_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch search through block-max postings: equal hits, fewer blocks."""
    ws = _ws(spark, sf_dir)
    return PO.search_pruned(ws.model(), ws.block_index(), ws.display(), _benchmark_queries(ws))


@register
def search_pruned_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five words of every benchmark passage, through block-max postings."""
    ws = _ws(spark, sf_dir)
    q = _benchmark_queries(ws).select("query_id", F.array_join(F.slice(F.split("text", " "), 1, 5), " ").alias("text"))
    return PO.search_pruned(ws.model(), ws.block_index(), ws.display(), q)


@register
def search_no_hit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every benchmark passage without its words (punctuation
    and blanks) as a query: (query_id, n_hits), and no query has a hit."""
    ws = _ws(spark, sf_dir)
    q = _benchmark_queries(ws)
    bare = q.select("query_id", F.regexp_replace("text", r"[\p{L}\p{N}]+", " ").alias("text"))
    hits = S.top_hits(S.score(ws.model(), bare)).groupBy("query_id").agg(F.count(F.lit(1)).alias("n"))
    return q.select("query_id").join(hits, "query_id", "left").select(
        "query_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_hits"))


@register
def fetch_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All fields of every document hit by the benchmark batch search."""
    ws = _ws(spark, sf_dir)
    hits = S.top_hits(S.score(ws.model(), _benchmark_queries(ws)))
    return S.fetch_hits(hits, ws.docs())


@register
def fetch_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same documents from a store bucketed by id: only their buckets are opened."""
    ws = _ws(spark, sf_dir)
    return DS.fetch(ws.store(), S.top_hits(S.score(ws.model(), _benchmark_queries(ws))))


@register
def suggest_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vocabulary terms containing 'er', most frequent in documents first (20)."""
    return S.suggest_terms(_ws(spark, sf_dir).model(), "ER", limit=20)


@register
def suggest_fuzzy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every word of the benchmark passages, typed without its second letter,
    the five best of all terms of the documents within one edit."""
    ws = _ws(spark, sf_dir)
    index = FZ.build_index(document_frequency(spark, sf_dir))
    word = F.concat(F.substring("token", 1, 1), F.expr("substring(token, 3)"))
    typed = ws.table("benchmark").select(F.explode(TX.tokens(F.col("text"))).alias("token")).select(word.alias("word"))
    return FZ.suggest_fuzzy(index, typed, 1, 5)


# ------------------------------------------------------- scans and sinks



def _raw(ws: Workspace) -> DataFrame:
    return SP.documents_as_speeches(ws.table("documents"))


#: input from which `scan_csv_split` writes one more file
SPLIT_FILE_BYTES = 128 * 1024 * 1024


def _files(ws: Workspace, least: int, target_bytes: int = TASK_BYTES) -> int:
    """Files that the raw speeches take, each small enough for one task."""
    return parts_for_task(ws.table("documents"), least, target_bytes)


def _csv_copy(spark: SparkSession, ws: Workspace) -> str:
    path = scratch_path(spark, "speeches-csv")
    SP.write_speeches_csv(_raw(ws), path, num_files=_files(ws, 4))
    return path


@register
def scan_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw speeches written as header CSV (texts with newlines and quotes),
    then scanned back with the fixed schema: every row and value survives."""
    ws = _ws(spark, sf_dir)
    return SP.read_speeches_csv(spark, _csv_copy(spark, ws))


@register
def scan_csv_reordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw speeches in two sets of CSV files with different column orders, one
    without `roles`, scanned together by header name."""
    ws = _ws(spark, sf_dir)
    raw, path = _raw(ws), scratch_path(spark, "speeches-reordered")
    n = -(-_files(ws, 4) // 2)
    SP.write_speeches_csv(raw.where("seq % 2 = 0"), f"{path}/part=a", num_files=n)
    SP.write_speeches_csv(raw.where("seq % 2 = 1").select(*reversed([c for c in raw.columns if c != "roles"])),
                          f"{path}/part=b", num_files=n)
    return SP.read_speeches_csv(spark, f"{path}/*")


@register
def scan_csv_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw speeches written as one CSV file (a large table as several, since one task
    writes a file) and read back in chunks of 256 KB, a task each, whose borders cut
    through quoted texts."""
    ws, path = _ws(spark, sf_dir), scratch_path(spark, "speeches-one-csv")
    SP.write_speeches_csv(_raw(ws), path, num_files=_files(ws, 1, SPLIT_FILE_BYTES))
    return CSV.read_speeches_csv_split(spark, path, chunk_bytes=256 * 1024)


@register
def scan_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column-pruned CSV scan: only member, speech and order are parsed into
    the output (CSV is row-oriented, so the file bytes are still scanned)."""
    ws = _ws(spark, sf_dir)
    return SP.read_speeches_csv(spark, _csv_copy(spark, ws), ["member_name", "speech", "seq"])


@register
def consolidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (party, member, date); first non-null attributes; speeches
    joined with ' | ' in row order; ids in key order."""
    return C.consolidate(_raw(_ws(spark, sf_dir)))


@register
def union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two raw sources stacked by name (documents and conversation turns),
    then consolidated (a conversation's turns joined in turn order)."""
    ws = _ws(spark, sf_dir)
    raw = SP.union_sources(_raw(ws), SP.conversations_as_speeches(ws.table("conversations")))
    return C.consolidate(raw)


@register
def sample_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exactly round(0.1 n) documents: those of smallest md5(doc_id)."""
    return C.sample_exact(_ws(spark, sf_dir).docs(), 0.1)


@register
def sample_one_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same documents as `sample_exact`, from one scan."""
    return C.sample_one_pass(_ws(spark, sf_dir).docs(), 0.1, expected_rows=1_000)


@register
def sample_bernoulli(spark: SparkSession, sf_dir: str) -> DataFrame:
    """About 10 % of the documents, Bernoulli sampling with seed 42 (one
    pass, no count); the rows are Spark's own sampler's, so no SQL twin."""
    return C.sample_approx(_ws(spark, sf_dir).docs(), 0.1, seed=42)


@register
def choose_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents if there are at most 1000, else the exact 10 % sample."""
    return C.choose_input(_ws(spark, sf_dir).docs(), 1000, 0.1)


@register
def lookup_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All eleven fields of every document listed in `labels`."""
    ws = _ws(spark, sf_dir)
    return C.lookup(ws.docs(), ws.table("labels"))


# --------------------------------------------------------- text functions

@register
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = _ws(spark, sf_dir)
    return ws.docs().select("doc_id", TX.clean_text(F.col("speech")).alias("clean"))


@register
def tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = _ws(spark, sf_dir)
    return ws.docs().select("doc_id", F.posexplode(TX.tokens(F.col("speech"))).alias("pos", "token"))


@register
def remove_stopwords(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tokenize(spark, sf_dir)
    return t.filter(LX.not_stop_word("token", LX.default_stop_words()))


@register
def conflate_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct (token, term) pairs where the suffix rules change the token."""
    t = remove_stopwords(spark, sf_dir).select("token").distinct()
    st = t.select("token", LX.stem("token", LX.as_rule_list(None)).alias("term"))
    return st.filter(F.col("token") != F.col("term"))


@register
def conflate_by_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(lang, token, term, n): every word that is no stop word of its document's
    language, under that language's suffix rules, with its occurrences."""
    docs = _ws(spark, sf_dir).table("documents")
    t = docs.select("lang", F.explode(TX.tokens(F.col("text"))).alias("token"))
    kept = t.filter(LX.not_stop_word_of("token", "lang", {k: LX.spark_stop_words(k) for k in LX.DEFAULT_LANGUAGES}))
    counted = kept.groupBy("lang", "token").agg(F.count(F.lit(1)).alias("n"))
    return counted.select("lang", "token", LX.stem_of("token", "lang", LX.RULES_BY_LANGUAGE).alias("term"), "n")


@register
def conflate_learned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(lang, word, term, df): the word forms of every language that endings and
    documents show to be one term, learned without any list of suffixes."""
    docs = _ws(spark, sf_dir).table("documents").select("lang", "doc_id", "text")
    # dealt by doc_id as text: a document's words are then put together in place
    docs = docs.repartition(partitions_for(docs), "doc_id")
    return CF.learn_terms_of(docs.select("lang", "doc_id", F.array_distinct(TX.tokens(F.col("text"))).alias("words")))


@register
def snippet(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = _ws(spark, sf_dir)
    return ws.docs().select("doc_id", TX.snippet(F.col("speech")).alias("speech_start"))


# --------------------------------------------------------------- keywords



def _per_doc(ws: Workspace) -> DataFrame:
    # member and party ride along from the one join that adds the date
    return K.keywords_per_doc(ws.model().weights, ws.docs(), carry=("member_name", "political_party"))


@register
def keywords_per_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top-10 words of every document by weight (ties: word descending)."""
    return _per_doc(_ws(spark, sf_dir)).select("doc_id", "rank", "word", "tfidf", "date")


@register
def keywords_per_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = _ws(spark, sf_dir)
    return K.keywords_per_member(_per_doc(ws), ws.docs())


@register
def keywords_per_party(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = _ws(spark, sf_dir)
    return K.keywords_per_party(_per_doc(ws), ws.docs())


@register
def keywords_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three keyword lists written as nested JSON lines and read back, long form."""
    ws = _ws(spark, sf_dir)
    docs = ws.docs()
    per_doc = _per_doc(ws)
    path = scratch_path(spark, "keywords-json")
    K.write_keywords_json(per_doc.select("doc_id", "rank", "word", "tfidf", "date"),
                          K.keywords_per_member(per_doc, docs),
                          K.keywords_per_party(per_doc, docs), path)
    return K.read_keywords_json(spark, path)


@register
def keyword_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = _ws(spark, sf_dir)
    docs = ws.docs()
    per_doc = _per_doc(ws)
    return K.keyword_timeline(per_doc, K.keywords_per_member(per_doc, docs),
                              K.keywords_per_party(per_doc, docs))


@register
def keyword_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per party and year: speeches with the word among their top 10, best weight."""
    ws = _ws(spark, sf_dir)
    return K.keyword_trend(_per_doc(ws), ws.docs())


@register
def keyword_bursts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When a party's speeches turn to a word: its bursts among their top keywords,
    with a low price (0.2) for going up."""
    ws = _ws(spark, sf_dir)
    return BU.keyword_bursts(_per_doc(ws), ws.docs(), gamma=0.2)


# ---------------------------------------------------------------- members

def _member_vectors(ws: Workspace) -> DataFrame:
    return M.member_vectors(ws.model().weights, ws.docs())


@register
def member_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _member_vectors(_ws(spark, sf_dir))
    return v.select("member_name", "term", F.round("weight", SCORE_DIGITS).alias("weight"))


@register
def similar_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 most similar member pairs with cosine >= 0.6."""
    return M.similar_pairs(_member_vectors(_ws(spark, sf_dir)), 10, 0.6)


@register
def similar_pairs_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same pairs by an exact prefix index, without copies of every vector."""
    return PP.similar_pairs_prefix(_member_vectors(_ws(spark, sf_dir)), 10, 0.6)


@register
def similar_pairs_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every member pair with cosine >= 0.6 (no top-k cut)."""
    return M.similar_pairs(_member_vectors(_ws(spark, sf_dir)), None, 0.6)


@register
def pair_graph_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Node degrees of the graph of the 10 most similar pairs."""
    return M.pair_graph_nodes(similar_pairs(spark, sf_dir))


# ------------------------------------------------------- topics, clusters



@register
def singular_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 largest singular values of the TF-IDF matrix (non-increasing)."""
    return TP.singular_values_frame(spark, _ws(spark, sf_dir).lsa())


@register
def topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """10 topics x 10 terms by signed loading."""
    ws = _ws(spark, sf_dir)
    return TP.topics(ws.lsa(), ws.model().vocabulary)


@register
def project_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document projected on three given loading vectors (a parameter:
    loading i of term t is ((t * (i + 1)) % 7 - 3) / 10), long form."""
    m = _ws(spark, sf_dir).model()
    n = int(m.vocabulary.agg({"term_id": "max"}).first()[0]) + 1
    t, i = np.arange(n)[None, :], np.arange(3)[:, None]
    given = TP.LsaModel(np.ones(3), ((t * (i + 1)) % 7 - 3) / 10.0, 0)
    return TP.doc_topics_long(TP.doc_topics(given, m.weights, _ws(spark, sf_dir).docs()))


@register
def doc_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in topic space (U S), long form; term-less documents are zero."""
    return TP.doc_topics_long(_ws(spark, sf_dir).doc_topics())


@register
def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k-means (k=10, seed 42) on the topic vectors: first 10 speeches of every cluster."""
    ws = _ws(spark, sf_dir)
    return CL.cluster_examples(ws.clusters(10), ws.docs(), 10)


@register
def kmeans_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size and cohesion of the k-means clusters."""
    ws = _ws(spark, sf_dir)
    return CL.cluster_profile(ws.model().weights, ws.clusters(10))


@register
def singular_values_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 largest singular values of the matrix of all terms, no vocabulary cut,
    with the basis kept in Spark."""
    m = _ws(spark, sf_dir).model(max_features=None)
    return TP.singular_values_frame(spark, WT.fit_lsa_wide(m.weights, 10, tol=1e-7, factors=m.factors))


@register
def topic_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What makes topics a truncated SVD: (kind, i, j, value) of the components' inner
    products (`component`: the identity), of the documents' topic columns' inner
    products over the squared singular values (`document`: the identity too), and of
    A^T A v - s^2 v (`residual`: the largest entry, 0)."""
    ws = _ws(spark, sf_dir)
    m, lsa = ws.model(), ws.lsa()
    k = len(lsa.singular_values)
    comp = lsa.components_frame(spark)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]

    def products(rows: DataFrame, col: str, kind: str, scale) -> DataFrame:
        sums = rows.agg(*(F.sum(F.col(col)[i] * F.col(col)[j]).alias(f"p{n}") for n, (i, j) in enumerate(pairs)))
        return sums.select(F.inline(F.array(*(F.struct(
            F.lit(kind).alias("kind"), F.lit(i).alias("i"), F.lit(j).alias("j"),
            (F.col(f"p{n}") / F.lit(scale(i, j))).alias("value")) for n, (i, j) in enumerate(pairs)))))

    s = lsa.singular_values
    docs = TP.doc_topics(lsa, m.weights)
    entries = m.weights.select("doc_id", "term_id", "weight")
    back = entries.join(docs, "doc_id").groupBy("term_id").agg(
        *(F.sum(F.col("weight") * F.col("topic")[i]).alias(f"z{i}") for i in range(k))).join(F.broadcast(comp), "term_id")
    worst = back.agg(*(F.max(F.abs(F.col(f"z{i}") - F.col("loadings")[i] * F.lit(float(s[i] ** 2)))).alias(f"r{i}") for i in range(k)))
    residual = worst.select(F.inline(F.array(*(F.struct(F.lit("residual").alias("kind"), F.lit(i).alias("i"), F.lit(i).alias("j"),
                                                        F.col(f"r{i}").alias("value")) for i in range(k)))))
    out = products(comp, "loadings", "component", lambda i, j: 1.0).unionByName(
        products(docs, "topic", "document", lambda i, j: float(s[i] * s[j]))).unionByName(residual)
    return out.withColumn("value", F.round("value", SCORE_DIGITS) + F.lit(0.0))


@register
def cluster_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What makes the clusters k-means: documents, clusters, documents whose centre is
    not the nearest one, and distances that are not those to it (both 0)."""
    vectors = _ws(spark, sf_dir).doc_topics()
    found, centres = CL.fit_clusters(vectors, 10)
    cells = local_frame(spark, [(c, i, float(x)) for c, v in enumerate(centres) for i, x in enumerate(v)], "c int, i int, x double")
    own = vectors.select("doc_id", F.posexplode("topic").alias("i", "y"))
    far = own.join(F.broadcast(cells), "i").groupBy("doc_id", "c").agg(F.sqrt(F.sum((F.col("x") - F.col("y")) ** 2)).alias("d"))
    best = far.groupBy("doc_id").agg(F.min("d").alias("least")).join(found, "doc_id").join(
        far.withColumnRenamed("c", "cluster_id"), ["doc_id", "cluster_id"])
    return best.agg(F.count(F.lit(1)).alias("n_docs"), F.lit(len(centres)).cast("long").alias("n_clusters"),
                    F.count(F.when(F.col("d") > F.col("least") + 1e-6, F.lit(1))).alias("n_misplaced"),
                    F.count(F.when(F.abs(F.col("d") - F.col("distance")) > 1e-6, F.lit(1))).alias("n_wrong"))


def _label_assignment(ws: Workspace) -> DataFrame:
    lab = ws.table("labels")
    return lab.select("doc_id", (F.col("quality") * 2 + F.col("toxic")).cast("int").alias("cluster_id"))


@register
def cluster_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size and cohesion of the groups given by `labels` (quality, toxic)."""
    ws = _ws(spark, sf_dir)
    return CL.cluster_profile(ws.model().weights, _label_assignment(ws))


@register
def cluster_top_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top-10 centroid terms of the groups given by `labels`."""
    ws = _ws(spark, sf_dir)
    return CL.cluster_top_terms(ws.model().weights, _label_assignment(ws))


@register
def assign_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest centre for every embedding; centres = mean embedding per label."""
    ws = _ws(spark, sf_dir)
    emb = ws.table("embeddings")
    ids, centres = CL.label_means(emb, "embedding", "label")
    out = CL.assign_to_centres(emb, "embedding", centres, ids)
    return out.select("vec_id", "cluster_id", F.round("distance", SCORE_DIGITS).alias("distance"))


# -------------------------------------------------------------- streaming



@register
def search_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark passages arriving as a stream of query files (one file
    per micro-batch), each batch searched against the fixed model; the
    collected hits equal the batch search."""
    ws = _ws(spark, sf_dir)
    src = scratch_path(spark, "query-stream")
    _benchmark_queries(ws).repartition(4).write.parquet(src)
    sink = scratch_path(spark, "stream-hits")
    q = ST.start_search_stream(ST.query_stream(spark, src, max_files_per_trigger=1), ws.model(),
                               ws.display(), sink, scratch_path(spark, "stream-ckpt"),
                               available_now=True)
    q.awaitTermination()
    return ST.read_stream_hits(spark, sink).drop("epoch")


@register
def tfidf_consolidated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TF-IDF of the consolidated speeches, computed from the grouped speech
    rows without building any joined text (equal to TF-IDF of the joined text)."""
    ws = _ws(spark, sf_dir)
    groups, parts = C.consolidate_parts(_raw(ws))
    m = T.fit_tfidf(parts, parts=True, n_docs=groups.count())
    return T.rounded_weights(m.weights).select("doc_id", "term", "term_id", "tf", "weight")


@register
def tfidf_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights of a corpus that arrived in three batches: half of the documents
    (every fifth of them cut short), the other half, then the cut ones as they
    are now; equal to a fit on all documents."""
    docs = _ws(spark, sf_dir).docs()
    corpus = R.open_corpus(spark, scratch_path(spark, "corpus"))
    short = F.when(F.col("doc_id") % 10 == 0, F.expr("substring(speech, 1, length(speech) div 2)")).otherwise(F.col("speech"))
    R.append(corpus, docs.where("doc_id % 2 = 0").withColumn("speech", short), "first")
    R.append(corpus, docs.where("doc_id % 2 = 1"), "second")
    R.append(corpus, docs.where("doc_id % 10 = 0"), "corrected", replace=True)
    return T.rounded_weights(R.refreshed_model(corpus).weights).select("doc_id", "term", "term_id", "tf", "weight")


@register
def tfidf_from_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights fitted on a store of documents bucketed by id: texts are counted where they lie."""
    ws = _ws(spark, sf_dir)
    m = T.fit_tfidf(ws.store(), path=scratch_path(spark, "model"), clustered=DS.store_buckets(spark, ws.artifact_path("store")))
    return T.rounded_weights(m.weights).select("doc_id", "term", "term_id", "tf", "weight")


@register
def pair_graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adjacency of the graph of the 10 most similar pairs, both directions."""
    return M.pair_graph_edges(similar_pairs(spark, sf_dir))


@register
def vocabulary_unbounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No max_features: every term within max_df, ids numbered alphabetically
    by the distributed two-pass numbering."""
    m = _ws(spark, sf_dir).model(max_df=0.9, max_features=None)
    return m.vocabulary.select("term", "term_id", "df", "cf", F.round("idf", SCORE_DIGITS).alias("idf"))
