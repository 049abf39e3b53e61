"""Independent DuckDB SQL for each registered query (the correctness oracle).

Every query here is written from the operator's definition, as one SQL
statement over the pre-registered tables (documents, benchmark, labels,
conversations, embeddings). Constants shared with the Spark side (stop words,
suffix rules, the punctuation class, the column mapping of the test tables)
come from the same fixed-value lists.
"""

from __future__ import annotations

from speechlens.functions import lexicon
from speechlens.functions.text import PUNCTUATION_CLASS, TOKEN_PATTERN, WHITESPACE_CLASS
from speechlens.sources.speeches import _ATTRIBUTE_PATTERN

D = 6  # decimals of every compared double


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _attrs(alias: str = "") -> str:
    p = f"{alias}." if alias else ""
    parts = []
    for col, prefix, a, b in _ATTRIBUTE_PATTERN:
        parts.append(f"CASE WHEN {p}doc_id % {a} = 0 THEN NULL ELSE {lit(prefix)} || "
                     f"CAST({p}doc_id % {b} AS VARCHAR) END AS {col}")
    return ",\n         ".join(parts)


SPEECHES = f"""speeches AS (
  SELECT lang AS political_party, lang || '-' || source AS member_name,
         strftime(DATE '1989-07-03' + CAST((doc_id % 40) * 280 AS INTEGER), '%d/%m/%Y') AS sitting_date,
         {_attrs()},
         text AS speech, doc_id AS seq
  FROM documents)"""

DOCS = """docs AS (
  SELECT seq AS doc_id, political_party, member_name, sitting_date, parliamentary_period,
         parliamentary_session, parliamentary_sitting, government, member_region, roles,
         member_gender, speech
  FROM speeches)"""


def tokens_sql(text: str) -> str:
    return (f"regexp_extract_all(lower(regexp_replace(coalesce({text}, ''), "
            f"{lit(PUNCTUATION_CLASS)}, '', 'g')), {lit(TOKEN_PATTERN)})")


def stop_list() -> str:
    return ", ".join(lit(w) for w in lexicon.default_stop_words(packaged=True))


def stem_sql(tok: str, rules=None) -> str:
    rules = lexicon.as_rule_list(rules)
    whens = []
    for suffix, repl, min_len in rules:
        n = len(suffix)
        whens.append(f"WHEN ends_with({tok}, {lit(suffix)}) AND length({tok}) - {n} >= {min_len} "
                     f"THEN left({tok}, length({tok}) - {n}) || {lit(repl)}")
    return "CASE " + " ".join(whens) + f" ELSE {tok} END"


def terms_cte(name: str, src: str, id_col: str, text_col: str) -> str:
    """(id, term) rows of a text table, same pipeline as the Spark side."""
    return f"""{name}_tok AS (
  SELECT {id_col} AS id, unnest({tokens_sql(text_col)}) AS token FROM {src}),
{name}_terms AS (
  SELECT id, {stem_sql('token')} AS term FROM {name}_tok
  WHERE token NOT IN ({stop_list()})),
{name}_tf AS (
  SELECT id, term, count(*) AS tf FROM {name}_terms WHERE length(term) >= 2 GROUP BY id, term)"""


def model_ctes(max_df: float = 0.9, max_features: int | None = 6000, docs_block: str | None = None) -> str:
    return f"""{docs_block or SPEECHES + ',' + chr(10) + DOCS},
{terms_cte('d', 'docs', 'doc_id', 'speech')},
n AS (SELECT count(*) AS n_docs FROM docs),
stats AS (SELECT term, count(*) AS df, sum(tf) AS cf FROM d_tf GROUP BY term),
top AS (
  SELECT term, df, cf FROM stats
  WHERE df <= {float(max_df)} * (SELECT n_docs FROM n)
  ORDER BY cf DESC, term ASC {'' if max_features is None else f'LIMIT {int(max_features)}'}),
vocab AS (
  SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS term_id,
         CAST(df AS BIGINT) AS df, CAST(cf AS BIGINT) AS cf,
         ln((1.0 + (SELECT n_docs FROM n)) / (1.0 + df)) + 1.0 AS idf
  FROM top),
weights AS (
  SELECT t.id AS doc_id, t.term, v.term_id, CAST(t.tf AS BIGINT) AS tf,
         t.tf * v.idf / sqrt(sum((t.tf * v.idf) * (t.tf * v.idf)) OVER (PARTITION BY t.id)) AS weight
  FROM d_tf t JOIN vocab v ON t.term = v.term)"""


def query_weights_ctes(src: str = "benchmark", id_col: str = "item_id", text_col: str = "text") -> str:
    return f"""{terms_cte('q', src, id_col, text_col)},
qweights AS (
  SELECT t.id AS query_id, t.term, t.tf * v.idf / sqrt(sum((t.tf * v.idf) * (t.tf * v.idf))
         OVER (PARTITION BY t.id)) AS qw
  FROM q_tf t JOIN vocab v ON t.term = v.term)"""


def words_sql(text: str) -> str:
    return f"list_filter(regexp_split_to_array(coalesce({text}, ''), {lit(WHITESPACE_CLASS + '+')}), lambda x: x <> '')"


def snippet_sql(text: str, n: int = 10) -> str:
    w = words_sql(text)
    return (f"array_to_string(list_slice({w}, 1, {n}), ' ') || "
            f"CASE WHEN len({w}) > {n} THEN '...' ELSE '' END")


def search_sql(src: str, id_col: str, text_col: str, k: int = 10, floor: float = 0.001) -> str:
    return f"""WITH {model_ctes()},
{query_weights_ctes(src, id_col, text_col)},
scores AS (
  SELECT q.query_id, w.doc_id, round(sum(w.weight * q.qw), {D}) AS score
  FROM weights w JOIN qweights q ON w.term = q.term GROUP BY q.query_id, w.doc_id),
ranked AS (
  SELECT query_id, doc_id, score,
         CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
  FROM scores WHERE score >= {floor})
SELECT CAST(r.query_id AS BIGINT) AS query_id, r.rank, CAST(r.doc_id AS BIGINT) AS doc_id,
       {snippet_sql('d.speech')} AS speech_start, d.member_name AS name, d.political_party,
       d.sitting_date AS date, r.score
FROM ranked r JOIN docs d ON d.doc_id = r.doc_id
WHERE r.rank <= {k}"""


# ---------------------------------------------------------------- registry

ORACLE: dict[str, str] = {}

ORACLE["term_frequency"] = f"""WITH {SPEECHES},
{DOCS},
{terms_cte('d', 'docs', 'doc_id', 'speech')}
SELECT id AS doc_id, term, CAST(tf AS BIGINT) AS tf FROM d_tf"""

ORACLE["document_frequency"] = f"""WITH {SPEECHES},
{DOCS},
{terms_cte('d', 'docs', 'doc_id', 'speech')}
SELECT term, CAST(count(*) AS BIGINT) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM d_tf GROUP BY term"""

ORACLE["vocabulary"] = f"""WITH {model_ctes()}
SELECT term, term_id, df, cf FROM vocab"""

ORACLE["idf"] = f"""WITH {model_ctes()}
SELECT term, round(idf, {D}) AS idf FROM vocab"""

ORACLE["tfidf_weights"] = f"""WITH {model_ctes()}
SELECT doc_id, term, term_id, tf, round(weight, {D}) AS weight FROM weights"""

ORACLE["tfidf_refreshed"] = ORACLE["tfidf_weights"]

ORACLE["tfidf_from_store"] = ORACLE["tfidf_weights"]

ORACLE["vocabulary_small"] = f"""WITH {model_ctes(0.3, 500)}
SELECT term, term_id, df, cf FROM vocab"""

ORACLE["inverted_index"] = f"""WITH {model_ctes()}
SELECT w.term, v.df, w.doc_id, w.tf FROM weights w JOIN vocab v ON v.term = w.term"""

ORACLE["transform_new_text"] = f"""WITH {model_ctes()},
{terms_cte('q', 'benchmark', 'item_id', 'text')}
SELECT CAST(t.id AS BIGINT) AS query_id, t.term, v.term_id, CAST(t.tf AS BIGINT) AS tf,
       round(t.tf * v.idf / sqrt(sum((t.tf * v.idf) * (t.tf * v.idf)) OVER (PARTITION BY t.id)), {D}) AS weight
FROM q_tf t JOIN vocab v ON t.term = v.term"""

ORACLE["search_batch"] = search_sql("benchmark", "item_id", "text")

ORACLE["search_topk"] = search_sql("benchmark", "item_id", "text", k=3, floor=0.2)

ORACLE["search_pruned"] = ORACLE["search_batch"]

ORACLE["search_pruned_short"] = search_sql(
    "(SELECT item_id, array_to_string(list_slice(string_split(text, ' '), 1, 5), ' ') AS text FROM benchmark)", "item_id", "text")

_BARE = search_sql(r"(SELECT item_id, regexp_replace(text, '[\p{L}\p{N}]+', ' ', 'g') AS text FROM benchmark)", "item_id", "text")
ORACLE["search_no_hit"] = f"""SELECT item_id AS query_id, count(h.doc_id) AS n_hits
FROM benchmark LEFT JOIN ({_BARE}) h ON h.query_id = item_id GROUP BY item_id"""

ORACLE["fetch_hits"] = f"""WITH hits AS ({search_sql('benchmark', 'item_id', 'text')}),
{SPEECHES},
{DOCS}
SELECT * FROM docs WHERE doc_id IN (SELECT doc_id FROM hits)"""

ORACLE["fetch_pruned"] = ORACLE["fetch_hits"]

ORACLE["suggest_terms"] = f"""WITH {model_ctes()}
SELECT term, df FROM vocab WHERE contains(lower(term), 'er')
ORDER BY df DESC, term LIMIT 20"""


def _left_out(word: str) -> str:
    """The word and what is left of it without one character."""
    return (f"list_distinct(list_append(list_transform(range(1, CAST(length({word}) AS BIGINT) + 1), "
            f"lambda i: substring({word}, 1, i - 1) || substring({word}, i + 1)), {word}))")


# two words within one edit share what is left of them; of equal length they must differ in one place
ORACLE["suggest_fuzzy"] = f"""WITH {SPEECHES},
{DOCS},
{terms_cte('d', 'docs', 'doc_id', 'speech')},
terms AS (SELECT term, CAST(count(*) AS BIGINT) AS df FROM d_tf GROUP BY term),
typed AS (SELECT DISTINCT substring(t, 1, 1) || substring(t, 3) AS word
          FROM (SELECT unnest({tokens_sql('text')}) AS t FROM benchmark)),
typed_left AS (SELECT word, unnest({_left_out('word')}) AS v FROM typed),
terms_left AS (SELECT term, unnest({_left_out('term')}) AS v FROM terms),
pairs AS (SELECT DISTINCT word, term FROM typed_left JOIN terms_left USING (v)),
near AS (
  SELECT word, term, CASE WHEN word = term THEN 0 ELSE 1 END AS edits FROM pairs
  WHERE length(word) <> length(term) OR len(list_filter(range(1, CAST(length(word) AS BIGINT) + 1),
        lambda i: substring(word, i, 1) <> substring(term, i, 1))) <= 1),
ranked AS (
  SELECT word, CAST(row_number() OVER (PARTITION BY word ORDER BY edits, df DESC, term) AS INTEGER) AS rank, term, df, edits
  FROM near JOIN terms USING (term))
SELECT word, rank, term, df, edits FROM ranked WHERE rank <= 5"""


RAW_COLS = ("political_party, member_name, sitting_date, parliamentary_period, parliamentary_session, "
            "parliamentary_sitting, government, member_region, roles, member_gender, speech, seq")

ORACLE["scan_csv_roundtrip"] = f"""WITH {SPEECHES}
SELECT {RAW_COLS} FROM speeches"""

ORACLE["scan_csv_reordered"] = f"""WITH {SPEECHES}
SELECT {RAW_COLS.replace('roles', "CASE WHEN seq % 2 = 0 THEN roles END AS roles")} FROM speeches"""

ORACLE["scan_csv_split"] = ORACLE["scan_csv_roundtrip"]

ORACLE["scan_pruned"] = f"""WITH {SPEECHES}
SELECT member_name, speech, seq FROM speeches"""

_ATTR_NAMES = [c for c, *_ in _ATTRIBUTE_PATTERN]


def consolidate_sql(src: str) -> str:
    firsts = ",\n       ".join(
        f"arg_min({c}, seq) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in _ATTR_NAMES)
    return f"""SELECT CAST(row_number() OVER (ORDER BY political_party, member_name, sitting_date) - 1 AS BIGINT) AS doc_id,
       political_party, member_name, sitting_date,
       {firsts},
       string_agg(speech, ' | ' ORDER BY seq) AS speech
FROM {src}
WHERE political_party IS NOT NULL AND member_name IS NOT NULL AND sitting_date IS NOT NULL
GROUP BY political_party, member_name, sitting_date"""


CONV_SPEECHES = """conv AS (
  SELECT role AS political_party, 'conv-' || CAST(conv_id AS VARCHAR) AS member_name,
         '01/01/2000' AS sitting_date,
         """ + ",\n         ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in _ATTR_NAMES) + """,
         text AS speech, CAST(turn AS BIGINT) AS seq
  FROM conversations)"""

ORACLE["consolidate"] = f"""WITH {SPEECHES}
{consolidate_sql('speeches')}"""

ORACLE["union_sources"] = f"""WITH {SPEECHES},
{CONV_SPEECHES},
allsp AS (SELECT * FROM speeches UNION ALL BY NAME SELECT * FROM conv)
{consolidate_sql('allsp')}"""

SAMPLE = """(SELECT * FROM docs
  QUALIFY row_number() OVER (ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id)
          <= (SELECT round_even(0.1 * count(*), 0) FROM docs))"""

ORACLE["sample_exact"] = f"""WITH {SPEECHES},
{DOCS}
SELECT * FROM {SAMPLE}"""

ORACLE["sample_one_pass"] = ORACLE["sample_exact"]

ORACLE["choose_input"] = f"""WITH {SPEECHES},
{DOCS}
SELECT * FROM docs WHERE (SELECT count(*) FROM docs) <= 1000
UNION ALL
SELECT * FROM {SAMPLE} WHERE (SELECT count(*) FROM docs) > 1000"""

ORACLE["lookup_doc"] = f"""WITH {SPEECHES},
{DOCS}
SELECT * FROM docs WHERE doc_id IN (SELECT doc_id FROM labels)"""

ORACLE["clean_text"] = f"""WITH {SPEECHES},
{DOCS}
SELECT doc_id, lower(regexp_replace(coalesce(speech, ''), {lit(PUNCTUATION_CLASS)}, '', 'g')) AS clean
FROM docs"""

TOKENS = f"""toks AS (
  SELECT doc_id, CAST(i - 1 AS INTEGER) AS pos, l[i] AS token
  FROM (SELECT doc_id, l, unnest(generate_series(1, len(l))) AS i
        FROM (SELECT doc_id, {tokens_sql('speech')} AS l FROM docs)))"""

ORACLE["tokenize"] = f"""WITH {SPEECHES},
{DOCS},
{TOKENS}
SELECT doc_id, pos, token FROM toks"""

ORACLE["remove_stopwords"] = f"""WITH {SPEECHES},
{DOCS},
{TOKENS}
SELECT doc_id, pos, token FROM toks WHERE token NOT IN ({stop_list()})"""

ORACLE["conflate_terms"] = f"""WITH {SPEECHES},
{DOCS},
{TOKENS},
kept AS (SELECT DISTINCT token FROM toks WHERE token NOT IN ({stop_list()}))
SELECT token, {stem_sql('token')} AS term FROM kept WHERE token <> {stem_sql('token')}"""

ORACLE["conflate_by_language"] = f"""WITH toks AS (
  SELECT lang, unnest({tokens_sql('text')}) AS token FROM documents),
kept AS (SELECT lang, token, count(*) AS n FROM toks WHERE NOT CASE {' '.join(
    f"WHEN lang = '{k}' THEN token IN ({', '.join(lit(w) for w in lexicon.packaged_stop_words(k))})"
    for k in lexicon.DEFAULT_LANGUAGES)} ELSE false END GROUP BY lang, token)
SELECT lang, token, CASE {' '.join(
    f"WHEN lang = '{k}' THEN {stem_sql('token', v)}" for k, v in lexicon.RULES_BY_LANGUAGE.items())} ELSE token END AS term,
       n FROM kept"""

ORACLE["conflate_learned"] = f"""WITH RECURSIVE tok AS (
  SELECT DISTINCT lang, doc_id, word FROM (SELECT lang, doc_id, unnest({tokens_sql('text')}) AS word FROM documents)
  WHERE lang IS NOT NULL AND doc_id IS NOT NULL),
nd AS (SELECT lang, count(DISTINCT doc_id) AS docs FROM tok GROUP BY lang),
words AS (SELECT lang, word, count(*) AS df FROM tok GROUP BY lang, word),
cuts AS (
  SELECT lang, word, substring(word, 1, length(word) - cut) AS stem, substring(word, length(word) - cut + 1) AS ending
  FROM words, (SELECT unnest(range(4)) AS cut) WHERE length(word) - cut >= 4),
kept AS (
  SELECT lang, ending FROM (SELECT lang, ending, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, ending) AS r
                            FROM cuts GROUP BY lang, ending) WHERE r <= 30),
c AS (SELECT cuts.* FROM cuts JOIN kept USING (lang, ending)),
pairs AS (SELECT x.lang, x.ending AS xe, y.ending AS ye, x.word AS a, y.word AS b
          FROM c x JOIN c y ON x.lang = y.lang AND x.stem = y.stem AND x.ending < y.ending),
classes AS (SELECT lang, xe, ye FROM pairs GROUP BY lang, xe, ye HAVING count(*) >= 10),
asked AS (SELECT DISTINCT lang, a, b FROM pairs JOIN classes USING (lang, xe, ye)),
together AS (
  SELECT s.lang, s.a, s.b, count(*) AS n FROM asked s JOIN tok p ON p.lang = s.lang AND p.word = s.a
  JOIN tok q ON q.lang = s.lang AND q.word = s.b AND q.doc_id = p.doc_id GROUP BY ALL),
links AS (
  SELECT t.lang, a, b FROM together t JOIN nd ON nd.lang = t.lang
  JOIN words x ON x.lang = t.lang AND x.word = a JOIN words y ON y.lang = t.lang AND y.word = b
  WHERE n >= 3 AND n * docs >= 2.0 * x.df * y.df),
ends AS (SELECT lang, a, b FROM links UNION SELECT lang, b, a FROM links),
reach(lang, word, met) AS (
  SELECT DISTINCT lang, a, a FROM ends
  UNION SELECT r.lang, r.word, e.b FROM reach r JOIN ends e ON e.lang = r.lang AND e.a = r.met),
comp AS (SELECT lang, word, min(met) AS least FROM reach GROUP BY lang, word),
own AS (SELECT c.lang, c.word, least, df FROM comp c JOIN words w ON w.lang = c.lang AND w.word = c.word)
SELECT lang, word, first_value(word) OVER (PARTITION BY lang, least ORDER BY df DESC, word) AS term, df FROM own"""

ORACLE["snippet"] = f"""WITH {SPEECHES},
{DOCS}
SELECT doc_id, {snippet_sql('speech')} AS speech_start FROM docs"""

KW_DOC = f"""kw_doc AS (
  SELECT w.doc_id, CAST(w.rank AS INTEGER) AS rank, w.word, w.tfidf, d.sitting_date AS date
  FROM (SELECT doc_id, term AS word, round(weight, {D}) AS tfidf,
               row_number() OVER (PARTITION BY doc_id ORDER BY round(weight, {D}) DESC, term DESC) AS rank
        FROM weights) w
  JOIN docs d ON d.doc_id = w.doc_id
  WHERE w.rank <= 10)"""


def kw_group(name: str, col: str) -> str:
    return f"""{name} AS (
  SELECT {col}, CAST(rank AS INTEGER) AS rank, tfidf, word, date FROM (
    SELECT d.{col}, k.tfidf, k.word, k.date,
           row_number() OVER (PARTITION BY d.{col} ORDER BY k.tfidf DESC, k.word DESC, k.date DESC) AS rank
    FROM kw_doc k JOIN docs d ON d.doc_id = k.doc_id)
  WHERE rank <= 10)"""


KW_ALL = f"""{model_ctes()},
{KW_DOC},
{kw_group('kw_member', 'member_name')},
{kw_group('kw_party', 'political_party')}"""

ORACLE["keywords_per_doc"] = f"""WITH {KW_ALL}
SELECT doc_id, rank, word, tfidf, date FROM kw_doc"""

ORACLE["keywords_per_member"] = f"""WITH {KW_ALL}
SELECT member_name, rank, tfidf, word, date FROM kw_member"""

ORACLE["keywords_per_party"] = f"""WITH {KW_ALL}
SELECT political_party, rank, tfidf, word, date FROM kw_party"""

ORACLE["keywords_json"] = f"""WITH {KW_ALL}
SELECT 'speech' AS kind, CAST(doc_id AS VARCHAR) AS key, rank, word, tfidf, date FROM kw_doc
UNION ALL SELECT 'member', member_name, rank, word, tfidf, date FROM kw_member
UNION ALL SELECT 'party', political_party, rank, word, tfidf, date FROM kw_party"""

ORACLE["keyword_timeline"] = f"""WITH {KW_ALL}
SELECT 'speech' AS series_kind, CAST(doc_id AS VARCHAR) AS series, rank, word,
       CAST(try_strptime(date, '%d/%m/%Y') AS DATE) AS date FROM kw_doc
UNION ALL SELECT 'member', member_name, rank, word, CAST(try_strptime(date, '%d/%m/%Y') AS DATE) FROM kw_member
UNION ALL SELECT 'party', political_party, rank, word, CAST(try_strptime(date, '%d/%m/%Y') AS DATE) FROM kw_party"""

ORACLE["keyword_trend"] = f"""WITH {KW_ALL}
SELECT d.political_party, CAST(year(CAST(try_strptime(k.date, '%d/%m/%Y') AS DATE)) AS INTEGER) AS year,
       k.word, CAST(count(*) AS BIGINT) AS n_speeches, max(k.tfidf) AS max_tfidf
FROM kw_doc k JOIN docs d ON d.doc_id = k.doc_id
GROUP BY ALL"""

def _burst_cost(p: str, r: str, d: str) -> str:
    return f"-({r} * ln({p}) + ({d} - {r}) * ln(1.0 - {p}))"


# the automaton step by step: forward and backward costs by recursion over each series
ORACLE["keyword_bursts"] = f"""WITH RECURSIVE {KW_ALL},
dated AS (SELECT doc_id, political_party AS series, CAST(try_strptime(sitting_date, '%d/%m/%Y') AS DATE) AS t FROM docs),
totals AS (SELECT series, t, CAST(count(*) AS DOUBLE) AS d FROM dated WHERE series IS NOT NULL AND t IS NOT NULL GROUP BY series, t),
told AS (SELECT *, sum(d) OVER (PARTITION BY series ORDER BY t) AS until, sum(d) OVER (PARTITION BY series) AS speeches,
                count(*) OVER (PARTITION BY series) AS steps FROM totals),
occ AS (SELECT d.series, k.word, d.t, CAST(count(*) AS DOUBLE) AS r FROM kw_doc k JOIN dated d USING (doc_id) GROUP BY ALL),
p AS (SELECT o.*, d, until, steps, least(sum(r) OVER (PARTITION BY series, word) / speeches, 0.9998) AS p0,
             row_number() OVER line AS k, until - d - coalesce(lag(until) OVER line, 0.0) AS gap
      FROM occ o JOIN told USING (series, t) WINDOW line AS (PARTITION BY series, word ORDER BY t)),
q AS (SELECT *, least(2.0 * p0, 0.9999) AS p1, 0.2 * ln(steps) AS up FROM p),
c AS (SELECT *, {_burst_cost('p0', 'r', 'd')} AS low, {_burst_cost('p1', 'r', 'd')} AS high,
             {_burst_cost('p0', '0.0', 'gap')} AS g0, {_burst_cost('p1', '0.0', 'gap')} AS g1,
             max(k) OVER (PARTITION BY series, word) AS n FROM q),
fw AS (
  SELECT series, word, k, g0 + low AS f0, g0 + up + high AS f1 FROM c WHERE k = 1
  UNION ALL
  SELECT c.series, c.word, c.k, least(f0 + g0 + low, f1 + g0 + low), least(f0 + g0 + up + high, f1 + least(g1, g0 + up) + high)
  FROM fw JOIN c ON c.series = fw.series AND c.word = fw.word AND c.k = fw.k + 1),
bw AS (
  SELECT series, word, k, CAST(0 AS DOUBLE) AS b0, CAST(0 AS DOUBLE) AS b1 FROM c WHERE k = n
  UNION ALL
  SELECT c.series, c.word, c.k - 1, least(g0 + low + b0, g0 + up + high + b1), least(g0 + low + b0, least(g1, g0 + up) + high + b1)
  FROM bw JOIN c ON c.series = bw.series AND c.word = bw.word AND c.k = bw.k AND c.k > 1),
high AS (SELECT c.* FROM c JOIN fw USING (series, word, k) JOIN bw USING (series, word, k) WHERE f1 + b1 < f0 + b0 - 1e-9),
parted AS (
  SELECT *, coalesce(lag(k) OVER line = k - 1 AND (gap = 0 OR g0 - g1 + up > 1e-9), false) AS goes_on
  FROM high WINDOW line AS (PARTITION BY series, word ORDER BY k)),
numbered AS (SELECT *, sum(CASE WHEN goes_on THEN 0 ELSE 1 END) OVER (PARTITION BY series, word ORDER BY k) AS burst FROM parted)
SELECT series, word, CAST(burst AS INTEGER) AS burst, min(t) AS first_t, max(t) AS last_t, count(*) AS steps,
       CAST(sum(r) AS BIGINT) AS speeches,
       round(sum(low - high + CASE WHEN goes_on THEN g0 - g1 ELSE 0.0 END), {D}) AS weight
FROM numbered GROUP BY series, word, burst"""

MEMBER_CTES = f"""{model_ctes()},
mcount AS (SELECT member_name, count(*) AS n FROM docs GROUP BY member_name),
mv AS (
  SELECT d.member_name, w.term, sum(w.weight) / any_value(c.n) AS weight
  FROM weights w JOIN docs d ON d.doc_id = w.doc_id JOIN mcount c ON c.member_name = d.member_name
  GROUP BY d.member_name, w.term),
mnorm AS (SELECT member_name, sqrt(sum(weight * weight)) AS nrm FROM mv GROUP BY member_name),
sims AS (
  SELECT a.member_name AS member_a, b.member_name AS member_b,
         round(sum(a.weight * b.weight) / (any_value(na.nrm) * any_value(nb.nrm)), {D}) AS similarity
  FROM mv a JOIN mv b ON a.term = b.term AND a.member_name < b.member_name
  JOIN mnorm na ON na.member_name = a.member_name JOIN mnorm nb ON nb.member_name = b.member_name
  GROUP BY a.member_name, b.member_name),
top_pairs AS (
  SELECT * FROM sims WHERE similarity >= 0.6
  ORDER BY similarity DESC, member_a, member_b LIMIT 10)"""

ORACLE["member_vectors"] = f"""WITH {MEMBER_CTES}
SELECT member_name, term, round(weight, {D}) AS weight FROM mv"""

ORACLE["similar_pairs"] = f"""WITH {MEMBER_CTES}
SELECT member_a, member_b, similarity FROM top_pairs"""

ORACLE["similar_pairs_prefix"] = ORACLE["similar_pairs"]

ORACLE["similar_pairs_all"] = f"""WITH {MEMBER_CTES}
SELECT member_a, member_b, similarity FROM sims WHERE similarity >= 0.6"""

ORACLE["pair_graph_nodes"] = f"""WITH {MEMBER_CTES}
SELECT member_name, CAST(count(*) AS BIGINT) AS degree FROM (
  SELECT member_a AS member_name FROM top_pairs UNION ALL SELECT member_b FROM top_pairs)
GROUP BY member_name"""

LABEL_ASSIGN = """assign AS (SELECT doc_id, CAST(quality * 2 + toxic AS INTEGER) AS cluster_id FROM labels),
csize AS (SELECT cluster_id, count(*) AS n_docs FROM assign GROUP BY cluster_id),
cent AS (
  SELECT a.cluster_id, w.term, sum(w.weight) / any_value(s.n_docs) AS c
  FROM weights w JOIN assign a ON a.doc_id = w.doc_id JOIN csize s ON s.cluster_id = a.cluster_id
  GROUP BY a.cluster_id, w.term)"""

ORACLE["cluster_profile"] = f"""WITH {model_ctes()},
{LABEL_ASSIGN},
cnorm AS (SELECT cluster_id, sqrt(sum(c * c)) AS cn FROM cent GROUP BY cluster_id),
dots AS (
  SELECT a.cluster_id, w.doc_id, sum(w.weight * c.c) AS dot
  FROM weights w JOIN assign a ON a.doc_id = w.doc_id
  JOIN cent c ON c.cluster_id = a.cluster_id AND c.term = w.term
  GROUP BY a.cluster_id, w.doc_id),
tot AS (SELECT d.cluster_id, sum(d.dot / n.cn) AS sc FROM dots d JOIN cnorm n ON n.cluster_id = d.cluster_id GROUP BY d.cluster_id)
SELECT s.cluster_id, CAST(s.n_docs AS BIGINT) AS n_docs, round(coalesce(t.sc, 0.0) / s.n_docs, {D}) AS cohesion
FROM csize s LEFT JOIN tot t ON t.cluster_id = s.cluster_id"""

ORACLE["cluster_top_terms"] = f"""WITH {model_ctes()},
{LABEL_ASSIGN}
SELECT cluster_id, CAST(rank AS INTEGER) AS rank, term, weight FROM (
  SELECT cluster_id, term, round(c, {D}) AS weight,
         row_number() OVER (PARTITION BY cluster_id ORDER BY round(c, {D}) DESC, term) AS rank
  FROM cent)
WHERE rank <= 10"""

ORACLE["assign_clusters"] = f"""WITH el AS (
  SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS m
  FROM (SELECT label, embedding, unnest(generate_series(1, len(embedding))) AS i FROM embeddings)
  GROUP BY label, i),
centres AS (SELECT label, list(m ORDER BY i) AS c FROM el GROUP BY label),
d AS (
  SELECT e.vec_id, c.label,
         sqrt(list_sum(list_transform(list_zip(e.embedding, c.c),
                                      lambda p: (CAST(p[1] AS DOUBLE) - p[2]) * (CAST(p[1] AS DOUBLE) - p[2])))) AS dist
  FROM embeddings e CROSS JOIN centres c)
SELECT vec_id, CAST(label AS INTEGER) AS cluster_id, round(dist, {D}) AS distance
FROM d QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY dist, label) = 1"""

ORACLE["project_topics"] = f"""WITH {model_ctes()}
SELECT d.doc_id, CAST(i AS INTEGER) AS topic_id,
       round(coalesce(sum(w.weight * ((w.term_id * (i + 1)) % 7 - 3) / 10.0), 0.0), {D}) AS value
FROM docs d CROSS JOIN range(3) r(i) LEFT JOIN weights w ON w.doc_id = d.doc_id
GROUP BY d.doc_id, i"""

ORACLE["search_stream"] = search_sql("benchmark", "item_id", "text")


ORACLE["tfidf_consolidated"] = f"""WITH {model_ctes(docs_block=SPEECHES + ", docs AS (" + consolidate_sql('speeches') + ")")}
SELECT doc_id, term, term_id, tf, round(weight, {D}) AS weight FROM weights"""

ORACLE["pair_graph_edges"] = f"""WITH {MEMBER_CTES}
SELECT member_a AS member_name, member_b AS neighbour, similarity FROM top_pairs
UNION ALL
SELECT member_b, member_a, similarity FROM top_pairs"""

ORACLE["vocabulary_unbounded"] = f"""WITH {model_ctes(0.9, None)}
SELECT term, term_id, df, cf, round(idf, {D}) AS idf FROM vocab"""

ORACLE["build_if_absent"] = ORACLE["vocabulary"]

# invariants: what the values must be, whatever the fit found
ORACLE["topic_invariants"] = """WITH n AS (SELECT unnest(range(10)) AS i),
pairs AS (SELECT a.i, b.i AS j FROM n a, n b WHERE a.i <= b.i)
SELECT kind, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, CASE WHEN i = j THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS value
FROM pairs, (VALUES ('component'), ('document')) k(kind)
UNION ALL SELECT 'residual', CAST(i AS INTEGER), CAST(i AS INTEGER), 0.0::DOUBLE FROM n"""

ORACLE["cluster_invariants"] = """SELECT count(*) AS n_docs, CAST(10 AS BIGINT) AS n_clusters,
       CAST(0 AS BIGINT) AS n_misplaced, CAST(0 AS BIGINT) AS n_wrong FROM documents"""
