"""DuckDB SQL for the training-data queries that SQL can express."""

from __future__ import annotations

from . import license_scan

ORACLE: dict[str, str] = {}

# Temperature mixing: the exponent by a recursive bisection over the shares.
ORACLE["op10_mixing"] = r"""
WITH RECURSIVE counted AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n_tokens,
         coalesce(CAST(doc_id AS VARCHAR), 'null') AS id,
         CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS key FROM documents),
per AS (SELECT key, sum(n_tokens) AS src FROM counted GROUP BY key HAVING sum(n_tokens) > 0),
shares AS (SELECT key, src, (SELECT sum(src) FROM per) AS total,
                  CAST(src AS DOUBLE) / (SELECT sum(src) FROM per) AS s FROM per),
packed AS (SELECT list(s ORDER BY s) AS l, min(s) AS least, count(*) AS n FROM shares),
bis(i, lo, hi) AS (
  SELECT 0, CAST(0 AS DOUBLE), CAST(1 AS DOUBLE)
  UNION ALL
  SELECT i + 1, CASE WHEN ok THEN lo ELSE mid END, CASE WHEN ok THEN mid ELSE hi END FROM (
    SELECT i, lo, hi, mid,
           pow(least, mid - 1) / z <= 1.2 AS ok FROM (
      SELECT i, lo, hi, (lo + hi) / 2 AS mid, least, n,
             list_sum(list_transform(l, lambda x: pow(x, (lo + hi) / 2))) AS z
      FROM bis, packed WHERE i < 35))),
solved AS (
  SELECT CASE WHEN pow(least, -1) / n <= 1.2 THEN 0.0
              ELSE round((SELECT hi FROM bis WHERE i = 35), 6) END AS alpha FROM packed),
plan AS (
  SELECT key, pow(s, alpha) / (SELECT sum(pow(s, alpha)) FROM shares) AS weight,
         CAST(ceil(src / 200000.0) AS BIGINT) AS blocks,
         pow(s, alpha) / (SELECT sum(pow(s, alpha)) FROM shares) * CAST(total AS DOUBLE) / src AS rep, alpha
  FROM shares, solved),
dealt AS (
  SELECT c.*, p.weight, p.rep, p.alpha, CAST(floor(rep) AS BIGINT) AS full_epochs,
         CAST('0x' || substr(md5('17:' || id), 1, 8) AS BIGINT) % blocks AS block,
         md5('17:' || CAST(CAST(floor(rep) AS BIGINT) AS VARCHAR) || ':' || id) AS ord
  FROM counted c JOIN plan p ON c.key = p.key),
part AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY key, block ORDER BY ord, id, n_tokens
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run,
         sum(n_tokens) OVER (PARTITION BY key, block) AS whole FROM dealt),
drawn AS (
  SELECT *, unnest(range(full_epochs + CASE WHEN run - n_tokens / 2.0 <= (rep - full_epochs) * whole
                                            THEN 1 ELSE 0 END)) AS epoch FROM part)
SELECT doc_id, source, CAST(n_tokens AS BIGINT) AS n_tokens, round(alpha, 6) AS alpha, round(weight, 6) AS weight,
       CAST(epoch AS BIGINT) AS epoch, CAST(block AS BIGINT) AS block,
       CAST(row_number() OVER (PARTITION BY key, block, epoch
            ORDER BY md5('17:' || CAST(epoch AS VARCHAR) || ':' || id), id, n_tokens) AS BIGINT) AS position,
       CAST('0x' || substr(md5('17:' || CAST(epoch AS VARCHAR) || ':' || key || ':' || CAST(block AS VARCHAR)), 1, 8)
            AS BIGINT) AS draw_key
FROM drawn"""


# Filter audit by its definition: every order and step against the counts of each mask.
ORACLE["op11_filter_audit"] = r"""
WITH words AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
firsts AS (SELECT t, min(doc_id) AS first_id FROM words GROUP BY t),
marked AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic
           FROM labels GROUP BY doc_id),
masks AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         CASE WHEN len(w) < 200 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
         + CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 2 * length(t) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN doc_id > first_id THEN 16 ELSE 0 END AS mask
  FROM words LEFT JOIN firsts USING (t) LEFT JOIN marked USING (doc_id)),
counted AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM masks GROUP BY part, mask),
f(name, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
  SELECT a.name || b.name || c.name || d.name || e.name AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM f a, f b, f c, f d, f e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
    AND len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5),
steps AS (
  SELECT filter_order, step, bits[step] AS own, coalesce(list_sum(bits[1:step - 1]), 0) AS before
  FROM orders, (SELECT unnest(range(1, 6)) AS step)),
dealt AS (
  SELECT part, filter_order, step, any_value(own) AS own,
         sum(CASE WHEN mask & CAST(own + before AS INT) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN mask & CAST(before AS INT) = 0 AND mask & own != 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN mask & CAST(before AS INT) != 0 AND mask & own != 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = own THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN mask & CAST(before AS INT) = 0 AND mask & own != 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN mask & CAST(before AS INT) = 0 AND mask & own != 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM counted, steps GROUP BY part, filter_order, step)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM dealt"""


def _license_sql() -> str:
    """Every place of every template by a join of diagonals with their neighbours."""
    rows = ", ".join("({}, '{}', {}, {}, {}, [{}])".format(
        no, t.label, str(t.base).lower(), t.need, t.k, ", ".join(f"'{w}'" for w in t.words))
        for no, t in enumerate(license_scan.templates()))
    return rf"""
WITH listed AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
words AS (SELECT doc_id, w, unnest(range(len(w))) AS p FROM listed),
placed AS (SELECT doc_id, p, w[p + 1] AS w0, w[p + 2] AS w1, w[p + 3] AS w2 FROM words),
tpl(no, label, base, need, k, words) AS (VALUES {rows}),
grams AS (SELECT no, k, t, words[t + 1] AS g0, words[t + 2] AS g1, words[t + 3] AS g2
          FROM (SELECT no, k, words, unnest(range(len(words) - k + 1)) AS t FROM tpl)),
diags AS (
  SELECT doc_id, no, p - t AS diag, bit_or(CAST(1 AS BIGINT) << t) AS mask, count(*) AS votes, min(p) AS low, max(p) + any_value(k) AS high
  FROM placed JOIN grams ON w0 = g0 AND w1 = g1 AND (k = 2 OR w2 = g2) GROUP BY doc_id, no, p - t),
merged AS (
  SELECT a.doc_id, a.no, a.diag, bit_or(b.mask) AS mask, min(b.low) AS low,
         bool_and(b.diag = a.diag OR need = 1 OR (b.votes, -b.diag) < (a.votes, -a.diag)) AS strongest
  FROM diags a JOIN tpl USING (no) JOIN diags b ON a.doc_id = b.doc_id AND a.no = b.no
   AND abs(a.diag - b.diag) <= CASE WHEN need = 1 THEN 0 ELSE {license_scan.SHIFT} END
  GROUP BY a.doc_id, a.no, a.diag),
spans AS (
  SELECT doc_id, label, base, low, need,
         bit_count(mask | (mask << 1) | CASE WHEN k = 3 THEN mask << 2 ELSE 0 END) / CAST(len(words) AS DOUBLE) AS share
  FROM merged JOIN tpl USING (no) WHERE strongest),
good AS (SELECT * FROM spans WHERE share >= need),
per AS (
  SELECT doc_id, count(*) FILTER (base) AS n_base, min(low) FILTER (base) AS first_word, max(low) FILTER (base) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
  FROM good GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, round(coalesce(score, 0.0), 6) AS score
FROM listed LEFT JOIN per USING (doc_id)"""


ORACLE["op12_license_scan"] = _license_sql()
