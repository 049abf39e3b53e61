"""Stop words and suffix rules: small, bounded tables applied as expressions.

Both tables are parameters of the text pipeline. They are small by nature
(hundreds of words, tens of rules) and are turned into JVM-side expressions
(`InSet` membership, a `CASE WHEN` suffix chain), so no join and no shuffle is
needed to apply them to billions of tokens. Their size is checked before they
are pulled into an expression.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from importlib.resources import files

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# language code -> name of Spark ML's bundled stop-word list
SPARK_STOPWORD_LISTS = {"en": "english", "de": "german", "fr": "french", "es": "spanish"}
DEFAULT_LANGUAGES = ("en", "de", "fr", "es")

MAX_STOP_WORDS = 200_000
MAX_STEM_RULES = 1_000

# The "S" stemmer of Harman (1991), written as longest-suffix
# rules (suffix, replacement, minimum stem length). A longer suffix wins over a
# shorter one; identity rules ("us", "ss") block the plain "s" rule.
S_STEMMER_RULES = [
    ("eies", "eie", 1),
    ("aies", "aie", 1),
    ("ies", "y", 1),
    ("aes", "ae", 1),
    ("ees", "ee", 1),
    ("oes", "oe", 1),
    ("es", "e", 1),
    ("us", "us", 1),
    ("ss", "ss", 1),
    ("s", "", 1),
]


def spark_stop_words(language: str) -> tuple[str, ...]:
    """Spark ML's default stop-word list for a language code (needs a session)."""
    from pyspark.ml.feature import StopWordsRemover

    return tuple(w for w in StopWordsRemover.loadDefaultStopWords(SPARK_STOPWORD_LISTS[language]) if w)


def packaged_stop_words(language: str) -> tuple[str, ...]:
    """The same list from a text file of this package: readable without a
    session or a JVM, also when the package is imported from a zip."""
    text = files("speechlens.resources").joinpath(f"stopwords_{language}.txt").read_text("utf-8")
    return tuple(text.split())


def default_stop_words(languages: Iterable[str] = DEFAULT_LANGUAGES, packaged: bool = False) -> list[str]:
    read = packaged_stop_words if packaged else spark_stop_words
    return sorted({w for lang in languages for w in read(lang)})


def as_word_list(stop_words: DataFrame | Sequence[str] | None,
                 languages: Iterable[str] = DEFAULT_LANGUAGES) -> list[str]:
    """Normalise a stop-word parameter (DataFrame with a `term` column, a
    list, or None for the defaults) into a sorted list, checking its size."""
    if stop_words is None:
        return default_stop_words(languages)
    if isinstance(stop_words, DataFrame):
        rows = (stop_words.select("term").where(F.col("term").isNotNull()).distinct()
                .limit(MAX_STOP_WORDS + 1).collect())
        words = [r[0] for r in rows]
    else:
        words = [w for w in stop_words if w is not None]
    if len(words) > MAX_STOP_WORDS:
        raise ValueError(f"stop-word table too large to inline ({len(words)} > {MAX_STOP_WORDS})")
    return sorted(set(w.lower() for w in words))


def as_rule_list(rules: DataFrame | Sequence[tuple] | None) -> list[tuple[str, str, int]]:
    """Normalise suffix rules into (suffix, replacement, min_len), longest first."""
    if rules is None:
        rules = S_STEMMER_RULES
    if isinstance(rules, DataFrame):
        rows = (rules.select("suffix", "replacement", "min_len")
                .where(F.col("suffix").isNotNull() & (F.col("suffix") != ""))
                .limit(MAX_STEM_RULES + 1).collect())
        rules = [(r[0], r[1] or "", int(r[2] or 0)) for r in rows]
    rules = [(s, r or "", int(m)) for s, r, m in rules if s]
    if len(rules) > MAX_STEM_RULES:
        raise ValueError(f"too many suffix rules to inline ({len(rules)} > {MAX_STEM_RULES})")
    # longest suffix first; among equal suffixes the first given wins
    seen: set[str] = set()
    ordered = []
    for s, r, m in sorted(rules, key=lambda t: -len(t[0])):
        if s in seen:
            continue
        seen.add(s)
        ordered.append((s, r, m))
    return ordered


# Short suffix rules of the same kind for the other languages (plurals and endings)
RULES_BY_LANGUAGE = {
    "en": S_STEMMER_RULES,
    "de": [("ern", "", 3), ("en", "", 3), ("er", "", 3), ("es", "", 3), ("e", "", 3), ("n", "", 3)],
    "fr": [("eaux", "eau", 1), ("aux", "al", 2), ("euses", "eux", 2), ("es", "", 3), ("s", "", 3), ("e", "", 3)],
    "es": [("ces", "z", 2), ("iones", "ión", 1), ("es", "", 3), ("os", "o", 2), ("as", "a", 2), ("s", "", 3)],
}


def by_language_sql(lang: str, per_language: dict[str, str], otherwise: str) -> str:
    """SQL text choosing among expressions by the value of the column `lang`."""
    return "CASE " + " ".join(f"WHEN {lang} = {sql_literal(k)} THEN {v}" for k, v in per_language.items()) + f" ELSE {otherwise} END"


def not_stop_word_of(column_name: str, lang_col: str, words: dict[str, Sequence[str]]) -> Column:
    """Predicate: not a stop word of the row's own language; a row in another
    language (or none) keeps all its words."""
    return F.expr(by_language_sql(f"`{lang_col}`", {k: stop_sql(f"`{column_name}`", tuple(v)) for k, v in words.items()}, "true"))


def stem_of(column_name: str, lang_col: str, rules: dict[str, Sequence[tuple[str, str, int]]]) -> Column:
    """The stem by the rules of the row's own language; others stay as they are."""
    return F.expr(by_language_sql(f"`{lang_col}`", {k: stem_sql(f"`{column_name}`", as_rule_list(v)) for k, v in rules.items()},
                                  f"`{column_name}`"))


def sql_literal(s: str) -> str:
    """A Spark SQL string literal (backslash escapes are on by default)."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def stop_sql(var: str, words: Sequence[str]) -> str:
    """SQL text `NOT var IN (...)`; Catalyst turns the list into a hash set."""
    if not words:
        return "true"
    return f"NOT {var} IN ({', '.join(sql_literal(w) for w in words)})"


def stem_sql(var: str, rules: Sequence[tuple[str, str, int]]) -> str:
    """SQL text applying the longest matching suffix rule to `var`."""
    if not rules:
        return var
    whens = []
    for suffix, replacement, min_len in rules:
        n = len(suffix)
        whens.append(f"WHEN endswith({var}, {sql_literal(suffix)}) AND length({var}) - {n} >= {min_len} "
                     f"THEN concat(left({var}, length({var}) - {n}), {sql_literal(replacement)})")
    return "CASE " + " ".join(whens) + f" ELSE {var} END"


def _expr(text: str) -> Column:
    # one py4j call for the whole text; building 1000-literal lists one element
    # at a time costs seconds per query plan
    return F.expr(text)


def in_list(column_name: str, values: Sequence) -> Column:
    """`column IN (v1, v2, ...)` parsed from SQL text (one JVM call)."""
    if not values:
        return F.lit(False)
    if isinstance(values[0], str):
        items = ", ".join(sql_literal(v) for v in values)
    else:
        items = ", ".join(str(int(v)) for v in values)
    return F.expr(f"`{column_name}` IN ({items})")


def not_stop_word(column_name: str, words: Sequence[str]) -> Column:
    """Predicate on the string column `column_name`: not a stop word."""
    return _expr(stop_sql(f"`{column_name}`", tuple(words)))


def stem(column_name: str, rules: Sequence[tuple[str, str, int]]) -> Column:
    """The stem of the string column `column_name`."""
    return _expr(stem_sql(f"`{column_name}`", tuple(rules)))
