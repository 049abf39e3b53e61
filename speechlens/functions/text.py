"""Scalar text functions, all built-in Spark expressions (no Python UDF).

The cleaning follows the reference pipeline: delete the 32 ASCII punctuation
marks (not blank them out, so ``a.b`` becomes ``ab``), lower-case, and keep
runs of two or more word characters.
"""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 32 ASCII punctuation marks, as one regex character class.
PUNCTUATION_CLASS = r"""[!"#$%&'()*+,\-./:;<=>?@\[\\\]^_`{|}~]"""

# a token is a run of at least two word characters (letters, digits, '_')
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"

# Whitespace as Python's str.split() sees it, so snippets cut words the same way.
WHITESPACE_CLASS = (r"[\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
                    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")

SNIPPET_WORDS = 10
DATE_FORMAT = "dd/MM/yyyy"


# the same marks as plain characters, for a character-mapping delete
PUNCTUATION_CHARS = string.punctuation


def clean_text(text: Column) -> Column:
    """Null-safe: null text becomes ''; punctuation deleted (character
    mapping, cheaper than a regex); lower-cased."""
    return F.lower(F.translate(F.coalesce(text, F.lit("")), PUNCTUATION_CHARS, ""))


def tokens(text: Column) -> Column:
    """array<string> of the tokens of a raw text."""
    return F.regexp_extract_all(clean_text(text), F.lit(TOKEN_PATTERN), F.lit(0))


def words(text: Column) -> Column:
    """Whitespace-separated words, like Python's ``str.split()``."""
    parts = F.split(F.coalesce(text, F.lit("")), WHITESPACE_CLASS + "+")
    return F.filter(parts, lambda w: w != F.lit(""))


def snippet(text: Column, n_words: int = SNIPPET_WORDS) -> Column:
    """First `n_words` words joined by blanks, with '...' if the text is longer."""
    # only the words that are shown and one more are split, not the rest of the text
    head = f"^(?:{WHITESPACE_CLASS}*+[^{WHITESPACE_CLASS[1:]}++){{0,{n_words + 1}}}"
    parts = F.split(F.regexp_extract(F.coalesce(text, F.lit("")), head, 0), WHITESPACE_CLASS + "+")
    w = F.filter(parts, lambda x: x != F.lit(""))
    return F.concat(
        F.array_join(F.slice(w, 1, n_words), " "),
        F.when(F.size(w) > n_words, F.lit("...")).otherwise(F.lit("")),
    )


def parse_date(text: Column) -> Column:
    """`dd/MM/yyyy` text to DATE; bad text gives null instead of an error."""
    return F.try_to_date(text, DATE_FORMAT)
