"""Personal data by weak supervision: labelers vote on spans, EM weighs them.

Candidate spans come from the base patterns (always kept) and from looser ones
(spelled-out e-mail addresses, phone numbers without a country code, digit
groups of identity numbers, card numbers that fail their check digit). On every
candidate five labelers vote yes, no or abstain: the strict pattern, a checksum
or range, a gazetteer (top-level domains, card issuers, reserved networks), the
words before it, and its edges. A candidate's votes, kind and length bin make
its pattern; Spark counts the patterns over all documents, and there are at
most a few thousand different ones. On these counts expectation-maximisation
estimates how reliable each labeler is for each kind (two classes, abstaining
allowed), and its posteriors train the final span classifier, a logistic
regression on votes and shape. Candidates that it accepts and that touch no base
span are added.

Defined cases: null texts count as empty; texts of any length are searched whole; spans are listed by
kind, then by start; repeated rows are searched each;
further columns are ignored (`find_pii`) or kept (`redact`); an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, written
from .shingles import chunks, text_bytes

KINDS = ("email", "ip", "card", "phone", "ident")
LABELERS = ("pattern", "checksum", "gazetteer", "context", "edges")

# Base patterns. Possessive repeats and look-behind keep them linear on long runs
# without changing their leftmost matches.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Looser candidates
_SPELLED = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?[(\[{]\x20?at\x20?[)\]}]\x20?[A-Za-z0-9-]{1,64}"
    r"(?:\x20?(?:\.|[(\[{]\x20?dot\x20?[)\]}])\x20?[A-Za-z0-9-]{1,64}){1,4}", re.I)
_LOCAL_PHONE = re.compile(r"(?<![0-9+.)-])\(?[0-9]{3}\)?[-.\x20][0-9]{3}[-.\x20][0-9]{4}(?![0-9-])")
_IDENT = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")

# Gazetteer and context words
_DOMAINS = frozenset("com org net edu gov io co de fr es uk eu info biz example".split())
_RESERVED = re.compile(r"(0|10|127|255|192\.168|169\.254)\.")
_ISSUER = re.compile(r"4|5[1-5]|2[2-7]|3[47]|6011|65")
_CUES = {
    "email": re.compile(r"e-?mail|contact|correo|courriel|write to|kontakt", re.I),
    "ip": re.compile(r"\bip\b|address|host|server|client|adresse", re.I),
    "card": re.compile(r"card|visa|master|karte|carte|tarjeta|payment", re.I),
    "phone": re.compile(r"phone|tel\b|tel[.:e]|call|fax|mobil|anruf|appel|llam", re.I),
    "ident": re.compile(r"ssn|social|security|ident|passport|ausweis|dni", re.I),
}
_AGAINST = re.compile(r"version|isbn|order|invoice|page|section|chapter|\bv$|build|serial", re.I)
CONTEXT = 30


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += (d * 2 - 9 * (d > 4)) if i % 2 else d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            end = found.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of the base patterns, by kind and start."""
    out = [(0, a, b) for a, b in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_digits(m[0])) <= 15:
            out.append((3, m.start(), m.end()))
    return out


def _looser(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    found = [(0, m.start(), m.end()) for m in _SPELLED.finditer(text)] if re.search(r"[(\[{]\x20?at", text, re.I) else []
    found += [(2, m.start(), m.end()) for m in _CARD.finditer(text) if 13 <= len(_digits(m[0])) <= 19]
    found += [(3, m.start(), m.end()) for m in _LOCAL_PHONE.finditer(text)]
    found += [(4, m.start(), m.end()) for m in _IDENT.finditer(text)]
    taken = sorted((a, b) for _, a, b in base)
    starts = [a for a, _ in taken]
    out: list[tuple[int, int, int]] = []

    def free(a: int, b: int) -> bool:
        i = bisect_left(starts, b)
        return not any(taken[j][1] > a for j in range(max(0, i - 4), i))

    end = -1
    for kind, a, b in sorted(found, key=lambda x: (x[1], -x[2], x[0])):
        if a >= end and free(a, b):
            out.append((kind, a, b))
            end = b
    return out


def votes(text: str, kind: int, start: int, end: int, strict: bool) -> str:
    """The pattern of a candidate: kind, five votes (0 no, 1 abstain, 2 yes), length bin."""
    span, digits, name = text[start:end], _digits(text[start:end]), KINDS[kind]
    checksum = gazetteer = 1
    if name == "email":
        gazetteer = 2 if re.split(r"[.\x20(\[{)\]}]+", span.rstrip(")]} "))[-1].lower() in _DOMAINS else 0
    elif name == "ip":
        checksum, gazetteer = 2, 0 if _RESERVED.match(span) else 1
    elif name == "card":
        checksum = 2 if luhn(digits) else 0
        gazetteer = 2 if _ISSUER.match(digits) else 0
    elif name == "phone":
        checksum = 2 if 8 <= len(digits) <= 15 else 0
        gazetteer = 2 if "+" in span or "(" in span else 1
    else:
        checksum = 0 if digits[:3] in ("000", "666") or digits[:1] == "9" or digits[5:] == "0000" else 2
    before = text[max(0, start - CONTEXT):start]
    context = 2 if _CUES[name].search(before) else 0 if _AGAINST.search(before) else 1
    edges = 0 if (start and text[start - 1].isalnum()) or (end < len(text) and text[end].isalnum()) else 2
    return f"{kind}{2 if strict else 0}{checksum}{gazetteer}{context}{edges}{min((end - start) // 6, 9)}"


@dataclass(frozen=True)
class SpanModel:
    """Reliabilities by kind and labeler (probability of yes, given a personal
    span and given none, among votes cast) and the classifier's verdicts."""

    reliability: dict
    accepted: frozenset
    probability: dict


def fit_spans(counts: dict[str, int], *, rounds: int = 50, threshold: float = 0.5) -> SpanModel:
    """EM over the counted patterns, then a logistic regression on its posteriors."""
    patterns = sorted(counts)
    if not patterns:
        return SpanModel({}, frozenset(), {})
    n = np.array([counts[p] for p in patterns], dtype=float)
    kind = np.array([int(p[0]) for p in patterns])
    vote = np.array([[int(c) for c in p[1:6]] for p in patterns])
    post = np.clip((vote - 1).sum(axis=1) / 5 * 0.5 + 0.5, 0.02, 0.98)
    reliability = {}
    for _ in range(rounds):
        score = np.zeros(len(patterns))
        for k in np.unique(kind):
            own = kind == k
            yes, no = (n * post)[own], (n * (1 - post))[own]
            logit = np.log((yes.sum() + 1) / (no.sum() + 1)) * np.ones(own.sum())
            for j, name in enumerate(LABELERS):
                v = vote[own, j]
                # one pseudo-count a side keeps a labeler better than chance
                p = (yes[v == 2].sum() + 2) / (yes[v != 1].sum() + 3)
                q = (no[v == 2].sum() + 1) / (no[v != 1].sum() + 3)
                reliability[(KINDS[k], name)] = (p, q)
                logit += np.where(v == 2, np.log(p / q), np.where(v == 0, np.log((1 - p) / (1 - q)), 0.0))
            score[own] = logit
        post = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
    x = np.column_stack([
        np.ones(len(patterns)), *((vote == v) for v in (0, 2)), *((kind == k) for k in range(len(KINDS))),
        np.array([int(p[6]) for p in patterns]) / 9])
    w = np.zeros(x.shape[1])
    share = n / n.sum() + 1 / len(patterns) * 0.01  # rare patterns count a little too
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (share * (p - post)) + 1e-3 * w
        w -= np.linalg.solve(x.T @ (x * (share * p * (1 - p))[:, None]) + 1e-3 * np.eye(len(w)), grad)
    p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
    return SpanModel(reliability, frozenset(a for a, b in zip(patterns, p) if b >= threshold),
                     dict(zip(patterns, p.tolist(), strict=True)))


_DIGIT_OR_AT = np.zeros(256, dtype=np.int64)
_DIGIT_OR_AT[48:58] = 1
_DIGIT_OR_AT[[64, 40, 91, 123]] = 1


def _candidates(text: str) -> list[tuple[int, int, int, bool, str]]:
    base = base_spans(text)
    rows = [(k, a, b, True, votes(text, k, a, b, True)) for k, a, b in base]
    return rows + [(k, a, b, False, votes(text, k, a, b, False)) for k, a, b in _looser(text, base)]


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, str]]:
    """(row, text) of the rows that can hold anything: those with a digit, an at
    sign or an opening bracket."""
    data, offsets = text_bytes(batch.column(column))
    texts = batch.column(column)
    for a, b in chunks(offsets):
        some = np.concatenate([[0], np.cumsum(_DIGIT_OR_AT[data[offsets[a]:offsets[b]]])])
        ends = offsets[a:b + 1] - offsets[a]
        for i in np.flatnonzero(np.diff(some[ends]) > 0):
            yield a + int(i), texts[a + int(i)].as_py()


_SPAN = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()),
                   ("pattern", pa.string())])


def _search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: list = [[]] * batch.num_rows
        for i, text in _texts(batch, 1):
            rows[i] = [dict(zip(("kind", "start", "end", "base", "pattern"), c, strict=True)) for c in _candidates(text)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(_SPAN))], names=["id", "found"])


def _join(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def _candidate_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    kind = dict(docs.dtypes)[id_col]
    found = lean(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        _search, f"id {kind}, found array<struct<kind:int,start:bigint,end:bigint,base:boolean,pattern:string>>")
    return written(found, "pii-candidates")


def _fit(found: DataFrame) -> SpanModel:
    # at most 5 kinds * 3^5 votes * 10 lengths different patterns
    counts = found.select(F.explode("found.pattern").alias("p")).groupBy("p").count().collect()
    return fit_spans({r["p"]: r["count"] for r in counts})


def find_pii(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: its id, n_email, n_ip, n_card, n_phone (base
    spans), n_added, base_sha256 and spans (all spans, by kind and start)."""
    found = _candidate_table(docs, id_col, text_col)
    accepted = _fit(found).accepted

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for spans in batch.column(1).to_pylist():
                base = [(s["kind"], s["start"], s["end"]) for s in spans if s["base"]]
                more = [(s["kind"], s["start"], s["end"]) for s in spans if not s["base"] and s["pattern"] in accepted]
                counts = [sum(k == j for k, _, _ in base) for j in range(4)]
                out.append((*counts, len(more), hashlib.sha256(_join(base).encode()).hexdigest(), _join(base + more)))
            cols = list(zip(*out, strict=True)) if out else [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in cols[:5]), *(pa.array(c, pa.string()) for c in cols[5:])],
                names=["id", "n_email", "n_ip", "n_card", "n_phone", "n_added", "base_sha256", "spans"])

    kind = dict(docs.dtypes)[id_col]
    return found.mapInArrow(digest, f"id {kind}, n_email long, n_ip long, n_card long, n_phone long, n_added long, "
                                    "base_sha256 string, spans string").withColumnRenamed("id", id_col)


def redact(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with every span replaced by its kind in brackets. The model is
    fitted on all documents first; the texts are then read once more."""
    accepted = _fit(_candidate_table(docs, id_col, text_col)).accepted
    place = docs.columns.index(text_col)

    def replace(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            changed = {}
            for i, text in _texts(batch, place):
                spans = sorted((a, b, k) for k, a, b, base, p in _candidates(text) if base or p in accepted)
                if spans:
                    out, at = [], 0
                    for a, b, k in spans:
                        if a >= at:
                            out += [text[at:a], f"[{KINDS[k].upper()}]"]
                        at = max(at, b)
                    changed[i] = "".join(out) + text[at:]
            if not changed:
                yield batch
                continue
            texts = batch.column(place).to_pylist()
            for i, t in changed.items():
                texts[i] = t
            columns = list(batch.columns)
            columns[place] = pa.array(texts, batch.column(place).type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return lean(docs).mapInArrow(replace, docs.schema)
