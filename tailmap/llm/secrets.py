"""Secret scan: fixed patterns, and sliding-window entropy over candidate strings.

Fixed kinds are ``assign``, ``access`` and ``hex``.  The method adds kind ``entropy``: in a candidate (a run of characters of
one class) a window moves by one character at a time, its counts and the sum of c * log2(c) changing by one step each, and
windows of high Shannon entropy are joined into spans.  The allow-list names whole candidates that are left alone, and
placeholder words: a window that holds one is not suspicious.  A span inside a fixed one is left out, as is one inside a span
of an earlier class.  Offsets are code points, ends exclusive.

Defined results: a null text is empty; texts of any length are scanned whole, in time proportional to their length; repeated
rows and null ids get a row each; an empty table gives an empty table; other columns stay as they are.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "entropy")

# Patterns and least lengths of the fixed kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_LEAST, ACCESS_LEAST = 12, 18
ASSIGN_WORDS = ("passw", "secret", "token", "api")

#: Characters of a window, and the classes: candidates, and the least bits a character of a suspicious window.
WINDOW = 20
CLASSES = ((re.compile(r"[0-9A-Fa-f]{%d,}" % WINDOW), 3.0), (re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % WINDOW), 4.0))
#: Candidates that are no secrets: without a digit or without a letter, and UUIDs.
ALLOWED = tuple(re.compile(p) for p in (r"[^0-9]*\Z", r"[^A-Za-z]*\Z", r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}\Z"))
#: What shows that the characters around it are made up.
PLACEHOLDER = re.compile(r"example|placeholder|changeme|your[_-]|xxxx|deadbeef|0123456789abcdef", re.IGNORECASE)

_TERM = [0.0] + [c * math.log2(c) for c in range(1, WINDOW + 1)]


def hot_windows(text: str, bits: float, window: int = WINDOW) -> list[tuple[int, int]]:
    """Spans made of the windows whose entropy is at least ``bits`` a character; one pass, counts changed in place."""
    counts: dict[str, int] = {}
    total, spans = 0.0, []
    most = window * (math.log2(window) - bits)
    for i, c in enumerate(text):
        n = counts.get(c, 0)
        counts[c] = n + 1
        total += _TERM[n + 1] - _TERM[n]
        if i >= window:
            out = text[i - window]
            n = counts[out]
            counts[out] = n - 1
            total += _TERM[n - 1] - _TERM[n]
        if i >= window - 1 and total <= most + 1e-9:
            start = i - window + 1
            if spans and start <= spans[-1][1]:
                spans[-1] = (spans[-1][0], i + 1)
            else:
                spans.append((start, i + 1))
    return spans


def without_placeholders(text: str) -> list[tuple[int, int]]:
    """The parts of a candidate between its placeholder words; whole windows fit in them."""
    cuts = [m.span() for m in PLACEHOLDER.finditer(text)]
    return [(s, e) for s, e in zip([0, *(e for _, e in cuts)], [*(s for s, _ in cuts), len(text)], strict=True) if e - s >= WINDOW]


def outside(spans: list[tuple[int, int]], others: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans that lie in none of the others, both by start; each list is gone through once.

    Of the others that begin no later than a span, the one that reaches farthest decides.
    """
    out, reach, i = [], -1, 0
    for s, e in spans:
        while i < len(others) and others[i][0] <= s:
            reach = max(reach, others[i][1])
            i += 1
        if e > reach:
            out.append((s, e))
    return out


def spans_of(text: str) -> list[tuple[int, int, str]]:
    """All spans (start, end, kind) by start, then kind as listed."""
    low = text.lower()
    found = []
    if any(w in low for w in ASSIGN_WORDS):
        found += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    found += [(*m.span(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found += [(*m.span(), "hex") for m in HEX.finditer(text)]
    known = sorted((s, e) for s, e, _ in found)
    for candidates, bits in CLASSES:
        hot = []
        for m in candidates.finditer(text):
            if not any(a.match(m[0]) for a in ALLOWED):
                hot += [(m.start() + at + s, m.start() + at + e) for at, to in without_placeholders(m[0]) for s, e in hot_windows(m[0][at:to], bits)]
        new = outside(hot, known)
        found += [(s, e, "entropy") for s, e in new]
        known = sorted(known + new)
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())])


def _span_lists(texts: pa.Array) -> pa.Array:
    return pa.array([[dict(zip(("start", "end", "kind"), s, strict=True)) for s in spans_of(t or "")] for t in texts.to_pylist()], pa.list_(_SPAN))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan_secrets(docs: DataFrame, *, text_col: str = "text", out_col: str = "secret_spans") -> DataFrame:
    """``docs`` with the array of spans added (start, end, kind); a column of that name is replaced."""
    spans = F.arrow_udf(_span_lists, "array<struct<start:bigint,end:bigint,kind:string>>")
    return docs.withColumn(out_col, spans(F.col(text_col).cast("string")))


def secret_digests(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    rows = scan_secrets(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), out_col="found").select("doc_id", "found")
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("found", lambda s: s["kind"] != "entropy")
    return rows.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"))


def redact_secrets(docs: DataFrame, *, text_col: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of the text replaced by the mask; overlapping spans count as one."""

    def redacted(texts: pa.Array) -> pa.Array:
        out = []
        for t in texts.to_pylist():
            if t is not None:
                parts, at = [], 0
                for s, e, _ in spans_of(t):
                    if s >= at:
                        parts += [t[at:s], mask]
                    at = max(at, e)
                t = "".join([*parts, t[at:]])
            out.append(t)
        return pa.array(out, pa.string())

    return docs.withColumn(text_col, F.arrow_udf(redacted, "string")(F.col(text_col).cast("string")))
