"""Secret scans with multipart credential linking.

Strong spans are found by pattern alone:

* ``assign``: a named secret with its value (value of 6+ characters)
* ``access``: an access identifier (20+ characters)
* ``hex``: a hexadecimal run (24+ characters)

Weak candidates of three parts are found beside them: ``identifier`` (a user or
client name, or a short access identifier), ``secret`` (a mixed run that looks
random) and ``endpoint`` (a host with a scheme or port).  One alone is common in
clean text, so a weak candidate is reported only when complementary parts occur
within one scope: its interval, widened by ``REACH`` characters and cut at blank
lines, must overlap a secret part (weak or strong), and the secret part itself
needs an identifier or an endpoint.  The interval join sorts the spans of a text
by start and sweeps them once; a credential never crosses documents, so the join
needs no shuffle.

Texts are scanned whole, in Arrow batches bounded by bytes.  Spans count code
points, end exclusive.

Defined results: a null text is empty and has no spans; rows are judged each,
repeated or not; an empty table gives an empty table; only ``id_col`` and
``text`` are read.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

STRONG = ("assign", "access", "hex")
WEAK = ("identifier", "secret", "endpoint")
KINDS = STRONG + WEAK
SECRET_KINDS = frozenset({0, 2, 4})  # assign, hex, secret; the others name or place one
REACH = 200
MASK = "<secret>"

_ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_HEX_LONG = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")

_IDENTIFIER = re.compile(
    r"\b(?:user(?:name)?|login|client_?id|account|access_?key_?id)[\"']?\x20*[:=]\x20*[\"']?"
    r"[A-Za-z0-9@._-]{3,}|\bA[KS]IA[A-Z0-9]{8,}", re.IGNORECASE | re.ASCII)
_SECRET = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{16,}={0,2}", re.ASCII)
_ENDPOINT = re.compile(
    r"\b(?:https?|s3|ftp|ssh|jdbc|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\s\"'<>]+"
    r"|\bhost(?:name)?[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9.-]{3,}", re.IGNORECASE | re.ASCII)
_BREAK = re.compile(r"\n[ \t\r]*\n")

Span = tuple[int, int, int]  # start, kind index, end


def strong_spans(text: str) -> list[Span]:
    spans = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    spans += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    # a run of hex digits is maximal, so filtering by length equals matching long runs
    spans += [(m.start(), 2, m.end()) for m in _HEX_LONG.finditer(text)]
    return spans


def _random_looking(s: str) -> bool:
    digits = sum(c.isdigit() for c in s)
    upper = sum(c.isupper() for c in s)
    lower = sum(c.islower() for c in s)
    return digits >= 2 and upper >= 2 and lower >= 2


def _outside(spans: list[Span], strong: list[Span]) -> list[Span]:
    """Spans that do not overlap a strong one."""
    merged: list[list[int]] = []
    for s, _, e in sorted(strong):
        if merged and s < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([s, e])
    ends = [e for _, e in merged]
    out = []
    for p in spans:
        k = bisect_right(ends, p[0])
        if k == len(merged) or merged[k][0] >= p[2]:
            out.append(p)
    return out


def weak_spans(text: str, strong: list[Span], reach: int = REACH) -> list[Span]:
    """Weak candidates whose complementary parts lie in the same scope."""
    found = [(m.start(), 3, m.end()) for m in _IDENTIFIER.finditer(text)]
    found += [(m.start(), 5, m.end()) for m in _ENDPOINT.finditer(text)]
    if not found and not any(k == 1 for _, k, _ in strong):
        return []  # a secret alone is no credential
    found += [(m.start(), 4, m.end()) for m in _SECRET.finditer(text)
              if _random_looking(m.group())]
    found = _outside(found, strong)
    if not found:
        return []
    breaks = [m.start() for m in _BREAK.finditer(text)]
    out: set[Span] = set()
    # parts within reach, by role; spans of a kind do not overlap, so these are few
    near: tuple[list, list] = ([], [])
    scope = 0
    for part in sorted(found + strong):
        start, kind, end = part
        if scope < len(breaks) and breaks[scope] < start:
            scope = bisect_left(breaks, start)
            near = ([], [])
        is_secret = kind in SECRET_KINDS
        others = [p for p in near[not is_secret] if p[2] + reach >= start]
        near[not is_secret][:] = others
        if others:
            out.update(p for p in (*others, part) if p[1] >= len(STRONG))
        near[is_secret].append(part)
    return list(out)


def find_spans(text: str | None) -> list[Span]:
    """All spans of a text by start, then kind as listed in ``KINDS``."""
    if not text:
        return []
    strong = strong_spans(text)
    return sorted(strong + weak_spans(text, strong))


def spell(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def mask(text: str, spans: list[Span], by: str = MASK) -> str:
    """``text`` with every span (overlapping ones together) replaced."""
    out, at = [], 0
    for s, _, e in spans:
        if s >= at:
            out += [text[at:s], by]
        at = max(at, e)
    return "".join([*out, text[at:]]) if spans else text


def scan(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``id_col, n_assign, n_access, n_hex, n_weak, base_sha256, spans`` per row."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: list[list[int]] = [[] for _ in range(len(STRONG) + 1)]
            digests, spelled = [], []
            for text in batch.column(1).to_pylist():
                spans = find_spans(text)
                base = [s for s in spans if s[1] < len(STRONG)]
                for i in range(len(STRONG)):
                    counts[i].append(sum(k == i for _, k, _ in base))
                counts[-1].append(len(spans) - len(base))
                digests.append(hashlib.sha256(spell(base).encode()).hexdigest())
                spelled.append(spell(spans))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.int64()) for c in counts],
                 pa.array(digests, pa.string()), pa.array(spelled, pa.string())],
                names=[id_col, "n_assign", "n_access", "n_hex", "n_weak", "base_sha256", "spans"])

    return docs.select(id_col, "text").mapInArrow(
        judge, f"`{id_col}` {id_type}, n_assign long, n_access long, n_hex long, n_weak long, "
               "base_sha256 string, spans string")


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with spans masked in ``text_col``; texts without spans stay as they are.

    ``length_col``, if given and present, becomes the new length of a changed text.
    """
    columns = docs.columns
    sized = length_col if length_col in columns else None

    text_at, size_at = columns.index(text_col), columns.index(sized) if sized else None

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_at).to_pylist()
            found = [find_spans(t) for t in texts]
            changed = pa.array([bool(spans) for spans in found], pa.bool_())
            if changed.true_count:
                texts = [mask(t, spans) if spans else t for t, spans in zip(texts, found)]
                arrays = list(batch.columns)
                arrays[text_at] = pa.array(texts, batch.schema.field(text_at).type)
                if sized:  # lengths of changed texts only; nothing passes through floats
                    new = pa.array([len(t) if spans else None for t, spans in zip(texts, found)], pa.int64())
                    arrays[size_at] = pc.if_else(changed, new.cast(arrays[size_at].type), arrays[size_at])
                batch = pa.RecordBatch.from_arrays(arrays, schema=batch.schema)
            yield batch

    return docs.mapInArrow(clean, docs.schema)
