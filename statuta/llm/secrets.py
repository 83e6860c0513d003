"""Secret scans: patterns, and Shannon entropy in sliding windows.

Spans are in code points, end exclusive.  Kinds, in the order of ties:

* assign: a key word, an assignment and a value of 8 or more characters
* access: an access key id of 16 or more characters
* hex: 32 or more lower-case hex digits
* entropy: in a candidate (a run of 20 or more base64 or URL characters), the
  stretches covered by windows whose entropy is at least the limit of a
  character class (hex: 3.0 bits over 32 characters, alphanumeric: 3.7 over 24,
  base64: 4.2 over 32), taken in each maximal run of 20 or more characters of
  that class.  In a shorter run the window is the run and the limit goes
  down with the logarithm of its length.

Window entropies come from counts that change by one character in and one out.
Runs that match the allow-list (UUIDs, repeated or ordered alphabets, paths and
host names of plain words, capitalised and hyphenated words) give no entropy
span.  Letters alone pass as words if all or few (one and a quarter) of them are
capitals and, from ``LONG_WORD`` letters on, a quarter are vowels.  Where a span of another
kind lies, a candidate ends; what is left of it on both sides is judged.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

KINDS = ("assign", "access", "hex", "entropy")

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_LONG_HEX = re.compile(r"[0-9a-f]{32,}")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")

#: Per character class: its runs, window length and least entropy in bits.
CLASSES = (("hex", re.compile(r"[0-9a-fA-F]{20,}"), 32, 3.0), ("alnum", re.compile(r"[A-Za-z0-9]{20,}"), 24, 3.7), ("base64", _CANDIDATE, 32, 4.2))

ALLOWED = (
    re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"),
    re.compile(r"[0-9_=+/-]+"),
    re.compile(r"(.)\1*"),
    re.compile(r"(.{1,8}?)\1{2,}.{0,8}"),
)

_WORDS = re.compile(r"/?([A-Za-z]+[0-9]{0,4}[-_/=+]+)*[A-Za-z]*[0-9]{0,4}/?")
_LETTERS = re.compile(r"[A-Za-z]+")
LONG_WORD = 16


def _allowed(run: str) -> bool:
    if any(p.fullmatch(run) for p in ALLOWED):
        return True
    if not _WORDS.fullmatch(run):
        return False
    return all(_is_word(w) for w in _LETTERS.findall(run))


def _is_word(w: str) -> bool:
    capitals = sum(c.isupper() for c in w)
    return (capitals == len(w) or 4 * (capitals - 1) <= len(w)) and (len(w) < LONG_WORD or 4 * sum(w.lower().count(v) for v in "aeiouy") >= len(w))


def _entropy_windows(text: str, size: int, least: float) -> list[tuple[int, int]]:
    """The stretches of ``text`` covered by windows of ``size`` characters with that entropy (if shorter: all of it, and a limit for its length)."""
    if len(text) < size:
        least *= math.log2(len(text)) / math.log2(size)
        size = len(text)
    log = [0.0] + [n * math.log2(n) for n in range(1, size + 1)]
    count: dict[str, int] = {}
    total = 0.0
    out: list[tuple[int, int]] = []
    for end, c in enumerate(text, 1):
        n = count.get(c, 0)
        count[c] = n + 1
        total += log[n + 1] - log[n]
        if end > size:
            old = text[end - size - 1]
            n = count[old]
            count[old] = n - 1
            total += log[n - 1] - log[n]
        if end >= size and math.log2(size) - total / size >= least:
            start = end - size
            if out and start <= out[-1][1]:
                out[-1] = out[-1][0], end
            else:
                out.append((start, end))
    return out


def _high(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """The stretches of high entropy, of any class, of the part of a candidate from ``start`` to ``end``."""
    if end - start < 20 or _allowed(text[start:end]):
        return []
    every = []
    for _, runs, size, least in CLASSES:
        for m in runs.finditer(text, start, end):
            if not _allowed(m[0]):
                every += [(m.start() + a, m.start() + b) for a, b in _entropy_windows(m[0], size, least)]
    out: list[tuple[int, int]] = []
    for a, b in sorted(every):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def spans_of(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind as an index of KINDS, end), sorted."""
    if not text:
        return []
    out = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8] if ":" in text or "=" in text else []
    out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16] if "AKIA" in text else []
    out += [(m.start(), 2, m.end()) for m in _LONG_HEX.finditer(text)]
    base = sorted(out)
    at = 0
    for m in _CANDIDATE.finditer(text):
        start, found = m.start(), []
        # Base spans are sorted by start; those that end before a candidate don't meet a later one either.
        while at < len(base) and base[at][2] <= start:
            at += 1
        for a, _, b in [*base[at:], (m.end(), 0, m.end())] if at < len(base) else [(m.end(), 0, m.end())]:
            if a > start:
                found += _high(text, start, min(a, m.end()))
            start = max(start, b)
            if a >= m.end():
                break
        out += [(a, 3, b) for a, b in found]
    return sorted(out)


def scan_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex (long), base_sha256 and spans per row of ``docs`` (doc_id, text).

    spans lists kind:start:end of all spans by start, then kind, comma-joined;
    base_sha256 is the SHA-256 of that list without entropy spans.  A null text
    counts as empty: no span, and the hash of an empty string.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                found = spans_of(text)
                named = [(k, f"{KINDS[k]}:{a}:{b}") for a, k, b in found]
                n = [sum(k == x for k, _ in named) for x in range(3)]
                rows.append((*n, hashlib.sha256(",".join(s for k, s in named if k < 3).encode()).hexdigest(), ",".join(s for _, s in named)))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            types = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
