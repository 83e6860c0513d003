"""Cutting a document's text into sections.

The search for a heading starts where the last heading that was found ends, so
it is a fold over the sections of a document: documents are independent and
run in parallel, one document's text in memory at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_pages

SCHEMA = "doc_id long, ord int, num string, heading string, content string, start int, end int, match_type string, similarity double"
#: How far the similarity search looks, and what it accepts.
FUZZY_WINDOW, FUZZY_LEAST = 5000, 0.80
_NUMBERED = re.compile(r"(\d+[A-Za-z]*\.\s*.+?)[—–]", re.DOTALL)
_NUMBER = re.compile(r"\d+[A-Za-z]*\.\s*")
_DOT = re.compile(r"\.(?=\s)")

#: Characters of contents that leave a task at once.
BATCH_CHARS = 4 << 20


def similarity(a: str, b: str) -> float:
    """Ratio of matching blocks of two headings, without case and closing punctuation."""
    return SequenceMatcher(None, *(x.lower().strip().rstrip(".,;:-–—") for x in (a, b))).ratio()


class Searcher:
    """Finds headings in one document; the last answer is remembered, as a section's end is the next one's start.

    ``numbers`` are those that will be asked for.  Where each of them stands last is
    noted in one pass, so that a number that doesn't come any more takes no pass of its own.
    """

    def __init__(self, text: str, numbers: Iterable[str] = ()):
        self.text, self.low = text, text.lower()
        # Lower-casing may lengthen a text; offsets are those of the lowered text, as in compatible mode.
        self.known: tuple[tuple[str, str, int] | None, tuple | None] = None, None
        self.last: dict[str, int] = dict.fromkeys(numbers, -1)
        self.heads: dict[str, int] = {}
        widths = sorted({len(n) for n in self.last})
        for m in _DOT.finditer(text) if widths else ():
            for width in widths:
                at = m.start() - width
                if at < 0:
                    break
                if (num := text[at : m.start()]) in self.last:
                    self.last[num] = at
                    if at and text[at - 1] == "\n":
                        self.heads[num] = at

    def find(self, num: str, heading: str, start: int) -> tuple[int, int, str, float | None] | None:
        key = num, heading, start
        if key != self.known[0]:
            self.known = key, self._exact(heading, start) or self._numbered(num, start) or self._similar(heading, start)
        return self.known[1]

    def line(self, num: str, start: int) -> int | None:
        """Where the next line that begins with the number and a point follows, at its break."""
        if num in self.last and self.heads.get(num, -1) <= start:
            return None
        m = re.compile(rf"\n{re.escape(num)}\.\s").search(self.text, start)
        return m and m.start()

    def _exact(self, heading: str, start: int):
        want = heading.lower()
        at = self.low.find(want, start)
        while at >= 0:
            end = at + len(heading)
            if any(c in self.text[end : end + 10] for c in "\n—–-"):
                return at, end, "exact", None
            at = self.low.find(want, at + 1)
        return None

    def _numbered(self, num: str, start: int):
        # Not anchored on the left: 1. is found in 11. as well.
        if self.last.get(num, start) < start:
            return None
        m = re.compile(rf"{re.escape(num)}\.\s+(.+?)(?:\n|$)").search(self.text, start)
        return m and (m.start(), m.end(), "simple_pattern", None)

    def _similar(self, heading: str, start: int):
        best = None
        for m in _NUMBERED.finditer(self.text[start : start + FUZZY_WINDOW]):
            other = _NUMBER.sub("", m[1].strip(), count=1)
            if other:
                s = similarity(heading, other)
                if s >= FUZZY_LEAST and (best is None or s > best[3]):
                    best = start + m.start(), start + m.end(), "similarity", s
        return best


def _sliced(text: str, sections: list[tuple[int, str, str]], compat: bool, missing: bool) -> Iterator[tuple]:
    """The rows of ``slice_document`` one after another; with ``missing`` only those whose heading isn't found."""
    search, at = Searcher(text, (num for _, num, _ in sections)), 0
    for k, (ord_, num, heading) in enumerate(sections):
        hit = search.find(num, heading, at)
        if hit is None:
            gone = "Repealed" in heading or "Omitted" in heading
            yield ord_, num, heading, "[Repealed/Omitted]" if gone else "", None, None, None, None
            continue
        at, end = hit[1], len(text)
        if missing:
            continue
        if k + 1 < len(sections):
            _, after, next_heading = sections[k + 1]
            ahead = search.find(after, next_heading, at)
            if ahead:
                end = ahead[0]
            elif (head := search.line(after, at)) is not None:
                end = head
        content = text[hit[0] : end].strip()
        if not compat and k + 1 < len(sections):
            content = re.sub(rf"\n\s*{re.escape(sections[k + 1][1])}\.\s*$", "", content)
        content = re.sub(r"\d+\[", "[", re.sub(r"\n\d+\n", "\n", content))
        yield ord_, num, heading, content, hit[0], hit[1], hit[2], hit[3]


def slice_document(text: str, sections: list[tuple[int, str, str]], compat: bool = True) -> list[tuple]:
    """(ord, num, heading, content, start, end, match_type, similarity) for each (ord, num, heading), in order.

    A section runs from its heading to the next section's heading, with that
    one's number at its end; with ``compat=False`` it ends before the number.
    If the next heading isn't found either, it runs to the end of the text.
    """
    return list(_sliced(text, sections, compat, False))


def extract_sections(bodies: DataFrame, sections: DataFrame, compat: bool = True, missing: bool = False) -> DataFrame:
    """Content of each section (doc_id, ord, num, heading) in the text after the contents (doc_id, body).

    The text is cleaned first, by built-in functions; documents without a body get empty contents.
    With ``missing`` only sections whose heading isn't in the text give rows, and no other contents
    are made: a section before a missing one may run to the end of its document, so all
    contents of a document can come to far more than its text.  They leave a task in parts
    of about ``BATCH_CHARS``."""
    columns = [c.split()[0] for c in SCHEMA.split(", ")]
    cleaned = bodies.select("doc_id", clean_pages("body").alias("body"))

    def one(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        doc_id, text, listed = None, None, []
        for pdf in frames:
            doc_id = pdf["doc_id"].iat[0]
            entry = pdf["ord"].notna()
            if text is None and not entry.all():
                text = pdf["body"][~entry].iat[0] or ""
            listed += zip(pdf["ord"][entry].astype(int).tolist(), pdf["num"][entry], pdf["heading"][entry], strict=True)
        listed.sort(key=lambda x: x[0])
        rows, chars = [], 0

        def frame() -> pd.DataFrame:
            return pd.DataFrame([(doc_id, *r) for r in rows], columns=columns).astype({"start": "Int64", "end": "Int64"})

        for row in _sliced(text or "", listed, compat, missing):
            rows.append(row)
            chars += 100 + len(row[3])
            if chars > BATCH_CHARS:
                yield frame()
                rows, chars = [], 0
        yield frame()

    toc = sections.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ord").cast("int").alias("ord"), "num", "heading", F.lit(None).cast("string").alias("body"))
    texts = cleaned.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(None).cast("int").alias("ord"), F.lit(None).cast("string").alias("num"), F.lit(None).cast("string").alias("heading"), "body")
    return toc.unionByName(texts).groupBy("doc_id").applyInPandas(one, SCHEMA)
