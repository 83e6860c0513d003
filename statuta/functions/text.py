"""Column helpers for text: trimming, line splitting and the cleanup of extracted pages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Where a text breaks into lines.
LINE_BREAKS = "\\r\\n|[\\n\\r\\x0b\\f\\x1c-\\x1e\\x85\\u2028\\u2029]"

# Patterns that find the parts of an Act.
TOC_MARKER = r"(?iu)^(ARRANGEMENT\s+OF\s+(SECTIONS|CLAUSES)|TABLE\s+OF\s+CONTENTS|CONTENTS)\s*$"
CHAPTER = r"^(?:CHAPTER|PART)\s+([IVXLCA]+)$"
ANY_CHAPTER = r"(?d)^(CHAPTER|PART)\s+.+$"
SECTION = r"(?Ud)^(\d+[A-Za-z]*)\.\s+(.+)$"
DIVIDER = r"^[_\-=*~]{3,}$"
SCHEDULE_LINE = r"(?iu)^THE\s+[A-Z]*\s*SCHEDULE"
SCHEDULE_HEADINGS = (
    r"^(THE\s+[A-Z]+\s+SCHEDULE)\b",
    r"^(SCHEDULE\s+[IVX0-9]+[A-Z]*)\b",
    r"^(FORM\s+(?:No\.?\s*)?[A-Z0-9]+)\b",
    r"^(APPENDIX\s+[IVX0-9]+[A-Z]*)\b",
    r"^(ANNEX(?:URE)?\s+[IVX0-9]+[A-Z]*)\b",
)
RETRYABLE = ("429", "rate limit", "ReadTimeout", "read timed out", "timeout", "timed out", "ConnectionError", "connection error", "connection reset", "connection aborted", "broken pipe", "remote disconnected", "service unavailable", "bad gateway", "gateway timeout", "500", "502", "503", "504", "internal server error")
#: Page artefacts in the order of their removal.
CLEANUPS = (
    (r"(?U)\n\s*\d+\s*\n", "\n"),
    (r"(?iuU)THE GAZETTE OF INDIA\s*\n", "\n"),
    (r"(?iuU)EXTRAORDINARY\s*\n", "\n"),
    (r"(?iuU)PART \w+[-–—]\w+\s*\n", "\n"),
    (r"(?iuU)Section \w+\s*\n", "\n"),
    (r"(?iudU)\[.*\d{4}\]\s*\n", "\n"),
    (r"(?U)(\n|^)\s*\d+\[(\d+[A-Za-z]*\.)", "$1$2"),
    (r"(?U)(\d+[A-Za-z]*\.)\]", "$1"),
    (r"\n{3,}", "\n\n"),
)


def strip(c: Column | str) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+\z", "")


def split_lines(c: Column | str) -> Column:
    """The lines of a text; a break at its end makes no further line."""
    parts = F.split(F.regexp_replace(c, LINE_BREAKS, "\n"), "\n")
    return F.when(F.length(c) == 0, F.array().cast("array<string>")).otherwise(F.when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts))


def is_upper(c: Column) -> Column:
    return (c == F.upper(c)) & (c != F.lower(c))


def is_digits(c: Column) -> Column:
    return c.rlike(r"(?U)^\d+$")


def leading_int(c: Column | str) -> Column:
    return F.regexp_extract(c, r"^(\d+)", 1).try_cast("int")


def clean_pages(c: Column | str) -> Column:
    """A text without page numbers, gazette headers and footnote marks."""
    out = F.col(c) if isinstance(c, str) else c
    for pattern, by in CLEANUPS:
        out = F.regexp_replace(out, pattern, by)
    return strip(out)


def clean_section(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r"(?U)\n\d+\n", "\n"), r"(?U)\d+\[", "[")


def indented(block: Column, indent: Column) -> Column:
    """Each line of a block that isn't empty behind ``indent``."""
    return F.array_join(F.transform(F.split(block, "\n"), lambda x: F.when(x == "", x).otherwise(F.concat(indent, x))), "\n")


def page_span(pages: Column) -> Column:
    return F.when(F.size(pages) == 1, F.concat(F.lit("page "), pages[0].cast("string"))).otherwise(F.concat(F.lit("pages "), pages[0].cast("string"), F.lit("-"), F.element_at(pages, -1).cast("string")))


def retryable(c: Column | str) -> Column:
    """Whether an error message names a passing fault."""
    low = F.lower(c)
    return F.exists(F.array(*[F.lit(k.lower()) for k in RETRYABLE]), lambda k: F.contains(low, k))


def data_url(png: Column | str) -> Column:
    """Base64 data URL of an image; base64 output must not be chunked (spark.sql.chunkBase64String.enabled=false)."""
    return F.concat(F.lit("data:image/png;base64,"), F.regexp_replace(F.base64(png), "\r\n", ""))
