"""Tables of contents and chapter ranges as window expressions over the lines of a document.

All windows share the partition and order (doc_id, line_no), so they share one
exchange and one sort; the lines of an entry are gathered once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..functions import text as T


def _doc():
    return Window.partitionBy("doc_id")


def _order():
    return _doc().orderBy("line_no")


def _so_far():
    return _order().rowsBetween(Window.unboundedPreceding, 0)


def toc_start(lines: DataFrame) -> DataFrame:
    """(doc_id, toc_start, title): the line after the first marker (0 if none), and the first line that's no divider."""
    s = T.strip("line")
    return lines.groupBy("doc_id").agg(
        F.coalesce(F.min(F.when(s.rlike(T.TOC_MARKER), F.col("line_no"))) + 1, F.lit(0)).cast("int").alias("toc_start"),
        F.min_by(s, F.when((s != "") & ~s.rlike(T.DIVIDER), F.col("line_no"))).alias("title"),
    )


def _chapter_lines(lines: DataFrame, start: Column) -> DataFrame:
    """Adds s, next, roman, active (a chapter line that is read), taken (its heading line) and valid.

    A chapter line takes the next line with it; of chapter lines in a row from ``start``, every other one is read."""
    df = lines.withColumn("s", T.strip("line")).withColumn("next", F.lead("s").over(_order()))
    df = df.withColumn("roman", F.when(F.col("line_no") >= start, F.regexp_extract("s", T.CHAPTER, 1)).otherwise(""))
    other = F.when(F.col("roman") == "", F.col("line_no"))
    df = df.withColumn("in_row", F.col("line_no") - F.coalesce(F.last(other, ignorenulls=True).over(_so_far()), F.lit(-1)))
    df = df.withColumn("active", (F.col("roman") != "") & (F.col("in_row") % 2 == 1))
    df = df.withColumn("taken", F.coalesce(F.lag("active").over(_order()), F.lit(False)))
    good = F.coalesce((F.col("next") != "") & (F.col("next") != "SECTIONS") & ~T.is_digits(F.col("next")), F.lit(False))
    return df.withColumn("valid", F.col("active") & good)


def parse_toc(lines: DataFrame) -> DataFrame:
    """(doc_id, line_no, kind, roman, num, num_int, heading, last_line): chapters and sections of the table of contents.

    Chapters without a valid heading have a null heading; they end the table all the same."""
    s = T.strip("line")
    df = lines.withColumn("toc_start", F.coalesce(F.min(F.when(s.rlike(T.TOC_MARKER), F.col("line_no"))).over(_doc()) + 1, F.lit(0)))
    df = df.withColumn("title", F.min_by(s, F.when((s != "") & ~s.rlike(T.DIVIDER), F.col("line_no"))).over(_doc()))
    df = _chapter_lines(df, F.col("toc_start"))
    read = (F.col("line_no") >= F.col("toc_start")) & ~F.col("taken")
    known = F.count_if("valid").over(Window.partitionBy("doc_id", "next").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)) > 0
    stop = read & (((F.lower("s") == F.lower("title")) & (F.col("line_no") > 10)) | (F.col("s").rlike(T.ANY_CHAPTER) & F.col("next").isNotNull() & known))
    df = df.withColumn("stop", F.min(F.when(stop, F.col("line_no"))).over(_doc()))
    ends = (F.col("s") == "") | F.col("s").rlike(r"(?U)^\d+[A-Za-z]*\.\s+") | F.col("s").rlike(r"(?iu)^(CHAPTER|PART)\s+") | (T.is_upper(F.col("s")) & (F.length("s") > 10)) | T.is_digits(F.col("s")) | F.col("s").rlike(T.SCHEDULE_LINE)
    kept = read & (F.col("stop").isNull() | (F.col("line_no") < F.col("stop")))
    is_section = ~F.col("active") & (F.regexp_extract("s", T.SECTION, 1) != "")
    # Entries are lines that end the one before, so each heads a group; only the lines after a section's go with it.
    df = df.withColumn("ends", ends).withColumn("entry", F.when(kept & F.col("active"), 1).when(kept & is_section, 2).otherwise(0))
    df = df.withColumn("group", F.count_if("ends").over(_so_far())).withColumn("of", F.last(F.when(F.col("ends"), F.col("entry")), ignorenulls=True).over(_so_far()))
    df = df.where((F.col("ends") & (F.col("entry") > 0)) | (~F.col("ends") & (F.col("of") == 2)))
    df = df.groupBy("doc_id", "group").agg(
        F.min_by(F.struct("line_no", "s", "next", "roman", "active", "valid"), "line_no").alias("head"),
        F.sort_array(F.collect_list(F.when(~F.col("ends"), F.struct("line_no", "s")))).alias("more"),
    ).select("doc_id", "head.*", "more")
    num = F.regexp_extract("s", T.SECTION, 1)
    heading = F.concat_ws(" ", F.array(T.strip(F.regexp_extract("s", T.SECTION, 2))), F.transform("more", lambda x: x.s))
    return df.select(
        "doc_id", F.col("line_no").cast("int").alias("line_no"),
        F.when(F.col("active"), "chapter").otherwise("section").alias("kind"),
        F.when(F.col("active"), F.col("roman")).alias("roman"),
        F.when(~F.col("active"), num).alias("num"),
        F.when(~F.col("active"), T.leading_int(num)).alias("num_int"),
        F.when(F.col("valid"), F.col("next")).when(~F.col("active"), F.regexp_replace(heading, r"\.+$", "")).alias("heading"),
        (F.col("line_no") + F.when(F.col("active"), 1).otherwise(F.size("more"))).cast("int").alias("last_line"),
    )


def chapters(toc: DataFrame) -> DataFrame:
    rows = toc.where("kind = 'chapter' and heading is not null")
    return rows.select("doc_id", F.row_number().over(Window.partitionBy("doc_id").orderBy("line_no")).alias("ord"), "roman", "heading")


def toc_sections(toc: DataFrame) -> DataFrame:
    rows = toc.where("kind = 'section'")
    return rows.select("doc_id", F.row_number().over(Window.partitionBy("doc_id").orderBy("line_no")).alias("ord"), "num", "num_int", "heading")


def toc_ends(toc: DataFrame) -> DataFrame:
    """(doc_id, toc_end): the last line of the last entry."""
    return toc.groupBy("doc_id").agg(F.max_by("last_line", "line_no").alias("toc_end"))


def toc_gaps(sections: DataFrame) -> DataFrame:
    """(doc_id, gap_start, gap_end): numbers that consecutive sections skip."""
    prev = F.lag("num_int").over(Window.partitionBy("doc_id").orderBy("ord"))
    return sections.where("num_int is not null").withColumn("prev", prev).where("num_int - prev > 1").select("doc_id", (F.col("prev") + 1).alias("gap_start"), (F.col("num_int") - 1).alias("gap_end"))


def chapter_ranges(lines: DataFrame, ends: DataFrame | None = None) -> DataFrame:
    """(doc_id, ord, roman, heading, start, end): per chapter the least and largest number of its sections.

    ``ends`` (doc_id, toc_end) bounds the lines that are read; by default all are.
    Chapters without a section give no row."""
    if ends is not None:
        lines = lines.join(ends, "doc_id").where("line_no <= toc_end + 1")
    df = _chapter_lines(lines, F.lit(0))
    if ends is not None:
        df = df.where("line_no <= toc_end")
    chapter = F.struct(F.col("line_no").alias("at"), "roman", F.col("next").alias("heading"))
    df = df.withColumn("chapter", F.last(F.when(F.col("valid"), chapter), ignorenulls=True).over(_so_far()))
    number = T.leading_int(F.regexp_extract("s", r"(?U)^(\d+[A-Za-z]*)\.\s+", 1))
    numbered = df.where(~F.col("active") & ~F.col("taken") & F.col("chapter").isNotNull()).withColumn("n", number).where("n is not null")
    out = numbered.groupBy("doc_id", "chapter").agg(F.min("n").alias("start"), F.max("n").alias("end"))
    return out.select("doc_id", F.row_number().over(Window.partitionBy("doc_id").orderBy("chapter.at")).alias("ord"), "chapter.roman", "chapter.heading", "start", "end")
