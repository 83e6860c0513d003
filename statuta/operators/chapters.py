"""Assigning sections to chapters, and keeping the first of repeated sections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..functions.text import leading_int


def assign_chapters(sections: DataFrame, ranges: DataFrame, selected: list[str] | None = None) -> DataFrame:
    """``sections`` (doc_id, ord, num, ...) with chapter_roman and chapter_heading.

    The first range that holds the number wins, else the nearest one (ties: the
    first).  Documents with ranges lose sections without a number; documents
    without any keep all, as NA / Unknown.  The join is on doc_id with a
    document's few chapters on one side; ranges of a row are compared in an
    aggregate, so the sections' other columns don't multiply.
    """
    best = ranges.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("ord", "start", "end", "roman", "heading"))).alias("ranges"))
    n = F.col("__n")
    distance = lambda r: F.when((r.start <= n) & (n <= r.end), F.lit(-1)).otherwise(F.least(F.abs(n - r.start), F.abs(n - r.end)))
    df = sections.join(best, "doc_id", "left").withColumn("__n", leading_int("num"))
    pick = F.array_min(F.transform("ranges", lambda r: F.struct(distance(r).alias("d"), r.ord.alias("ord"), r.roman.alias("roman"), r.heading.alias("heading"))))
    df = df.withColumn("__pick", F.when(n.isNotNull(), pick))
    df = df.withColumn("chapter_roman", F.coalesce("__pick.roman", F.lit("NA"))).withColumn("chapter_heading", F.coalesce("__pick.heading", F.lit("Unknown")))
    df = df.where(F.col("ranges").isNull() | (F.col("chapter_roman") != "NA"))
    if selected is not None:
        df = df.where(F.col("chapter_roman").isin(selected))
    return df.drop("ranges", "__n", "__pick")


def in_ranges(sections: DataFrame, ranges: DataFrame) -> DataFrame:
    """All matches of sections with ranges that hold their number; overlapping ranges give several rows."""
    r = ranges.select("doc_id", F.col("ord").alias("chapter_ord"), "roman", F.col("heading").alias("chapter_heading"), "start", "end")
    return sections.join(r, "doc_id").where(leading_int("num").between(F.col("start"), F.col("end")))


def unassigned(sections: DataFrame, ranges: DataFrame) -> DataFrame:
    """Sections whose number no range holds, compared by number."""
    return sections.join(in_ranges(sections, ranges).select("doc_id", "num").distinct(), ["doc_id", "num"], "left_anti")


def first_of_each(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in the given order."""
    return df.withColumn("__rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__rn = 1").drop("__rn")
