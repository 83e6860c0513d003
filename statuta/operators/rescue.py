"""Rescuing tables: page runs, regions, sentinels, splicing, trailing schedules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..functions import text as T

SENTINEL = "<<TABLE_REGION:%d>>"
SENTINEL_LINE = r"^([ \t]*)<<TABLE_REGION:(\d+)>>[ \t]*$"


def flagged_pages(replies: DataFrame) -> DataFrame:
    """(doc_id, page_no) of pages whose reply starts with YES; fails for a document whose replies are all errors."""
    per_doc = Window.partitionBy("doc_id")
    failed = F.bool_and(F.col("reply").startswith("ERROR:")).over(per_doc)
    checked = replies.withColumn("yes", F.when(failed, F.raise_error(F.lit("all pages of a document failed"))).otherwise(F.upper(T.strip("reply")).startswith("YES")))
    return checked.where("yes").select("doc_id", "page_no")


def page_runs(pages: DataFrame) -> DataFrame:
    """(doc_id, region_id, pages): runs of consecutive pages, numbered from 0."""
    order = Window.partitionBy("doc_id").orderBy("page_no")
    runs = pages.select("doc_id", "page_no").distinct().withColumn("run", F.col("page_no") - F.row_number().over(order))
    regions = runs.groupBy("doc_id", "run").agg(F.sort_array(F.collect_list("page_no")).alias("pages"))
    return regions.select("doc_id", (F.row_number().over(Window.partitionBy("doc_id").orderBy("run")) - 1).alias("region_id"), "pages")


def build_regions(runs: DataFrame, ocr_pages: DataFrame) -> DataFrame:
    """(doc_id, region_id, pages, markdown): runs with the text of their pages; runs without text go, their ids stay unused."""
    each = runs.select("doc_id", "region_id", "pages", F.explode("pages").alias("page_no")).join(ocr_pages, ["doc_id", "page_no"])
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("page_no", "markdown"))), lambda x: x.markdown), "\n\n")
    return each.groupBy("doc_id", "region_id", "pages").agg(T.strip(joined).alias("markdown")).where("markdown <> ''")


def place_sentinels(pages: DataFrame, regions: DataFrame) -> DataFrame:
    """``pages`` (doc_id, page_no, text): a region's first page becomes its sentinel, its other pages empty."""
    at = regions.select("doc_id", "region_id", F.posexplode("pages").alias("place", "page_no"))
    df = pages.join(at, ["doc_id", "page_no"], "left")
    text = F.when(F.col("region_id").isNull(), F.col("text")).when(F.col("place") == 0, F.concat(F.lit("\n<<TABLE_REGION:"), F.col("region_id").cast("string"), F.lit(">>\n"))).otherwise("")
    return df.select("doc_id", "page_no", text.alias("text"))


def splice(markups: DataFrame, blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(``markups`` with sentinel lines replaced by their blocks, (doc_id, region_id) of the blocks used).

    ``markups`` has doc_id, ord, markup; blocks (doc_id, region_id, block) take the sentinel's
    indent.  Unknown ids and sentinels inside a line stay."""
    lines = markups.select("doc_id", "ord", F.posexplode(F.split("markup", "\n")).alias("line_no", "line"))
    number = F.regexp_extract("line", SENTINEL_LINE, 2)
    lines = lines.withColumn("region_id", number.try_cast("int")).withColumn("indent", F.regexp_extract("line", SENTINEL_LINE, 1))
    joined = lines.join(blocks, ["doc_id", "region_id"], "left")
    used = joined.where("block is not null").select("doc_id", "region_id").distinct()
    line = F.when(F.col("block").isNotNull(), T.indented(F.col("block"), F.col("indent"))).otherwise(F.col("line"))
    whole = joined.withColumn("out", line).groupBy("doc_id", "ord").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line_no", "out"))), lambda x: x.out), "\n").alias("markup"))
    return markups.drop("markup").join(whole, ["doc_id", "ord"]), used


def schedule_heading(regions: DataFrame) -> DataFrame:
    """``regions`` with heading: the first of the first 25 lines that reads like a schedule's heading, or a default."""
    cleaned = F.transform(F.slice(T.split_lines("markdown"), 1, 25), lambda x: T.strip(F.regexp_replace(F.regexp_replace(T.strip(x), r"^[“\"']+", ""), r"[”\"']+\z", "")))
    found = F.transform(cleaned, lambda x: F.coalesce(*[F.nullif(F.regexp_extract(x, p, 1), F.lit("")) for p in T.SCHEDULE_HEADINGS]))
    first = F.get(F.filter(found, lambda x: x.isNotNull()), F.lit(0))
    span = F.concat(F.col("pages")[0].cast("string"), F.when(F.size("pages") > 1, F.concat(F.lit("-"), F.element_at("pages", -1).cast("string"))).otherwise(""))
    return regions.withColumn("heading", F.coalesce(T.strip(first), F.concat(F.lit("Schedule (rescued from page "), span, F.lit(")"))))


def schedules(regions: DataFrame, blocks: DataFrame, used: DataFrame) -> DataFrame:
    """Entries of kind schedule for regions that no section took up."""
    left = schedule_heading(regions.join(used, ["doc_id", "region_id"], "left_anti")).join(blocks, ["doc_id", "region_id"], "left")
    markup = F.concat(F.lit("SCHEDULE - "), F.col("heading"), F.lit("\n"), T.indented(F.coalesce("block", F.lit("")), F.lit("  ")))
    return left.select("doc_id", F.col("region_id").alias("ord"), F.lit("schedule").alias("kind"), F.concat(F.lit("SCH_R"), F.col("region_id").cast("string")).alias("num"), markup.alias("markup"), F.lit("SCHEDULE").alias("chapter_roman"), F.col("heading").alias("chapter_heading"), "pages")


def missing_pages(wanted: DataFrame, cache: DataFrame) -> DataFrame:
    """Pages (doc_id, mtime, page_no) that the cache doesn't hold for the document's present mtime."""
    return wanted.join(cache.select("doc_id", "mtime", "page_no").distinct(), ["doc_id", "mtime", "page_no"], "left_anti")


def cached_pages(wanted: DataFrame, cache: DataFrame) -> DataFrame:
    return wanted.join(cache, ["doc_id", "mtime", "page_no"]).select("doc_id", "page_no", "markdown")
