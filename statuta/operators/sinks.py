"""Markup, metadata and debugging outputs as one string or row each, and writers that use Spark's commit protocol."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..functions.text import page_span
from ..sources.scans import tolerant_json

RULE = "=" * 80


def markup_texts(converted: DataFrame) -> DataFrame:
    """(doc_id, text) of entries (doc_id, ord, kind, markup, chapter_roman, chapter_heading, pages).

    A header stands wherever the chapter differs from the entry's before; schedules come last under one divider."""
    plan = Window.partitionBy("doc_id", F.col("kind") == "schedule").orderBy("ord")
    roman, heading = F.coalesce("chapter_roman", F.lit("NA")), F.coalesce("chapter_heading", F.lit("Unknown"))
    first = F.row_number().over(plan) == 1
    changed = first | (F.lag(roman).over(plan) != roman)
    header = F.when(changed, F.concat(F.lit("\n\nCHAPTER "), roman, F.lit("\n"), heading, F.lit(f"\n{RULE}\n\n"))).otherwise("")
    divider = F.when(first, F.lit(f"\n\n{RULE}\nSCHEDULES\n{RULE}\n\n")).otherwise("")
    source = F.when(F.size(F.coalesce("pages", F.array().cast("array<int>"))) > 0, F.concat(F.lit("# Source: "), page_span(F.col("pages")), F.lit("\n"))).otherwise("")
    schedule = F.col("kind") == "schedule"
    df = converted.withColumn("piece", F.concat(F.when(schedule, F.concat(divider, source)).otherwise(header), "markup", F.lit("\n\n")))
    pieces = F.sort_array(F.collect_list(F.struct(F.when(schedule, 1).otherwise(0).alias("late"), "ord", "piece")))
    return df.groupBy("doc_id").agg(F.array_join(F.transform(pieces, lambda x: x.piece), "").alias("text"))


def metadata(converted: DataFrame, errors: DataFrame, doc_meta: DataFrame | None = None) -> DataFrame:
    """(doc_id, sections_converted, chapters, errors, document, act_number, replaces); schedules count as sections and as one chapter."""
    counts = converted.groupBy("doc_id").agg(F.count("*").alias("sections_converted"), F.count_distinct(F.coalesce("chapter_roman", F.lit("NA"))).alias("chapters"))
    failed = errors.groupBy("doc_id").agg(F.count("*").alias("errors"))
    out = counts.join(failed, "doc_id", "left").withColumn("errors", F.coalesce("errors", F.lit(0)).cast("long"))
    if doc_meta is None:
        return out.withColumns({c: F.lit(None).cast("string") for c in ("document", "act_number", "replaces")})
    return out.join(doc_meta, "doc_id", "left")


def metadata_json(meta: DataFrame) -> DataFrame:
    """(doc_id, json): absent and empty optional values are left out."""
    cleaned = meta.withColumns({c: F.nullif(c, F.lit("")) for c in ("document", "act_number", "replaces")})
    fields = [F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("conversion_date"), *[c for c in cleaned.columns if c != "doc_id"]]
    return cleaned.select("doc_id", F.to_json(F.struct(*fields)).alias("json"))


def chapter_tree(ranges: DataFrame, matches: DataFrame) -> DataFrame:
    """Per chapter its sections: (doc_id, ord, roman, heading, start, end, section_count, sections)."""
    each = matches.groupBy("doc_id", F.col("chapter_ord").alias("ord")).agg(F.count("*").alias("section_count"), F.sort_array(F.collect_list(F.struct(F.col("ord").alias("at"), "num", "heading"))).alias("sections"))
    return ranges.join(each, ["doc_id", "ord"], "left").withColumn("section_count", F.coalesce("section_count", F.lit(0)).cast("long"))


def tsv_rows(sections: DataFrame) -> DataFrame:
    """(doc_id, num, heading, content) with breaks as blanks, for a tab-separated listing."""
    flat = lambda c: F.replace(F.replace(c, F.lit("\n"), F.lit(" ")), F.lit("\t"), F.lit(" "))
    return sections.select("doc_id", "num", flat(F.col("heading")).alias("heading"), flat(F.col("content")).alias("content"))


def region_report(regions: DataFrame, blocks: DataFrame) -> DataFrame:
    """(doc_id, region_id, report): a region's pages, its text as read and as rendered."""
    df = regions.join(blocks, ["doc_id", "region_id"], "left")
    head = F.concat(F.lit(f"{RULE}\nREGION "), F.col("region_id").cast("string"), F.lit("  ("), page_span(F.col("pages")), F.lit(f")\n{RULE}\n\n"))
    return df.select("doc_id", "region_id", F.concat(head, F.lit("--- read ---\n"), "markdown", F.lit("\n\n--- rendered ---\n"), F.coalesce("block", F.lit("(none)")), F.lit("\n\n")).alias("report"))


def save_analyses(results: DataFrame, path: str) -> None:
    """Analyses (doc_id, analysis_type, result, error) as JSON lines, a folder a type; a result of type json is kept as the JSON it holds."""
    parsed = F.when(F.col("analysis_type") == "json", tolerant_json("result"))
    results.withColumn("parsed", parsed).write.mode("overwrite").partitionBy("analysis_type").json(path)


def analysis_summaries(texts: DataFrame, results: DataFrame, path: str) -> DataFrame:
    """(doc_id, json): length of the text, the analyses that ran, where they are, and the errors; documents without one have empty lists."""
    done = results.groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.when(F.col("error").isNull(), F.col("analysis_type")))).alias("analyses_performed"),
        F.sort_array(F.collect_list(F.when(F.col("error").isNotNull(), F.concat_ws(": ", "analysis_type", "error")))).alias("errors"),
    )
    none = F.array().cast("array<string>")
    df = texts.select("doc_id", F.length(F.coalesce("text", F.lit(""))).alias("extracted_text_length")).join(done, "doc_id", "left")
    df = df.withColumns({c: F.coalesce(c, none) for c in ("analyses_performed", "errors")})
    files = F.transform("analyses_performed", lambda t: F.concat(F.lit(f"{path}/analysis_type="), t)).alias("files_generated")
    whole = F.struct((F.size("errors") == 0).alias("analysis_complete"), "extracted_text_length", "analyses_performed", files, "errors", F.date_format(F.current_timestamp(), "yyyyMMdd_HHmmss").alias("timestamp"))
    return df.select("doc_id", F.to_json(whole).alias("json"))


def progress(log: DataFrame, total: int, seconds: float) -> DataFrame:
    """One row: done, failed, percent of ``total``, mean seconds a section and seconds left, after ``seconds`` of work."""
    done = log.agg(F.count_if(F.col("status") == "ok").alias("done"), F.count_if(F.col("status") != "ok").alias("failed"))
    mean = F.try_divide(F.lit(float(seconds)), "done")
    return done.withColumns({"percent": F.round(100 * F.try_divide("done", F.lit(total)), 1), "mean_seconds": mean, "seconds_left": mean * (F.lit(total) - F.col("done"))})


def write_texts(texts: DataFrame, path: str, column: str = "text") -> None:
    """One folder with one text file, which ends in a line break, for each document; the commit protocol makes it all or nothing.

    For up to some ten thousand documents; write larger corpora as tables of (doc_id, text).
    """
    texts.select("doc_id", F.col(column).alias("value")).repartition("doc_id").write.mode("overwrite").partitionBy("doc_id").text(path)


def append_tsv(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").option("sep", "\t").option("quote", "").csv(path)


def html_report(summary: DataFrame) -> DataFrame:
    """(doc_id, html): a small page for each document of (doc_id, analysis_type, result, error)."""
    esc = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    row = F.concat(F.lit("<tr><td>"), esc(F.col("analysis_type")), F.lit("</td><td>"), esc(F.coalesce("result", "error", F.lit(""))), F.lit("</td></tr>"))
    rows = F.array_join(F.sort_array(F.collect_list(row)), "")
    return summary.groupBy("doc_id").agg(F.concat(F.lit("<!DOCTYPE html><html><body><table>"), rows, F.lit("</table></body></html>")).alias("html"))
