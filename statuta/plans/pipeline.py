"""From pages to markup: the whole flow as DataFrames over a corpus of documents."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import chapters, convert, mdtable, rescue, sections, sinks, toc
from ..sources.scans import join_pages, lines_of
from ..sources.recognition import page_images, recognise_pages
from ..sources.transport import Transport, analyze, classify_pages


@dataclass
class Services:
    """What depends on a document format or a service: pages of a document, one page as a document, images, recognition, vision."""

    count: Callable[[bytes], int]
    cut: Callable[[bytes, int], bytes]
    read: Callable[[bytes], str]
    render: Callable[[bytes, list[int], float], list[bytes]] | None = None
    ask: Callable[[bytes], str] | None = None
    pages: Callable[[bytes], list[str | None]] | None = None
    transport: Transport | None = None
    analyse: Callable[[str, str], str] | None = None


@dataclass
class Settings:
    log: str
    model: str = "rules"
    document: str = "Legislative Document"
    compat: bool = True
    selected: list[str] | None = None
    lanes: int = 4


def parse(pages: DataFrame, compat: bool = True, selected: list[str] | None = None) -> dict[str, DataFrame]:
    """Contents, ranges, and sections with content and chapter, of pages (doc_id, page_no, text)."""
    texts = join_pages(pages)
    lines = lines_of(texts)
    entries = toc.parse_toc(lines)
    ends = toc.toc_ends(entries)
    ranges = toc.chapter_ranges(lines, ends)
    listed = toc.toc_sections(entries)
    body = lines.join(ends, "doc_id", "left").where("line_no > coalesce(toc_end, 0)")
    body = body.groupBy("doc_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line_no", "line"))), lambda x: x.line), "\n").alias("body"))
    content = sections.extract_sections(body, listed, compat)
    placed = chapters.first_of_each(chapters.assign_chapters(content, ranges, selected), ["doc_id", "num"], ["ord"])
    return {"texts": texts, "lines": lines, "toc": entries, "ranges": ranges, "listed": listed, "body": body, "sections": placed, "gaps": toc.toc_gaps(listed)}


def table_texts(documents: DataFrame, mode: str, services: Services, cache: str, declared: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(pages with tables (doc_id, page_no), their recognised text (doc_id, page_no, markdown)) of ``documents`` (doc_id, mtime, content).

    ``mode``: declared takes the pages of ``declared`` (doc_id, page_no), full takes all
    pages, auto those of which the vision service says that they hold a table.
    """
    if mode not in ("declared", "auto", "full"):
        raise ValueError(f"no table mode {mode!r}")
    if (mode == "declared") != (declared is not None):
        raise ValueError("mode declared and declared pages go together")

    def numbers(frames):
        for pdf in frames:
            yield pdf[["doc_id"]].assign(n_pages=[services.count(bytes(c)) for c in pdf["content"]])

    if mode == "declared":
        tables = declared.select("doc_id", "page_no").distinct()
    else:
        counted = documents.select("doc_id", "content").mapInPandas(numbers, "doc_id long, n_pages int").where("n_pages > 0")
        tables = counted.select("doc_id", F.explode(F.sequence(F.lit(1), F.col("n_pages"))).alias("page_no"))
    if mode == "auto":
        images = page_images(documents, tables, services.count, services.render)
        tables = rescue.flagged_pages(classify_pages(images, services.ask))

    def cut(frames):
        for pdf in frames:
            yield pdf[["doc_id", "mtime", "page_no"]].assign(document=[services.cut(bytes(c), int(p)) for c, p in zip(pdf["content"], pdf["page_no"], strict=True)])

    wanted = documents.join(tables, "doc_id").mapInPandas(cut, "doc_id long, mtime timestamp, page_no int, document binary")
    return tables, recognise_pages(wanted, services.read, cache)


def analyze_corpus(texts: DataFrame, ask: Callable[[str, str], str], path: str, types: tuple[str, ...] = ("summary", "json")) -> DataFrame:
    """Analyses of ``texts`` (doc_id, text) written under ``path``, and their summaries (doc_id, json); failures are collected in them."""
    analyze(texts, ask, types).write.mode("overwrite").parquet(f"{path}/results")
    results = texts.sparkSession.read.parquet(f"{path}/results")
    sinks.save_analyses(results, f"{path}/analyses")
    return sinks.analysis_summaries(texts, results, f"{path}/analyses")


def convert_corpus(pages: DataFrame, settings: Settings, transport: Transport | None = None, ocr_pages: DataFrame | None = None, table_pages: DataFrame | None = None) -> dict[str, DataFrame]:
    """``parse`` plus regions, converted entries, markup texts and metadata.

    Without a transport, sections are converted by rules.  ``table_pages`` (doc_id,
    page_no) with their recognised text ``ocr_pages`` (doc_id, page_no, markdown) are
    rescued as tables."""
    spark = pages.sparkSession
    regions = None
    if table_pages is not None and ocr_pages is not None:
        regions = rescue.build_regions(rescue.page_runs(table_pages), ocr_pages)
        pages = rescue.place_sentinels(pages, regions)
    out = parse(pages, settings.compat, settings.selected)
    work = out["sections"]
    if transport is None:
        done = work.select("doc_id", "ord", "num", convert.rule_markup(F.col("num"), F.col("heading"), F.col("content")).alias("markup"))
        errors = spark.createDataFrame([], "doc_id long")
    else:
        hashed = convert.with_hash(work)
        log = convert.run_conversion(work, transport, settings.model, settings.log, settings.document, settings.lanes)
        done = hashed.select("doc_id", "ord", "num", "content_hash").join(log.select("doc_id", "num", "content_hash", "markup"), ["doc_id", "num", "content_hash"]).select("doc_id", "ord", "num", "markup")
        errors = hashed.select("doc_id", "num").join(done, ["doc_id", "num"], "left_anti")
    entries = done.join(work.select("doc_id", "num", "chapter_roman", "chapter_heading"), ["doc_id", "num"], "left").withColumns({"kind": F.lit("section"), "pages": F.lit(None).cast("array<int>"), "chapter_roman": F.coalesce("chapter_roman", F.lit("NA")), "chapter_heading": F.coalesce("chapter_heading", F.lit("Unknown"))})
    if regions is not None:
        blocks = mdtable.render_regions(regions, ["doc_id", "region_id"])
        entries, used = rescue.splice(entries, blocks)
        entries = entries.unionByName(rescue.schedules(regions, blocks, used), allowMissingColumns=True)
        out |= {"regions": regions, "blocks": blocks}
    return out | {"converted": entries, "errors": errors, "markup": sinks.markup_texts(entries), "metadata": sinks.metadata(entries, errors)}
