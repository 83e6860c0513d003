"""Sources: pages of documents, page specifications, environment files."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import split_lines, strip


def page_scan(spark: SparkSession, paths: str | list[str], read_pages: Callable[[bytes], list[str | None]]) -> DataFrame:
    """(path, mtime, page_no, text) of binary documents; ``read_pages`` turns one into its pages' texts."""
    files = spark.read.format("binaryFile").load(paths).select("path", F.col("modificationTime").alias("mtime"), "content")

    def run(frames):
        import pandas as pd

        for pdf in frames:
            rows = [(path, mtime, n, text or "") for path, mtime, content in zip(pdf["path"], pdf["mtime"], pdf["content"], strict=True) for n, text in enumerate(read_pages(content), 1)]
            yield pd.DataFrame(rows, columns=["path", "mtime", "page_no", "text"])

    return files.mapInPandas(run, "path string, mtime timestamp, page_no int, text string")


def text_scan(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, text) of whole text files."""
    return spark.read.option("wholetext", True).text(paths).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def join_pages(pages: DataFrame) -> DataFrame:
    """(doc_id, text): a document's pages by number, joined by a line break; null pages are empty."""
    ordered = F.sort_array(F.collect_list(F.struct("page_no", F.coalesce("text", F.lit("")).alias("text"))))
    return pages.groupBy("doc_id").agg(F.array_join(F.transform(ordered, lambda x: x.text), "\n").alias("text"))


def lines_of(texts: DataFrame) -> DataFrame:
    """(doc_id, line_no, line), numbered from 0."""
    return texts.select("doc_id", F.posexplode(split_lines("text")).alias("line_no", "line"))


def page_counts(pages: DataFrame) -> DataFrame:
    return pages.groupBy("doc_id").agg(F.count("*").alias("n_pages"))


def page_spec(spec: Column) -> Column:
    """The pages of a specification such as 10,12-15 as a sorted array; fails on anything else."""
    parts = F.filter(F.transform(F.split(spec, ","), strip), lambda x: x != "")

    def one(x: Column) -> Column:
        low, high = F.regexp_extract(x, r"^(\d+)(?:\s*-\s*(\d+))?$", 1).try_cast("int"), F.regexp_extract(x, r"^(\d+)(?:\s*-\s*(\d+))?$", 2).try_cast("int")
        high = F.coalesce(high, low)
        bad = low.isNull() | (low < 1) | (high < low)
        return F.when(bad, F.raise_error(F.concat(F.lit("not a page or range: "), x)).cast("array<int>")).otherwise(F.sequence(F.coalesce(low, F.lit(1)), F.when(bad, F.coalesce(low, F.lit(1))).otherwise(high)))

    return F.array_sort(F.array_distinct(F.flatten(F.transform(parts, one))))


def select_pages(pages: DataFrame, wanted: DataFrame) -> DataFrame:
    """The pages (doc_id, page_no, ...) that ``wanted`` names; fails for one that isn't there."""
    df = wanted.join(pages.withColumn("__there", F.lit(True)), ["doc_id", "page_no"], "left")
    there = F.when(F.col("__there").isNull(), F.raise_error(F.concat(F.lit("no page "), F.col("page_no").cast("string")))).otherwise(F.col("__there"))
    return df.withColumn("__there", there).where("__there").drop("__there")


def read_env(path: str) -> dict[str, str]:
    """Assignments of an environment file; blank lines and comments are skipped, quotes around values go."""
    out = {}
    for raw in Path(path).read_text(encoding="utf-8").splitlines():
        line = raw.strip()
        if line and not line.startswith("#") and "=" in line:
            name, _, value = line.partition("=")
            out[name.strip()] = value.strip().strip('"').strip("'")
    return out


def ocr_markdown(response: Column | str) -> Column:
    """The text of a recognition service's JSON reply: its pages' markdown that isn't empty, joined by a line break."""
    pages = F.from_json(response, "pages array<struct<markdown: string>>").pages
    return F.array_join(F.filter(F.transform(pages, lambda p: p.markdown), lambda m: m.isNotNull() & (m != "")), "\n")


def tolerant_json(reply: Column | str) -> Column:
    """A reply's JSON text: the reply itself or what stands between its first { and its last }; null if neither parses."""
    inner = F.nullif(F.regexp_extract(reply, r"(?s)(\{.*\})", 1), F.lit(""))
    parsed = lambda c: F.when(F.try_parse_json(c).isNotNull(), c)
    return F.coalesce(parsed(F.col(reply) if isinstance(reply, str) else reply), parsed(inner))
