"""Pipe tables in markdown: parsing, merging of continuations, rendering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..functions.text import split_lines, strip

SEPARATOR = r"^:?-{3,}:?$"


def split_row(line: Column) -> Column:
    """The trimmed cells of a pipe row; an empty first or last part belongs to the border."""
    parts = F.split(strip(line), r"\|")
    parts = F.when(parts[0] == "", F.slice(parts, F.lit(2), F.size(parts))).otherwise(parts)
    parts = F.when((F.size(parts) > 0) & (F.element_at(F.concat(F.array(F.lit("x")), parts), -1) == ""), F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)
    return F.transform(parts, strip)


def is_separator(cells: Column) -> Column:
    return (F.size(cells) > 0) & F.forall(cells, lambda c: c.rlike(SEPARATOR))


def is_pipe_line(line: Column) -> Column:
    s = strip(line)
    return s.startswith("|") & s.endswith("|")


def parse_tables(regions: DataFrame, keys: list[str], markdown: str = "markdown") -> DataFrame:
    """(keys, tbl_no, headers, rows): a row for each run of pipe lines; ``keys`` name a region."""
    lines = regions.select(*keys, F.posexplode(split_lines(markdown)).alias("line_no", "line")).where(is_pipe_line(F.col("line")))
    order = Window.partitionBy(*keys).orderBy("line_no")
    runs = lines.withColumn("run", F.col("line_no") - F.row_number().over(order))
    runs = runs.groupBy(*keys, "run").agg(F.transform(F.sort_array(F.collect_list(F.struct("line_no", "line"))), lambda x: split_row(x.line)).alias("all"))
    # The first separator splits header and rows; the header is the row above it, what stands above that goes.
    at = F.coalesce(F.expr("array_min(filter(transform(all, (c, i) -> if(size(c) > 0 and forall(c, x -> x rlike '^:?-{3,}:?$'), i, null)), i -> i is not null))"), F.lit(-1))
    runs = runs.withColumn("at", at)
    header = F.when(F.col("at") > 0, F.expr("get(all, at - 1)")).when(F.col("at") < 0, F.expr("get(all, 0)")).otherwise(F.array().cast("array<string>"))
    rows = F.when(F.col("at") >= 0, F.expr("slice(all, at + 2, size(all))")).otherwise(F.expr("slice(all, 2, size(all))"))
    number = F.row_number().over(Window.partitionBy(*keys).orderBy("run"))
    return runs.select(*keys, number.alias("tbl_no"), header.alias("headers"), rows.alias("rows"))


def merge_tables(tables: DataFrame, keys: list[str]) -> DataFrame:
    """Tables whose headers, not empty, equal those of the table before become one with it."""
    order = Window.partitionBy(*keys).orderBy("tbl_no")
    new = F.coalesce((F.lag("headers").over(order) != F.col("headers")) | (F.size("headers") == 0), F.lit(True))
    marked = tables.withColumn("new", new)
    run = F.count_if("new").over(order.rowsBetween(Window.unboundedPreceding, 0))
    parts = marked.withColumn("run", run).groupBy(*keys, "run").agg(F.min_by("headers", "tbl_no").alias("headers"), F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("tbl_no", "rows"))), lambda x: x.rows)).alias("rows"))
    return parts.select(*keys, F.col("run").cast("int").alias("tbl_no"), "headers", "rows")


def _lines_of(row: Column, kind: str, indent: str) -> Column:
    cells = F.flatten(F.transform(row, lambda c: F.array(F.lit(f"{indent}    {kind}"), F.concat(F.lit(f"{indent}      "), c))))
    return F.concat(F.array(F.lit(f"{indent}  TR")), cells)


def render_table(headers: Column, rows: Column, indent: str = "") -> Column:
    """A TABLE block: a TR for each row, TH cells for the header and TC cells below it."""
    head = F.when(F.size(headers) > 0, _lines_of(headers, "TH", indent)).otherwise(F.array().cast("array<string>"))
    body = F.flatten(F.transform(rows, lambda r: _lines_of(r, "TC", indent)))
    return F.array_join(F.concat(F.array(F.lit(f"{indent}TABLE")), head, body), "\n")


def render_fallback(markdown: Column, indent: str = "") -> Column:
    """Text without a table as a single cell that holds its lines that aren't blank."""
    lines = F.filter(split_lines(markdown), lambda x: strip(x) != "")
    inner = F.transform(lines, lambda x: F.concat(F.lit(f"{indent}      "), x))
    return F.array_join(F.concat(F.array(F.lit(f"{indent}TABLE"), F.lit(f"{indent}  TR"), F.lit(f"{indent}    TC")), inner), "\n")


def render_regions(regions: DataFrame, keys: list[str], indent: str = "") -> DataFrame:
    """(keys, block): each region's merged tables, joined by a blank line, or the fallback."""
    merged = merge_tables(parse_tables(regions, keys), keys).select(*keys, "tbl_no", render_table(F.col("headers"), F.col("rows"), indent).alias("block"))
    blocks = merged.groupBy(*keys).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("tbl_no", "block"))), lambda x: x.block), "\n\n").alias("tables"))
    return regions.join(blocks, keys, "left").select(*keys, F.coalesce("tables", render_fallback(F.col("markdown"), indent)).alias("block"))
