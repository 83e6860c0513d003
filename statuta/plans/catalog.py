"""The library's operators bound to the tables of a data directory, with independent SQL for each.

The tables hold no Acts, so they are laid out from the star schema: one Act a
region, one chapter a nation, one section a customer, with the contents first
and the body after.  The SQL of the answers comes from the base tables, not from the lines.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import chapters as C
from ..operators import convert as V
from ..operators import mdtable as M
from ..operators import rescue as R
from ..operators import sections as S
from ..operators import sinks as K
from ..operators import toc
from ..sources import scans
from ..sources.transport import EchoTransport

#: What an Act is made of: chapters in order, sections in order; valid in Spark and in DuckDB.
_RM = """
s AS (
  SELECT n.n_regionkey AS doc_id, n.n_name, r.r_name, c.c_name || ' in ' || c.c_mktsegment AS heading, c.c_mktsegment AS seg,
         row_number() OVER (PARTITION BY n.n_regionkey ORDER BY n.n_nationkey, c.c_custkey) AS num,
         dense_rank() OVER (PARTITION BY n.n_regionkey ORDER BY n.n_nationkey) AS ch,
         row_number() OVER (PARTITION BY n.n_nationkey ORDER BY c.c_custkey) AS in_ch
  FROM customer c JOIN nation n ON c.c_nationkey=n.n_nationkey JOIN region r ON r.r_regionkey=n.n_regionkey),
rm AS (SELECT *, CASE ch WHEN 1 THEN 'I' WHEN 2 THEN 'II' WHEN 3 THEN 'III' WHEN 4 THEN 'IV' ELSE 'V' END AS roman FROM s)"""

_LINES = """
l AS (
  SELECT DISTINCT doc_id, 0 AS part, CAST(0 AS BIGINT) AS num, 0 AS sub, 'THE ' || r_name || ' ACT' AS line FROM rm
  UNION ALL SELECT DISTINCT doc_id, 0, CAST(0 AS BIGINT), 1, 'ARRANGEMENT OF SECTIONS' FROM rm
  UNION ALL SELECT doc_id, 1, num, 0, 'CHAPTER ' || roman FROM rm WHERE in_ch=1
  UNION ALL SELECT doc_id, 1, num, 1, n_name FROM rm WHERE in_ch=1
  UNION ALL SELECT doc_id, 1, num, 2, {toc} FROM rm WHERE {listed}
  UNION ALL SELECT doc_id, 1, num, 3, 'as amended.' FROM rm WHERE {wrapped}
  UNION ALL SELECT DISTINCT doc_id, 2, CAST(0 AS BIGINT), 0, 'THE ' || r_name || ' ACT' FROM rm
  UNION ALL SELECT doc_id, 3, num, 0, 'CHAPTER ' || roman FROM rm WHERE in_ch=1
  UNION ALL SELECT doc_id, 3, num, 1, n_name FROM rm WHERE in_ch=1
  UNION ALL SELECT doc_id, 3, num, 2, CASE WHEN num%13=0 THEN '1[' ELSE '' END || CAST(num AS VARCHAR(20)) || '. ' || heading || '.—The balance is held in ' || seg || '.' FROM rm WHERE {body}
  UNION ALL SELECT doc_id, 3, num, 3, CAST(num AS VARCHAR(20)) FROM rm WHERE num%20=0)
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY part,num,sub)-1 AS line_no, line FROM l"""


def acts_sql(listed: str = "true", wrapped: str = "false", body: str = "true", toc_line: str = "CAST(num AS VARCHAR(20)) || '. ' || heading || '.'") -> str:
    lines = _LINES.format(toc=toc_line, listed=listed, wrapped=wrapped, body=body)
    return f"WITH {_RM}, {lines}"


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def acts(spark: SparkSession, d: str, **kind) -> DataFrame:
    sql = acts_sql(**kind)
    for name in ("customer", "nation", "region"):
        sql = sql.replace(f" {name} ", f" {{{name}}} ")
    lines = spark.sql(sql, **{n: _table(spark, d, n) for n in ("customer", "nation", "region")})
    return lines.select("doc_id", F.col("line_no").cast("int").alias("line_no"), "line")


Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


# ---- text ----------------------------------------------------------------------
_DOC_LINES = "SELECT doc_id, generate_subscripts(ls, 1) - 1 AS line_no, unnest(ls) AS line FROM (SELECT doc_id, CASE WHEN p[len(p)] = '' THEN p[1:len(p)-1] ELSE p END AS ls FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents))"


def _doc_lines(spark: SparkSession, d: str) -> DataFrame:
    return scans.lines_of(_table(spark, d, "documents"))


@query(f"SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, line FROM ({_DOC_LINES})")
def q01_lines_split(spark, d):
    return _doc_lines(spark, d)


@query(f"SELECT doc_id, count(*) AS n_lines, count(*) FILTER (trim(line) = '') AS n_blank, count(*) FILTER (trim(line) = upper(trim(line)) AND trim(line) <> lower(trim(line))) AS n_upper, count(*) FILTER (regexp_full_match(trim(line), '[0-9]+')) AS n_digits, count(*) FILTER (length(trim(line)) > 80) AS n_long FROM ({_DOC_LINES}) GROUP BY doc_id")
def q02_line_predicates(spark, d):
    s = T.strip("line")
    return _doc_lines(spark, d).groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.count_if(s == "").alias("n_blank"), F.count_if(T.is_upper(s)).alias("n_upper"), F.count_if(T.is_digits(s)).alias("n_digits"), F.count_if(F.length(s) > 80).alias("n_long"))


_NUMBERED_TEXT = "replace(text, chr(10), chr(10) || CAST(doc_id % 90 AS VARCHAR(9)) || chr(10))"


@query(f"SELECT doc_id, regexp_replace({_NUMBERED_TEXT}, '\\n\\s*\\d+\\s*\\n', chr(10), 'g') AS cleaned FROM documents")
def q03_clean_page_numbers(spark, d):
    pattern, by = T.CLEANUPS[0]
    return _table(spark, d, "documents").select("doc_id", F.regexp_replace(F.expr(_NUMBERED_TEXT), pattern, by).alias("cleaned"))


_HEADED = "chr(10) || '1[10. One.]' || chr(10) || 'The Gazette of India ' || chr(10) || 'Extraordinary ' || chr(10) || 'PART I-A' || chr(10) || '[No. 22 of 2021]' || chr(10) || 'see Section 5' || chr(10) || chr(10) || chr(10) || text || chr(10) || '11.] Two'"


@query(f"""SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(t,
  '\\n\\s*\\d+\\s*\\n', chr(10), 'g'), '(?i)THE GAZETTE OF INDIA\\s*\\n', chr(10), 'g'), '(?i)EXTRAORDINARY\\s*\\n', chr(10), 'g'), '(?i)PART \\w+[-–—]\\w+\\s*\\n', chr(10), 'g'), '(?i)Section \\w+\\s*\\n', chr(10), 'g'), '(?i)\\[.*\\d{{4}}\\]\\s*\\n', chr(10), 'g'), '(\\n|^)\\s*\\d+\\[(\\d+[A-Za-z]*\\.)', '\\1\\2', 'g'), '(\\d+[A-Za-z]*\\.)\\]', '\\1', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g'), ' ' || chr(10)) AS cleaned
  FROM (SELECT doc_id, {_HEADED} AS t FROM documents)""")
def q04_clean_headers_footnotes(spark, d):
    return _table(spark, d, "documents").select("doc_id", T.clean_pages(F.expr(_HEADED)).alias("cleaned"))


def _doc_pages(spark, d):
    return _doc_lines(spark, d).groupBy("doc_id", F.floor(F.col("line_no") / 20).cast("int").alias("page")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line_no", "line"))), lambda x: x.line), "\n").alias("text")).select("doc_id", (F.col("page") + 1).alias("page_no"), "text")


@query(f"SELECT doc_id, string_agg(line, chr(10) ORDER BY line_no) AS text FROM ({_DOC_LINES}) GROUP BY doc_id")
def q05_page_concat(spark, d):
    return scans.join_pages(_doc_pages(spark, d))


@query(f"SELECT doc_id, CAST(ceil(count(*) / 20) AS BIGINT) AS n_pages FROM ({_DOC_LINES}) GROUP BY doc_id")
def q06_page_count(spark, d):
    return scans.page_counts(_doc_pages(spark, d))


# ---- contents and chapters -----------------------------------------------------
@query(f"WITH {_RM} SELECT doc_id, 2 AS toc_start, 'THE ' || any_value(r_name) || ' ACT' AS title FROM rm GROUP BY doc_id")
def q07_toc_start(spark, d):
    return toc.toc_start(acts(spark, d))


@query(f"WITH {_RM} SELECT DISTINCT doc_id, CAST(ch AS INTEGER) AS ord, roman, n_name AS heading FROM rm")
def q08_toc_chapters(spark, d):
    return toc.chapters(toc.parse_toc(acts(spark, d)))


@query(f"WITH {_RM} SELECT doc_id, CAST(num AS INTEGER) AS ord, CAST(num AS VARCHAR) AS num, CAST(num AS INTEGER) AS num_int, heading || CASE WHEN num % 7 = 0 THEN '. as amended' ELSE '' END AS heading FROM rm")
def q09_toc_sections(spark, d):
    return toc.toc_sections(toc.parse_toc(acts(spark, d, wrapped="num % 7 = 0")))


def _ranges(lines):
    return toc.chapter_ranges(lines, toc.toc_ends(toc.parse_toc(lines)))


@query(f'WITH {_RM} SELECT doc_id, CAST(ch AS INTEGER) AS ord, roman, n_name AS heading, CAST(min(num) AS INTEGER) AS "start", CAST(max(num) AS INTEGER) AS "end" FROM rm GROUP BY ALL')
def q10_chapter_ranges(spark, d):
    return _ranges(acts(spark, d))


@query(f"WITH {_RM}, kept AS (SELECT doc_id, num, lag(num) OVER (PARTITION BY doc_id ORDER BY num) AS prev FROM rm WHERE num % 17 NOT IN (0, 1)) SELECT doc_id, CAST(prev + 1 AS INTEGER) AS gap_start, CAST(num - 1 AS INTEGER) AS gap_end FROM kept WHERE num - prev > 1")
def q11_toc_gaps(spark, d):
    return toc.toc_gaps(toc.toc_sections(toc.parse_toc(acts(spark, d, listed="num % 17 NOT IN (0, 1)"))))


def _bodies(lines, entries):
    body = lines.join(toc.toc_ends(entries), "doc_id").where("line_no > toc_end")
    return body.groupBy("doc_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line_no", "line"))), lambda x: x.line), "\n").alias("body"))


def _sliced(spark, d, missing=False, **kind):
    lines = acts(spark, d, **kind)
    entries = toc.parse_toc(lines)
    return S.extract_sections(_bodies(lines, entries), toc.toc_sections(entries), missing=missing)


@query(f"WITH {_RM} SELECT doc_id, 'exact' AS match_type, count(*) AS n FROM rm GROUP BY doc_id")
def q12_section_boundaries(spark, d):
    return _sliced(spark, d).groupBy("doc_id", "match_type").agg(F.count("*").alias("n"))


@query(f"""WITH {_RM}, n AS (SELECT *, lead(num) OVER w AS next_num, lead(in_ch) OVER w AS next_in, lead(roman) OVER w AS next_roman, lead(n_name) OVER w AS next_name FROM rm WINDOW w AS (PARTITION BY doc_id ORDER BY num))
SELECT doc_id, CAST(num AS INTEGER) AS ord, CAST(num AS VARCHAR) AS num, heading || '.—The balance is held in ' || seg || '.'
  || CASE WHEN next_num IS NULL THEN CASE WHEN num % 20 = 0 THEN chr(10) || CAST(num AS VARCHAR) ELSE '' END
     ELSE CASE WHEN next_in = 1 THEN chr(10) || 'CHAPTER ' || next_roman || chr(10) || next_name ELSE '' END || chr(10) || CAST(next_num AS VARCHAR) || '.' END AS content FROM n""")
def q13_section_content(spark, d):
    return _sliced(spark, d).select("doc_id", "ord", "num", "content")


def _numbered_sections(spark, d, shift=0):
    rows = acts(spark, d)
    return toc.toc_sections(toc.parse_toc(rows)).select("doc_id", "ord", (F.col("num_int") + shift).cast("string").alias("num"))


@query(f"WITH {_RM} SELECT doc_id, CAST(num AS INTEGER) AS ord, CAST(num AS VARCHAR) AS num, roman AS chapter_roman, n_name AS chapter_heading FROM rm")
def q14_assign_chapter_exact(spark, d):
    return C.assign_chapters(_numbered_sections(spark, d), _ranges(acts(spark, d)))


@query(f"""WITH {_RM}, r AS (SELECT doc_id, ch, roman, n_name, min(num) AS a, max(num) - 3 AS b FROM rm GROUP BY ALL),
m AS (SELECT s.doc_id, s.num, r.roman, r.n_name, row_number() OVER (PARTITION BY s.doc_id, s.num ORDER BY CASE WHEN s.num + 5 BETWEEN a AND b THEN -1 ELSE least(abs(s.num + 5 - a), abs(s.num + 5 - b)) END, r.ch) AS k FROM rm s JOIN r ON s.doc_id = r.doc_id)
SELECT doc_id, CAST(num AS INTEGER) AS ord, CAST(num + 5 AS VARCHAR) AS num, roman AS chapter_roman, n_name AS chapter_heading FROM m WHERE k = 1""")
def q15_assign_chapter_nearest(spark, d):
    return C.assign_chapters(_numbered_sections(spark, d, 5), _ranges(acts(spark, d)).withColumn("end", F.col("end") - 3))


@query(f"WITH {_RM} SELECT doc_id, CAST(num AS INTEGER) AS ord, CAST(num AS VARCHAR) AS num, roman AS chapter_roman, n_name AS chapter_heading FROM rm WHERE roman IN ('I', 'III')")
def q16_filter_selected_chapters(spark, d):
    return C.assign_chapters(_numbered_sections(spark, d), _ranges(acts(spark, d)), ["I", "III"])


@query("SELECT conv_id, role, turn, text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn, text) AS k FROM conversations) WHERE k = 1")
def q17_dedup_first(spark, d):
    return C.first_of_each(_table(spark, d, "conversations"), ["conv_id", "role"], ["turn", "text"]).select("conv_id", "role", "turn", "text")


@query(f"WITH {_RM} SELECT doc_id, CAST(num AS VARCHAR) AS num FROM rm WHERE roman IN ('II', 'V')")
def q18_unassigned_sections(spark, d):
    return C.unassigned(_numbered_sections(spark, d), _ranges(acts(spark, d)).where("roman not in ('II', 'V')")).select("doc_id", "num")


# Their numbers have a suffix, as a plain one would be found inside a longer number.
_REPEALED = {"toc_line": "CAST(num AS VARCHAR(20)) || CASE WHEN num%29=0 THEN 'ZZ' ELSE '' END || '. ' || CASE WHEN num%29=0 THEN 'Section ' || CAST(num AS VARCHAR(20)) || ' [Repealed]' ELSE heading END || '.'", "body": "num%29<>0"}


@query(f"WITH {_RM} SELECT doc_id, CAST(num AS VARCHAR) || 'ZZ' AS num, '[Repealed/Omitted]' AS content FROM rm WHERE num % 29 = 0")
def q19_repealed_fallback(spark, d):
    return _sliced(spark, d, missing=True, **_REPEALED).select("doc_id", "num", "content")


# ---- tables --------------------------------------------------------------------
def _order_pages(spark, d, split: bool):
    li = _table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").cast("long").alias("qty"))
    page = F.when(F.col("l_linenumber") <= 2, 1).otherwise(2) if split else F.lit(1)
    cells = F.struct("l_linenumber", "l_partkey", "qty")
    body = F.transform(F.sort_array(F.collect_list(cells)), lambda x: F.concat(F.lit("| "), x.l_linenumber.cast("string"), F.lit(" | "), x.l_partkey.cast("string"), F.lit(" | "), x.qty.cast("string"), F.lit(" |")))
    pages = li.groupBy("l_orderkey", page.alias("page")).agg(F.concat(F.lit("Items\n| line | part | qty |\n|---|:---:|---|\n"), F.array_join(body, "\n")).alias("markdown"))
    return pages


_ITEMS = "SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS BIGINT) AS qty FROM lineitem"


def _flat(tables, key):
    rows = tables.select(key, "tbl_no", F.array_join("headers", ",").alias("header"), F.posexplode("rows").alias("row_no", "row"))
    return rows.select(key, "tbl_no", "header", (F.col("row_no") + 1).cast("long").alias("row_no"), F.array_join("row", ",").alias("cells"))


@query(f"SELECT l_orderkey, 1 AS tbl_no, 'line,part,qty' AS header, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, qty) AS row_no, concat_ws(',', l_linenumber, l_partkey, qty) AS cells FROM ({_ITEMS})")
def q20_md_parse_tables(spark, d):
    return _flat(M.parse_tables(_order_pages(spark, d, False), ["l_orderkey"]), "l_orderkey")


@query(f"SELECT l_orderkey, 1 AS tbl_no, 'line,part,qty' AS header, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, qty) AS row_no, concat_ws(',', l_linenumber, l_partkey, qty) AS cells FROM ({_ITEMS})")
def q21_md_merge_continuation(spark, d):
    pages = _order_pages(spark, d, True).groupBy("l_orderkey").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("page", "markdown"))), lambda x: x.markdown), "\n\n").alias("markdown"))
    return _flat(M.merge_tables(M.parse_tables(pages, ["l_orderkey"]), ["l_orderkey"]), "l_orderkey")


_TR = "chr(10) || '  TR' || chr(10) || '    TC' || chr(10) || '      ' || l_linenumber || chr(10) || '    TC' || chr(10) || '      ' || l_partkey || chr(10) || '    TC' || chr(10) || '      ' || qty"


@query(f"SELECT l_orderkey, 'TABLE' || chr(10) || '  TR' || chr(10) || '    TH' || chr(10) || '      line' || chr(10) || '    TH' || chr(10) || '      part' || chr(10) || '    TH' || chr(10) || '      qty' || string_agg({_TR}, '' ORDER BY l_linenumber, l_partkey, qty) AS block FROM ({_ITEMS}) GROUP BY l_orderkey")
def q22_md_render_table(spark, d):
    return M.render_regions(_order_pages(spark, d, False).drop("page"), ["l_orderkey"])


@query(f"SELECT doc_id, 'TABLE' || chr(10) || '  TR' || chr(10) || '    TC' || chr(10) || string_agg('      ' || line, chr(10) ORDER BY line_no) AS block FROM ({_DOC_LINES}) WHERE trim(line) <> '' AND doc_id IN (SELECT doc_id FROM documents WHERE NOT regexp_matches(text, '(?m)^\\s*\\|')) GROUP BY doc_id")
def q23_md_render_fallback(spark, d):
    docs = _table(spark, d, "documents").where(~F.col("text").rlike(r"(?m)^\s*\|") & (T.strip("text") != ""))
    return M.render_regions(docs.select("doc_id", F.col("text").alias("markdown")), ["doc_id"])


_ROWS = [("|---|:---:|", True), ("| -- | --- |", False), ("|", False), ("|:--:|", False), ("| :---- |---:|", True), ("|a|---|", False)]


@query("SELECT * FROM (VALUES " + ", ".join(f"('{r}', {str(v).lower()})" for r, v in _ROWS) + ") t(line, is_separator)")
def q24_md_separator_rows(spark, d):
    return spark.createDataFrame([(r,) for r, _ in _ROWS], "line string").select("line", M.is_separator(M.split_row(F.col("line"))).alias("is_separator"))


@query("SELECT n_nationkey, CAST(unnest(list_sort(list_distinct(range(n_nationkey + 1, n_nationkey + 4) || [n_nationkey + 10, n_nationkey + 2]))) AS INTEGER) AS page_no FROM nation")
def q25_page_spec(spark, d):
    n = F.col("n_nationkey")
    spec = F.concat(n + 10, F.lit(", "), n + 1, F.lit("-"), n + 3, F.lit(",,"), n + 2)
    return _table(spark, d, "nation").select("n_nationkey", F.explode(scans.page_spec(spec)).alias("page_no"))


@query("""WITH p AS (SELECT DISTINCT l_orderkey % 100 AS doc_id, CAST(l_partkey AS INTEGER) AS page_no FROM lineitem),
g AS (SELECT *, page_no - row_number() OVER (PARTITION BY doc_id ORDER BY page_no) AS k FROM p)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY k) - 1 AS INTEGER) AS region_id, CAST(min(page_no) AS INTEGER) AS first_page, CAST(max(page_no) AS INTEGER) AS last_page, count(*) AS n_pages FROM g GROUP BY doc_id, k""")
def q26_page_runs(spark, d):
    pages = _table(spark, d, "lineitem").select((F.col("l_orderkey") % 100).alias("doc_id"), F.col("l_partkey").cast("int").alias("page_no"))
    return R.page_runs(pages).select("doc_id", "region_id", F.col("pages")[0].alias("first_page"), F.element_at("pages", -1).alias("last_page"), F.size("pages").cast("long").alias("n_pages"))


def _act_pages(spark, d):
    return acts(spark, d).groupBy("doc_id", (F.floor(F.col("line_no") / 40) + 1).cast("int").alias("page_no")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line_no", "line"))), lambda x: x.line), "\n").alias("text"))


def _act_regions(spark, d):
    pages = _act_pages(spark, d).where("page_no % 5 in (1, 2)")
    text = F.when(F.col("page_no") % 10 == 6, "").when(F.col("page_no") % 10 == 7, "").otherwise(F.concat(F.lit("| a |\n|---|\n| "), "page_no", F.lit(" |")))
    return R.build_regions(R.page_runs(pages), pages.select("doc_id", "page_no", text.alias("markdown")))


_ACT_PAGES = f"SELECT doc_id, CAST(line_no // 40 + 1 AS INTEGER) AS page_no, string_agg(line, chr(10) ORDER BY line_no) AS text FROM ({acts_sql()}) GROUP BY ALL"


@query(f"SELECT doc_id, page_no, CASE WHEN page_no % 10 = 1 THEN chr(10) || '<<TABLE_REGION:' || CAST(page_no // 5 AS VARCHAR) || '>>' || chr(10) WHEN page_no % 10 = 2 THEN '' ELSE text END AS text FROM ({_ACT_PAGES})")
def q27_region_sentinels(spark, d):
    return R.place_sentinels(_act_pages(spark, d), _act_regions(spark, d))


@query("SELECT n_regionkey AS doc_id, n_nationkey AS ord, 'SEC ' || n_name || chr(10) || CASE WHEN n_nationkey % 3 = 0 THEN '  <<TABLE_REGION:' || CAST(n_nationkey AS VARCHAR) || '>>' ELSE '  TABLE' || chr(10) || chr(10) || '    ' || n_name END || chr(10) || 'end <<TABLE_REGION:1>> ' AS markup FROM nation")
def q28_splice_blocks(spark, d):
    n = _table(spark, d, "nation").withColumnsRenamed({"n_regionkey": "doc_id", "n_nationkey": "ord"})
    markups = n.select("doc_id", "ord", F.concat(F.lit("SEC "), "n_name", F.lit("\n  <<TABLE_REGION:"), F.col("ord").cast("string"), F.lit(">>\nend <<TABLE_REGION:1>> ")).alias("markup"))
    blocks = n.where("ord % 3 <> 0").select("doc_id", F.col("ord").alias("region_id"), F.concat(F.lit("TABLE\n\n  "), "n_name").alias("block"))
    return R.splice(markups, blocks)[0].select("doc_id", "ord", "markup")


@query("SELECT n_regionkey AS doc_id, 'SCH_R' || n_nationkey AS num, CASE WHEN n_nationkey % 2 = 0 THEN 'FORM ' || n_nationkey ELSE 'Schedule (rescued from page 7' || CASE WHEN n_nationkey % 3 = 0 THEN '-8' ELSE '' END || ')' END AS chapter_heading FROM nation WHERE n_nationkey >= 5")
def q29_trailing_schedules(spark, d):
    n = _table(spark, d, "nation").withColumnsRenamed({"n_regionkey": "doc_id", "n_nationkey": "region_id"})
    head = F.when(F.col("region_id") % 2 == 0, F.concat(F.lit("\n “FORM "), "region_id", F.lit("” of \n"))).otherwise("Form of words\n")
    regions = n.select("doc_id", "region_id", F.when(F.col("region_id") % 3 == 0, F.array(F.lit(7), F.lit(8))).otherwise(F.array(F.lit(7))).alias("pages"), F.concat(head, "n_name").alias("markdown"))
    used = regions.where("region_id < 5").select("doc_id", "region_id")
    return R.schedules(regions, M.render_regions(regions, ["doc_id", "region_id"]), used).select("doc_id", "num", "chapter_heading")


@query("SELECT user_id AS doc_id, CAST(event_id AS INTEGER) AS page_no FROM events WHERE event_type = (SELECT min(event_type) FROM events) OR event_type = (SELECT max(event_type) FROM events)")
def q30_vision_flags(spark, d):
    e = _table(spark, d, "events")
    ends = e.agg(F.min("event_type").alias("lo"), F.max("event_type").alias("hi"))
    reply = F.when(F.col("event_type") == F.col("lo"), " yes.").when(F.col("event_type") == F.col("hi"), "YES, a table").otherwise("No")
    replies = e.join(F.broadcast(ends)).select(F.col("user_id").alias("doc_id"), F.col("event_id").cast("int").alias("page_no"), reply.alias("reply"))
    return R.flagged_pages(replies)


# ---- conversion ----------------------------------------------------------------
_PARTS = "'Text of ' || c_name || chr(10) || '(1) first' || chr(10) || '(a) alpha' || chr(10) || '(i) roman' || chr(10) || '  <<TABLE_REGION:3>>' || chr(10) || chr(10) || '(2) second ' || c_mktsegment"


@query("SELECT c_custkey, 'SEC ' || c_custkey || '. - ' || c_mktsegment || chr(10) || '  Text of ' || c_name || chr(10) || '  SUBSEC (1) first' || chr(10) || '    PARA (a) alpha' || chr(10) || '      SUBPARA (i) roman' || chr(10) || '  <<TABLE_REGION:3>>' || chr(10) || '  SUBSEC (2) second ' || c_mktsegment AS markup FROM customer")
def q31_rule_markup(spark, d):
    return _table(spark, d, "customer").select("c_custkey", V.rule_markup(F.col("c_custkey").cast("string"), F.col("c_mktsegment"), F.expr(_PARTS)).alias("markup"))


_PROMPT_SQL = "'" + V.PROMPT.replace("{document}", "Act").replace("'", "''").replace("{num}", "' || c_custkey || '").replace("{heading}", "' || c_mktsegment || '").replace("{content}", "' || c_name || '") + "'"


@query(f"SELECT c_custkey, {_PROMPT_SQL} AS prompt FROM customer")
def q32_prompt_build(spark, d):
    c = _table(spark, d, "customer").select("c_custkey", F.col("c_custkey").cast("string").alias("num"), F.col("c_mktsegment").alias("heading"), F.col("c_name").alias("content"))
    return V.prompts(c, "Act").select("c_custkey", "prompt")


_ERRORS = [("HTTP 503", True), ("bad request", False), ("ReadTimeout: x", True), ("read TIMED OUT", True), ("code 15007", True), ("invalid key", False), ("Bad Gateway", True)]


@query("SELECT * FROM (VALUES " + ", ".join(f"('{e}', {str(v).lower()})" for e, v in _ERRORS) + ") t(error, retryable)")
def q33_retryable_errors(spark, d):
    return V.fault_kinds(spark.createDataFrame([(e,) for e, _ in _ERRORS], "error string"))


@query("SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1)")
def q34_resume_pending(spark, d):
    docs = _table(spark, d, "documents").select("doc_id", F.lit("1").alias("num"), F.lit("h").alias("heading"), F.col("source").alias("content"))
    sections = V.with_hash(docs)
    status = F.when(F.col("quality") == 1, "ok").otherwise("error")
    log = sections.join(_table(spark, d, "labels"), "doc_id").select("doc_id", "num", "content_hash", F.lit(V.PROMPT_VERSION).alias("prompt_ver"), F.lit("m").alias("model"), status.alias("status"))
    return V.pending(sections, log, "m").select("doc_id")


@query("SELECT page_id, page_id % 3 = 0 AS hit FROM pages WHERE page_id IS NOT NULL")
def q35_cache_hit_miss(spark, d):
    p = _table(spark, d, "pages").select("page_id", F.lit(1).cast("long").alias("doc_id"), F.lit(2.0).alias("mtime"), F.col("page_id").cast("int").alias("page_no"), F.col("url").alias("markdown")).where("page_id is not null")
    cache = p.withColumn("mtime", F.when(F.col("page_id") % 3 == 1, 1.0).otherwise(2.0)).where("page_id % 3 <> 2").select("doc_id", "mtime", "page_no", "markdown")
    wanted = p.select("doc_id", "mtime", "page_no")
    hits = R.cached_pages(wanted, cache).select(F.col("page_no").cast("long").alias("page_id"), F.lit(True).alias("hit"))
    return hits.unionByName(R.missing_pages(wanted, cache).select(F.col("page_no").cast("long").alias("page_id"), F.lit(False).alias("hit")))


def _converted(spark, d):
    n = _table(spark, d, "nation").withColumnsRenamed({"n_regionkey": "doc_id", "n_nationkey": "ord"})
    schedule = F.col("ord") % 8 == 7
    return n.select("doc_id", "ord", F.when(schedule, "schedule").otherwise("section").alias("kind"), F.col("ord").cast("string").alias("num"), F.col("n_name").alias("markup"), F.when(schedule, "SCHEDULE").when(F.col("ord") % 3 == 0, "I").otherwise("II").alias("chapter_roman"), F.when(F.col("ord") % 3 == 0, "One").otherwise("Two").alias("chapter_heading"), F.when(schedule, F.array(F.lit(4), F.lit(5))).alias("pages"))


_CONVERTED = "SELECT n_regionkey AS doc_id, n_nationkey AS ord, n_nationkey % 8 = 7 AS late, n_name, CASE WHEN n_nationkey % 3 = 0 THEN 'I' ELSE 'II' END AS roman, CASE WHEN n_nationkey % 3 = 0 THEN 'One' ELSE 'Two' END AS head FROM nation"


@query(f"""WITH c AS ({_CONVERTED}), p AS (SELECT *, lag(roman) OVER (PARTITION BY doc_id, late ORDER BY ord) AS prev, row_number() OVER (PARTITION BY doc_id, late ORDER BY ord) AS k FROM c)
SELECT doc_id, string_agg(CASE WHEN late THEN CASE WHEN k = 1 THEN chr(10) || chr(10) || repeat('=', 80) || chr(10) || 'SCHEDULES' || chr(10) || repeat('=', 80) || chr(10) || chr(10) ELSE '' END || '# Source: pages 4-5' || chr(10)
  WHEN prev IS NULL OR prev <> roman THEN chr(10) || chr(10) || 'CHAPTER ' || roman || chr(10) || head || chr(10) || repeat('=', 80) || chr(10) || chr(10) ELSE '' END || n_name || chr(10) || chr(10), '' ORDER BY late, ord) AS text FROM p GROUP BY doc_id""")
def q36_write_markup_text(spark, d):
    return K.markup_texts(_converted(spark, d))


@query(f"WITH c AS ({_CONVERTED}) SELECT doc_id, count(*) AS sections_converted, count(DISTINCT CASE WHEN late THEN 'SCHEDULE' ELSE roman END) AS chapters, CASE WHEN doc_id % 2 = 0 THEN CAST(1 AS BIGINT) ELSE 0 END AS errors FROM c GROUP BY doc_id")
def q37_metadata(spark, d):
    errors = _table(spark, d, "region").where("r_regionkey % 2 = 0").select(F.col("r_regionkey").alias("doc_id"))
    return K.metadata(_converted(spark, d), errors).select("doc_id", "sections_converted", "chapters", "errors")


@query(f"WITH {_RM} SELECT doc_id, CAST(ch AS INTEGER) AS ord, roman, count(*) AS section_count, string_agg(CAST(num AS VARCHAR), ',' ORDER BY num) AS nums FROM rm GROUP BY ALL")
def q38_chapter_tree(spark, d):
    lines = acts(spark, d)
    sections, ranges = toc.toc_sections(toc.parse_toc(lines)), _ranges(lines)
    return K.chapter_tree(ranges, C.in_ranges(sections, ranges)).select("doc_id", "ord", "roman", "section_count", F.array_join(F.transform("sections", lambda s: s.num), ",").alias("nums"))


@query("SELECT c_custkey AS doc_id, 'similarity' AS match_type, round(2.0 * (length(c_mktsegment) + 8) / (2 * length(c_mktsegment) + 17), 6)::DOUBLE AS similarity FROM customer")
def q39_similarity_match(spark, d):
    """Headings that the body spells otherwise, found by similarity."""
    docs = _table(spark, d, "customer").select(F.col("c_custkey").alias("doc_id"), F.concat(F.col("c_custkey").cast("string"), F.lit("."), F.col("c_mktsegment"), F.lit(" mattters—")).alias("body"))
    toc_rows = _table(spark, d, "customer").select(F.col("c_custkey").alias("doc_id"), F.lit(1).alias("ord"), F.col("c_custkey").cast("string").alias("num"), F.concat("c_mktsegment", F.lit(" matters")).alias("heading"))
    return S.extract_sections(docs, toc_rows).select("doc_id", "match_type", F.round("similarity", 6).alias("similarity"))


@query("SELECT CAST(n_regionkey AS BIGINT) AS doc_id, CAST(n_nationkey AS VARCHAR) AS num, n_name AS markup, 'ok' AS status FROM nation")
def q40_streaming_convert(spark, d):
    """Sections converted by a stream over files, with a failure that the next run makes good."""
    from ..streaming.convert_stream import stream_conversion

    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="statuta-")
    root = f"{base}/stream-{spark.sparkContext.applicationId}-{spark.sparkContext._jvm.System.nanoTime()}"
    n = _table(spark, d, "nation")
    n.select(F.col("n_regionkey").cast("long").alias("doc_id"), F.col("n_nationkey").cast("int").alias("ord"), F.col("n_nationkey").cast("string").alias("num"), F.col("n_name").alias("heading"), F.col("n_name").alias("content")).write.parquet(f"{root}/in")
    stream_conversion(spark, f"{root}/in", f"{root}/log", f"{root}/checkpoint", EchoTransport(), "echo")
    return V.latest(V.read_log(spark, f"{root}/log")).select("doc_id", "num", "markup", "status")
