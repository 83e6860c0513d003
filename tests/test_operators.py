"""Literal edge cases of the operators."""

import tracemalloc

import pytest
from pyspark.sql import functions as F

from statuta.functions import text as T
from statuta.operators import chapters, convert, mdtable, rescue, sections, sinks, toc
from statuta.plans.pipeline import Settings, convert_corpus
from statuta.sources import scans, transport
from statuta.streaming.convert_stream import stream_conversion
from statuta import cli


def one(spark, value, make):
    return spark.createDataFrame([(value,)], "v string").select(make(F.col("v")).alias("x")).first().x


@pytest.mark.parametrize("spec,pages", [("10,12-15,20", [10, 12, 13, 14, 15, 20]), ("3,,3, 1-2", [1, 2, 3])])
def test_page_spec(spark, spec, pages):
    assert one(spark, spec, scans.page_spec) == pages


@pytest.mark.parametrize("spec", ["0", "5-3", "-5", "x"])
def test_bad_page_spec(spark, spec):
    with pytest.raises(Exception, match="not a page"):
        one(spark, spec, scans.page_spec)


def test_split_lines_and_strip(spark):
    assert one(spark, "a\r\nb\x0bc\n", T.split_lines) == ["a", "b", "c"]
    assert one(spark, "", T.split_lines) == []
    assert one(spark, "\n\n", T.split_lines) == ["", ""]
    assert one(spark, "  x \t\n", T.strip) == "x"


def test_page_numbers_alternate(spark):
    assert one(spark, "a\n1\n2\n3\nx", lambda c: F.regexp_replace(c, *T.CLEANUPS[0])) == "a\n2\nx"


def test_page_runs(spark):
    pages = spark.createDataFrame([(1, p) for p in (3, 78, 79, 80, 92, 79)], "doc_id long, page_no int")
    assert [r.pages for r in rescue.page_runs(pages).orderBy("region_id").collect()] == [[3], [78, 79, 80], [92]]


def test_separator_and_cells(spark):
    for row, want in ((":---:|---", True), ("--", False), ("|", False)):
        assert one(spark, row, lambda c: mdtable.is_separator(mdtable.split_row(c))) is want
    assert one(spark, "|", mdtable.split_row) == []
    assert one(spark, "| a | | b", mdtable.split_row) == ["a", "", "b"]


def tables(spark, md):
    df = spark.createDataFrame([(1, md)], "id long, markdown string")
    return [(r.headers, r.rows) for r in mdtable.merge_tables(mdtable.parse_tables(df, ["id"]), ["id"]).orderBy("tbl_no").collect()]


def test_header_split_and_merge(spark):
    assert tables(spark, "|a|\n|b|\n|---|\n|c|\n|---|") == [(["b"], [["c"], ["---"]])]
    assert tables(spark, "|a|\n|c|") == [(["a"], [["c"]])]
    assert tables(spark, "|---|\n|c|") == [([], [["c"]])]
    part = "|{}|\n|---|\n|{}|\n\ntext\n"
    assert len(tables(spark, "".join(part.format(h, i) for i, h in enumerate("HHGH")))) == 3


def test_render(spark):
    df = spark.createDataFrame([(1, "x\n\n y"), (2, "|h|\n|---|\n||")], "id long, markdown string")
    got = {r.id: r.block for r in mdtable.render_regions(df, ["id"]).collect()}
    assert got[1] == "TABLE\n  TR\n    TC\n      x\n       y"
    assert got[2].startswith("TABLE\n  TR\n    TH\n      h\n  TR")


def lines(spark, text):
    return scans.lines_of(spark.createDataFrame([(1, text)], "doc_id long, text string"))


def test_toc_edges(spark):
    text = "An Act\n____\nCONTENTS\nPART IA\nHeading\n1. First\nwrapped..\n2. Second\n12\nCHAPTER 1\nPART D\nCHAPTER II\nSECTIONS\n3. Third\nPART IA\nHeading\n1. First—body"
    entries = toc.parse_toc(lines(spark, text))
    assert [(r.roman, r.heading) for r in toc.chapters(entries).orderBy("ord").collect()] == [("IA", "Heading")]
    assert [(r.num, r.heading) for r in toc.toc_sections(entries).orderBy("ord").collect()] == [("1", "First wrapped"), ("2", "Second"), ("3", "Third")]
    assert toc.toc_ends(entries).first().toc_end == 13
    assert toc.toc_start(lines(spark, "x\ny")).first().toc_start == 0


def test_contents_of_one_long_document(spark):
    text = "Act\n1. First\nand more\n" + "plain words\n" * 100_000 + "2. Second.\n"
    lines = spark.createDataFrame([(1, n, x) for n, x in enumerate(text.split("\n"))], "doc_id long, line_no int, line string")
    got = [(r.num, len(r.heading), r.last_line) for r in toc.parse_toc(lines).orderBy("line_no").collect()]
    assert got == [("1", len("First and more") + 100_000 * len(" plain words"), 100_002), ("2", 6, 100_003)]


def test_chapter_lines_in_a_row(spark):
    got = toc.chapters(toc.parse_toc(lines(spark, "CHAPTER I\nCHAPTER II\nCHAPTER III\nName\n1. A"))).orderBy("ord").collect()
    assert [(r.roman, r.heading) for r in got] == [("I", "CHAPTER II"), ("III", "Name")]


def test_nearest_chapter_ties_and_no_ranges(spark):
    secs = spark.createDataFrame([(1, 1, "4"), (1, 2, "x"), (2, 1, "4")], "doc_id long, ord int, num string")
    ranges = spark.createDataFrame([(1, 1, "I", "a", 1, 3), (1, 2, "II", "b", 5, 9)], "doc_id long, ord int, roman string, heading string, start int, end int")
    got = {(r.doc_id, r.num): r.chapter_roman for r in chapters.assign_chapters(secs, ranges).collect()}
    assert got == {(1, "4"): "I", (2, "4"): "NA"}


def test_slicing():
    text = "1. Short—a\n12.Heading here—z"
    out = sections.slice_document(text, [(1, "1", "Missing"), (2, "12", "Heading heer"), (3, "13", "Gone [Omitted]")])
    assert out[0][4:7] == (0, 11, "simple_pattern")
    assert out[1][6] == "similarity" and out[1][3].startswith("12.Heading")
    assert out[2][3] == "[Repealed/Omitted]"
    # The number is found inside 11. when nothing stands before it.
    assert sections.slice_document("11. Foo\n", [(1, "1", "None")])[0][4] == 1
    cut = sections.slice_document("1. One—a\n2. Two—b", [(1, "1", "One"), (2, "2", "Two")], compat=False)
    assert [c[3] for c in cut] == ["One—a", "Two—b"]


def test_missing_sections_of_a_long_document(spark):
    """Contents before missing headings run to the end of the text: all of them would take the square of its length."""
    n = 4_000
    listed = [(k, f"{k}ZZ" if k % 2 else str(k), f"Gone {k} [Omitted]" if k % 2 else f"Heading number {k}") for k in range(n)]
    text = "\n".join(f"{num}. {heading}—{'words ' * 60}" for k, num, heading in listed if k % 2 == 0)
    tracemalloc.start()
    rows = list(sections._sliced(text, listed, True, True))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30 * len(text) and [r[0] for r in rows] == list(range(1, n, 2)) and {r[3] for r in rows} == {"[Repealed/Omitted]"}
    toc_rows = spark.createDataFrame([(1, *r) for r in listed[:40]] + [(2, 1, "1", "Absent")], "doc_id long, ord int, num string, heading string")
    body = spark.createDataFrame([(1, text), (3, "x")], "doc_id long, body string")
    gone = sections.extract_sections(body, toc_rows, missing=True)
    assert sorted((r.doc_id, r.ord, r.content, r.start) for r in gone.collect()) == [(1, k, "[Repealed/Omitted]", None) for k in range(1, 40, 2)] + [(2, 1, "", None)]
    every = sections.extract_sections(body, toc_rows)
    assert sorted(map(repr, every.where("start is null").collect())) == sorted(map(repr, gone.collect())) and every.count() == 41


def test_splice_keeps_what_it_does_not_know(spark):
    m = spark.createDataFrame([(1, 1, "a\n  <<TABLE_REGION:0>>  \nx <<TABLE_REGION:0>>\n<<TABLE_REGION:9>>")], "doc_id long, ord int, markup string")
    b = spark.createDataFrame([(1, 0, "T\n\n u"), (1, 2, "V")], "doc_id long, region_id int, block string")
    out, used = rescue.splice(m, b)
    assert out.first().markup == "a\n  T\n\n   u\nx <<TABLE_REGION:0>>\n<<TABLE_REGION:9>>"
    assert [r.region_id for r in used.collect()] == [0]


def test_flagged_pages(spark):
    ok = spark.createDataFrame([(1, 1, " yes."), (1, 2, "No"), (1, 3, "ERROR: t/o")], "doc_id long, page_no int, reply string")
    assert [r.page_no for r in rescue.flagged_pages(ok).collect()] == [1]
    with pytest.raises(Exception, match="all pages"):
        rescue.flagged_pages(ok.where("page_no = 3")).collect()


def test_header_runs_and_metadata(spark):
    rows = [(1, i, "section", str(i), "m", r, r, None) for i, r in enumerate("ABA")]
    df = spark.createDataFrame(rows, "doc_id long, ord int, kind string, num string, markup string, chapter_roman string, chapter_heading string, pages array<int>")
    assert sinks.markup_texts(df).first().text.count("CHAPTER ") == 3
    meta = sinks.metadata(df, spark.createDataFrame([], "doc_id long"))
    assert (meta.first().chapters, meta.first().errors) == (2, 0)
    assert "act_number" not in sinks.metadata_json(meta).first().json


def test_retry():
    waits, calls = [], []

    class Flaky:
        def invoke(self, prompt):
            calls.append(prompt)
            raise RuntimeError("HTTP 503" if prompt == "a" else "bad request")

    pace = transport.Pace()
    assert transport.call_with_retry(Flaky(), "a", pace, waits.append) == ("exhausted", None, "HTTP 503", 3)
    assert waits == [60, 120, 240]
    assert transport.call_with_retry(Flaky(), "b", pace, waits.append)[0] == "error"
    with pytest.raises(ValueError):
        transport.check_api_mode("soap", "X")


def test_log_retries_failures_only(spark, tmp_path):
    rows = [(1, i, str(i), "h", f"body {i}") for i in range(6)]
    secs = spark.createDataFrame(rows, "doc_id long, ord int, num string, heading string, content string")
    bad = transport.EchoTransport(fail=lambda p: "bad request" if "body 3" in p else None)
    log = str(tmp_path / "log")
    assert convert.run_conversion(secs, bad, "m", log).count() == 5
    assert convert.pending(convert.with_hash(secs), convert.read_log(spark, log), "m").count() == 1
    assert convert.run_conversion(secs, transport.EchoTransport(), "m", log).count() == 6
    assert convert.read_log(spark, log).count() == 7


def test_stream_resumes(spark, tmp_path):
    src = str(tmp_path / "in")
    row = lambda i: spark.createDataFrame([(1, i, str(i), "h", f"b{i}")], "doc_id long, ord int, num string, heading string, content string")
    row(1).write.parquet(src)
    args = (spark, src, str(tmp_path / "log"), str(tmp_path / "cp"), transport.EchoTransport(), "m")
    stream_conversion(*args)
    row(2).write.mode("append").parquet(src)
    stream_conversion(*args)
    assert sorted(r.markup for r in convert.latest(convert.read_log(spark, args[2])).collect()) == ["b1", "b2"]


def test_corpus_with_tables(spark, tmp_path):
    pages = [(1, 1, "THE ACT OF TESTS\nCONTENTS\nCHAPTER I\nName\n1. One.\n2. Two."), (1, 2, "CHAPTER I\nName\n1. One.—(1) first\n(a) alpha"), (1, 3, "| x |"), (1, 4, "2. Two.—end"), (1, 5, "junk")]
    docs = spark.createDataFrame(pages, "doc_id long, page_no int, text string")
    ocr = spark.createDataFrame([(1, 3, "|h|\n|---|\n|v|"), (1, 5, "FORM A\n|k|")], "doc_id long, page_no int, markdown string")
    out = convert_corpus(docs, Settings(str(tmp_path / "log")), None, ocr, ocr.select("doc_id", "page_no"))
    text = out["markup"].first().text
    assert "CHAPTER I\nName" in text and "SEC 1. - One" in text and "SCHEDULE - FORM A" not in text.split("SCHEDULES")[0]
    assert "  TABLE\n    TR\n      TH\n        h" in text
    meta = out["metadata"].first()
    assert meta.sections_converted >= 2 and meta.errors == 0
    assert [len(r.pages) for r in out["regions"].orderBy("region_id").collect()] == [1, 1]


def test_sources(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"one\x0ctwo\x0c")
    got = scans.page_scan(spark, str(tmp_path / "a.bin"), lambda b: [p.decode() or None for p in b.split(b"\x0c")]).orderBy("page_no").collect()
    assert [(r.page_no, r.text) for r in got] == [(1, "one"), (2, "two"), (3, "")]
    (tmp_path / ".env").write_text("# x\n\nA = \"b=c\"\nAZURE_INFERENCE_ENDPOINT='u'\nPROVIDER=anthropic\n")
    env = scans.read_env(str(tmp_path / ".env"))
    assert env["A"] == "b=c" and cli.provider_of(env) == "azure"
    assert cli.settings_of({"a": None}, env, {"a": "A"}) == {"a": "b=c"}
    assert one(spark, '{"pages":[{"markdown":"x"},{"markdown":""},{"markdown":"y"}]}', scans.ocr_markdown) == "x\ny"
    assert one(spark, 'so: {"a": 1} ok', scans.tolerant_json) == '{"a": 1}'
    assert one(spark, "none", scans.tolerant_json) is None
    pages = spark.createDataFrame([(1, 1, "x")], "doc_id long, page_no int, text string")
    with pytest.raises(Exception, match="no page"):
        scans.select_pages(pages, spark.createDataFrame([(1, 2)], "doc_id long, page_no int")).collect()


def test_analysis_and_classification(spark):
    texts = spark.createDataFrame([(1, "t" * 5000)], "doc_id long, text string")

    def ask(kind, text):
        if kind == "json":
            raise RuntimeError("no")
        return str(len(text))

    got = {r.analysis_type: (r.result, r.error) for r in transport.analyze(texts, ask, ("summary", "json")).collect()}
    assert got == {"summary": ("4000", None), "json": (None, "no")}
    with pytest.raises(ValueError):
        transport.analyze(texts, ask, ("other",))
    assert "4000" in sinks.html_report(transport.analyze(texts, ask, ("summary",))).first().html
    images = spark.createDataFrame([(1, 1, bytearray(b"x"))], "doc_id long, page_no int, image binary")
    assert transport.classify_pages(images, lambda b: "YES" if b == b"x" else "No", 2).first().reply == "YES"


def test_cli_checks():
    p = cli.parser()
    with pytest.raises(SystemExit):
        cli.checked(p.parse_args(["convert", "x", "-o", "y", "--table-mode", "declared"]))
    with pytest.raises(SystemExit):
        cli.checked(p.parse_args(["convert", "x", "-o", "y", "--llm", "{}", "--llm-env", "e"]))
