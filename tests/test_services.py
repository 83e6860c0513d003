"""Recognition, vision, table modes, analyses and the command line, with services played by functions."""

import json
import sys
import types

import pytest

from statuta import cli
from statuta.operators import convert, sinks
from statuta.plans.pipeline import Services, analyze_corpus, table_texts
from statuta.sources import transport
from statuta.sources.recognition import Recogniser, Vision, page_images, reachable, read_cache, recognise_pages

ENV = {"AZURE_API_KEY": "k", "AZURE_MULTIMODAL_ENDPOINT": "https://v/", "AZURE_MULTIMODAL_DEPLOYMENT": "d"}
DOC = "doc_id long, mtime timestamp, content binary"


def replies(*given):
    """A post that answers by ``given`` in turn and keeps what it was sent."""
    left, sent = list(given), []

    def post(url, headers, payload, timeout):
        sent.append((url, headers, payload))
        found = left.pop(0)
        if isinstance(found, Exception):
            raise found
        return found

    return post, sent


def test_recogniser_tries_again():
    waits = []
    good = json.dumps({"pages": [{"markdown": "a"}, {"markdown": ""}, {"markdown": "b"}]})
    post, sent = replies((502, ""), RuntimeError("reset"), (200, good))
    assert Recogniser("u", "k", post=post, sleep=waits.append).read(b"x") == "a\nb"
    assert waits == [1, 2] and sent[0][2]["document"]["document_url"] == "data:application/pdf;base64,eA=="
    post, _ = replies(*[(200, '{"pages": []}')] * 3)
    with pytest.raises(RuntimeError, match="3 attempts: no text"):
        Recogniser("u", "k", post=post, sleep=waits.append).read(b"x")


@pytest.mark.parametrize("mode,path,body", [("chat", "chat/completions", {"choices": [{"message": {"content": " YES "}}]}), ("responses", "responses", {"output": [{"content": [{"type": "output_text", "text": " YES "}]}]}), ("azure-inference", "chat/completions", {"choices": [{"message": {"content": "YES"}}]})])
def test_vision_modes(mode, path, body):
    post, sent = replies((200, json.dumps(body)), (500, "no"))
    vision = Vision.configured(ENV, mode=mode, post=post, max_tokens=1)
    assert vision.ask("a table?", b"x") == "YES" and vision.max_tokens == 16
    assert sent[0][0] == f"https://v/{path}" and "eA==" in json.dumps(sent[0][2])
    assert reachable(None, vision)["vision"].startswith("failed: status 500")
    with pytest.raises(ValueError):
        Vision.configured(ENV, mode="other")
    with pytest.raises(ValueError, match="AZURE_API_KEY"):
        Vision.configured({}, mode=mode)


def services(**more):
    """Documents are pages joined by |; a page with T holds a table."""
    base = dict(count=lambda b: len(b.split(b"|")), cut=lambda b, p: b.split(b"|")[p - 1], read=lambda b: b.decode().upper(), render=lambda b, pages, scale: [b.split(b"|")[p - 1] for p in pages], ask=lambda image: "Yes." if b"T" in image else "no")
    return Services(**(base | more))


def test_table_modes_and_the_cache(spark, tmp_path):
    docs = spark.sql("select 1L doc_id, timestamp'2024-01-01' mtime, cast('a|T b|c' as binary) content union all select 2L, timestamp'2024-01-01', cast('d' as binary)")
    pages = lambda df: sorted(tuple(r) for r in df.collect())
    one = spark.createDataFrame([(1, 3), (1, 3)], "doc_id long, page_no int")
    tables, texts = table_texts(docs, "declared", services(), f"{tmp_path}/declared", one)
    assert pages(tables) == [(1, 3)] and pages(texts) == [(1, 3, "C")]
    tables, texts = table_texts(docs, "auto", services(), f"{tmp_path}/auto")
    assert pages(tables) == [(1, 2)] and pages(texts) == [(1, 2, "T B")]

    def fails(content):
        if content == b"c":
            raise RuntimeError("lost")
        return content.decode()

    with pytest.raises(RuntimeError, match="page 3 of document 1: lost"):
        table_texts(docs, "full", services(read=fails), f"{tmp_path}/full")
    assert {(r.doc_id, r.page_no) for r in read_cache(spark, f"{tmp_path}/full").collect()} == {(1, 1), (1, 2), (2, 1)}
    # What was read stays, only the rest is asked for again.
    assert pages(table_texts(docs, "full", services(), f"{tmp_path}/full")[1]) == [(1, 1, "a"), (1, 2, "T b"), (1, 3, "C"), (2, 1, "d")]
    newer = docs.selectExpr("doc_id", "mtime + interval 1 day mtime", "1 page_no", "content document")
    assert pages(recognise_pages(newer, lambda b: "new", f"{tmp_path}/full")) == [(1, 1, "new"), (2, 1, "new")]
    with pytest.raises(Exception, match="has pages 1 to 1, not 2"):
        page_images(docs, spark.createDataFrame([(2, 2)], "doc_id long, page_no int"), services().count, services().render).collect()
    for mode, declared in (("declared", None), ("auto", one), ("other", None)):
        with pytest.raises(ValueError):
            table_texts(docs, mode, services(), f"{tmp_path}/x", declared)


def test_analyses_are_saved_and_summed_up(spark, tmp_path):
    texts = spark.createDataFrame([(1, "abc"), (2, None)], "doc_id long, text string")

    def ask(kind, text):
        if text is None:
            raise RuntimeError("empty")
        return 'here: {"n": 3}' if kind == "json" else "fine"

    got = {r.doc_id: json.loads(r.json) for r in analyze_corpus(texts, ask, str(tmp_path), ("content", "json")).collect()}
    assert (got[1]["analysis_complete"], got[1]["extracted_text_length"], got[1]["analyses_performed"]) == (True, 3, ["content", "json"])
    assert got[1]["files_generated"][1].endswith("analysis_type=json") and got[2]["errors"] == ["content: empty", "json: empty"]
    saved = spark.read.json(f"{tmp_path}/analyses").where("analysis_type = 'json' and doc_id = 1").first()
    assert "3" in saved.parsed and saved.result == 'here: {"n": 3}'


def test_batches_cool_down():
    waits = []
    for k in range(7):
        transport.cool_down(k, transport.Pace(), waits.append)
    assert waits == [30.0, 30.0]
    assert len(convert.RULES) == 10 and all(r in convert.PROMPT for r in convert.RULES)


def test_progress(spark):
    log = spark.createDataFrame([("ok",), ("ok",), ("error",)], "status string")
    r = sinks.progress(log, 8, 10.0).first()
    assert (r.done, r.failed, r.percent, r.mean_seconds, r.seconds_left) == (2, 1, 25.0, 5.0, 30.0)
    assert sinks.progress(log.limit(0), 8, 0.0).first().mean_seconds is None


def test_command_line_runs_with_services(spark, tmp_path, monkeypatch):
    module = types.ModuleType("played_services")
    module.build = lambda config: services(pages=lambda b: b.decode().split("|"), analyse=lambda kind, text: kind)
    monkeypatch.setitem(sys.modules, "played_services", module)
    (tmp_path / "act.bin").write_text("Act\nCONTENTS\n1. First\n2. Second\nCHAPTER I\nONE\n1. First—body|T page\n|2. Second—(1) more")
    args = cli.checked(cli.parser().parse_args(["convert", f"{tmp_path}/act.bin", "-o", f"{tmp_path}/out", "--services", "played_services", "--table-mode", "auto", "--act-number", "7", "--debug"]))
    cli.run_convert(spark, args)
    meta = json.loads(spark.read.text(f"{tmp_path}/out/metadata").first().value)
    assert meta["act_number"] == "7" and meta["document"] == "Legislative Document"
    assert "T PAGE" in "\n".join(r.value for r in spark.read.text(f"{tmp_path}/out/markup").collect())
    cli.run_analyze(spark, cli.parser().parse_args(["analyze", f"{tmp_path}/act.bin", "-o", f"{tmp_path}/seen", "--services", "played_services", "--types", "summary"]))
    assert json.loads(spark.read.text(f"{tmp_path}/seen/summary").first().value)["analyses_performed"] == ["summary"]
    with pytest.raises(SystemExit):
        cli.checked(cli.parser().parse_args(["convert", "x", "-o", "y", "--table-mode", "auto"]))
    assert cli.main(["check"]) == 1
