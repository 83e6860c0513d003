"""Command line: ``python -m statuta.cli convert|analyze|check``.

What depends on a document format or a service comes from ``--services MODULE``,
whose ``build(config)`` returns a ``statuta.plans.pipeline.Services``; without it,
convert takes text documents and converts by rules.

Options that name a service override the environment file, which overrides the
process environment."""

from __future__ import annotations

import argparse
import importlib
import json
import os
from pathlib import Path

from .sources.scans import read_env

MODES = ("declared", "auto", "full")


def settings_of(flags: dict[str, str | None], env_file: dict[str, str], names: dict[str, str]) -> dict[str, str | None]:
    """For each option: the flag, else the environment file's value, else the environment's."""
    return {k: flags.get(k) or env_file.get(v) or os.environ.get(v) for k, v in names.items()}


def provider_of(env: dict[str, str]) -> str | None:
    """An Azure endpoint in the environment file decides, whatever PROVIDER says."""
    return "azure" if env.get("AZURE_INFERENCE_ENDPOINT") else env.get("PROVIDER")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="statuta")
    sub = top.add_subparsers(dest="command", required=True)
    c = sub.add_parser("convert", help="convert documents to markup")
    c.add_argument("paths", nargs="+")
    c.add_argument("-o", "--output", required=True)
    c.add_argument("--llm", help="model configuration as JSON")
    c.add_argument("--llm-json", help="file with a model configuration")
    c.add_argument("--llm-env", help="environment file with a model configuration")
    c.add_argument("--table-mode", choices=MODES)
    c.add_argument("--table-pages", help="pages such as 10,12-15, with --table-mode declared")
    c.add_argument("--document-name", default="Legislative Document")
    c.add_argument("--act-number")
    c.add_argument("--replaces")
    c.add_argument("--debug", action="store_true", help="write the texts, the sections and the chapters as read")
    a = sub.add_parser("analyze", help="analyse the tables of documents")
    a.add_argument("paths", nargs="+")
    a.add_argument("-o", "--output", required=True)
    a.add_argument("--types", default="summary,json", help="of summary, structure, content, json")
    k = sub.add_parser("check", help="say whether the services can be reached")
    for p in (c, a, k):
        p.add_argument("--services", help="module with build(config)")
        p.add_argument("--env", help="environment file with the settings of services")
        for name in SERVICE_NAMES:
            p.add_argument("--" + name.replace("_", "-"))
    return top


#: Options of services and the environment's names for them.
SERVICE_NAMES = {"api_key": "AZURE_API_KEY", "ocr_endpoint": "AZURE_OCR_ENDPOINT", "vision_endpoint": "AZURE_MULTIMODAL_ENDPOINT", "vision_deployment": "AZURE_MULTIMODAL_DEPLOYMENT", "vision_mode": "AZURE_MULTIMODAL_API_STYLE"}


def service_settings(args: argparse.Namespace) -> dict[str, str | None]:
    return settings_of({k: getattr(args, k) for k in SERVICE_NAMES}, read_env(args.env) if args.env else {}, SERVICE_NAMES)


def services_of(args: argparse.Namespace, config: dict | None = None):
    if not args.services:
        return None
    return importlib.import_module(args.services).build({**service_settings(args), **(config or {})})


def checked(args: argparse.Namespace) -> argparse.Namespace:
    if sum(bool(x) for x in (args.llm, args.llm_json, args.llm_env)) > 1:
        raise SystemExit("give one source of the model configuration")
    if (args.table_mode == "declared") != bool(args.table_pages):
        raise SystemExit("--table-mode declared and --table-pages go together")
    if not args.services and (args.table_mode or args.llm or args.llm_json or args.llm_env):
        raise SystemExit("--table-mode and --llm need --services")
    return args


def llm_config(args: argparse.Namespace) -> dict | None:
    if args.llm:
        return json.loads(args.llm)
    if args.llm_json:
        return json.loads(Path(args.llm_json).read_text(encoding="utf-8"))
    if args.llm_env:
        env = read_env(args.llm_env)
        return {"provider": provider_of(env), **env}
    return None


def run_convert(spark, args: argparse.Namespace) -> None:
    from pyspark.sql import functions as F

    from .operators import chapters, sinks
    from .plans.pipeline import Settings, convert_corpus, table_texts
    from .sources.scans import page_scan, page_spec, text_scan

    services = services_of(args, llm_config(args))
    tables = recognised = None
    if services and services.pages:
        scanned = page_scan(spark, args.paths, services.pages)
        docs = scanned.select(F.xxhash64("path").alias("doc_id"), "page_no", "text")
    else:
        docs = text_scan(spark, args.paths).select(F.xxhash64("path").alias("doc_id"), F.lit(1).alias("page_no"), "text")
    if args.table_mode:
        files = spark.read.format("binaryFile").load(args.paths).select(F.xxhash64("path").alias("doc_id"), F.col("modificationTime").alias("mtime"), "content")
        declared = files.select("doc_id", F.explode(page_spec(F.lit(args.table_pages))).alias("page_no")) if args.table_pages else None
        tables, recognised = table_texts(files, args.table_mode, services, f"{args.output}/recognised", declared)
    out = convert_corpus(docs, Settings(log=f"{args.output}/log", document=args.document_name), services and services.transport, recognised, tables)
    sinks.write_texts(out["markup"], f"{args.output}/markup")
    about = {"document": args.document_name, "act_number": args.act_number, "replaces": args.replaces}
    meta = out["metadata"].withColumns({k: F.lit(v).cast("string") for k, v in about.items()})
    sinks.write_texts(sinks.metadata_json(meta), f"{args.output}/metadata", "json")
    sinks.write_texts(out["body"], f"{args.output}/body", "body")
    if args.debug:
        sinks.write_texts(out["texts"], f"{args.output}/debug/texts")
        sinks.append_tsv(sinks.tsv_rows(out["sections"]), f"{args.output}/debug/sections")
        sinks.chapter_tree(out["ranges"], chapters.in_ranges(out["listed"], out["ranges"])).write.mode("overwrite").json(f"{args.output}/debug/chapters")
        if "regions" in out:
            sinks.region_report(out["regions"], out["blocks"]).write.mode("overwrite").json(f"{args.output}/debug/regions")


def run_analyze(spark, args: argparse.Namespace) -> None:
    from pyspark.sql import functions as F

    from .operators.sinks import write_texts
    from .plans.pipeline import analyze_corpus
    from .sources.recognition import recognise_pages

    services = services_of(args)
    if services is None or services.analyse is None:
        raise SystemExit("analyze needs --services with read and analyse")
    files = spark.read.format("binaryFile").load(args.paths).select(F.xxhash64("path").alias("doc_id"), F.col("modificationTime").alias("mtime"), F.lit(0).alias("page_no"), F.col("content").alias("document"))
    texts = recognise_pages(files, services.read, f"{args.output}/recognised").select("doc_id", F.col("markdown").alias("text"))
    write_texts(texts, f"{args.output}/extracted")
    write_texts(analyze_corpus(texts, services.analyse, args.output, tuple(args.types.split(","))), f"{args.output}/summary", "json")


def run_check(args: argparse.Namespace) -> int:
    from .sources.recognition import Recogniser, Vision, reachable

    s = service_settings(args)
    vision = None
    if s["vision_endpoint"]:
        vision = Vision.configured({}, key=s["api_key"], endpoint=s["vision_endpoint"], deployment=s["vision_deployment"], mode=s["vision_mode"])
    found = reachable(Recogniser(s["ocr_endpoint"] or "", s["api_key"] or ""), vision)
    for name, state in found.items():
        print(f"{name}: {state}")
    return int(any(v != "ok" for v in found.values()))


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    if args.command == "check":
        return run_check(args)
    if args.command == "convert":
        checked(args)
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.appName("statuta").getOrCreate()
    run_convert(spark, args) if args.command == "convert" else run_analyze(spark, args)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
