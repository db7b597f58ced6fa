"""Command line: one subcommand for each flow and check.

Settings are a YAML file: those of a flow, and under ``provider`` the name ('offline',
'converse', 'completions'), models by role and what else the client needs.  What reads or
renders PDFs is named as module:function.
"""

from __future__ import annotations

import argparse
import dataclasses
import importlib
import logging
from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.functions.text import PAGE_BREAK, data_url
from pagewright.generation.config import ProviderConfig
from pagewright.generation.providers import make_client
from pagewright.operators import quality, reconcile, toc
from pagewright.plans.pipelines import Flow, Settings
from pagewright.session import local_session
from pagewright.sources import scans, sinks

LOG = logging.getLogger("pagewright")


def named(spec: str | None) -> Callable[..., Any]:
    """The function that module:function names."""
    if not spec or ":" not in spec:
        raise SystemExit("this command needs --converter (and --counter), as module:function")
    module, name = spec.split(":", 1)
    return getattr(importlib.import_module(module), name)


def make_flow(spark: SparkSession, out: str, settings: str | None, required: tuple[str, ...] = ()) -> Flow:
    """A flow from a settings file; unknown settings and missing ones are errors."""
    if required and not settings:
        raise SystemExit(f"this command needs --settings with {', '.join(required)}")
    own = scans.read_settings(settings, required) if settings else {}
    given = own.pop("provider", None) or {}
    given = {"name": given} if isinstance(given, str) else dict(given)
    url, threads = given.pop("url", None), given.pop("threads", 4)
    given["provider"] = given.pop("name", "offline")
    config = ProviderConfig(**{"models": {"text": own.pop("model", "offline")}, **given})
    unknown = sorted(set(own) - {f.name for f in dataclasses.fields(Settings)})
    if unknown:
        raise SystemExit(f"unknown settings: {unknown}")
    return Flow(spark, out, make_client(config, url=url, threads=threads), config, Settings(**own))


def _images(spark: SparkSession, folder: str) -> DataFrame:
    images = scans.read_images(spark, folder, with_content=True)
    return images.select("filename", "page", data_url(F.col("path"), F.col("content")).alias("url"))


def _excluded(spark: SparkSession, manifest: str | None) -> DataFrame | None:
    if manifest is None:
        return None
    return spark.read.schema("filename string, image_page_number int, exclude_from_visual_summaries boolean, exclude_from_image_rendering boolean").json(manifest)


def manifest(spark: SparkSession, args: argparse.Namespace) -> None:
    """score pages and write the page manifest; PDFs with --converter, else Markdown"""
    if args.converter:
        pages = scans.read_pdf_pages(spark, args.source, named(args.converter))
        failed = pages.where("page_index is null").select("filename", F.col("parse_status").alias("error"))
        listed = pages.select("filename").distinct().join(failed, "filename", "left")
        pages = pages.where("page_index is not null")
    else:
        documents = scans.read_markdown(spark, args.source)
        pages = documents.select("filename", F.posexplode(F.split("content", PAGE_BREAK, -1)).alias("page_index", "page")).select("filename", "page_index", F.split("page", "\n", -1).alias("lines"))
        listed = documents.select("filename")
    found = toc.page_manifest(pages)
    sinks.write_json_lines(found, f"{args.out}/page_manifest.jsonl")
    sinks.write_csv(found, f"{args.out}/page_manifest.csv")
    sinks.write_csv(toc.document_summary(found, listed), f"{args.out}/toc_detection_summary.csv")


def images(spark: SparkSession, args: argparse.Namespace) -> None:
    """render the pages of PDFs, without those that a manifest excludes and documents done before"""
    pages = _excluded(spark, args.manifest)
    excluded = toc.excluded_pages(pages, toc.EXCLUSION_FIELDS[1]) if pages is not None else None
    rendered = scans.render_pdf_pages(spark, args.source, named(args.converter), named(args.counter), excluded, done=sinks.folders(spark, args.out))
    LOG.info("%d pages rendered", sinks.write_images(rendered, args.out))


def extract(spark: SparkSession, args: argparse.Namespace) -> None:
    """convert PDFs to Markdown and other formats; documents done before are left out"""
    done = sinks.stems(spark, args.out, ".md")
    parts = scans.read_pdf_markdown(spark, args.source, named(args.converter), named(args.counter), done=done)
    whole = scans.joined_parts(parts)
    for suffix in args.formats.split(","):
        LOG.info("%d files as %s", sinks.write_documents(whole.where("error is null"), args.out, suffix), suffix)
    sinks.write_json_lines(whole.where("error is not null").select("filename", "error"), f"{args.out}/errors")


def summaries(spark: SparkSession, args: argparse.Namespace) -> None:
    """sections and summaries of Markdown documents"""
    make_flow(spark, args.out, args.settings).markdown_summaries(scans.read_markdown(spark, args.source))


def visual(spark: SparkSession, args: argparse.Namespace) -> None:
    """descriptions and summaries of page images, combined, judged and selected"""
    flow, shown = make_flow(spark, args.out, args.settings, ("wanted",)), _images(spark, args.source)
    described = flow.visual_descriptions(shown)
    single = flow.visual_summaries(shown, _excluded(spark, args.manifest), described)
    flow.selected(single, flow.combined_summaries(single) if flow.settings.combine else None)


def pages(spark: SparkSession, args: argparse.Namespace) -> None:
    """queries that a vision model writes for windows of page images"""
    make_flow(spark, args.out, args.settings).page_queries(_images(spark, args.source))


def queries(spark: SparkSession, args: argparse.Namespace) -> None:
    """typed queries of selected summaries of Markdown documents, through all gates"""
    flow = make_flow(spark, args.out, args.settings, ("wanted",))
    single = flow.markdown_summaries(scans.read_markdown(spark, args.source))
    combined = flow.combined_summaries(single) if flow.settings.combine else None
    flow.queries(flow.selected_in_turn(single, spark.read.parquet(f"{args.out}/sections"), combined))


def postprocess(spark: SparkSession, args: argparse.Namespace) -> None:
    """drop queries that hold their answer from a table of queries, and rephrase half of the others"""
    flow = make_flow(spark, args.out, args.settings)
    own = spark.read.parquet(args.source)
    checked = flow.stage("answer_check", lambda: flow.ask(own, "detect_answer"))
    free = quality.without_answer(checked.withColumn("has_answer", F.col("value.has_answer"))).drop("ok", "error", "value", "has_answer")
    kinds = free.withColumn("query_type", F.col("supposed_query_type")).withColumn("query_format", F.col("supposed_query_format"))
    said = flow.stage("rephrased", lambda: flow.ask(kinds, "rephrase_query"))
    flow.stage("final_queries", lambda: quality.final_queries(said.withColumn("rephrased_query", F.col("value.rephrased_query")).drop("value", "ok", "error", "query_type", "query_format"), "query_id"))


def check(spark: SparkSession, args: argparse.Namespace) -> int:
    """compare the listings of two folders of documents"""
    different = reconcile.missing_on_either_side(scans.read_markdown(spark, args.source), scans.read_markdown(spark, args.other))
    different.show(1000, truncate=False)
    return int(different.limit(1).count() > 0)


def normalize(spark: SparkSession, args: argparse.Namespace) -> int:
    """give Markdown files normalised names, unless two would have the same"""
    names = reconcile.normalized_names(scans.read_markdown(spark, args.source))
    clashes = names.where("clash").orderBy("normalized", "filename").limit(1000).collect()
    for row in clashes:
        LOG.error("%s and another would be called %s", row["filename"], row["normalized"])
    if clashes:
        return 1
    LOG.info("%d files renamed", sinks.rename_files(spark, args.source, {r["filename"]: r["normalized"] for r in names.where("filename <> normalized").toLocalIterator()}, ".md"))
    return 0


def smoke(spark: SparkSession, args: argparse.Namespace) -> None:
    """ask the configured model once"""
    make_flow(spark, args.out, args.settings).ask(spark.range(1), "smoke_test").show(truncate=False)


def end_to_end(spark: SparkSession, args: argparse.Namespace) -> None:
    """manifest of Markdown documents, their summaries, and queries through all gates"""
    manifest(spark, args)
    queries(spark, args)


COMMANDS = {
    "manifest": manifest, "create-images": images, "extract-text": extract, "summaries": summaries, "visual-summaries": visual, "page-queries": pages, "queries": queries,
    "postprocess": postprocess, "check": check, "normalize": normalize, "smoke": smoke, "end-to-end": end_to_end,
}


def main(argv: Sequence[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="pagewright", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    for name, function in COMMANDS.items():
        command = commands.add_parser(name, help=function.__doc__)
        command.add_argument("--in", dest="source", default=".")
        command.add_argument("--other", default=".")
        command.add_argument("--out", default="out")
        for option in ("settings", "manifest", "converter", "counter", "log"):
            command.add_argument(f"--{option}")
        command.add_argument("--formats", default="md")
    args = parser.parse_args(argv)
    form = logging.Formatter("%(asctime)s %(levelname)s %(message)s")
    handlers: list[logging.Handler] = [logging.StreamHandler(), *([logging.FileHandler(args.log)] if args.log else [])]
    for handler in handlers:
        handler.setFormatter(form)
    LOG.handlers, LOG.propagate = handlers, False
    LOG.setLevel(logging.INFO)
    LOG.info("%s: %s to %s", args.command, args.source, args.out)
    result = COMMANDS[args.command](SparkSession.getActiveSession() or local_session(), args)
    LOG.info("%s done", args.command)
    return int(result or 0)


if __name__ == "__main__":
    raise SystemExit(main())
