from __future__ import annotations

import json

import pytest

from pagewright import cli
from pagewright.functions.text import PAGE_BREAK
from pagewright.generation.client import OfflineClient, Reply
from pagewright.generation.config import ProviderConfig
from pagewright.operators import selection
from pagewright.plans.pipelines import Flow, Settings
from pagewright.sources import scans, sinks


class Recording:
    """Replies with a JSON object, after what the prompt asks for."""

    def __init__(self, folder):
        self.folder = str(folder)

    def generate(self, requests):
        return [self.one(r) for r in requests]

    def one(self, request):
        own = OfflineClient().generate([request])[0]
        if "has_table_of_contents" in (request.schema or ""):
            return Reply(True, json.dumps({"explanation": "e", "has_table_of_contents": "real" in request.prompt}), None, 3, 1)
        if "begin" in request.prompt and request.images[0].endswith("bad"):
            return Reply(False, error="no")
        if request.images and "queries" in (request.schema or ""):
            return Reply(True, json.dumps({"queries": ["|".join([*request.captions, *request.images])]}), None, 1, 1)
        return own


def flow(spark, path, **settings):
    return Flow(spark, str(path), Recording(path), ProviderConfig({"text": "m"}), Settings(**settings))


def test_visual_descriptions_and_queries_of_pages(spark, tmp_path):
    images = spark.createDataFrame([("a", k, f"data:image/png;base64,a{k}") for k in range(5)] + [("b", 0, "data:image/png;base64,bad")], "filename string, page int, url string")
    own = flow(spark, tmp_path, section_size=2, document_description="nothing known")
    described = {r["filename"]: r["description"] for r in own.visual_descriptions(images).collect()}
    assert described["a"].startswith("description ") and described["b"] == "nothing known"
    combined = spark.createDataFrame([("s", ["one", "two"], ["a", "b"], [[1, 2], [0]])], "summary_id string, original_summaries array<string>, filenames array<string>, page_numbers array<array<int>>")
    rows = {r["query"]: (r["filenames"], r["page_numbers"]) for r in own.page_queries(images, combined).collect()}
    url = "data:image/png;base64,"
    assert rows[f"{url}a0|{url}a1"] == (["a"], [[0, 1]]) and rows[f"{url}a4"] == (["a"], [[4]])
    assert rows[f"Images of section 1|Images of section 1|Images of section 2|{url}a1|{url}a2|{url}bad"] == (["a", "b"], [[1, 2], [0]])
    assert len(rows) == 5


def test_contents_pages_are_confirmed_and_usage_is_logged(spark, tmp_path):
    listing = lambda word: f"Table of contents {word}\n" + "\n".join(f"Part {'abcdefghi'[k]} of it {k * 3 + 1}" for k in range(9))
    body = [f"# Part {'abcdefghi'[k // 3]} of it\ntext" if k % 3 == 0 else "text" for k in range(27)]
    frame = spark.createDataFrame([(word, f"\n{PAGE_BREAK}\n".join([listing(word), *body])) for word in ("real", "fake")], "filename string, content string")
    own = flow(spark, tmp_path, check_contents=True)
    assert [r["filename"] for r in own.contents_pages(frame).collect()] == ["real"]
    own.markdown_summaries(frame)
    sizes = {}
    for r in spark.read.parquet(f"{tmp_path}/sections").collect():
        sizes.setdefault(r["filename"], []).append(len(r["page_numbers"]))
    assert sizes["fake"] == [5, 5, 5, 5, 5, 3] and sizes["real"] != sizes["fake"]
    log = {r["batch_description"]: r for r in spark.read.json(f"{tmp_path}/usage").collect()}
    assert log["check_contents_page"]["call_count"] == 2 and log["check_contents_page"]["input_tokens"] == 6 and log["describe_document"]["call_count"] == 2
    flow(spark, tmp_path, check_contents=True, overwrite=True).contents_pages(frame)  # replies are known
    assert spark.read.json(f"{tmp_path}/usage").where("batch_description = 'check_contents_page'").count() == 1


def test_balanced_selection(spark):
    rows = []
    for k in range(60):
        kind = k % 3  # several documents, one document, single
        files = [["a", "b"], ["a", "a"], ["a"]][kind]
        pages = [[[k], [k + 1]], [[k], [k + 1]], [[k]]][kind]
        rows.append((f"s{k}", k, files, pages, kind < 2, 5 if k != 7 else 3))
    rows.append(("copy", 99, ["a", "b"], [[0], [1]], True, 5))
    grades = ", ".join(f"{g} as {c}" for g, c in zip(["grade"] * 4, selection.CRITERIA))
    judged = spark.createDataFrame(rows, "summary_id string, ord int, filenames array<string>, page_numbers array<array<int>>, combined boolean, grade int").selectExpr("*", grades.split(", ")[0], *grades.split(", ")[1:])
    sections = spark.createDataFrame([("a", '<!--<annotation kind="x">-->', list(range(30))), ("a", "plain", list(range(30, 70)))], "filename string, section string, page_numbers array<int>")
    chosen = selection.balanced_selection(judged, sections, 40).collect()
    assert len(chosen) >= 40 and "copy" not in {r["summary_id"] for r in chosen} and "s7" not in {r["summary_id"] for r in chosen}
    for r in chosen:
        kind = 0 if len(set(r["filenames"])) > 1 else 1 if len(r["filenames"]) > 1 else 2
        visual = min(min(p) for p in r["page_numbers"]) < 30
        assert r["bucket_no"] == kind + (0 if visual else 3)
        assert r["selected_reason"] == selection.BUCKET_REASONS[r["bucket_no"]]
    assert selection.BUCKET_REASONS[1] == "summary based on sections from a single document with visual information" and len(set(selection.BUCKET_REASONS)) == 6


def test_vectors_are_kept_by_their_text(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    def embedder(texts):
        import numpy as np

        calls.add(len(texts))
        return np.array([[float(len(t)), 1.0] for t in texts])

    first = spark.createDataFrame([(k, "x" * k) for k in range(6)], "ord bigint, summary string")
    assert flow(spark, tmp_path).embedded(first, embedder, 2).count() == 6
    before = calls.value
    second = first.where("ord < 5").unionByName(spark.createDataFrame([(5, "new")], first.schema))
    assert flow(spark, tmp_path, overwrite=True).embedded(second, embedder, 2).count() == 6
    assert calls.value - before < before  # the one text that is new


def test_commands(spark, tmp_path, capsys):
    folder, out = tmp_path / "in", tmp_path / "out"
    folder.mkdir()
    for k in range(3):
        (folder / f"Docu ment-{k}.md").write_text(f"# T{k}\ntext\n{PAGE_BREAK}\nmore")
    assert cli.main(["normalize", "--in", str(folder)]) == 0
    assert sorted(p.name for p in folder.glob("*.md")) == [f"docu_ment_{k}.md" for k in range(3)]
    settings = tmp_path / "s.yaml"
    settings.write_text("wanted: 2\niterations: 2\nprovider: {name: offline, models: {text: m}}\n")
    assert cli.main(["end-to-end", "--in", str(folder), "--out", str(out), "--settings", str(settings), "--log", str(tmp_path / "log.txt")]) == 0
    assert spark.read.json(f"{out}/page_manifest.jsonl").count() == 6 and "end-to-end done" in (tmp_path / "log.txt").read_text()
    assert {"final_queries", "usage", "selected", "vectors"} <= {p.name for p in out.iterdir()}
    assert set(r["selected_reason"] for r in spark.read.parquet(f"{out}/selected").collect()) <= set(selection.BUCKET_REASONS)
    assert cli.main(["check", "--in", str(folder), "--other", str(tmp_path)]) == 1
    assert cli.main(["smoke", "--out", str(out)]) == 0
    (folder / "Docu-Ment_0.md").write_text("x")
    assert cli.main(["normalize", "--in", str(folder)]) == 1
    settings.write_text("unknown: 1\n")
    with pytest.raises(SystemExit):
        cli.main(["summaries", "--in", str(folder), "--settings", str(settings)])


def pdf_text(data, first=0, last=0):
    return f"part {first} of {data.decode()}"


def pdf_pages(data):
    return 90


def pdf_image(data, page):
    return b"png"


def test_pdf_commands(spark, tmp_path):
    folder = tmp_path / "pdfs"
    folder.mkdir()
    (folder / "x.pdf").write_bytes(b"x")
    args = ["--in", str(folder), "--converter", "tests.test_flows:pdf_text", "--counter", "tests.test_flows:pdf_pages"]
    assert cli.main(["extract-text", *args, "--out", str(tmp_path / "texts"), "--formats", "md,html,json,doctags"]) == 0
    assert (tmp_path / "texts" / "x.md").read_text() == f"part 0 of x\n{PAGE_BREAK}\npart 30 of x\n{PAGE_BREAK}\npart 60 of x"
    assert "<section><p>part 30 of x</p></section>" in (tmp_path / "texts" / "x.html").read_text() and (tmp_path / "texts" / "x.doctags").read_text().count("<page_break>") == 2
    (tmp_path / "texts" / "x.md").write_text("kept")
    assert cli.main(["extract-text", *args, "--out", str(tmp_path / "texts")]) == 0 and (tmp_path / "texts" / "x.md").read_text() == "kept"
    args[3] = "tests.test_flows:pdf_image"
    assert cli.main(["create-images", *args, "--out", str(tmp_path / "imgs")]) == 0
    assert scans.read_images(spark, str(tmp_path / "imgs")).count() == 90
    assert cli.main(["create-images", *args, "--out", str(tmp_path / "imgs")]) == 0
    (tmp_path / "imgs" / "a_empty").mkdir()
    assert scans.read_images(spark, str(tmp_path / "imgs"), 1).count() == 0 and scans.read_images(spark, str(tmp_path / "imgs"), 2).count() == 90
    assert sinks.as_html("# A & B\n\ntext") == "<!DOCTYPE html><html><body><section><h1>A &amp; B</h1><p>text</p></section></body></html>"
