from __future__ import annotations

import json
import re

import pytest
from pyspark.sql import functions as F

from pagewright.generation.client import OfflineClient, Reply, Request, RetryingClient, Throttled, backoff
from pagewright.generation.config import ProviderConfig
from pagewright.generation.prompts import TASKS, descriptions_in_one, rendered
from pagewright.generation.runner import cached_replies, parsed, run_prompts, split_failures
from pagewright.plans.pipelines import Flow, Settings


def test_retry_only_on_throttling():
    waits, calls = [], []

    def call(request: Request) -> Reply:
        calls.append(request.prompt)
        if request.prompt == "busy" and calls.count("busy") < 3:
            raise Throttled("later")
        if request.prompt == "bad":
            raise ValueError("no")
        return Reply(True, "fine")

    client = RetryingClient(call, sleep=waits.append, threads=1)
    replies = client.generate([Request("busy"), Request("bad"), Request("good")])
    assert [r.ok for r in replies] == [True, False, True] and replies[1].error == "ValueError: no"
    assert waits == [60.0, 120.0] and backoff(5) == 300.0
    with pytest.raises(ValueError):
        RetryingClient(call, strict=True, threads=1).generate([Request("bad")])


def test_envelope_and_cache(spark, tmp_path):
    frame = rendered(spark.createDataFrame([(k, f"query {k % 5}") for k in range(20)], "n int, query string"), TASKS["detect_answer"])
    replies = run_prompts(frame, OfflineClient(fail_every=2), "m")
    assert replies.count() == 5
    good, bad = split_failures(parsed(replies, TASKS["detect_answer"].ddl, ["has_answer"]))
    assert good.count() + bad.count() == 5 and bad.where("error is null").count() == 0
    path = str(tmp_path / "cache")
    first = cached_replies(frame, OfflineClient(fail_every=2), "m", path).where("ok").count()
    assert first == good.count()
    assert cached_replies(frame, OfflineClient(), "m", path).where("ok").count() == 5


def test_only_documents_are_shortened(spark):
    frame = spark.createDataFrame([("x" * 450_000 + "end", "s" * 450_000 + "end"), ("short", "short")], "content string, section string")
    rows = rendered(frame.withColumn("document_description", F.lit("d")), TASKS["summarise_section"]).orderBy("section").collect()
    assert rows[1]["prompt"].endswith("s" * 450_000 + "end")
    rows = rendered(frame, TASKS["describe_document"]).collect()
    assert {len(r["content"]): (r["shortened"], len(r["prompt"]) > 400_200) for r in rows} == {450_003: (True, False), 5: (False, False)}


def test_corpus_is_described_by_all_documents(spark, tmp_path):
    many = spark.range(10_003).selectExpr("cast(id as string) as filename", "'d' as description")
    assert len(descriptions_in_one(many).first()["descriptions"]) == 10_003

    class Echo:
        def generate(self, requests):
            return [Reply("fail" not in r.prompt, json.dumps({"description": " ".join(sorted(set(re.findall(r"doc\d+", r.prompt))))}), None, 1, 1) for r in requests]

    flow = Flow(spark, str(tmp_path / "a"), Echo(), ProviderConfig({"text": "echo"}))
    names = {f"doc{k}" for k in range(60)}
    frame = spark.createDataFrame([(n, f"about {n} " + "x" * 90) for n in sorted(names)], "filename string, description string")
    row = flow.described_corpus(frame, 1_500).collect()
    assert len(row) == 1 and row[0]["ok"] and set(row[0]["value"]["description"].split()) == names
    assert flow.spark.read.parquet(f"{tmp_path}/a/corpus_description_blocks/0").count() > 3
    flow = Flow(spark, str(tmp_path / "b"), Echo(), ProviderConfig({"text": "echo"}))
    broken = flow.described_corpus(frame.unionByName(spark.createDataFrame([("zz", "fail")], frame.schema)), 1_500).collect()
    assert [r["ok"] for r in broken] == [False]


def test_malformed_payload_is_a_failure(spark):
    frame = spark.createDataFrame([(True, "no json", None), (True, '{"has_answer": true}', None)], "ok boolean, text string, error string")
    assert [r["ok"] for r in parsed(frame, "has_answer boolean", ["has_answer"]).collect()] == [False, True]


def test_config_roles():
    config = ProviderConfig({"text": "a", "judge": "b"}, extra={"judge": {"max_tokens": 1}}, max_concurrency=4)
    assert config.model("vision") == "a" and config.model("judge") == "b"
    assert config.arguments("judge", max_tokens=9) == {"max_tokens": 9} and config.concurrency(50) == 4
    for bad in ({}, {"text": "a", "other": "b"}):
        with pytest.raises(ValueError):
            ProviderConfig(bad)
    for name in ("section_size", "stride", "max_windows", "min_grade"):
        with pytest.raises(ValueError):
            Settings(**{name: 0})


def test_flow_from_documents_to_queries(spark, tmp_path):
    documents = spark.createDataFrame([(f"doc{k}", f"# Title {k}\ntext\n<!-- page break -->\nmore") for k in range(4)], "filename string, content string")
    flow = Flow(spark, str(tmp_path), OfflineClient(), ProviderConfig({"text": "offline"}), Settings(wanted=3, iterations=2, neighbours=2))
    summaries = flow.markdown_summaries(documents)
    assert [r["ord"] for r in summaries.orderBy("ord").collect()] == [0, 1, 2, 3]
    embeddings = summaries.selectExpr("ord", "array(cast(1.0 as float), cast(ord as float) / 10) as embedding")
    combined = flow.combined_summaries(summaries, embeddings)
    assert combined.count() > 0 and combined.where("size(filenames) < 2").count() == 0
    chosen = flow.selected(summaries, combined)
    assert chosen.count() == 3
    final = flow.queries(chosen)
    assert set(final.columns) >= {"query", "original_query", "generation_process", "filenames", "page_numbers", "origin_summary"}
    assert final.count() <= flow.spark.read.parquet(f"{tmp_path}/queries_to_judge").count()


def test_flow_from_images(spark, tmp_path):
    images = spark.createDataFrame([("a", k, f"data:image/png;base64,{k}") for k in (0, 2, 10)], "filename string, page int, url string")
    flow = Flow(spark, str(tmp_path), OfflineClient(), ProviderConfig({"text": "offline"}), Settings(section_size=2))
    rows = flow.visual_summaries(images).orderBy("ord").collect()
    assert [r["page_numbers"] for r in rows] == [[[0, 2]], [[2, 10]], [[10]]]
