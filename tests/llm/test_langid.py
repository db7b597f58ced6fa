from __future__ import annotations

import pytest

from pagewright.llm import langid

LANGUAGES = {
    "english": ["the pump was repaired in the spring by the team", "which measures did the office take to protect the water", "how did the plant change the contracts after the visit"],
    "french": ["la pompe a été réparée au printemps par l'équipe", "quelles mesures le bureau a-t-il prises pour protéger l'eau", "comment l'usine a-t-elle modifié les contrats après la visite"],
    "german": ["die pumpe wurde im frühjahr von der gruppe repariert", "welche maßnahmen ergriff das büro um das wasser zu schützen", "wie veränderte das werk die verträge nach der besichtigung"],
}


@pytest.fixture(scope="module")
def model():
    samples = [(name, f"s{n}{k}", text) for name, texts in LANGUAGES.items() for n, text in enumerate(texts) for k in range(4)]
    return langid.fit(samples, clusters=2)


def test_whole_and_mixed_texts(model):
    for name, texts in LANGUAGES.items():
        for text in texts:
            assert {s[2] for s in model.segments(text)} == {name}
    mixed = "Which measures did the office take? Wie veränderte das Werk die Verträge?"
    found = model.segments(mixed)
    assert [s[2] for s in found] == ["english", "german"] and mixed[found[1][0] : found[1][1]].strip().startswith("Wie")
    assert all(0 < s[3] <= 1 for s in found)


def test_upper_case_lost_accents_and_titles(model):
    assert {s[2] for s in model.segments("WELCHE MASSNAHMEN ERGRIFF DAS BURO")} == {"german"}
    assert {s[2] for s in model.segments("How did the plant (« la visite du bureau ») change the contracts")} == {"english"}


def test_rejection(model):
    for text in ("", "   ", None, "12 345 !!", "Zzyzx Qwrtz", "水の都"):
        assert model.segments(text) == []


def test_agreeing_finds_the_wrong_labels():
    samples = [("english", f"e{k}", "heating cost of the plant") for k in range(9)] + [("french", f"f{k}", "coût du chauffage de l'usine") for k in range(9)] + [("french", "x", "heating cost of the plant")]
    good = langid.agreeing(samples)
    assert all(good[:-1]) and not good[-1]


def test_tables(spark, model):
    names = spark.createDataFrame([("en", "english"), ("English", "english"), ("de", "german"), ("fr", "french")], "alias string, language string")
    rows = [
        (1, "English", "which measures did the office take", "a"), (2, "de", "which measures did the office take", "b"), (3, None, "comment l'usine a modifié les contrats", "c"),
        (4, "en", "How did the plant change? Welche Maßnahmen ergriff das Büro?", "d"), (5, None, None, "e"), (6, None, " ", "f"), (7, "en", "!!", "g"), (2, "de", "which measures did the office take", "z"),
    ]
    queries = spark.createDataFrame(rows, "query_id bigint, language string, query string, written string")
    got = sorted(map(tuple, langid.label_defects(queries, names, model).collect()))
    assert got == [(2, "english"), (3, "french"), (4, "english"), (4, "german")]
    labelled = {r["query_id"]: r for r in langid.identify(queries.where("query_id <> 2"), model, "query_id", "query").collect()}
    assert labelled[5]["language"] is None and labelled[5]["segments"] == [] and labelled[1]["confidence"] > 0.3
    assert langid.identify(queries.where("false"), model, "query_id", "query").count() == 0
    long = spark.createDataFrame([(1, "how did the plant change the contracts. " * 20_000)], "query_id bigint, query string")
    assert langid.identify(long, model, "query_id", "query").first()["language"] == "english"


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    names = spark.read.parquet(f"{folder}/language_names.parquet")
    model = langid.fit_from_tables(documents.where("doc_id % 2 = 0"), names)
    held = documents.where("doc_id % 2 = 1 and lang is not null and length(text) > 200").join(names.withColumnRenamed("language", "truth"), documents["lang"] == names["alias"])
    rows = held.select("doc_id", "truth").join(langid.identify(documents, model, "doc_id", "text"), "doc_id").collect()
    assert len(rows) > 300 and sum(r["truth"] == r["language"] for r in rows) >= 0.99 * len(rows)
