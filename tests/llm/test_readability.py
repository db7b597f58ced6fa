from __future__ import annotations

import numpy as np

from pagewright.llm import readability

EASY = "The cat sat. The dog ran. A boy got a red cup. "
HARD = "The institutional harmonisation of heterogeneous procurement frameworks substantiates the supplementary verification of electrochemical degradation mechanisms, whereas the disproportionate accumulation of actuarial liabilities circumscribes the convergence of incommensurable estimators. "


def test_prose_and_ranks():
    assert readability.prose("# Head\ntext <!-- note -->more\n| a | b |\n- item\n> quoted").split() == ["text", "more", "quoted"]
    assert readability.rank_table(np.array([5, 9, 5, 0])).tolist() == [2, 1, 2, 4]


def test_counts_are_of_all_texts(spark):
    frame = spark.createDataFrame([("a b b",), (None,), ("B é",)] * 50, "text string").repartition(5)
    table = readability.word_counts(frame)
    assert table.sum() == 250 and table[readability._slot("b")] == 150 and table[readability._slot("e")] == 50


def test_levels(spark):
    samples = spark.createDataFrame([(k, (EASY if k % 2 else HARD) * (3 + k), 1 if k % 2 else 4) for k in range(8)], "sample_id bigint, sample_text string, reading_level int")
    rows = [(1, EASY * 30, "en"), (2, HARD * 10, "en"), (3, None, "en"), (4, " ", "en"), (5, EASY * 30, "de"), (6, EASY, "en"), (7, EASY * 40 + HARD, "en"), (1, EASY * 30, "en"), (8, HARD * 2_000, "en"), (9, "- a\n" * 60, "en")]
    documents = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, lang string, reading_level string")
    got = sorted(map(tuple, readability.document_levels(documents, samples).collect()))
    assert [r for r in got if r[0] != 9] == [(1, 1), (2, 4), (7, 1), (8, 4)]
    assert readability.document_levels(documents.where("false"), samples).count() == 0
    assert readability.document_levels(documents, samples.where("false")).where("reading_level is not null").count() == 0


def test_leave_one_half_out(spark):
    samples = spark.read.parquet("/root/testdata/sf0.01/reading_samples.parquet")
    corpus = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang = 'en'")
    held = samples.where("sample_id % 8 >= 4").withColumnRenamed("sample_text", "text").drop("reading_level")
    found = readability.reading_levels(held, samples.where("sample_id % 8 < 4"), "sample_id", "text", corpus=corpus)
    rows = found.join(samples.selectExpr("sample_id", "reading_level as truth"), "sample_id").collect()
    assert len(rows) == 40 and sum(r["truth"] == r["reading_level"] for r in rows) >= 38
