from __future__ import annotations

import pytest

from pagewright.operators import toc

SCHEMA = "filename string, page_index int, total_pages int, lines array<string>"
ENTRIES = ["Contents"] + [f"{n} Chapter {n} .... {n * 7}" for n in range(1, 6)]


def scored(spark, *rows):
    return [r.asDict() for r in toc.score_pages(spark.createDataFrame(list(rows), SCHEMA)).orderBy("filename", "page_index").collect()]


def test_titled_page_is_found(spark):
    row = scored(spark, ("a", 1, 80, ENTRIES))[0]
    assert row["is_toc_page"] and row["toc_has_title"] and row["toc_trailing_page_number_count"] >= 4
    assert row["toc_reasons"][0] == "toc_title:+4" and len(row["toc_sample_lines"]) == 5


def test_prose_is_not_found(spark):
    row = scored(spark, ("a", 12, 80, ["This page is about pumps.", "They were repaired in spring.", "Nothing else happened."]))[0]
    assert not row["is_toc_page"] and row["toc_like_line_count"] == 0


def test_late_page_without_title_scores_less(spark):
    listing = [f"Part {n} of the book {n + 10}" for n in range(8)]
    early, late = scored(spark, ("a", 1, 120, listing), ("a", 80, 120, listing))
    assert late["toc_score"] < early["toc_score"] and "late_without_title:-2" in late["toc_reasons"]


def test_null_and_empty_lines(spark):
    rows = scored(spark, ("a", 0, 1, None), ("b", 0, 1, []), ("c", 0, 1, ["", "  "]))
    assert [r["toc_score"] for r in rows] == [1, 1, 1] and all(r["lines"] == [] for r in rows)


def test_manifest_summary_and_exclusions(spark):
    pages = spark.createDataFrame([("a", 0, ENTRIES), ("a", 1, ["Plain text here."]), ("b", 0, ["More text."])], "filename string, page_index int, lines array<string>")
    manifest = toc.page_manifest(pages)
    assert {(r["filename"], tuple(r["pages"])) for r in toc.excluded_pages(manifest).collect()} == {("a", (0,))}
    kept = toc.pages_kept(manifest.select("filename", "page_index"), manifest)
    assert sorted(map(tuple, kept.collect())) == [("a", 1), ("b", 0)]
    listed = spark.createDataFrame([("a", None), ("b", None), ("c", "ValueError: broken")], "filename string, error string")
    summary = {r["filename"]: r for r in toc.document_summary(manifest, listed).collect()}
    assert summary["a"]["toc_pages"] == [1] and summary["a"]["status"] == "ok"
    assert summary["c"]["status"] == "error" and summary["c"]["total_pages"] == 0
    with pytest.raises(ValueError):
        toc.excluded_pages(manifest, "something")
