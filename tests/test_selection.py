from __future__ import annotations

import pytest

from pagewright.operators import quality, querygen, selection, windows

CANDIDATE = "ord bigint, filenames array<string>, page_numbers array<array<int>>, original_summaries array<string>, addition_reason string, " + ", ".join(f"{c} int" for c in selection.CRITERIA)


def candidate(n, files, grades, originals=None):
    return (n, files, [[0]] * len(files), originals, None, *grades)


def test_priority_by_bucket_then_fallback(spark):
    rows = [candidate(0, ["a"], [5] * 4), candidate(1, ["a"], [5] * 4, ["x"]), candidate(2, ["a", "b"], [4] * 4), candidate(3, ["a"], [5, 5, 4, 3]), candidate(4, ["a"], [2] * 4), candidate(5, ["a"], [None, 5, 5, 5])]
    frame = spark.createDataFrame(rows, CANDIDATE)
    got = [r["ord"] for r in selection.priority_fill(frame, 5).collect()]
    assert got[:4] == [2, 1, 0, 3]
    assert selection.priority_fill(frame, 0).count() == 0


def test_quota_examples():
    sums = lambda plan: sum(h - low for *_, low, h in plan)
    assert sums(selection.quota_plan([10] * 6, 50)) == 51
    assert sums(selection.quota_plan([200] * 6, 50)) == 87
    assert sums(selection.quota_plan([200] * 6, 400)) == 459
    assert sums(selection.quota_plan([200] * 6, 400, strict=True)) == 400
    with pytest.raises(ValueError):
        selection.quota_plan([1] * 6, 50)


def test_quota_rows(spark):
    frame = spark.createDataFrame([(n, n % 6) for n in range(60)], "ord bigint, bucket_no int")
    rows = selection.quota_round_robin(frame, 50).collect()
    assert len(rows) == 51 and len({r["ord"] for r in rows}) == 51


def test_visual_is_a_cross_of_files_and_pages(spark):
    summaries = spark.createDataFrame([(1, ["a", "b"], [[0], [5]]), (2, ["a"], [[9]]), (3, None, None)], "summary_id bigint, filenames array<string>, page_numbers array<array<int>>")
    parts = spark.createDataFrame([("b", "x <!--<annotation kind= y", [0]), ("a", "plain", [9])], "filename string, section string, page_numbers array<int>")
    got = {r["summary_id"]: r["visual"] for r in selection.touched_visual(summaries, parts).collect()}
    assert got == {1: True, 2: False, 3: False}


def test_windows(spark):
    lists = spark.createDataFrame([("a", [1, 2, 10]), ("b", []), ("c", [4])], "filename string, pages array<int>")
    rows = [tuple(r) for r in windows.sliding_windows(lists, 2, 1).orderBy("filename", "window").collect()]
    assert rows == [("a", 0, [1, 2]), ("a", 1, [2, 10]), ("a", 2, [10]), ("c", 0, [4])]
    capped = windows.capped_windows(windows.sliding_windows(lists, 1, 1), 2, 2).orderBy("filename", "window").collect()
    assert [(r["filename"], r["window"]) for r in capped] == [("a", 0), ("a", 1)]
    with pytest.raises(ValueError):
        windows.sliding_windows(lists, 0, 1)


def test_gate_and_final_choice(spark):
    schema = "qtj_id bigint, query string, rephrased_query string, supposed_query_type string, supposed_query_format string, relevancy int, self_sufficiency int, persona_adaptation int, query_type_following boolean, query_format_following boolean, judged_ok boolean"
    rows = [(1, "q", "r", "numerical", "question", 5, 4, 4, True, True, True), (2, "q", None, "boolean", "keyword", 5, 5, 5, True, True, True), (3, "q", "r", "numerical", "question", 5, 3, 4, True, True, True), (4, "q", "r", None, None, None, None, None, None, None, None)]
    frame = spark.createDataFrame(rows, schema)
    got = {r["qtj_id"]: r["status"] for r in quality.query_gate(frame).collect()}
    assert got == {1: "keep", 2: "discard", 3: "discard", 4: "error"}
    rates = quality.gate_rates(quality.query_gate(frame)).first()
    assert rates["queries"] == 4 and rates["kept_share"] == pytest.approx(1 / 3)
    final = {r["qtj_id"]: r for r in quality.final_queries(frame).collect()}
    assert final[2]["query"] == "q" and final[2]["generation_process"] == "original"
    assert quality.gate_rates(quality.query_gate(frame.where("false"))).first()["kept_share"] is None


def test_allocation_keeps_its_caps(spark):
    frame = spark.range(400).withColumnRenamed("id", "summary_id")
    rows = querygen.question_allocation(frame).collect()
    for r in rows:
        assert r["adversarial"] + r["textual"] + r["tabular"] + r["visual"] == 3
        assert r["adversarial"] <= 1 and r["tabular"] <= 1 and r["visual"] <= 1
    modules = querygen.module_sample(querygen.question_allocation(frame)).collect()
    assert len(modules) == sum(r["textual"] + r["tabular"] + r["visual"] for r in rows)
    assert all(m["format"] not in querygen.FORBIDDEN.get(m["type"], ()) for m in modules)
    again = querygen.module_sample(querygen.question_allocation(frame.repartition(7))).collect()
    assert sorted(map(tuple, modules)) == sorted(map(tuple, again))
