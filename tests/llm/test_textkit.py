from __future__ import annotations

import pytest

from pagewright.llm.textkit import one_per_key, one_per_key_in_place


@pytest.mark.parametrize("most", [0, 1, 100])
def test_one_row_of_each_key(spark, most):
    rows = [("a", "x", 1), ("a", "b", 2), ("b", None, 1), ("b", None, 2), ("c", "", 1), (None, "lost", 1), ("d", "only", 3)]
    frame = spark.createDataFrame(rows, "id string, text string, n int")
    want = sorted(map(tuple, one_per_key(frame, "id", "text").collect()), key=repr)
    assert want == [("a", "b"), ("b", None), ("c", ""), ("d", "only")]
    assert sorted(map(tuple, one_per_key_in_place(frame, "id", "text", most=most).collect()), key=repr) == want
    assert one_per_key_in_place(frame.where("false"), "id", "text", most=most).count() == 0
    assert sorted(r["id"] for r in one_per_key_in_place(frame, "id", most=most).collect()) == list("abcd")
