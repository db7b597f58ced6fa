from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pagewright.llm.splitting import merge_atoms, split_oversized, split_text

TEXT = st.text(st.sampled_from("ab .\n#é"), max_size=200)


@given(TEXT, st.integers(1, 40), st.integers(0, 30))
@settings(max_examples=300, deadline=None)
def test_pieces_cover_the_text_within_the_limit(text, most, overlap):
    pieces = split_text(text, most, overlap)
    assert all(end - begin <= most for begin, _, end, _ in pieces)
    assert "".join(text[core:end] for _, core, end, _ in pieces) == text
    assert (len(pieces) > 1) == (len(text) > most)
    for (begin, core, _, _), (_, before, _, _) in zip(pieces[1:], pieces):
        assert max(core - overlap, before) <= begin <= core


def brute_merge(marks, length, room):
    pieces = [[b, e, s] for (b, s), e in zip(marks, [m[0] for m in marks[1:]] + [length])]
    while True:
        fits = [(pieces[i][2], pieces[i][1] - pieces[i - 1][0], pieces[i][0], i) for i in range(1, len(pieces)) if pieces[i][1] - pieces[i - 1][0] <= room]
        if not fits:
            return [(b, s) for b, _, s in pieces]
        i = min(fits)[3]
        pieces[i - 1][1] = pieces[i][1]
        del pieces[i]


@given(st.lists(st.tuples(st.integers(1, 6), st.integers(0, 6)), min_size=1, max_size=25), st.integers(4, 20))
@settings(max_examples=200, deadline=None)
def test_heap_merges_like_brute_force(parts, room):
    marks, at = [], 0
    for size, strength in parts:
        marks.append((at, strength))
        at += size
    assert merge_atoms(marks, at, room) == brute_merge(marks, at, room)


def test_natural_boundaries_are_preferred():
    text = "First one. " * 5 + "\n\n## Head\n\n" + "Second one. " * 5
    cores = [c for _, c, _, _ in split_text(text, 70, 5)]
    assert text[cores[1] :].startswith("## Head")
    with pytest.raises(ValueError):
        split_text("abc", 0, 0)


def test_edge_rows(spark):
    limits = spark.createDataFrame([("document", 10, 3), ("other", 1, 0)], "item_kind string, max_chars int, overlap_chars int")
    rows = [("a", "x" * 25, "zz"), ("a", "x" * 25, "yy"), ("b", "", None), ("c", None, None), ("d", "ü" * 10, None), (None, "abc", None), ("e", "long " * 50_000, None)]
    frame = spark.createDataFrame(rows, "id string, content string, piece string")
    got = {}
    for r in split_oversized(frame, limits, "document", "id", "content").collect():
        got.setdefault(r["item_id"], []).append(r)
    assert set(got) == {"a", "b", "d", "e"}
    assert len(got["b"]) == 1 and got["b"][0]["text"] == "" and len(got["d"]) == 1
    assert len(got["a"]) == got["a"][0]["pieces"] and max(len(r["text"]) for r in got["e"]) <= 10
    assert split_oversized(frame.where("false"), limits, "document", "id", "content").count() == 0
    assert split_oversized(frame, limits.where("false"), "document", "id", "content").count() == 0
