from __future__ import annotations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from pagewright.llm.leakage import ItemIndex, leaked_items, myers_ends
from pagewright.llm.textkit import PAGE_BREAK, words


def edit_within(pattern, text, limit):
    row = [0] * (len(text) + 1)
    for i, x in enumerate(pattern):
        fresh = [i + 1]
        for j, y in enumerate(text):
            fresh.append(min(row[j] + (x != y), row[j + 1] + 1, fresh[j] + 1))
        row = fresh
    return min(row) <= limit


@given(st.lists(st.integers(0, 2), max_size=9), st.lists(st.integers(0, 2), max_size=12), st.integers(0, 4))
@settings(max_examples=300, deadline=None)
def test_myers(pattern, text, limit):
    assert bool(list(myers_ends(pattern, text, limit))) == edit_within(pattern, text, limit)


def brute(item, text):
    need = -(-len(item) // 2)
    for d in range(-len(item), len(text)):
        for i in range(len(item)):
            errors = 0
            for n, j in enumerate(range(i, len(item)), 1):
                if not 0 <= j + d < len(text):
                    break
                errors += item[j] != text[j + d]
                if n >= need and errors * 10 <= n:
                    return True
    return False


def test_search_against_brute_force():
    rng = np.random.default_rng(3)
    vocabulary = [f"w{k}" for k in range(12)]
    items = [(k, " ".join(rng.choice(vocabulary, rng.integers(1, 34)))) for k in range(25)]
    index = ItemIndex(items)
    texts = []
    for _ in range(120):
        own = words(items[rng.integers(len(items))][1])
        at, n = rng.integers(len(own)), rng.integers(1, len(own) + 1)
        part = [w if rng.random() > 0.08 else "zz" for w in own[at : at + n]]
        texts.append(" ".join([*rng.choice(vocabulary, rng.integers(0, 6)), *part, *rng.choice(vocabulary, rng.integers(0, 6))]))
    got = set(index.find(texts))
    truth = {(t, k) for t, text in enumerate(texts) for k, item in items if brute(words(item), words(text))}
    assert got == truth and len(truth) > 30


def brute_edits(item, text):
    """By the edit distance of every run of half of the item or of whole tens of words beyond."""
    least = -(-len(item) // 2)
    lengths = [least] + [n for n in range(10, len(item) + 1, 10) if n > least]
    return any(edit_within(item[i : i + n], text, n // 10) for n in lengths for i in range(len(item) - n + 1))


def test_edits_against_brute_force():
    rng = np.random.default_rng(5)
    vocabulary = [f"w{k}" for k in range(14)]
    items = [(k, " ".join(rng.choice(vocabulary, rng.integers(1, 50)))) for k in range(14)]
    index, strict = ItemIndex(items, replaced=False), ItemIndex(items)
    texts = []
    for _ in range(60):
        own = words(items[rng.integers(len(items))][1])
        at, n = rng.integers(len(own)), rng.integers(1, len(own) + 1)
        part: list[str] = []
        for w in own[at : at + n]:
            draw = rng.random()
            part += [w, "zz"] if draw < 0.05 else [] if draw < 0.08 else [w]
        texts.append(" ".join([*rng.choice(vocabulary, rng.integers(0, 6)), *part, *rng.choice(vocabulary, rng.integers(0, 6))]))
    got, fewer = set(index.find(texts)), set(strict.find(texts))
    truth = {(t, k) for t, text in enumerate(texts) for k, item in items if brute_edits(words(item), words(text))}
    assert got == truth and len(truth) > 20
    assert fewer < got


def test_inserted_words_and_the_verdict_of_myers(monkeypatch):
    own = [f"word{k}" for k in range(40)]
    text = " ".join(own[:13] + ["oh"] + own[13:27] + ["well"] + own[27:])
    assert ItemIndex([(1, " ".join(own))], replaced=False).find([text]) == [(0, 1)]
    half = " ".join(own[:8] + ["x", "y", "z"] + own[8:14] + ["u", "v"] + own[14:20])
    for replaced in (True, False):
        assert ItemIndex([(1, " ".join(own))], replaced=replaced).find([half]) == []
    monkeypatch.setattr("pagewright.llm.leakage.myers_ends", lambda pattern, text, limit: iter(()))
    for replaced in (True, False):
        assert ItemIndex([(1, " ".join(own))], replaced=replaced).find([" ".join(own)]) == []


def test_tables(spark):
    item = " ".join(f"Word{k}" for k in range(40))
    half = item.split()[:20]
    rows = [
        (1, "start " + " ".join(half) + " end", 0), (2, " ".join(half[:10] + [PAGE_BREAK] + half[10:]), 0), (3, " ".join(half[:19]), 0), (4, " ".join(half[:5] + ["x"] + half[6:12] + ["y"] + half[13:]), 0),
        (5, " ".join(half[:5] + ["x", "y", "z"] + half[8:]), 0), (6, None, 0), (7, "", 0), (1, "other copy", 0), (8, ("filler words " * 50_000) + item.upper(), 0), (9, " ".join(reversed(item.split())), 0),
    ]
    documents = spark.createDataFrame(rows, "doc_id bigint, text string, item_id int")
    items = spark.createDataFrame([(7, item, "t"), (8, None, "t"), (9, "?!", "t"), (7, item, "u")], "item_id bigint, item_text string, text string")
    for block in (20_000, 1):
        got = sorted(map(tuple, leaked_items(documents, items, block_rows=block).collect()))
        assert got == [(1, 7), (2, 7), (4, 7), (8, 7)]
    assert leaked_items(documents.where("false"), items).count() == 0 and leaked_items(documents, items.where("false")).count() == 0
