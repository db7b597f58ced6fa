from __future__ import annotations

import base64
import os

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from pagewright.llm import bpe

pytestmark = pytest.mark.skipif(not os.path.exists(bpe.DEFAULT_VOCABULARY), reason="the public vocabulary is missing")
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@pytest.fixture(scope="module")
def both():
    data = open(bpe.DEFAULT_VOCABULARY, "rb").read()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
    return bpe.ByteBpe(data), tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@given(text=st.text(st.one_of(st.sampled_from("ab' \n\tstrevlmd1²_!é"), st.characters(exclude_categories=["Cs", "Cn"])), max_size=40))
@settings(max_examples=400, deadline=None)
def test_ids_are_those_of_the_pattern_and_ranks(both, text):
    own, other = both
    assert own.encode(text) == other.encode_ordinary(text)
    assert own.decode(own.encode(text)) == text


def test_long_pieces_and_cache(both):
    own, other = both
    text = "".join("abcdefgh23456789"[(k * k + 7 * k) % 16] for k in range(4_000))
    assert own.encode(text) == other.encode_ordinary(text)
    assert all(len(k) <= own.cached_bytes for k in own.cache)
    own.cache_size = 10
    own.encode(" one two three four five six seven eight nine ten eleven twelve")
    assert len(own.cache) <= 10


def test_table(spark, both):
    own, _ = both
    rows = [(1, "It's a test.", "x"), (2, None, "y"), (3, "", None), (4, "  \n ", "z"), (5, "naïve 水 text", ""), (5, "naïve 水 text", ""), (6, "word " * 200_000, ""), (7, "<|endoftext|>", "")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    got = [(r["doc_id"], r["ids"]) for r in bpe.encode_corpus(frame).collect()]
    assert sorted(got) == sorted((k, own.encode(t)) for k, t, _ in rows)
    assert dict(got)[2] == [] and dict(got)[3] == [] and dict(got)[4]
    assert bpe.encode_corpus(frame.where("false")).count() == 0
    for r in bpe.encode_corpus(frame.where("doc_id in (1, 5)"), offsets=True).collect():
        text = dict((k, t) for k, t, _ in rows)[r["doc_id"]].encode()
        at = 0
        for start, stop, n in zip(r["starts"], r["starts"][1:] + [len(text)], r["counts"]):
            assert own.decode(r["ids"][at : at + n]).encode() == text[start:stop]
            at += n
        assert at == len(r["ids"])


@given(text=st.text(st.sampled_from("ab' \n\tstrevlmd1²_!é"), min_size=1, max_size=60), cut=st.integers(0, 60))
@settings(max_examples=300, deadline=None)
def test_scan_is_the_automaton_step_by_step(text, cut):
    points = np.array([ord(c) for c in text], np.uint32)
    first = np.unique([0, min(cut, len(text) - 1)])
    symbols = bpe.symbols_of(points, first)
    state, states, begins = bpe.FRESH, [], []
    for k, symbol in enumerate(symbols.tolist()):
        states.append(state)
        state, begin = bpe._step(state, symbol)
        begins += [k] * begin
    assert bpe.automaton().states_before(symbols).tolist() == states
    assert bpe.piece_starts(points, first).tolist() == begins


def test_boundaries_come_from_the_scan(both, monkeypatch):
    own, other = both
    text = "They've  said: 'tis 12 o'clock,\n\n  isn't it?"
    assert own.encode(text) == other.encode_ordinary(text)
    monkeypatch.setattr(bpe.Automaton, "states_before", lambda self, symbols: np.zeros(len(symbols), np.uint8))
    assert own.encode(text) != other.encode_ordinary(text)


def test_composition_is_associative():
    compose = bpe.automaton().compose
    n = len(compose)
    a, b, c = np.meshgrid(*[np.arange(n)] * 3, indexing="ij")
    assert (compose[compose[a, b], c] == compose[a, compose[b, c]]).all()
