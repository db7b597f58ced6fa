"""Problem 8: evaluation items that leak into a corpus.

An item leaks into a document when a run of at least half of its words stands in the document
in order, apart from one wrong word in every ten.  A run of n words with at most e errors, cut
into e + 1 pieces, has a piece without an error (pigeonhole), so every leak holds an exact
piece.  The pieces of all such runs of an item are its word n-grams of one length; their hashes
form a sorted array, and one vectorised pass over the documents looks up every window.  Hits
are counted by document and item on a band of diagonals, since a run with few errors must hold
several pieces there (q-gram lemma).  What remains is verified with Myers' bit-parallel edit
distance over words, which finds the places where a run ends within its budget.  An error is an
inserted, missing or replaced word; where only replaced words are allowed, the words before
each of these places are compared one by one as well.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.textkit import PAGE_BREAK, one_per_key, slices, words

_PRIME = np.uint64(0x9E3779B97F4A7C15)


def myers_ends(pattern: list[int], text: list[int], limit: int) -> Iterator[int]:
    """The places in text where a substring within limit edits of pattern ends (Myers, 1999).

    One bit of a Python integer stands for each word of the pattern, so its length is free.
    """
    size = len(pattern)
    if size <= limit:
        yield 0
    if not size:
        return
    peq: dict[int, int] = {}
    for i, symbol in enumerate(pattern):
        peq[symbol] = peq.get(symbol, 0) | 1 << i
    full, top = (1 << size) - 1, 1 << (size - 1)
    plus, minus, score = full, 0, size
    for place, symbol in enumerate(text, 1):
        eq = peq.get(symbol, 0)
        diagonal = (((eq & plus) + plus) ^ plus) | eq | minus
        up, down = (minus | ~(diagonal | plus)) & full, plus & diagonal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        if score <= limit:
            yield place
        up, down = (up << 1) & full, (down << 1) & full
        plus, minus = (down | ~((eq | minus) | up)) & full, up & (eq | minus)


def window_hashes(ids: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each window of size ids."""
    count = len(ids) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for k in range(size):
        total = (total ^ (total >> np.uint64(29))) * _PRIME + ids[k : k + count].astype(np.uint64)
    return total


class ItemIndex:
    """Pieces of a block of items.

    share: part of an item's words that must stand in one run; per_error: words per error;
    replaced: whether only replaced words are errors, else inserted and missing ones, too.  For an item of m words the shortest run has n = ceil(share * m) words and
    e = n // per_error errors, and a run without error in it has (n - e) // (e + 1) words at
    least.  Longer runs may have more errors, but a run of 10k to 10k + 9 words with k errors
    holds one of 10k words with k errors, so only these lengths are needed; the piece length
    is the least over all of them.
    """

    def __init__(self, items: list[tuple[int, str]], share: float = 0.5, per_error: int = 10, replaced: bool = True):
        self.per_error, self.replaced = per_error, replaced
        self.vocabulary = _Known()
        self.items: list[tuple[int, np.ndarray, list[tuple[int, int]]]] = []
        grams: dict[int, list[tuple[np.ndarray, int]]] = {}
        for item_id, text in items:
            tokens = words(text)
            if not tokens:
                continue
            ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in tokens], np.int64)
            least = max(1, -(-len(ids) * share // 1))
            lengths = [int(least)] + [k for k in range(per_error, len(ids) + 1, per_error) if k > least]
            runs = [(n, n // per_error) for n in lengths]
            size = max(1, min((n - e) // (e + 1) for n, e in runs))
            grams.setdefault(size, []).append((ids, len(self.items)))
            self.items.append((item_id, ids, runs))
        self.tables = []
        for size, entries in sorted(grams.items()):
            hashes = np.concatenate([window_hashes(ids, size) for ids, _ in entries])
            owner = np.concatenate([np.full(max(0, len(ids) - size + 1), k) for ids, k in entries])
            place = np.concatenate([np.arange(max(0, len(ids) - size + 1)) for ids, _ in entries])
            order = np.argsort(hashes, kind="stable")
            self.tables.append((size, hashes[order], owner[order], place[order]))
        self.bands = np.array([0 if replaced else max(e for _, e in runs) for *_, runs in self.items], np.int64)
        self.needs = {size: np.array([min(self._need(n, e, size) for n, e in runs) for *_, runs in self.items], np.int64) for size, *_ in self.tables}

    @staticmethod
    def _need(length: int, errors: int, size: int) -> int:
        """How many pieces of size a run of length with errors holds at least."""
        return max(1, length - size + 1 - errors * size)

    def find(self, texts: list[str | None]) -> list[tuple[int, int]]:
        """(index of text, item id) of each leak in the texts."""
        return self.find_words(text_words(texts))

    def find_words(self, lists: list[list[str]]) -> list[tuple[int, int]]:
        """The same for the words of texts."""
        sizes = np.array([len(x) for x in lists], np.int64)
        total = int(sizes.sum()) + len(lists)
        ids = np.zeros(total, np.int64)  # a zero, which matches nothing, ends every text
        get = self.vocabulary.__getitem__
        begin = np.concatenate([[0], np.cumsum(sizes + 1)])
        for at, tokens in zip(begin, lists):
            if tokens:
                ids[at : at + len(tokens)] = np.fromiter(map(get, tokens), np.int64, len(tokens))
        found: set[tuple[int, int]] = set()
        for size, hashes, owner, place in self.tables:
            unknown = np.concatenate([[0], np.cumsum(ids == 0)])
            whole = np.flatnonzero(unknown[size:] == unknown[: len(unknown) - size])
            if not len(whole):
                continue
            own = window_hashes(ids, size)[whole]
            low = np.searchsorted(hashes, own, "left")
            hit = low < len(hashes)
            hit[hit] = hashes[low[hit]] == own[hit]
            low, whole, own = low[hit], whole[hit], own[hit]
            count = np.searchsorted(hashes, own, "right") - low
            entry = np.repeat(low - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(int(count.sum()))
            at = np.repeat(whole, count)
            item, inner = owner[entry], place[entry]
            text = np.searchsorted(begin, at, "right") - 1
            diagonal = at - begin[text] - inner
            order = np.lexsort((inner, diagonal, item, text))
            text, item, diagonal, inner = text[order], item[order], diagonal[order], inner[order]
            if not len(text):
                continue
            # of each hit, all that lie on its band of diagonals; a run needs some of them
            spread = int(np.abs(diagonal).max()) + int(self.bands.max()) + 1
            place_of = (text * len(self.items) + item) * (4 * spread) + diagonal
            band = self.bands[item]
            near = np.searchsorted(place_of, place_of + band, "right") - np.searchsorted(place_of, place_of - band)
            enough = near >= self.needs[size][item]
            edge = np.flatnonzero(np.concatenate([[True], (np.diff(text) != 0) | (np.diff(item) != 0)]))
            stop = np.append(edge[1:], len(text))
            some = np.logical_or.reduceat(enough, edge)
            for a, b in zip(edge[some].tolist(), stop[some].tolist()):
                key = (int(text[a]), int(item[a]))
                tried = np.unique(diagonal[a:b][enough[a:b]]).tolist()
                if key not in found and self._verify(ids[begin[key[0]] : begin[key[0] + 1] - 1], diagonal[a:b], inner[a:b], tried, size, *self.items[key[1]][1:]):
                    found.add(key)
        return sorted((text, self.items[item][0]) for text, item in found)

    def _verify(self, text: np.ndarray, diagonals: np.ndarray, places: np.ndarray, tried: list[int], size: int, item: np.ndarray, runs: list[tuple[int, int]]) -> bool:
        """Whether text holds a run of item on one of the diagonals tried; diagonals (in order) and
        places (in the item) of the pieces found.  The pieces of a run lie within its errors of
        the diagonal of any of them."""
        for length, errors in runs:
            need, band = self._need(length, errors, size), 0 if self.replaced else errors
            if len(places) < need or length > len(item):
                continue
            for diagonal in tried:
                low, high = np.searchsorted(diagonals, diagonal - band), np.searchsorted(diagonals, diagonal + band, "right")
                if high - low < need:
                    continue
                own = np.sort(places[low:high])
                starts = np.arange(max(0, -diagonal - band), min(len(item), len(text) - diagonal + band) - length + 1)
                support = np.searchsorted(own, starts + length - size, "right") - np.searchsorted(own, starts)
                for k in np.argsort(-support, kind="stable").tolist():
                    if support[k] < need:
                        break
                    start = int(starts[k])
                    if self._matches(item[start : start + length], text[max(0, start + diagonal - errors) : start + diagonal + length + errors], errors):
                        return True
        return False

    def _matches(self, pattern: np.ndarray, piece: np.ndarray, errors: int) -> bool:
        ends = myers_ends(pattern.tolist(), piece.tolist(), errors)
        if not self.replaced:
            return next(ends, None) is not None
        size = len(pattern)
        return any(end >= size and int((piece[end - size : end] != pattern).sum()) <= errors for end in ends)


def text_words(texts: list[str | None]) -> list[list[str]]:
    """The words of each text, those across a page break side by side."""
    return [words(t.replace(PAGE_BREAK, " ")) if t else [] for t in texts]


class _Known(dict):
    """Word to number; words of no item are 0 and aren't kept."""

    def __missing__(self, word: str) -> int:
        return 0


def leaked_items(
    documents: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "item_text",
    share: float = 0.5, per_error: int = 10, replaced: bool = True, block_rows: int = 20_000, blocks_at_once: int = 4,
) -> DataFrame:
    """(<id_col>, <item_col>) of each item that a document gives away.

    One word in every per_error may be wrong: replaced by another, and without ``replaced`` also
    inserted or left out.
    Null, empty and blank texts and items without words give no rows; rows repeated under one
    id count once; texts of any length are read whole; ties don't arise, as every leak is
    given; an empty table on either side gives an empty result; other columns aren't read.
    The items are a stated query set: each block of at most about block_rows of them is
    indexed once and sent with the tasks.  Documents are read, and cut into words, once for
    every blocks_at_once blocks, so what a task holds keeps a bound when the items grow.  There
    is no shuffle of documents beyond the removal of repeated result rows.
    """
    items = one_per_key(items, item_col, item_text_col).where(F.col(item_text_col).isNotNull())
    blocks = max(1, -(-items.count() // block_rows))
    schema = documents.select(id_col).schema
    schema = schema.add(items.schema[item_col])
    kind = pa.int32() if items.schema[item_col].dataType.simpleString() == "int" else None
    result = None
    for begin in range(0, blocks, blocks_at_once):
        indexes = []
        for block in range(begin, min(begin + blocks_at_once, blocks)):
            part = items.where(F.pmod(F.xxhash64(item_col), F.lit(blocks)) == block) if blocks > 1 else items
            indexes.append(documents.sparkSession.sparkContext.broadcast(ItemIndex([(r[0], r[1]) for r in part.collect()], share, per_error, replaced)))

        def run(batches: Iterator[pa.RecordBatch], indexes=indexes) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for rows in slices(batch, "_text"):
                    lists = text_words(rows.column(1).to_pylist())
                    found = [leak for shared in indexes for leak in shared.value.find_words(lists)]
                    if found:
                        picked = rows.column(0).take(pa.array([t for t, _ in found]))
                        yield pa.RecordBatch.from_arrays([picked, pa.array([i for _, i in found], kind)], names=schema.names)

        own = documents.select(documents[id_col], documents[text_col].alias("_text")).where(F.col(id_col).isNotNull() & F.col("_text").isNotNull()).mapInArrow(run, schema)
        result = own if result is None else result.unionByName(own)
    return result.distinct()
