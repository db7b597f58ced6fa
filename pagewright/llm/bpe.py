"""Problem 7: encoding a corpus with a public byte-level BPE vocabulary.

Pre-tokenisation is vectorised.  Each code point gets a class (letter, number, space, other)
from a table, and with what follows it a symbol.  A symbol is a transition function over the
states of an automaton that cuts the text into pieces; functions are composed with a table of
the finite monoid they generate.  As composition is associative, a chunk is scanned in blocks
side by side: prefixes within all blocks at once, then the blocks' totals, then every block
from the state it is entered in.  A piece begins where the state before a code point and its
symbol say so, without a regular expression.  The resulting byte slices go through a cache of
merged pieces; only pieces not seen before run the pair merges.
"""

from __future__ import annotations

import base64
import heapq
import itertools
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pagewright.llm.textkit import extended, slices

DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

OTHER, LETTER, NUMBER, SPACE = range(4)


@lru_cache(maxsize=1)
def class_table() -> np.ndarray:
    """Class of every code point, by the rule of Unicode's general categories."""
    table = np.zeros(0x110000, np.uint8)
    for point in range(0x110000):
        kind = unicodedata.category(chr(point))[0]
        if kind == "L":
            table[point] = LETTER
        elif kind == "N":
            table[point] = NUMBER
        elif chr(point).isspace() and not 0x1C <= point <= 0x1F:
            table[point] = SPACE
    return table


#: States: the next code point begins a piece whatever it is; within a run of letters, of numbers, of
#: other characters, of white space; after a space that belongs to the next piece; within a
#: contraction with one or two letters to come.
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_SPACES, AFTER_SPACE, ONE_MORE, TWO_MORE = range(8)
#: Symbols: the classes; an apostrophe before one or two letters that make a contraction; white
#: space before more of it or the end, a space before something else, other white space before it.
S_OTHER, S_LETTER, S_NUMBER, S_SHORT, S_LONG, S_INNER, S_LEADING, S_LONE = range(8)
#: Added to the symbol of a text's first code point.
FIRST = 8


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """The state after a symbol, and whether a piece begins with it."""
    if symbol >= FIRST:
        return _step(FRESH, symbol - FIRST)[0], True
    if state == TWO_MORE:
        return ONE_MORE, False
    if state == ONE_MORE:
        return FRESH, False
    if symbol == S_INNER:
        return IN_SPACES, state != IN_SPACES
    if symbol == S_LEADING:
        return AFTER_SPACE, True
    if symbol == S_LONE:
        return FRESH, True
    if symbol in (S_SHORT, S_LONG) and state not in (IN_OTHERS, AFTER_SPACE):
        return (ONE_MORE if symbol == S_SHORT else TWO_MORE), True
    run = {S_LETTER: IN_LETTERS, S_NUMBER: IN_NUMBERS}.get(symbol, IN_OTHERS)
    return run, state not in (run, AFTER_SPACE)


class Automaton:
    """Tables of the automaton and of the monoid of its transition functions.

    after[f, q]: the state that function f leads to from state q; compose[f, g]: f and then g;
    symbol k is function k; begins[q, k]: whether a piece begins with symbol k in state q.
    """

    def __init__(self) -> None:
        states, symbols = range(8), range(2 * FIRST)
        functions = [tuple(_step(q, k)[0] for q in states) for k in symbols]
        number = {f: k for k, f in reversed(list(enumerate(functions)))}
        at = 0
        while at < len(functions):  # closed when no product with a symbol is new
            for k in symbols:
                product = tuple(functions[k][q] for q in functions[at])
                if product not in number:
                    number[product] = len(functions)
                    functions.append(product)
            at += 1
        self.after = np.array(functions, np.uint8)
        self.compose = np.array([[number[tuple(g[q] for q in f)] for g in functions] for f in functions], np.uint8 if len(functions) < 256 else np.uint16)
        self.begins = np.array([[_step(q, k)[1] for k in symbols] for q in states])

    def states_before(self, symbols: np.ndarray) -> np.ndarray:
        """The state before each symbol, by a scan in about sqrt(n) blocks of sqrt(n) symbols."""
        size = len(symbols)
        width = max(1, int(size**0.5))
        blocks = -(-size // width)
        rows = np.zeros((blocks, width), self.compose.dtype)
        rows.reshape(-1)[:size] = symbols
        prefix = np.ascontiguousarray(rows.T)  # a row per place within the blocks
        for k in range(1, width):
            prefix[k] = self.compose[prefix[k - 1], prefix[k]]
        entered = np.zeros(blocks, np.uint8)
        state = FRESH
        for block, total in enumerate(prefix[-1].tolist()):
            entered[block] = state
            state = self.after[total, state]
        before = np.empty((width, blocks), np.uint8)
        before[0] = entered
        before[1:] = self.after[prefix[:-1], entered[None, :]]
        return before.T.reshape(-1)[:size]


@lru_cache(maxsize=1)
def automaton() -> Automaton:
    return Automaton()


def symbols_of(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The symbol of each code point of concatenated texts that begin at first."""
    size = len(points)
    kinds = class_table()[points]
    opens = np.zeros(size + 3, bool)
    opens[first] = True
    opens[size:] = True  # the end counts as the begin of a next text
    symbols = np.array([S_OTHER, S_LETTER, S_NUMBER, S_INNER], np.uint8)[kinds]
    ends_run = np.zeros(size, bool)  # white space with something else after it
    ends_run[:-1] = (kinds[:-1] == SPACE) & (kinds[1:] != SPACE) & ~opens[1:size]
    last = np.flatnonzero(ends_run)
    symbols[last] = np.where(points[last] == 0x20, S_LEADING, S_LONE)
    marks = np.flatnonzero(points == 0x27)
    marks = marks[~opens[marks + 1]]
    if len(marks):
        one = points[marks + 1]
        symbols[marks[np.isin(one, [ord(c) for c in "stmd"])]] = S_SHORT
        marks = marks[~opens[marks + 2]]
        pair = points[marks + 1].astype(np.int64) * 0x110000 + points[marks + 2]
        symbols[marks[np.isin(pair, [ord(a) * 0x110000 + ord(b) for a, b in ("re", "ve", "ll")])]] = S_LONG
    symbols[first] += FIRST
    return symbols


def piece_starts(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Indexes at which pieces begin in concatenated texts.

    points: code points of all texts; first: indexes where a text begins (no empty texts).
    """
    if not len(points):
        return np.zeros(0, np.int64)
    machine, symbols = automaton(), symbols_of(points, first)
    return np.flatnonzero(machine.begins[machine.states_before(symbols), symbols])


class ByteBpe:
    """Ranks of a byte-level vocabulary with a bounded cache of merged pieces."""

    def __init__(self, data: bytes, cache_size: int = 400_000, cached_bytes: int = 64):
        self.ranks: dict[bytes, int] = {}
        for line in data.splitlines():
            token, rank = line.split()
            self.ranks[base64.b64decode(token)] = int(rank)
        self.cache_size, self.cached_bytes = cache_size, cached_bytes
        self.cache = _Cache(self)

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Ids of one piece: the adjacent pair of lowest rank is merged until none is known."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return (whole,)
        return self._merge_short(piece) if len(piece) <= 40 else self._merge_long(piece)

    def _merge_short(self, piece: bytes) -> tuple[int, ...]:
        get = self.ranks.get
        parts = [piece[i : i + 1] for i in range(len(piece))]
        scores = [get(a + b, 1 << 30) for a, b in zip(parts, parts[1:])]
        while scores:
            best = min(scores)
            if best == 1 << 30:
                break
            at = scores.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del scores[at]
            if at < len(scores):
                scores[at] = get(parts[at] + parts[at + 1], 1 << 30)
            if at:
                scores[at - 1] = get(parts[at - 1] + parts[at], 1 << 30)
        return tuple(map(self.ranks.__getitem__, parts))

    def _merge_long(self, piece: bytes) -> tuple[int, ...]:
        """The same with a heap and linked parts, for pieces without a bound on their length."""
        get, size = self.ranks.get, len(piece)
        end = list(range(1, size + 1))
        before = list(range(-1, size - 1))
        alive = bytearray(b"\x01") * size
        heap = []
        for i in range(size - 1):
            rank = get(piece[i : i + 2])
            if rank is not None:
                heap.append((rank, i, i + 2))
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            if not alive[i] or end[i] >= size:
                continue
            j = end[i]
            if end[j] != stop:
                continue
            alive[j] = 0
            end[i] = stop
            if stop < size:
                before[stop] = i
                rank = get(piece[i : end[stop]])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, end[stop]))
            h = before[i]
            if h >= 0:
                rank = get(piece[h:stop])
                if rank is not None:
                    heapq.heappush(heap, (rank, h, stop))
        ids, i = [], 0
        while i < size:
            ids.append(self.ranks[piece[i : end[i]]])
            i = end[i]
        return tuple(ids)

    def encode_texts(self, data: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Encode concatenated UTF-8 texts.

        offsets: where each text begins in data, and the end.  Returns the ids, the number of
        ids before each text (and in all), the byte at which each piece begins, and the number
        of ids of each piece.
        """
        raw = np.frombuffer(data, np.uint8)
        if not len(raw):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        filled = np.unique(offsets[:-1][np.diff(offsets) > 0])
        if raw.max() < 0x80:
            begins = piece_starts(raw, filled)
        else:
            places = np.flatnonzero((raw & 0xC0) != 0x80)
            points = np.frombuffer(data.decode("utf-8").encode("utf-32-le"), np.uint32)
            begins = places[piece_starts(points, np.searchsorted(places, filled))]
        cuts = begins.tolist()
        cuts.append(len(data))
        found = list(map(self.cache.__getitem__, [data[a:b] for a, b in itertools.pairwise(cuts)]))
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter(itertools.chain.from_iterable(found), np.int32, int(lengths.sum()))
        before = np.concatenate([[0], np.cumsum(lengths)])
        if len(self.cache) > self.cache_size:
            self.cache.clear()
        return ids, before[np.searchsorted(begins, offsets)], begins, lengths

    def encode(self, text: str | None) -> list[int]:
        data = (text or "").encode("utf-8")
        return self.encode_texts(data, np.array([0, len(data)]))[0].tolist()

    def decode(self, ids: list[int]) -> str:
        if not hasattr(self, "tokens"):
            self.tokens = {rank: token for token, rank in self.ranks.items()}
        return b"".join(self.tokens[i] for i in ids).decode("utf-8", errors="replace")


class _Cache(dict):
    """Piece to ids; pieces longer than the encoder's bound are merged anew each time."""

    def __init__(self, encoder: ByteBpe):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, piece: bytes) -> tuple[int, ...]:
        ids = self.encoder.merge(piece)
        if len(piece) <= self.encoder.cached_bytes:
            self[piece] = ids
        return ids


_ENCODERS: dict[int, ByteBpe] = {}


def _encoder(data: bytes) -> ByteBpe:
    key = hash(data)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = ByteBpe(data)
    return _ENCODERS[key]


def encode_corpus(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = DEFAULT_VOCABULARY, offsets: bool = False, most_bytes: int = 32_000_000) -> DataFrame:
    """Token ids of each text, as ``<id_col>, ids``; with offsets also ``starts, counts``.

    Null and empty texts give empty lists; blank texts are encoded as they are; repeated rows
    stay repeated, as every row is encoded by itself; an empty table gives an empty one; other
    columns are not read.  starts has the byte of the text where each piece begins and counts
    its number of ids, so that a range of ids can be traced to its bytes.  There is no
    shuffle: one pass over the two columns.  The vocabulary file (most_bytes at most, checked)
    travels to the executors in a broadcast variable.
    """
    with open(vocabulary, "rb") as file:
        data = file.read()
    if len(data) > most_bytes:
        raise ValueError("the vocabulary file is larger than what may be broadcast")
    shared = df.sparkSession.sparkContext.broadcast(data)
    schema = extended(df, id_col, "ids array<int>" + ", starts array<bigint>, counts array<bigint>" * offsets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        for batch in batches:
            for part in slices(batch, "_text"):
                texts = part.column(1).fill_null("").cast(pa.string())
                if texts.offset:
                    texts = pa.concat_arrays([texts])
                ends = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4)
                body = texts.buffers()[2]
                raw = body.slice(int(ends[0]), int(ends[-1] - ends[0])).to_pybytes() if body is not None else b""
                begin = (ends - ends[0]).astype(np.int64)
                ids, before, starts, counts = encoder.encode_texts(raw, begin)
                columns = [part.column(0), pa.ListArray.from_arrays(pa.array(before.astype(np.int32)), pa.array(ids))]
                if offsets:
                    owner = np.searchsorted(starts, begin).astype(np.int32)
                    own = starts - np.repeat(begin[:-1], np.diff(owner))
                    columns += [pa.ListArray.from_arrays(pa.array(owner), pa.array(x)) for x in (own, counts)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return df.select(df[id_col], df[text_col].alias("_text")).mapInArrow(run, schema)
