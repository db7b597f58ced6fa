"""Problem 1: cutting oversized items at natural boundaries.

A text is first cut into atoms at every page break, heading, paragraph, line and sentence end;
an atom that is too long by itself is cut between words, and one without spaces at a fixed
length.  Adjacent pieces wait in a heap and are merged, weakest boundary first, while their
combined size leaves room for the overlap.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.textkit import PAGE_BREAK, extended, one_per_key_in_place, slices

#: Strength of the boundary before a piece.
HARD, WORD, SENTENCE, LINE, PARAGRAPH, HEADING, PAGE = range(7)
BOUNDARIES = ("hard", "word", "sentence", "line", "paragraph", "heading", "page")

_CUTS = re.compile(
    "|".join(
        [
            f"(?P<page>(?<=\n)[ \t]*(?={re.escape(PAGE_BREAK)})|(?={re.escape(PAGE_BREAK)}))",
            r"(?P<heading>(?<=\n)(?=#{1,6} ))",
            r"(?P<paragraph>(?<=\n\n)(?=[^\n]))",
            r"(?P<line>(?<=\n)(?=[^\n]))",
            r"(?P<sentence>(?<=[.!?…]\s)(?=\S)|(?<=[.!?…][\"'»”)]\s)(?=\S))",
        ]
    )
)
_STRENGTH = {"page": PAGE, "heading": HEADING, "paragraph": PARAGRAPH, "line": LINE, "sentence": SENTENCE}
_SPACE = re.compile(r"(?<=\s)(?=\S)")


def atoms(text: str, room: int) -> list[tuple[int, int]]:
    """(begin, strength of the boundary there) of the atoms, each of at most room characters."""
    begins = {0: PAGE}
    for match in _CUTS.finditer(text):
        at = match.start()
        if 0 < at < len(text):
            begins[at] = max(begins.get(at, 0), _STRENGTH[match.lastgroup])
    marks = sorted(begins.items())
    result = []
    for (at, strength), stop in zip(marks, [m[0] for m in marks[1:]] + [len(text)]):
        result.append((at, strength))
        if stop - at > room:
            begin = at
            for cut in [m.start() for m in _SPACE.finditer(text, at + 1, stop)] + [stop]:
                while cut - begin > room:  # no space in reach: a fixed length
                    begin += room
                    result.append((begin, HARD))
                if cut < stop:
                    result.append((cut, WORD))
                    begin = cut
    return result


def merge_atoms(marks: list[tuple[int, int]], length: int, room: int) -> list[tuple[int, int]]:
    """Merge adjacent pieces, weakest boundary first and of equal ones the smallest result,
    while the result is within room.  Returns (begin, strength) of the pieces left."""
    count = len(marks)
    begin = [m[0] for m in marks]
    end = begin[1:] + [length]
    strength = [m[1] for m in marks]
    before, after = list(range(-1, count - 1)), list(range(1, count + 1))
    alive = bytearray(b"\x01") * count
    heap = [(strength[i], end[i] - begin[i - 1], i, begin[i - 1], end[i]) for i in range(1, count) if end[i] - begin[i - 1] <= room]
    heapq.heapify(heap)
    while heap:
        _, _, i, left_begin, right_end = heapq.heappop(heap)
        if not alive[i]:
            continue
        h = before[i]
        if begin[h] != left_begin or end[i] != right_end:
            continue  # one side has grown since
        alive[i] = 0
        end[h] = end[i]
        j = after[i]
        after[h] = j
        if j < count:
            before[j] = h
            if end[j] - begin[h] <= room:
                heapq.heappush(heap, (strength[j], end[j] - begin[h], j, begin[h], end[j]))
        if h and end[h] - begin[before[h]] <= room:
            heapq.heappush(heap, (strength[h], end[h] - begin[before[h]], h, begin[before[h]], end[h]))
    return [(begin[i], strength[i]) for i in range(count) if alive[i]]


def split_text(text: str, max_chars: int, overlap_chars: int) -> list[tuple[int, int, int, int]]:
    """(begin, core begin, end, strength of the boundary at core begin) of the pieces.

    Cores are disjoint and cover the text; a piece begins before its core, with the last
    characters of the piece before, from a sentence or word of it where one begins within the
    overlap.  No piece is longer than max_chars; an overlap of max_chars or more is halved
    down to less than half of it.
    """
    if max_chars < 1:
        raise ValueError("max_chars must be positive")
    if len(text) <= max_chars:
        return [(0, 0, len(text), PAGE)]
    overlap = max(0, min(overlap_chars, (max_chars - 1) // 2))
    room = max_chars - overlap
    marks = atoms(text, room)
    cores = merge_atoms(marks, len(text), room)
    starts = [m[0] for m in marks if m[1] >= SENTENCE]
    result, k = [], 0
    for n, (core, strength) in enumerate(cores):
        end = cores[n + 1][0] if n + 1 < len(cores) else len(text)
        begin = core
        if n and overlap:
            least = max(core - overlap, cores[n - 1][0])
            while k < len(starts) and starts[k] < least:
                k += 1
            if k < len(starts) and starts[k] <= core - overlap // 2:
                begin = starts[k]
            else:
                space = _SPACE.search(text, least, core)
                begin = space.start() if space and least < space.start() <= core - overlap // 2 else least
        result.append((begin, core, end, strength))
    return result


def split_oversized(df: DataFrame, limits: DataFrame, kind: str, id_col: str, text_col: str) -> DataFrame:
    """item_kind, <id_col> as item_id, piece, pieces, begin, core_begin, end, boundary, text.

    limits has item_kind, max_chars and overlap_chars; the row of kind holds, and without it
    the result is empty.  Positions are code points.  An item within the limit comes out as
    one piece, without passing through Python.  Null texts have no piece, an empty text has
    one empty piece; copies of one id count once; a text without any boundary is cut at a
    fixed length; an empty table gives an empty one; other columns aren't read, so that
    clashing names do no harm.
    """
    limit = limits.where(F.col("item_kind") == kind).agg(F.min("max_chars").alias("m"), F.min("overlap_chars").alias("o")).first()
    own = one_per_key_in_place(df, id_col, text_col).select(F.lit(kind).alias("item_kind"), F.col(id_col).alias("item_id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    if limit["m"] is None:
        own = own.where("false")
    most, overlap = limit["m"] or 1, limit["o"] or 0
    sized = own.withColumn("length", F.length("text"))
    over = F.col("length") > most
    whole = sized.where(~over).select("item_kind", "item_id", F.lit(0).alias("piece"), F.lit(1).alias("pieces"), F.lit(0).alias("begin"), F.lit(0).alias("core_begin"), F.col("length").alias("end"), F.lit("page").alias("boundary"), "text")
    schema = extended(own, "item_id", "piece int, pieces int, begin int, core_begin int, end int, boundary string, text string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                rows = []
                for i, text in enumerate(part.column(1).to_pylist()):
                    pieces = split_text(text, most, overlap)
                    rows += [(i, n, len(pieces), b, c, e, BOUNDARIES[s], text[b:e]) for n, (b, c, e, s) in enumerate(pieces)]
                columns = list(zip(*rows)) if rows else [()] * 8
                kinds = [pa.int32()] * 5 + [pa.string()] * 2
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(columns[0], pa.int64())), *(pa.array(c, k) for c, k in zip(columns[1:], kinds))], names=schema.names)

    cut = sized.where(over).select("item_id", "text").mapInArrow(run, schema)
    return whole.unionByName(cut.withColumn("item_kind", F.lit(kind)))
