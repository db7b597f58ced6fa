"""Problem 9: the reading level of each document.

A document's coverage rank is the size of the smallest vocabulary, taken from the corpus's
words by falling frequency, that covers a fixed share of the document's tokens.  It is read
at two shares, beside the mean length of sentences and of words.  Labelled samples calibrate
these measures: for each level SQL computes their means and spreads, the spreads drawn halfway
to those of all levels together, and a document gets the level under which its measures are
most likely.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.textkit import PAGE_BREAK, extended, slices, words

#: Bits of the table of word counts: its 2 ** BITS counters bound what is broadcast (2 MB).
BITS = 18
#: Shares of a document's tokens that a vocabulary must cover.
SHARES = (0.65, 0.8)
#: Logarithm of words per sentence, letters per word, logarithms of the coverage ranks.
FEATURES = ("sentence_words", "word_letters", "cover_two_thirds", "cover_most")

_SKIP_LINES = re.compile(r"<!--(?:(?!-->)[\s\S])*-->|^[ \t]*(?:\||#|[-*+] |\d+[.)] ).*$", re.M)
_QUOTE = re.compile(r"^[ \t]*>[ \t]?", re.M)
_SENTENCE = re.compile(r"[.!?…]+(?=\s|$)|\n\s*\n")


def _slot(word: str) -> int:
    return xxhash.xxh64_intdigest(word) & ((1 << BITS) - 1)


def prose(text: str) -> str:
    """The running text: without comments, table rows, headings, list items and quote marks."""
    return _QUOTE.sub("", _SKIP_LINES.sub(" ", text.replace(PAGE_BREAK, " ")))


def word_counts(df: DataFrame, text_col: str = "text") -> np.ndarray:
    """Occurrences of the words of all texts, in a table of 2 ** BITS counters.

    A word's counter is chosen by its hash, so the table's size doesn't depend on the corpus;
    each task adds up its own words before anything is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        slots = np.zeros(1 << BITS, np.int64)

        def flush() -> None:
            for word, n in total.items():
                slots[_slot(word)] += n
            total.clear()

        for batch in batches:
            for part in slices(batch, "_text"):
                for text in part.column(0).to_pylist():
                    total.update(words(text))
                if len(total) > 200_000:
                    flush()
        flush()
        used = np.flatnonzero(slots)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(slots[used])], names=["slot", "n"])

    counted = df.select(df[text_col].alias("_text")).where("_text is not null").mapInArrow(run, "slot int, n bigint")
    table = np.zeros(1 << BITS, np.int64)
    rows = counted.groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    table[rows["slot"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return table


def rank_table(counts: np.ndarray) -> np.ndarray:
    """Rank of each counter by falling count, from 1; equal counts share a rank."""
    _, inverse, sizes = np.unique(-counts, return_inverse=True, return_counts=True)
    return (np.cumsum(sizes) - sizes + 1)[inverse].astype(np.int32)


class _Ranks(dict):
    def __init__(self, table: np.ndarray):
        super().__init__()
        self.table = table

    def __missing__(self, word: str) -> int:
        rank = int(self.table[_slot(word)])
        if len(self) < 300_000:
            self[word] = rank
        return rank


def measure(text: str | None, ranks: dict[str, int]) -> tuple[float, float, float, float] | None:
    """The measures in FEATURES of one text; None where it has no words."""
    if not text:
        return None
    body = prose(text)
    spans = [w for w in (words(s) for s in _SENTENCE.split(body)) if w]
    if not spans:
        spans = [w for w in [words(text)] if w]
        if not spans:
            return None
    tokens = [w for s in spans for w in s]
    places = np.sort(np.fromiter(map(ranks.__getitem__, tokens), np.float64, len(tokens)))
    letters = np.fromiter(map(len, tokens), np.float64, len(tokens)).mean()
    covered = [float(np.log1p(places[int((len(places) - 1) * share)])) for share in SHARES]
    return float(np.log(len(tokens) / len(spans))), float(letters), *covered


def text_measures(df: DataFrame, id_col: str, text_col: str, ranks: np.ndarray) -> DataFrame:
    """<id_col> and the columns of FEATURES of each text that has words."""
    shared = df.sparkSession.sparkContext.broadcast(ranks)
    schema = extended(df, id_col, ", ".join(f"{name} double" for name in FEATURES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _Ranks(shared.value)
        for batch in batches:
            for part in slices(batch, "_text"):
                rows = [measure(t, own) for t in part.column(1).to_pylist()]
                kept = [i for i, r in enumerate(rows) if r]
                columns = [pa.array([rows[i][k] for i in kept], pa.float64()) for k in range(len(FEATURES))]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(kept, pa.int64())), *columns], names=schema.names)

    return df.select(df[id_col], df[text_col].alias("_text")).mapInArrow(run, schema)


def reading_levels(
    documents: DataFrame, samples: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_text_col: str = "sample_text", level_col: str = "reading_level",
    corpus: DataFrame | None = None,
) -> DataFrame:
    """<id_col>, reading_level and the measures of each document that has words.

    corpus: whose words are counted; the documents where none is given.  Null and blank texts
    and texts without words have no row; a very long text is read whole; repeated rows stay
    repeated, each with the same level; of equally likely levels the lower is taken; without
    samples or documents the result is empty; other columns aren't read.  The documents are
    read twice, once to count words and once to measure, and nothing but the counters is
    shuffled; the calibration has one row per level.
    """
    counts = word_counts(corpus if corpus is not None else documents, text_col)
    ranks = rank_table(counts)
    labelled = samples.where(F.col(level_col).isNotNull()).select(F.col(level_col).cast("int").alias("sample_level"), F.col(sample_text_col).alias("sample_body"))
    fitted = text_measures(labelled, "sample_level", "sample_body", ranks)
    measured = text_measures(documents, id_col, text_col, ranks)
    moments = [f"avg({f}) as mean_{f}" for f in FEATURES] + [f"greatest(coalesce(stddev_samp({f}), 0), 0.05) as sd_{f}" for f in FEATURES]
    levels = fitted.groupBy("sample_level").agg(*[F.expr(x) for x in moments])
    drawn = [f"sqrt((pow(sd_{f}, 2) + avg(pow(sd_{f}, 2)) over (partition by 0)) / 2) as sd_{f}" for f in FEATURES]  # a row per level
    levels = levels.selectExpr("sample_level", *[f"mean_{f}" for f in FEATURES], *drawn)
    table = F.sort_array(F.collect_list(F.struct("sample_level", *[c for c in levels.columns if c != "sample_level"])))
    calibration = levels.agg(table.alias("levels")).first()["levels"]  # a row per level
    if not calibration:
        return measured.select(id_col, F.lit(None).cast("int").alias("reading_level"), *FEATURES).where("false")
    scores = []
    for row in calibration:
        terms = [f"(-ln({row[f'sd_{f}']!r}D) - 0.5D * pow(({f} - {row[f'mean_{f}']!r}D) / {row[f'sd_{f}']!r}D, 2))" for f in FEATURES]
        scores.append(f"struct({' + '.join(terms)} as likely, {-row['sample_level']} as lower)")
    best = F.expr(f"-array_max(array({', '.join(scores)})).lower")
    return measured.select(id_col, best.cast("int").alias("reading_level"), *FEATURES)


def document_levels(documents: DataFrame, samples: DataFrame, language: str = "en", least_pieces: int = 50) -> DataFrame:
    """doc_id, reading_level of the documents in language with at least least_pieces pieces
    separated by white space; word frequencies are those of all documents in the language.

    Texts aren't shuffled: rows repeated under one id are measured each and then count once
    (of different levels the lowest).
    """
    own = documents.where((F.col("lang") == language) & F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text")
    enough = own.where(F.size(F.expr(r"filter(split(text, '(?U)\\s+'), x -> x <> '')")) >= least_pieces)
    return reading_levels(enough, samples, corpus=own).groupBy("doc_id").agg(F.min("reading_level").alias("reading_level"))
