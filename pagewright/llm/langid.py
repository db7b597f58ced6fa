"""Problem 2: languages of documents and of the segments of mixed ones.

Texts become normalised TF-IDF vectors of words and of character trigrams within words.  Each
language has several centroids, found by spherical k-means on labelled texts, and a text has
the language of the centroid with the largest cosine; one that is far from every centroid is
rejected.  Words that no two sources share in the labelled texts (names, mostly) have no part
in the vectors, unless they stand in lower case among others in mixed case, as words with a
slip do.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagewright.llm.textkit import extended, fold, one_per_key, slices

DIMENSIONS = 1 << 13

#: A title in brackets and quotation marks, also one cut by either end of the text.
_TITLE = re.compile(r"[(\[]\s*[«“\"„‹'][^)\]]*(?:[»”\"“›']\s*[)\]]|$)|^[^(\[]*[»”\"“›']\s*[)\]]")
_CLAUSE = re.compile(r"[.?!;:,\n\r…¿¡()\[\]|]+|\s[–—-]+\s")
_TOKEN = re.compile(r"[^\W\d_]+")


def clauses(text: str) -> list[tuple[int, int]]:
    """Spans between punctuation marks, without titles in brackets."""
    body = _TITLE.sub(lambda m: "|" * len(m[0]), text)
    spans, at = [], 0
    for match in _CLAUSE.finditer(body):
        spans.append((at, match.start()))
        at = match.end()
    spans.append((at, len(body)))
    return [(a, b) for a, b in spans if body[a:b].strip()]


@dataclass
class LanguageModel:
    """Centroids (a column each, in the order of languages) and the words seen in several sources."""

    languages: list[str] = field(default_factory=list)
    owner: np.ndarray | None = None
    begins: np.ndarray | None = None
    centroids: np.ndarray | None = None
    idf: np.ndarray | None = None
    known: frozenset[str] = frozenset()
    reject: float = 0.12

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def _products(self, units: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
        """The sum of the units' products with all centroids, and the features of each.

        Products of units seen before are kept in rows of one table of bounded size.
        """
        known = self.__dict__.setdefault("_known", {})
        if "_rows" not in self.__dict__ or len(known) + len(units) > len(self._rows):
            known.clear()
            self._rows = np.zeros((max(20_000, len(units)), self.centroids.shape[1]), np.float32)
        places, ids = [], []
        for unit in units:
            found = known.get(unit)
            if found is None:
                own = features(unit)
                found = known[unit] = (len(known), own)
                self._rows[found[0]] = self.idf[own] @ self.centroids[own]
            places.append(found[0])
            ids.append(found[1])
        return self._rows[places].sum(0, dtype=np.float64), ids

    def usable(self, text: str) -> list[str]:
        """The folded words of a text that count."""
        raw = _TOKEN.findall(text)
        mixed = any(w[:1].isupper() for w in raw) and any(w.islower() for w in raw)
        result = []
        for word in raw:
            for part in (word.lower(),) if word.isascii() else _TOKEN.findall(fold(word)):
                if part in self.known or (mixed and word.islower() and len(part) > 3):
                    result.append(part)
        return result

    def scores(self, text: str) -> tuple[np.ndarray, int]:
        """The largest cosine of each language, and the number of words that count."""
        own = self.usable(text)
        if not own or not self.languages:
            return np.zeros(len(self.languages)), 0
        total, ids = np.zeros(len(self.owner)), []
        units = units_of(own)
        for begin in range(0, len(units), 5_000):
            sums, found = self._products(units[begin : begin + 5_000])
            total += sums
            ids += found
        names, counts = np.unique(np.concatenate(ids), return_counts=True)
        norm = np.sqrt(((counts * self.idf[names]) ** 2).sum())
        return np.maximum.reduceat(total, self.begins) / max(norm, 1e-12), len(own)

    def decide(self, text: str) -> tuple[str | None, float, int]:
        """Language (None where rejected), confidence and words that count."""
        best, count = self.scores(text)
        if not count:
            return None, 0.0, 0
        order = np.argsort(-best, kind="stable")
        first = float(best[order[0]])
        second = float(best[order[1]]) if len(order) > 1 else 0.0
        if first < self.reject:
            return None, 0.0, count
        return self.languages[order[0]], (first - max(second, 0.0)) / first, count

    def segments(self, text: str | None, margin: float = 0.35) -> list[tuple[int, int, str, float]]:
        """(begin, end, language, confidence) of the segments of a text.

        A clause with a clear language (margin is the least confidence, 0.9 where only
        one word counts) opens or continues a segment; the others go to the one before, or
        to the first after them.
        """
        if not text:
            return []
        merged: list[list] = []
        waiting: int | None = None
        vague: list[tuple[int, int]] = []
        for begin, end in clauses(text):
            language, confidence, count = self.decide(text[begin:end])
            clear = language is not None and count > 0 and confidence >= (margin if count > 1 else 0.9)
            clear = clear and (count > 1 or len(_TOKEN.findall(text[begin:end])[0]) > 3)
            if not clear:
                vague.append((begin, end))
                if merged:
                    merged[-1][1] = end
                elif waiting is None:
                    waiting = begin
                continue
            weight = count
            if merged and merged[-1][2] == language:
                last = merged[-1]
                last[1] = end
                last[3] = (last[3] * last[4] + confidence * weight) / (last[4] + weight)
                last[4] += weight
            else:
                merged.append([begin if waiting is None else waiting, end, language, confidence, weight])
                waiting = None
        if not merged:  # no clause is clear by itself: the whole text decides
            language, confidence, _ = self.decide(_TITLE.sub(" ", text))
            return [] if language is None else [(0, len(text), language, confidence)]
        return [(a, b, c, float(d)) for a, b, c, d, _ in merged]


def units_of(own: list[str]) -> list[str]:
    """Words and pairs of neighbours."""
    return own + [f"{a} {b}" for a, b in zip(own, own[1:])]


@lru_cache(maxsize=100_000)
def features(unit: str) -> np.ndarray:
    """Hashed features of a word or pair of words: itself, twice, and for a word the trigrams
    with its ends marked."""
    grams = [f"={unit}", f"={unit}"]
    if " " not in unit:
        padded = f"<{unit}>"
        grams += [padded[i : i + 3] for i in range(len(padded) - 2)]
    return np.array([xxhash.xxh32_intdigest(g) % DIMENSIONS for g in grams], np.int64)


def _counts(texts: list[list[str]]) -> np.ndarray:
    rows = np.zeros((len(texts), DIMENSIONS), np.float32)
    for row, own in zip(rows, texts):
        np.add.at(row, np.concatenate([features(u) for u in units_of(own)]), 1)
    return rows


def _vectors(texts: list[list[str]], idf: np.ndarray) -> np.ndarray:
    rows = _counts(texts)
    rows *= idf.astype(np.float32)
    rows /= np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)
    return rows


def _clusters(rows: np.ndarray, count: int, steps: int = 8) -> np.ndarray:
    """Centroids of spherical k-means, begun with rows far from each other."""
    count = min(count, len(rows))
    mean = rows.mean(0)
    centers = [mean / max(np.linalg.norm(mean), 1e-9)]
    near = rows @ centers[0]
    for _ in range(count - 1):
        centers.append(rows[int(near.argmin())])
        near = np.maximum(near, rows @ centers[-1])
    centers = np.array(centers)
    for _ in range(steps):
        own = (rows @ centers.T).argmax(1)
        for k in range(count):
            if (own == k).any():
                center = rows[own == k].mean(0)
                centers[k] = center / max(np.linalg.norm(center), 1e-9)
    return centers


@lru_cache(maxsize=200_000)
def _parts(word: str) -> tuple[str, ...]:
    return tuple(_TOKEN.findall(fold(word)))


def own_words(text: str) -> list[str]:
    """The folded words of a text."""
    if text.isascii():
        return _TOKEN.findall(text.lower())
    return [p for w in _TOKEN.findall(text) for p in _parts(w)]


@dataclass
class _Bags:
    """Distinct units (words, and pairs of neighbours behind them) of texts, in columns."""

    names: dict[str, int]
    text: np.ndarray
    unit: np.ndarray
    units: int
    codes: np.ndarray


def _bags(texts: list[list[str]]) -> _Bags:
    names: dict[str, int] = {}
    flat = np.array([names.setdefault(w, len(names)) for own in texts for w in own], np.int64)
    owner = np.repeat(np.arange(len(texts)), [len(own) for own in texts])
    next_to = owner[1:] == owner[:-1]
    pairs = len(names) + flat[:-1][next_to] * len(names) + flat[1:][next_to]
    codes, units = np.unique(np.concatenate([flat, pairs]), return_inverse=True)
    both = np.unique(np.concatenate([owner, owner[1:][next_to]]) * max(1, len(codes)) + units)
    return _Bags(names, both // max(1, len(codes)), both % max(1, len(codes)), len(codes), codes)


def _numbered(values: list[str]) -> tuple[np.ndarray, int]:
    places: dict[str, int] = {}
    return np.array([places.setdefault(v, len(places)) for v in values], np.int64), len(places)


def _distinct(left: np.ndarray, right: np.ndarray, rights: int, lefts: int) -> np.ndarray:
    """How many different values of right stand beside each value of left."""
    return np.bincount(np.unique(left * max(1, rights) + right) // max(1, rights), minlength=lefts)


class Votes:
    """Words and pairs of neighbours that vote by the labels of all texts (language, source,
    text) that hold them; those of fewer than least_sources sources have no vote."""

    def __init__(self, samples: list[tuple[str, str, str]], least_sources: int = 3):
        self.languages = sorted({s[0] for s in samples})
        place = {x: k for k, x in enumerate(self.languages)}
        self.label = np.array([place[s[0]] for s in samples], np.int64)
        self.source, self.sources = _numbered([s[1] for s in samples])
        self.bags = bags = _bags([own_words(s[2]) for s in samples])
        many = len(self.languages)
        counts = np.bincount(bags.unit * many + self.label[bags.text], minlength=bags.units * many).reshape(-1, max(1, many))
        self.votes = np.log((counts + 0.2) / (np.bincount(self.label, minlength=many) + 1)) if many else counts
        self.voting = _distinct(bags.unit, self.source[bags.text], self.sources, bags.units) >= least_sources
        self.places = dict(zip(bags.codes[self.voting].tolist(), np.flatnonzero(self.voting).tolist()))

    def language(self, text: str | None) -> str | None:
        """The language that most of a text's words and pairs vote for; None without votes."""
        names, places = self.bags.names, self.places
        ids = [names.get(w, -1) for w in own_words(text or "")]
        codes = {x for x in ids if x >= 0} | {len(names) + a * len(names) + b for a, b in zip(ids, ids[1:]) if a >= 0 and b >= 0}
        at = [places[c] for c in codes if c in places]
        return self.languages[int(self.votes[at].sum(0).argmax())] if at else None

    def agreeing(self) -> np.ndarray:
        """Whether the label of each sample agrees with its text.

        Texts with the same voting words decide by their own majority (three fifths) where they
        come from six sources or more.  Else the votes do, so that a label that contradicts the
        majority is told from the rest, and where texts with the same words come from three
        sources they must agree, too.
        """
        label, bags, count, many = self.label, self.bags, len(self.label), len(self.languages)
        if not count:
            return np.zeros(0, bool)
        own = self.voting[bags.unit]
        text, unit = bags.text[own], bags.unit[own]
        score = np.stack([np.bincount(text, self.votes[unit, k], count) for k in range(many)], axis=1)
        # texts with the same voting words: a sum of hashes, and their number
        single = bags.codes[unit] < len(bags.names)
        marks = np.random.default_rng(1).integers(0, 1 << 62, bags.units, np.uint64)
        key = np.zeros(count, np.uint64)
        np.add.at(key, text[single], marks[unit[single]])
        held = np.bincount(text[single], minlength=count)
        _, group = np.unique(key + held.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), return_inverse=True)
        groups = int(group.max()) + 1
        shares = np.bincount(group * many + label, minlength=groups * many).reshape(-1, many)
        group_sources = _distinct(group, self.source, self.sources, groups)[group]
        alike = shares.argmax(1)[group] == label
        majority = alike & (shares[group, label] >= 0.6 * shares.sum(1)[group])
        voted = (score.argmax(1) == label) & (alike | (group_sources < 3))
        return np.where(held == 0, False, np.where(group_sources >= 6, majority, voted))


def agreeing(samples: list[tuple[str, str, str]], least_sources: int = 3) -> list[bool]:
    """Votes.agreeing() of (language, source, text)."""
    return Votes(samples, least_sources).agreeing().tolist()


def fit(samples: list[tuple[str, str, str]], clusters: int = 48, most: int = 1_500, least_sources: int = 3) -> LanguageModel:
    """A model from (language, source, text): the ``most`` most frequent clauses of each
    language count, once each.

    Words must stand in the texts of at least least_sources sources of one language.  Of a
    feature's weight, the inverse document frequency over clauses, the part remains by which
    its languages are fewer than an even spread over all.  Centroids are square-rooted, so
    that a word that few members of a cluster have isn't drowned by what all of them share.
    """
    texts = [(language, source, own_words(text[a:b])) for language, source, text in samples for a, b in clauses(text)]
    texts = [x for x in texts if x[2]]
    languages = sorted({x[0] for x in texts})
    names: dict[str, int] = {}
    flat = np.array([names.setdefault(w, len(names)) for *_, own in texts for w in own], np.int64)
    sizes_of = [len(own) for *_, own in texts]
    label, _ = _numbered([*languages, *(x[0] for x in texts)])
    label = label[len(languages) :]
    source, sources = _numbered([x[1] for x in texts])
    both = np.repeat(label, sizes_of) * max(1, len(names)) + flat
    often_enough = _distinct(both, np.repeat(source, sizes_of), sources, len(languages) * max(1, len(names))) >= least_sources
    spread_over = often_enough.reshape(len(languages), -1).any(0) if languages else np.zeros(0, bool)
    known = frozenset(w for w, k in names.items() if spread_over[k])
    model = LanguageModel(languages, known=known)
    units: dict[str, list[list[str]]] = {x: [] for x in languages}
    for language, _, own in texts:
        units[language].append(own)
    chosen, seen, sizes = {}, np.zeros((len(units), DIMENSIONS)), np.zeros(len(units))
    for place, language in enumerate(model.languages):
        often = Counter(tuple(w for w in u if w in known) for u in units[language])  # what differs in names only counts once
        kept = [list(u) for u in sorted((u for u in often if len(u) > 1), key=lambda u: (-often[u], xxhash.xxh64_intdigest(" ".join(u))))[:most]]
        chosen[language] = kept
        seen[place] = (_counts(kept) > 0).sum(0)
        sizes[place] = len(kept)
    rates = (seen + 0.05) / (sizes + 1)[:, None]
    shares = rates / rates.sum(0)
    spread = -(shares * np.log(shares)).sum(0) / max(np.log(len(units)), 1e-9)
    model.idf = np.log((1 + sizes.sum()) / (1 + seen.sum(0))) * np.maximum(0.02, 1 - spread)
    columns, owner = [], []
    model.languages = [x for x in model.languages if chosen[x]]
    for k, language in enumerate(model.languages):
        centers = np.sqrt(np.maximum(_clusters(_vectors(chosen[language], model.idf), clusters), 0))
        centers /= np.maximum(np.linalg.norm(centers, axis=1, keepdims=True), 1e-9)
        columns.append(centers)
        owner += [k] * len(centers)
    model.centroids = np.concatenate(columns).T.astype(np.float32) if columns else np.zeros((DIMENSIONS, 0))
    model.owner = np.array(owner, np.int64)
    model.begins = np.searchsorted(model.owner, np.arange(len(model.languages)))
    return model


def _labelled(df: DataFrame, label: str, key: str, source: str, text: str, most: int) -> list[tuple[str, str, str]]:
    """At most ``most`` rows of each label: their keys are chosen first, without the texts.

    A label's rows are counted first, so that a threshold on the keys' hashes leaves little more
    than ``most`` of them before the exact choice, whatever the number of tasks.
    """
    bits = 1 << 30
    own = df.where(F.col(label).isNotNull() & F.col(text).isNotNull())
    share = F.broadcast(own.groupBy(label).agg((F.lit(1.5 * most * bits) / F.count(F.lit(1)) + 20 * bits / F.count(F.lit(1))).alias("_most")))
    order = W.partitionBy(label).orderBy(F.pmod(F.xxhash64(key), F.lit(bits)), key)
    few = own.select(label, key).join(share, label).where(F.pmod(F.xxhash64(key), F.lit(bits)) < F.col("_most"))
    keys = few.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= most).select(key).distinct()
    rows = own.select(label, key, source, text).join(F.broadcast(keys), key, "left_semi").dropDuplicates([key])
    return sorted((r[0], r[1] or "", r[2]) for r in rows.select(label, F.col(source).cast("string"), text).collect())


def hashed_sample(df: DataFrame, key: str, most: int) -> DataFrame:
    """At most ``most`` rows by the hashes of their keys.

    Rows are counted first, so that a threshold on the hash leaves little more than ``most``
    of them before the exact choice; tasks don't send ``most`` rows each.
    """
    count = df.count()
    bits = 1 << 30
    if count > 2 * most:
        df = df.where(F.pmod(F.xxhash64(key), F.lit(bits)) < int(1.5 * most / count * bits))
    return df.orderBy(F.pmod(F.xxhash64(key), F.lit(bits)), key).limit(most)


def table_samples(
    documents: DataFrame, names: DataFrame, queries: DataFrame | None = None, most_documents: int = 200, most_queries: int = 15_000, replies: list[tuple[str | None, str, str]] = (),
) -> list[tuple[str, str, str]]:
    """A bounded sample of labelled texts, (language, source, text).

    From documents (lang, a two-letter alias in names) at most most_documents of each
    language are taken, by the hashes of their ids.  Where queries are given, the clauses of
    most_queries labelled ones, likewise taken, are added, but only those that agree with
    their label, since labels of queries may be wrong or not the whole truth.  The labels are
    taken as often as they occur, so that right labels remain the majority.  replies are those
    of with_agreeing().
    """
    alias = F.broadcast(names.select(F.col("alias"), F.col("language").alias("_language")).distinct())
    labelled = documents.select("doc_id", "source", "text", "lang").join(alias, F.col("lang") == F.col("alias"))
    samples = _labelled(labelled, "_language", "doc_id", "source", "text", most_documents)
    if queries is None:
        return samples
    own = queries.select("query_id", "query", F.col("language").alias("_label")).join(alias, F.col("_label") == F.col("alias"))
    rows = hashed_sample(own.where(F.col("query").isNotNull()).select("_language", "query_id", "query"), "query_id", most_queries)
    return with_agreeing(samples, [(r[0], f"q{r[1]}", r[2]) for r in rows.collect()], replies)


def with_agreeing(samples: list[tuple[str, str, str]], uncertain: list[tuple[str, str, str]], replies: list[tuple[str | None, str, str]] = ()) -> list[tuple[str, str, str]]:
    """The clauses of samples, and those of uncertain ones that agree with their labels.

    replies are texts, (question, source, text), in the language of their question: the language
    that the question's words vote for.  Their clauses are added where their own votes agree.
    """
    added = [(language, source, text[a:b]) for language, source, text in uncertain for a, b in clauses(text)]
    parts = [(language, source, text[a:b]) for language, source, text in samples for a, b in clauses(text)]
    votes = Votes(parts + added)
    result = parts + [x for x, fine in zip(added, votes.agreeing()[len(parts) :]) if fine]
    for question, source, text in replies:
        language = votes.language(question)
        if language:
            result += [(language, source, text[a:b]) for a, b in clauses(text) if votes.language(text[a:b]) == language]
    return result


def fit_from_tables(documents: DataFrame, names: DataFrame, queries: DataFrame | None = None) -> LanguageModel:
    """A model fitted on table_samples()."""
    return fit(table_samples(documents, names, queries))


def identify(df: DataFrame, model: LanguageModel, id_col: str, text_col: str) -> DataFrame:
    """<id_col>, language, confidence, segments of each row.

    language is that of most of the text's characters; segments is an array of begin, end,
    language, confidence.  Null, empty and blank texts, texts without words and texts far
    from all languages get null, 0 and no segments; ties go to the language first in the
    alphabet; copies are labelled each for itself; a very long text is labelled clause by
    clause; an empty table gives an empty one; other columns aren't read.  No shuffle; the
    model (for six languages 9 MB of centroids and the words known, whatever the corpus; it grows
    with the languages) is broadcast.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    schema = extended(df, id_col, "language string, confidence double, segments array<struct<begin: int, end: int, language: string, confidence: double>>")
    kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("language", pa.string()), ("confidence", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for part in slices(batch, "_text"):
                languages, sure, found = [], [], []
                for text in part.column(1).to_pylist():
                    segments = own.segments(text)
                    sizes: dict[str, int] = {}
                    for begin, end, language, _ in segments:
                        sizes[language] = sizes.get(language, 0) + end - begin
                    best = min(sizes, key=lambda x: (-sizes[x], x)) if sizes else None
                    weights = [(e - b, c) for b, e, x, c in segments if x == best]
                    languages.append(best)
                    sure.append(sum(n * c for n, c in weights) / max(1, sum(n for n, _ in weights)) if best else 0.0)
                    found.append([dict(zip(("begin", "end", "language", "confidence"), s)) for s in segments])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(languages, pa.string()), pa.array(sure, pa.float64()), pa.array(found, kind)], names=schema.names)

    return df.select(df[id_col], df[text_col].alias("_text")).mapInArrow(run, schema)


def label_defects(queries: DataFrame, names: DataFrame, model: LanguageModel) -> DataFrame:
    """query_id, language of the queries whose label is missing, wrong or not the whole truth:
    a row for each language the query is written in.

    A label counts as it is spelled in names; null, blank and unknown labels are missing.
    Queries without words, and those far from all languages, have no row; copies of a
    query_id count once; very long queries are read whole; an empty table gives an empty
    result; other columns aren't read.
    """
    own = one_per_key(queries, "query_id", "query", "language").withColumnRenamed("language", "_label")
    labelled = own.join(F.broadcast(names.select("alias", F.col("language").alias("_named")).distinct()), F.col("_label") == F.col("alias"), "left")
    found = identify(labelled.select("query_id", "query"), model, "query_id", "query").select("query_id", F.array_distinct(F.col("segments.language")).alias("written"))
    both = labelled.select("query_id", "_named").join(found, "query_id")
    fine = (F.size("written") == 1) & F.coalesce(F.array_contains("written", F.col("_named")), F.lit(False))
    return both.where(~fine).select("query_id", F.explode("written").alias("language"))
