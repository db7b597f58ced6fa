"""Problem 6: near-duplicate records with small edits.

The similarity is the weighted Jaccard similarity of word multisets.  Texts with one multiset
form a class, and only a class's representative is sketched, by DartMinHash: hashed darts fall
into regions of (word, weight, rank), a text keeps those within its weights and, for each
coordinate, the one of lowest rank; two texts keep the same dart in a coordinate with
probability equal to their similarity.  Bands of coordinates are the join keys.

Texts that share a template agree in most bands although they are below the threshold, so the
key of a short text also holds one of its prefix words: of two texts of sizes m <= n at or
above the threshold t, one of the m - ceil(2t / (1 + t) * m) + 1 rarest words of the first is
among the n - ceil(t * n) + 1 rarest of the second, whatever total order of words is used.
The order comes from a table of hashed counters of fixed size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.session import reliable_checkpoint
from pagewright.llm.textkit import extended, one_per_key, slices, words

#: Bits of the table of counters that orders words: 2 ** BITS counters are broadcast (2 MB).
BITS = 18
#: Up to SHORT_MAX words a text's keys hold a prefix word; from SHORT_MAX * threshold on it has long keys, too.
SHORT_MAX = 80
SHORT_BANDS, SHORT_ROWS = 8, 1
LONG_BANDS, LONG_ROWS = 24, 4


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift-multiply)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Bounds on a uniform number for 0, 1, 2, ... darts in a region of unit area (Poisson, mean 1).
_DARTS = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])


def dart_signatures(elements: np.ndarray, weights: np.ndarray, owner: np.ndarray, texts: int, coordinates: int) -> np.ndarray:
    """Signatures (texts x coordinates, 64-bit dart ids) of weighted sets.

    elements: hashes; weights: positive numbers; owner: the set of each.  A set without
    elements gets zeros.  The plane over each element is cut into regions of unit weight and
    unit rank; each holds a Poisson number of darts that depend on nothing but the region.
    Ranks are searched in growing layers until every coordinate has a dart.
    """
    signature = np.zeros((texts, coordinates), np.uint64)
    best = np.full((texts, coordinates), np.inf)
    mass = np.bincount(owner, weights, texts)
    wanted = coordinates * (math.log(coordinates) + 2)
    cells = np.ceil(weights).astype(np.int64)
    row = np.repeat(np.arange(len(elements)), cells)
    cell = np.arange(len(row)) - np.repeat(np.cumsum(cells) - cells, cells)
    base = mix(elements[row] + cell.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    own, room = owner[row], weights[row] - cell
    low = np.zeros(texts, np.int64)
    high = np.where(mass > 0, np.ceil(wanted / np.maximum(mass, 1e-9)), 0).astype(np.int64)
    active = mass > 0
    while active.any():
        live = active[own]
        layers = (high - low)[own[live]]
        at = np.repeat(np.flatnonzero(live), layers)
        layer = np.arange(len(at)) - np.repeat(np.cumsum(layers) - layers, layers) + low[own[at]]
        seed = mix(base[at] ^ mix(layer.astype(np.uint64) + np.uint64(1)))
        count = np.searchsorted(_DARTS, (seed >> np.uint64(11)) / 2.0**53, "right")
        dart = np.repeat(np.arange(len(at)), count)
        number = np.arange(len(dart)) - np.repeat(np.cumsum(count) - count, count)
        name = mix(seed[dart] + (number.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD1342543DE82EF95))
        height = (mix(name ^ np.uint64(0xA5A5A5A5A5A5A5A5)) >> np.uint64(11)) / 2.0**53
        rank = layer[dart] + (mix(name ^ np.uint64(0x5A5A5A5A5A5A5A5A)) >> np.uint64(11)) / 2.0**53
        inside = height < room[at[dart]]
        name, rank, text = name[inside], rank[inside], own[at[dart[inside]]]
        place = text * coordinates + (mix(name ^ np.uint64(0x3C3C3C3C3C3C3C3C)) % np.uint64(coordinates)).astype(np.int64)
        order = np.lexsort((name, rank, place))
        place, rank, name = place[order], rank[order], name[order]
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]])) if len(place) else np.zeros(0, np.int64)
        flat, kept = signature.reshape(-1), best.reshape(-1)
        better = rank[first] < kept[place[first]]
        flat[place[first][better]] = name[first][better]
        kept[place[first][better]] = rank[first][better]
        active &= ~np.isfinite(best).all(1)
        low, high = np.where(active, high, low), np.where(active, high * 2, high)
    return signature


class _Tokens(dict):
    """(word, occurrence) to a signed 64-bit number, with a bound on what is kept."""

    def __missing__(self, key: tuple[str, int]) -> int:
        word, n = key
        value = xxhash.xxh64_intdigest(f"{word} {n}" if n else word) - (1 << 63)
        if len(self) < 300_000:
            self[key] = value
        return value


def _multiset(text: str | None, tokens: _Tokens) -> list[int]:
    """Numbers of the words of a text, each occurrence of a word having its own."""
    seen: dict[str, int] = {}
    result = []
    for word in words(text):
        n = seen.get(word, 0)
        seen[word] = n + 1
        result.append(tokens[word, n])
    result.sort()
    return result


def word_classes(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """<id_col>, tokens, class_key of each record whose text has words, one row per id."""
    schema = extended(df, id_col, "tokens array<bigint>, class_key string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Tokens()
        for batch in batches:
            for part in slices(batch, "_text"):
                lists = [_multiset(t, known) for t in part.column(1).to_pylist()]
                kept = [i for i, x in enumerate(lists) if x]
                keys = [xxhash.xxh3_128_hexdigest(np.array(lists[i], np.int64).tobytes()) for i in kept]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(kept, pa.int64())), pa.array([lists[i] for i in kept], pa.list_(pa.int64())), pa.array(keys, pa.string())], names=schema.names)

    return one_per_key(df, id_col, text_col).withColumnRenamed(text_col, "_text").mapInArrow(run, schema)


def membership(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """<id_col>, class_id of each record with words: the least id among the records whose
    words are the same multiset."""
    found = word_classes(df, id_col, text_col).select(id_col, "class_key")
    heads = found.groupBy("class_key").agg(F.min(id_col).alias("class_id"))
    return found.join(heads, "class_key").select(id_col, "class_id")


def _counters(classes: DataFrame) -> np.ndarray:
    slot = F.col("token").bitwiseAND(F.lit((1 << BITS) - 1)).cast("int")
    rows = classes.select(F.explode("tokens").alias("token")).groupBy(slot.alias("slot")).count().toPandas()
    table = np.zeros(1 << BITS, np.int64)
    table[rows["slot"].to_numpy(np.int64)] = rows["count"].to_numpy(np.int64)
    return table


def _band_keys(classes: DataFrame, table: np.ndarray, threshold: float) -> DataFrame:
    shared = classes.sparkSession.sparkContext.broadcast(table)
    schema = "key bigint, class_id " + classes.schema["class_id"].dataType.simpleString() + ", size int, side int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch in batches:
            ids, lists = batch.column(0), batch.column(1)
            sizes = np.diff(np.asarray(lists.offsets)).astype(np.int64)
            values = np.asarray(lists.flatten()).astype(np.int64)
            ends = np.cumsum(sizes)
            begin = 0
            while begin < len(sizes):  # texts of about 100,000 words in all at a time
                stop = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + 100_000, "right")))
                own = values[ends[begin] - sizes[begin] : ends[stop - 1]]
                keys, owner, side = _keys_of(own, sizes[begin:stop], counts, threshold)
                rows = pa.array(owner + begin)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), ids.take(rows), pa.array(sizes[owner + begin].astype(np.int32)), pa.array(side)], names=["key", "class_id", "size", "side"])
                begin = stop

    return classes.select("class_id", "tokens").mapInArrow(run, schema)


#: What a key is for: a text as the larger one of a pair only, or as either.
LARGER, EITHER = 2, 3


def _keys_of(values: np.ndarray, sizes: np.ndarray, counts: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, the text of each, and its side."""
    texts = len(sizes)
    owner = np.repeat(np.arange(texts), sizes)
    hashes = values.view(np.uint64)
    all_keys, all_owners, all_sides = [], [], []
    short = sizes <= SHORT_MAX
    if short.any():
        names = np.cumsum(short) - 1
        pick = short[owner]
        who, what = names[owner[pick]], hashes[pick]
        sign = dart_signatures(mix(what), np.ones(len(what)), who, int(short.sum()), SHORT_BANDS * SHORT_ROWS)
        bands = _fold_bands(sign, SHORT_BANDS, SHORT_ROWS)
        rarity = counts[(values[pick] & ((1 << BITS) - 1)).astype(np.int64)]
        order = np.lexsort((what, rarity, who))
        own = sizes[short]
        place = np.arange(len(who)) - np.repeat(np.cumsum(own) - own, own)
        smaller = own - np.ceil(2 * threshold / (1 + threshold) * own - 1e-9).astype(np.int64) + 1
        larger = own - np.ceil(threshold * own - 1e-9).astype(np.int64) + 1
        chosen = order[place < larger[who[order]]]
        token, holder = what[chosen], who[chosen]
        all_keys.append(mix(bands[holder] + mix(token ^ np.uint64(0x1234567))[:, None]).reshape(-1))
        all_owners.append(np.repeat(np.flatnonzero(short)[holder], SHORT_BANDS))
        all_sides.append(np.repeat(np.where((place < smaller[who[order]])[place < larger[who[order]]], EITHER, LARGER), SHORT_BANDS))
    long = sizes >= SHORT_MAX * threshold
    if long.any():
        names = np.cumsum(long) - 1
        pick = long[owner]
        sign = dart_signatures(mix(hashes[pick]), np.ones(int(pick.sum())), names[owner[pick]], int(long.sum()), LONG_BANDS * LONG_ROWS)
        all_keys.append(mix(_fold_bands(sign, LONG_BANDS, LONG_ROWS)).reshape(-1))
        all_owners.append(np.repeat(np.flatnonzero(long), LONG_BANDS))
        all_sides.append(np.full(len(all_owners[-1]), EITHER))
    return np.concatenate(all_keys), np.concatenate(all_owners), np.concatenate(all_sides).astype(np.int32)


def _fold_bands(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    folded = np.broadcast_to(np.arange(bands, dtype=np.uint64) + np.uint64(rows << 32), (len(signature), bands))
    for k in range(rows):
        folded = mix(folded + signature[:, k * bands : (k + 1) * bands])
    return folded


def near_duplicate_links(df: DataFrame, id_col: str, text_col: str, threshold: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Links between classes of equal records, and the membership of the records.

    The first result has ``a, b, common, total`` for each two classes (named by their least
    id, a < b) whose similarity common / total is at least threshold; the second is that of
    membership().  Records with null, empty or blank texts or without words are in neither;
    copies of one id count once; ties and repeated texts fall into one class and aren't
    expanded; a very long text has as many keys as a text of SHORT_MAX words at most; an
    empty table gives empty results; other columns aren't read.

    A pair at the threshold itself is missed with probability 0.2 ** 8 = 3e-6 for short and (1 - 0.8 ** 4) ** 24 = 3e-6 for long texts, and a more similar one more
    rarely.  Candidates are checked exactly.
    """
    found = reliable_checkpoint(word_classes(df, id_col, text_col))
    classes = found.groupBy("class_key").agg(F.min(id_col).alias("class_id"), F.any_value("tokens").alias("tokens"))
    keys = _band_keys(classes, _counters(classes), threshold)
    # both sides read one exchange: conditions of one side alone would be pushed below it and make two
    # of it, so the sides of both texts are in the one that lets the smaller text's shorter prefix count
    left = keys.select("key", F.col("class_id").alias("a"), F.col("size").alias("m"), F.col("side").alias("s")).hint("merge")
    right = keys.select("key", F.col("class_id").alias("b"), F.col("size").alias("n"), F.col("side").alias("t"))
    smaller = F.col("s") + F.col("t") >= F.col("t") + EITHER
    near = smaller & (F.col("m") >= F.lit(threshold) * F.col("n") - 1e-9) & ((F.col("m") < F.col("n")) | ((F.col("m") == F.col("n")) & (F.col("a") != F.col("b"))))
    pairs = left.join(right, "key").where(near).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    tokens = classes.select("class_id", "tokens")
    pairs = pairs.join(tokens.select(F.col("class_id").alias("a"), F.col("tokens").alias("x")), "a")
    pairs = pairs.join(tokens.select(F.col("class_id").alias("b"), F.col("tokens").alias("y")), "b")
    common = F.size(F.array_intersect("x", "y"))
    pairs = pairs.select("a", "b", common.alias("common"), (F.size("x") + F.size("y")).alias("both"))
    pairs = pairs.select("a", "b", "common", (F.col("both") - F.col("common")).alias("total"))
    links = pairs.where(F.col("common") >= F.lit(threshold) * F.col("total") - 1e-9)
    heads = classes.select("class_key", "class_id")
    members = found.select(id_col, "class_key").join(heads, "class_key").select(id_col, "class_id")
    return links, members


def near_duplicate_pairs(df: DataFrame, id_col: str, text_col: str, threshold: float = 0.8) -> DataFrame:
    """<id_col>_a, <id_col>_b of all pairs of records with similarity of at least threshold.

    This expands the classes of near_duplicate_links(), so its size is that of the answer;
    use the links and the membership where classes are large.
    """
    links, members = near_duplicate_links(df, id_col, text_col, threshold)
    left = members.select(F.col("class_id").alias("a"), F.col(id_col).alias("p"))
    right = members.select(F.col("class_id").alias("b"), F.col(id_col).alias("q"))
    across = links.select("a", "b").join(left, "a").join(right, "b").select("p", "q")
    within = left.withColumnRenamed("a", "c").join(right.withColumnRenamed("b", "c"), "c").where("p < q").select("p", "q")
    return across.unionByName(within).select(F.least("p", "q").alias(f"{id_col}_a"), F.greatest("p", "q").alias(f"{id_col}_b"))
