"""Vectors: mutual nearest neighbours, density-like clusters, pairs and triplets of summaries."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pagewright.functions.text import hash_integer
from pagewright.session import reliable_checkpoint


_FOUND = "{key} {kind}, neighbour {kind}, similarity double"


def _stacked(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def _top(names: np.ndarray, others: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Names and scores of the k best of others for each of names, by score and then name."""
    scores[names[:, None] == (others[None, :] if others.ndim == 1 else others)] = -np.inf
    others = np.broadcast_to(others, scores.shape)
    order = np.lexsort((others, -np.round(scores, 9)), axis=1)[:, :k]
    return np.take_along_axis(others, order, 1), np.take_along_axis(scores, order, 1)


def _ranked(found: DataFrame, k: int, key: str) -> DataFrame:
    rank = F.row_number().over(W.partitionBy(key).orderBy(F.desc(F.round("similarity", 9)), "neighbour"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select(key, "neighbour", "rank", "similarity")


def _met(held: DataFrame, posed: DataFrame, k: int, cells: list[str], block_rows: int, key: str, vector: str) -> DataFrame:
    """key, neighbour, similarity: of each posed row its k best held rows of the same cells, in
    parts.  A cell's rows are cut into blocks of about block_rows; each block of held rows
    meets each part of posed rows in a task of its own, whatever the size of the cell."""
    kind = held.schema[key].dataType.simpleString()
    pieces = lambda df, name: df.groupBy(*cells).agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias(name))
    if cells:
        sizes = pieces(held, "blocks").join(pieces(posed, "parts"), cells)
        held, posed = (df.join(sizes, cells) for df in (held, posed))
    else:
        counts = [max(1, -(-df.count() // block_rows)) for df in (held, posed)]
        held, posed = (df.select("*", F.lit(counts[0]).alias("blocks"), F.lit(counts[1]).alias("parts")) for df in (held, posed))
    own = lambda name: F.pmod(F.xxhash64(key), F.col(name)).cast("int")
    all_of = lambda name: F.explode(F.sequence(F.lit(0), F.col(name) - 1))
    held = held.withColumn("block", own("blocks")).withColumn("part", all_of("parts"))
    posed = posed.withColumn("part", own("parts")).withColumn("block", all_of("blocks"))

    def meet(group: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({key: [], "neighbour": [], "similarity": []})
        matrix, others, parts = _stacked(right[vector]), right[key].to_numpy(), []
        step = max(1, 4_000_000 // len(right))  # four million scores at a time
        for at in range(0, len(left), step):
            own = left.iloc[at : at + step]
            best, score = _top(own[key].to_numpy(), others, _stacked(own[vector]) @ matrix.T, k)
            parts.append(pd.DataFrame({key: np.repeat(own[key].to_numpy(), best.shape[1]), "neighbour": best.ravel(), "similarity": score.ravel()}))
        found = pd.concat(parts)
        return found[np.isfinite(found["similarity"])]

    columns = [key, vector, *cells, "block", "part"]
    left, right = (df.select(*[F.col(c).alias(f"{side}_{c}") for c in columns]).toDF(*columns).groupBy(*cells, "block", "part") for side, df in (("q", posed), ("v", held)))
    return left.cogroup(right).applyInPandas(meet, _FOUND.format(key=key, kind=kind))


def nearest_neighbours(vectors: DataFrame, queries: DataFrame | None = None, k: int = 5, key: str = "vec_id", vector: str = "embedding", block_rows: int = 20_000) -> DataFrame:
    """key, neighbour, rank, similarity: the k nearest other vectors by inner product.

    Exact, with as many products as pairs, for tables of moderate size or few queries; see
    indexed_neighbours() for others.  Ties go to the smaller key.  Queries (all vectors where
    none are given) of up to block_rows are broadcast and every task keeps k neighbours of each
    over its own rows; more are cut into blocks that meet blocks of vectors, in one plan
    whatever their number.
    """
    asked = (vectors if queries is None else queries).select(key, vector).where(F.col(vector).isNotNull())
    base = vectors.select(key, vector).where(F.col(vector).isNotNull())
    rows = asked.limit(block_rows + 1).toPandas()
    if len(rows) > block_rows:
        return _ranked(_met(base, asked, k, [], block_rows, key, vector), k, key)
    kind = vectors.schema[key].dataType.simpleString()
    if rows.empty:
        return vectors.sparkSession.createDataFrame([], f"{key} {kind}, neighbour {kind}, rank int, similarity double")
    shared = vectors.sparkSession.sparkContext.broadcast((rows[key].to_numpy(), _stacked(rows[vector])))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, matrix = shared.value
        best, score = np.zeros((len(names), 0), names.dtype), np.zeros((len(names), 0))
        step = max(1, 4_000_000 // len(names))
        for frame in frames:
            for at in range(0, len(frame), step):
                own = frame.iloc[at : at + step]
                others = np.concatenate([best, np.broadcast_to(own[key].to_numpy(), (len(names), len(own)))], axis=1)
                best, score = _top(names, others, np.concatenate([score, matrix @ _stacked(own[vector]).T], axis=1), k)
        if best.shape[1]:
            found = pd.DataFrame({key: np.repeat(names, best.shape[1]), "neighbour": best.ravel(), "similarity": score.ravel()})
            yield found[np.isfinite(found["similarity"])]

    return _ranked(base.mapInPandas(run, _FOUND.format(key=key, kind=kind)), k, key)


def hashed_rows(df: DataFrame, key: str, most: int) -> DataFrame:
    """At most most rows by the hashes of their keys; a threshold leaves few to sort."""
    bits, count = 1 << 30, df.count()
    own = F.pmod(F.xxhash64(key), F.lit(bits))
    return (df.where(own < int(1.5 * most / count * bits) + 1) if count > 2 * most else df).orderBy(own, key).limit(most)


def cell_centroids(vectors: DataFrame, cells: int, sample: int = 20_000, steps: int = 10, key: str = "vec_id", vector: str = "embedding") -> np.ndarray:
    """Directions of cells, by spherical k-means on at most sample vectors (by hashes of keys)."""
    rows = hashed_rows(vectors.select(key, vector).where(F.col(vector).isNotNull()), key, sample).toPandas()
    if rows.empty:
        return np.zeros((0, 1))
    matrix = _stacked(rows[vector])
    matrix /= np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-12)
    centers = matrix[np.linspace(0, len(matrix) - 1, min(cells, len(matrix))).astype(int)].copy()
    for _ in range(steps):
        nearest = np.concatenate([(matrix[at : at + 5_000] @ centers.T).argmax(1) for at in range(0, len(matrix), 5_000)])
        sums = np.zeros_like(centers)
        np.add.at(sums, nearest, matrix)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centers = np.where(norms > 1e-12, sums / np.maximum(norms, 1e-12), centers)
    return centers


def cells_for(count: int) -> int:
    """How many cells an index of count vectors has: they grow with the root of the vectors, up
    to 4,096 (whose centroids are broadcast and fitted on 20 vectors each)."""
    return max(1, min(4_096, int(2 * count**0.5)))


def measured_probes(vectors: DataFrame, centers: np.ndarray, k: int, recall: float, sample: int = 256, key: str = "vec_id", vector: str = "embedding") -> int:
    """How many cells a query must look into for recall, measured on a sample of vectors.

    The exact neighbours of the sample are found in one pass; the number of cells nearer to a
    query than the one its neighbour is in tells from how many probes on it would be found.
    """
    few = hashed_rows(vectors.select(key, vector).where(F.col(vector).isNotNull()), key, sample)
    near = nearest_neighbours(vectors, few, k, key, vector).select(F.col(key).alias("_q"), F.col("neighbour").alias(key))
    pairs = vectors.select(key, vector).join(F.broadcast(near), key).join(F.broadcast(few.select(F.col(key).alias("_q"), F.col(vector).alias("_v"))), "_q").select("_v", vector).toPandas()
    if pairs.empty:
        return 1
    own = (_stacked(pairs[vector]) @ centers.T).argmax(1)
    scores = _stacked(pairs["_v"]) @ centers.T
    before = (scores > np.take_along_axis(scores, own[:, None], 1)).sum(1)
    return int(np.sort(before)[min(len(before) - 1, int(np.ceil(recall * len(before))) - 1)]) + 1


def indexed_neighbours(
    vectors: DataFrame, queries: DataFrame | None = None, k: int = 5, cells: int | None = None, probes: int | None = None, block_rows: int = 5_000, recall: float = 0.97, key: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """key, neighbour, rank, similarity like nearest_neighbours(), through an index of cells.

    Every vector is in the cell of its nearest centroid, and a query looks into the probes
    cells nearest to it, so neighbours in other cells are missed.  Unless given, the number of
    cells grows with the root of the vectors and probes are those that a sample needs for
    recall.  A cell of more than block_rows vectors is cut into blocks, each of which meets the
    cell's queries in a task of its own; partial lists of k are merged at the end.  With probes
    equal to cells the result is exact.
    """
    kind = vectors.schema[key].dataType.simpleString()
    wanted = cells or cells_for(vectors.count())
    centers = cell_centroids(vectors, wanted, max(20_000, 20 * wanted), key=key, vector=vector)
    if not len(centers):
        return vectors.sparkSession.createDataFrame([], f"{key} {kind}, neighbour {kind}, rank int, similarity double")
    looked = probes or measured_probes(vectors, centers, k, recall, key=key, vector=vector)
    shared = vectors.sparkSession.sparkContext.broadcast(centers)

    def nearest(count: int):
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                for at in range(0, len(frame), 5_000):
                    own = frame.iloc[at : at + 5_000]
                    cells_of = np.argsort(-(_stacked(own[vector]) @ shared.value.T), axis=1, kind="stable")[:, :count]
                    n = cells_of.shape[1]
                    yield pd.DataFrame({key: np.repeat(own[key].to_numpy(), n), vector: [v for v in own[vector] for _ in range(n)], "cell": cells_of.ravel().astype(np.int32)})

        return run

    schema = f"{key} {kind}, {vector} array<float>, cell int"
    base = vectors.select(key, vector).where(F.col(vector).isNotNull()).mapInPandas(nearest(1), schema)
    asked = (vectors if queries is None else queries).select(key, vector).where(F.col(vector).isNotNull()).mapInPandas(nearest(looked), schema)
    return _ranked(_met(base, asked, k, ["cell"], block_rows, key, vector), k, key)


def mutual_neighbours(neighbours: DataFrame, key: str = "vec_id") -> DataFrame:
    """a, b (a < b): vectors that are among each other's neighbours."""
    one = neighbours.select(F.least(key, "neighbour").alias("a"), F.greatest(key, "neighbour").alias("b"), (F.col(key) < F.col("neighbour")).alias("way"))
    return one.groupBy("a", "b").agg(F.countDistinct("way").alias("ways")).where("ways = 2").select("a", "b")


def _to_least(rows: DataFrame, key: str, least: DataFrame, hub: int) -> DataFrame:
    """rows joined with least (key, m, degree) on key.

    Keys of hub rows or more, of which there are few, are broadcast, so that no task gets all
    rows of one key; the others meet in a shuffle.
    """
    hubs = F.broadcast(least.where(F.col("degree") >= hub).select(key, "m"))
    return rows.join(hubs, key).unionByName(rows.join(hubs.select(key), key, "left_anti").join(least.where(F.col("degree") < hub).select(key, "m"), key))


def _fingerprint(edges: DataFrame) -> tuple:
    """Number of edges, and sum and xor of their hashes; one row, whatever their order."""
    own = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(own.cast("decimal(20,0)")), F.bit_xor(own)).first())


def connected_components(edges: DataFrame, rounds: int = 60, hub: int = 100_000) -> DataFrame:
    """node, component (the least node reached) for each node of edges ``a, b``.

    Alternates hooking every node's larger neighbours and squaring of the pointers, so that
    the number of rounds grows with the logarithm of a component's diameter.  Each round is
    checkpointed to the shared folder; nothing but counts and hashes in one row reach the
    driver.  Nodes of hub neighbours or more are met by a broadcast of their minima.
    """
    links = reliable_checkpoint(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    nodes = links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node"))).distinct()
    current, mark = links, _fingerprint(links)
    for _ in range(rounds):
        # large star: each node's larger neighbours go to its least neighbour
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count(F.lit(1)).alias("degree"))
        large = _to_least(both.where("b > a"), "a", least, hub).select(F.col("m").alias("a"), "b").where("a <> b").distinct()
        # small star: each node's smaller neighbours and itself go to the least of them
        down = large.select(F.greatest("a", "b").alias("n"), F.least("a", "b").alias("s"))
        floor = down.groupBy("n").agg(F.min("s").alias("m"), F.count(F.lit(1)).alias("degree"))
        small = _to_least(down, "n", floor, hub).select(F.col("m").alias("a"), F.col("s").alias("b")).union(floor.select(F.col("m").alias("a"), F.col("n").alias("b"))).where("a <> b").distinct()
        current, before = reliable_checkpoint(small), mark
        mark = _fingerprint(current)
        if mark == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return nodes.join(current.select(F.col("b").alias("node"), F.col("a").alias("component")), "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def density_clusters(vectors: DataFrame, k: int = 5, least: int = 2, key: str = "vec_id", vector: str = "embedding", recall: float | None = 0.97) -> DataFrame:
    """key, cluster: components of the mutual k-nearest-neighbour graph of at least least
    vectors; the others are noise with cluster null.

    The graph is found through an index with the measured recall; None finds it exactly, which
    takes time with the square of the vectors.
    """
    near = nearest_neighbours(vectors, None, k, key, vector) if recall is None else indexed_neighbours(vectors, None, k, recall=recall, key=key, vector=vector)
    edges = mutual_neighbours(near, key)
    found = connected_components(edges)
    big = found.groupBy("component").count().where(F.col("count") >= least).select("component")
    kept = found.join(big, "component").select(F.col("node").alias(key), F.col("component").alias("cluster"))
    return vectors.select(key).distinct().join(kept, key, "left")


def _point(*parts: Column | str) -> Column:
    return hash_integer(*parts)


def cluster_tuples(members: DataFrame, size: int, iterations: int = 15, per_mille: int = 500, key: str = "ord", document: str = "document", cluster: str = "cluster") -> DataFrame:
    """iteration, cluster, multi, and the ordered members of one pair (size 2) or triplet
    (size 3) of each cluster and iteration.

    A hash of iteration and cluster decides, per_mille times of a thousand, that the members
    come from several documents: the first member of as many documents as are needed (for a
    triplet two documents if there are no three), by hashed ranks of documents and of members
    in a document.  Otherwise the document with the least hash among those with enough
    members gives them all.  If the first way isn't possible the other is tried; a cluster
    where neither is has no tuple.  Tuples found again in another iteration are the caller's
    to drop.
    """
    if size not in (2, 3):
        raise ValueError("size must be 2 or 3")
    own = members.where(F.col(cluster).isNotNull()).select(F.col(key).alias("m"), F.col(document).cast("string").alias("d"), F.col(cluster).alias("c"))
    own = own.select("*", F.explode(F.sequence(F.lit(0), F.lit(iterations - 1))).alias("i")) if iterations else own.select("*", F.lit(0).alias("i")).where("false")
    # no document gives more than size members, so ranks are cut in the tasks before the shuffle
    inner = W.partitionBy("i", "c", "d")
    own = own.withColumn("rm", F.row_number().over(inner.orderBy(_point("m", F.col("i"), F.col("m")), "m"))).where(F.col("rm") <= size)
    heads = own.groupBy("i", "c", "d").agg(F.max("rm").alias("nd"))
    point = F.struct(_point("d", F.col("i"), F.col("c"), F.col("d")).alias("p"), F.col("d").alias("d"))
    lone = heads.groupBy("i", "c").agg(F.count(F.lit(1)).alias("docs"), F.min(F.when(F.col("nd") >= size, point)).alias("lone"))
    first = heads.withColumn("rd", F.row_number().over(W.partitionBy("i", "c").orderBy(point["p"], "d"))).where(F.col("rd") <= 3)
    twice = first.where("rd <= 2 and nd >= 2").groupBy("i", "c").agg(F.min("rd").alias("twice"))
    facts = lone.join(twice, ["i", "c"], "left")
    coin = (_point("multi", F.col("i"), F.col("c")) % 1000) < per_mille
    several = (F.col("docs") >= size) if size == 2 else (F.col("docs") >= 3) | F.col("twice").isNotNull()
    facts = facts.withColumn("multi", F.when(several & F.col("lone").isNotNull(), coin).otherwise(several)).where(several | F.col("lone").isNotNull())
    ranked = own.join(facts, ["i", "c"]).join(first.select("i", "c", "d", "rd"), ["i", "c", "d"], "left")
    if size == 2:
        multi = (F.col("rd") <= 2) & (F.col("rm") == 1)
    else:
        three = (F.col("docs") >= 3) & ((_point("three", F.col("i"), F.col("c")) % 10 < 7) | F.col("twice").isNull())
        multi = F.when(three, (F.col("rd") <= 3) & (F.col("rm") == 1)).otherwise((F.col("rd") <= 2) & ((F.col("rm") == 1) | ((F.col("rm") == 2) & (F.col("rd") == F.col("twice")))))
    chosen = ranked.where(F.when(F.col("multi"), multi).otherwise(F.col("d") == F.col("lone.d")))
    return chosen.groupBy(F.col("i").alias("iteration"), F.col("c").alias("cluster"), "multi").agg(F.sort_array(F.collect_list("m")).alias("members"), F.countDistinct("d").alias("documents"))


def multi_document_share(tuples: DataFrame) -> DataFrame:
    """One row: distinct tuples, those of several documents, and their share (null of none)."""
    own = tuples.select("members", "documents").distinct()
    return own.agg(F.count(F.lit(1)).alias("tuples"), F.count_if(F.col("documents") > 1).alias("several")).withColumn("share", F.try_divide("several", "tuples"))
