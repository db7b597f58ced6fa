from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagewright.operators import embedding, vectors


def test_neighbours_against_brute_force(spark):
    rng = np.random.default_rng(1)
    matrix = rng.normal(size=(60, 8))
    matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
    matrix = matrix.astype(np.float32)
    frame = spark.createDataFrame([(k, [float(x) for x in v]) for k, v in enumerate(matrix)], "vec_id bigint, embedding array<float>")
    for block in (1_000, 17):
        got = {}
        for r in vectors.nearest_neighbours(frame, None, 3, block_rows=block).collect():
            got.setdefault(r["vec_id"], {})[r["rank"]] = r["neighbour"]
        scores = matrix.astype(np.float64) @ matrix.astype(np.float64).T
        np.fill_diagonal(scores, -np.inf)
        for k in range(60):
            order = sorted(range(60), key=lambda j: (-round(scores[k, j], 9), j))[:3]
            assert [got[k][r] for r in (1, 2, 3)] == order


def test_index_recall(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    truth = {(r["vec_id"], r["neighbour"]) for r in vectors.nearest_neighbours(frame).collect()}
    for cells, probes, block, least in ((8, 8, 40, 1.0), (64, 40, 5_000, 0.9)):
        rows = vectors.indexed_neighbours(frame, None, 5, cells, probes, block).collect()
        found = {(r["vec_id"], r["neighbour"]) for r in rows}
        assert len(found) == len(rows) and len(found & truth) >= least * len(truth)
    assert vectors.indexed_neighbours(frame.where("false")).count() == 0
    assert {(r["vec_id"], r["neighbour"]) for r in vectors.nearest_neighbours(frame, block_rows=40).collect()} == truth


@pytest.mark.parametrize("count", [500, 2_000, 8_000])
def test_measured_recall_of_a_growing_index(spark, count):
    rng = np.random.default_rng(count)
    centers = rng.normal(size=(max(4, int(count**0.5)), 16))
    matrix = (centers[rng.integers(len(centers), size=count)] + 0.5 * rng.normal(size=(count, 16))).astype(np.float32)
    matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
    frame = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(matrix)], "vec_id bigint, embedding array<float>")
    found = {(r["vec_id"], r["neighbour"]) for r in vectors.indexed_neighbours(frame, frame.where("vec_id % 10 = 0")).collect()}
    scores = matrix[::10].astype(np.float64) @ matrix.astype(np.float64).T
    scores[np.arange(len(scores)), np.arange(0, count, 10)] = -np.inf
    order = np.argsort(-scores, axis=1)[:, :5]
    truth = {(10 * q, int(n)) for q, own in enumerate(order) for n in own}
    assert len(found & truth) >= 0.95 * len(truth)
    cells = vectors.cells_for(count)
    probes = vectors.measured_probes(frame, vectors.cell_centroids(frame, cells), 5, 0.97)
    assert probes <= cells / 3  # far from looking into all of them


def test_components(spark):
    chain = [(k, k + 1) for k in range(0, 30)] + [(100, 101), (102, 101), (7, 7)]
    frame = spark.createDataFrame(chain, "a bigint, b bigint")
    got = {r["node"]: r["component"] for r in vectors.connected_components(frame).collect()}
    assert all(got[k] == 0 for k in range(31)) and got[102] == 100
    assert vectors.connected_components(frame.where("false")).count() == 0
    star = spark.range(1, 400).selectExpr("id as a", "0L as b").unionByName(spark.range(500, 900).selectExpr("id as a", "id + 1 as b"))
    for hub in (3, 100_000):
        got = {r["node"]: r["component"] for r in vectors.connected_components(star, hub=hub).collect()}
        assert got == {**dict.fromkeys(range(400), 0), **dict.fromkeys(range(500, 901), 500)}


def test_tuples(spark):
    frame = spark.createDataFrame([(k, k % 4, k % 3) for k in range(40)] + [(99, 1, 77)], "ord bigint, document int, cluster int")
    for size in (2, 3):
        rows = vectors.cluster_tuples(frame, size, 10).collect()
        assert {r["cluster"] for r in rows} == {0, 1, 2} and len(rows) == 30
        for r in rows:
            assert r["members"] == sorted(set(r["members"])) and len(r["members"]) == size
            assert (r["documents"] > 1) == r["multi"]
    share = vectors.multi_document_share(vectors.cluster_tuples(frame.where("ord = 99"), 2)).first()
    assert share["tuples"] == 0 and share["share"] is None


def test_embedding_and_reductions(spark):
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(["a b c", "a b c", None, "x"])], "ord bigint, summary string")
    rows = {r["ord"]: np.array(r["embedding"]) for r in embedding.embed_texts(frame, embedding.offline_embedder(16)).collect()}
    assert np.allclose(rows[0], rows[1]) and abs(np.linalg.norm(rows[0]) - 1) < 1e-6 and not rows[2].any()
    own = spark.createDataFrame([(k, [float(k), 2.0]) for k in range(5)], "vec_id bigint, embedding array<float>")
    centred = {r["vec_id"]: r["embedding"] for r in embedding.centred(own).collect()}
    assert centred[0] == [-2.0, 0.0] and centred[4] == [2.0, 0.0]
    one = {r["vec_id"]: r["embedding"] for r in embedding.random_projection(own, 3, 1).collect()}
    two = {r["vec_id"]: r["embedding"] for r in embedding.random_projection(own.repartition(3), 3, 1).collect()}
    assert one == two and len(one[0]) == 3


def test_multi_vectors(spark):
    frame = spark.createDataFrame([(1, "a bb"), (2, None), (3, "ccc")], "ord int, query string")
    embedder = lambda texts: [np.array([[len(w), 1.0] for w in t.split()]) for t in texts]
    found = embedding.embed_multi_vectors(frame, embedder, batch=2)
    assert {r["ord"]: r["embedding"] for r in found.collect()} == {1: [[1.0, 1.0], [2.0, 1.0]], 2: [], 3: [[3.0, 1.0]]}
    pairs = found.alias("x").join(found.alias("y"), F.col("x.ord") < F.col("y.ord")).select(F.col("x.ord").alias("a"), F.col("y.ord").alias("b"), embedding.late_interaction(F.col("x.embedding"), F.col("y.embedding")).alias("s"))
    assert {(r["a"], r["b"]): r["s"] for r in pairs.collect()} == {(1, 3): 11.0, (1, 2): None, (2, 3): 0.0}
