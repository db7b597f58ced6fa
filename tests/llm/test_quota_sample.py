from __future__ import annotations

import numpy as np
import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st

from pagewright.llm.quota_sample import calibrate, pivotal, quota_sample, tilt


@given(st.lists(st.floats(0.01, 0.99), min_size=1, max_size=30), st.integers(0, 2**31))
@settings(max_examples=150, deadline=None)
def test_pivotal_keeps_the_sum(chances, seed):
    chances = np.array(chances)
    out = pivotal(chances, np.random.default_rng(seed).random(len(chances)))
    assert out.sum() == pytest.approx(chances.sum()) and ((out > 0) & (out < 1)).sum() <= 1


def test_pivotal_keeps_the_probabilities():
    chances = np.array([0.2, 0.5, 0.7, 0.6])
    rng = np.random.default_rng(3)
    runs = np.array([pivotal(chances, rng.random(4)) for _ in range(4_000)])
    assert np.abs(runs.mean(0) - chances).max() < 0.03


def test_tilting_meets_marginal_moments():
    counts = np.array([100.0, 300.0, 50.0, 80.0])
    design = np.array([[1, 0, 1], [1, 0, 0], [0, 1, 1], [0, 1, 0]], float)
    goal = design.T @ (counts * np.array([0.2, 0.1, 0.3, 0.15]))
    found = tilt(counts, goal, design)
    assert np.allclose(design.T @ (counts * found), goal)
    assert np.allclose(tilt(counts, np.array([10.0, 30.0, 5.0, 8.0])), 0.1)
    square = np.array([[1, 0, 0, 1], [0, 1, 0, 1], [0, 0, 1, 1], [1, 1, 1, 1]], float)  # as many moments as categories
    goal = square.T @ (counts * np.array([0.2, 0.1, 0.3, 0.15]))
    assert np.allclose(square.T @ (counts * tilt(counts, goal, square, np.full(4, 0.15))), goal)


def test_floors_and_gaps():
    plan = calibrate(np.array([1_000, 5, 400, 0]), np.array([500, 300, 150, 50]), np.array([10, 10, 60, 10]), 100)
    drawn = plan.probability * np.array([1_000, 5, 400, 0])
    assert drawn[1] == 5 and drawn[2] == pytest.approx(60) and drawn[3] == 0 and drawn.sum() == pytest.approx(100)
    assert plan.required.tolist() == [50, 30, 60, 10]


def test_what_falls_short_goes_to_the_same_type_or_format():
    available = np.array([1_000, 1_000, 10, 1_000, 1_000, 1_000])
    kinds, shapes = list("aaabbb"), list("xyzxyz")
    plan = calibrate(available, [200, 150, 150, 150, 150, 200], [0] * 6, 400, kinds, shapes)
    expected = plan.probability * available
    shares = np.array([80, 60, 60, 60, 60, 80])
    assert expected[2] == 10 and plan.unmet.tolist() == [0, 0, 50, 0, 0, 0] and expected.sum() == pytest.approx(400)
    own = np.arange(6) != 2
    assert (expected[own] >= shares[own] - 1e-6).all()  # no share is cut
    more = expected - shares
    assert more[0] > more[3] and more[1] > more[4] and more[5] > more[3]
    assert calibrate([1_000] * 6, [200, 150, 150, 150, 150, 200], [0] * 6, 400, kinds, shapes).probability == pytest.approx(shares / 1_000)


@example([(5, 1, 1, 0, 1), (5, 49, 0, 0, 0), (38, 0, 38, 0, 0), (39, 0, 39, 0, 0)], 82)
@given(st.lists(st.tuples(st.integers(0, 300), st.integers(0, 200), st.integers(0, 40), st.integers(0, 2), st.integers(0, 2)), min_size=1, max_size=9), st.integers(0, 400))
@settings(max_examples=300, deadline=None)
def test_plans_keep_size_bounds_and_floors(cells, size):
    available, permille, floors, kinds, shapes = (list(x) for x in zip(*cells))
    plan = calibrate(available, permille, floors, size, kinds, shapes)
    expected = plan.probability * np.array(available)
    assert (plan.probability >= 0).all() and (plan.probability <= 1).all()
    assert (expected >= np.minimum(floors, available) - 1e-6).all()
    assert plan.unmet == pytest.approx([max(0, r - a) for a, r in zip(available, plan.required)])
    least = np.minimum(floors, available).sum()
    assert expected.sum() <= max(size, least) + 1e-6
    if size >= least and all(p for p in permille):
        assert expected.sum() == pytest.approx(min(size, sum(available)))


def test_tables(spark):
    targets = spark.createDataFrame([("open-ended", "question", 700, 2), ("multi-hop", "keyword", 300, 3)], "query_type string, query_format string, target_permille int, min_rows int")
    rows = [(k, f"q{k}", ["Open Ended", " open_ended ", "OPEN-ENDED"][k % 3], "Question ", "c") for k in range(90)]
    rows += [(100 + k, "q", "multi hop", "keyword", "c") for k in range(4)] + [(200, None, "multi-hop", "keyword", "c"), (201, "  ", "multi-hop", "keyword", "c")]
    rows += [(300 + k, "q", None, "keyword", "c") for k in range(6)] + [(0, "q0", "Open Ended", "Question ", "other")]
    frame = spark.createDataFrame(rows, "qtj_id bigint, query string, supposed_query_type string, supposed_query_format string, cell string")
    sample, report = quota_sample(frame, targets)
    got = {r["query_type"]: r for r in report.collect()}
    assert got["open-ended"]["available"] == 90 and got["open-ended"]["required"] == 14 and got["open-ended"]["drawn"] == 16
    assert got["multi-hop"]["available"] == 4 and got["multi-hop"]["required"] == 6 and got["multi-hop"]["unmet"] == 2 and got["multi-hop"]["gap"] == 2 and got["multi-hop"]["drawn"] == 4
    ids = [r["qtj_id"] for r in sample.collect()]
    assert len(ids) == len(set(ids)) == 20
    again, _ = quota_sample(frame.repartition(5), targets)
    assert sorted(ids) == sorted(r["qtj_id"] for r in again.collect())
    empty, report = quota_sample(frame.where("false"), targets)
    assert empty.count() == 0 and {r["gap"] for r in report.collect()} == {2, 3}
    assert quota_sample(frame, targets.where("false"))[1].count() == 0


def test_draws_in_many_blocks(spark):
    from pagewright.llm.quota_sample import draw

    frame = spark.range(5_000).selectExpr("id", "cast(id % 2 as int) as cell", "case when id % 2 = 0 then 0.1 else 0.33 end as chance")
    rows = draw(frame, 1, 2_500, block=50).collect()
    counts = [sum(r["cell"] == c for r in rows) for c in (0, 1)]
    assert abs(counts[0] - 250) <= 1 and abs(counts[1] - 825) <= 1 and abs(sum(counts) - 1_075) <= 1
