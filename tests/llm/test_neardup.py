from __future__ import annotations

from collections import Counter

import numpy as np

from pagewright.llm import neardup
from pagewright.llm.textkit import fold, words


def similarity(a, b):
    x, y = Counter(words(a)), Counter(words(b))
    common = sum((x & y).values())
    return common / (sum(x.values()) + sum(y.values()) - common)


def test_words():
    assert fold("Straße ÉTÉ") == "strasse ete"
    assert words("l'eau_2, café!") == ["l", "eau", "2", "cafe"] and words(None) == []


def test_collisions_have_the_rate_of_the_similarity():
    rng = np.random.default_rng(2)
    same = total = 0
    for n in range(60):
        pool = rng.integers(1, 2**63, 30).astype(np.uint64)
        left, right = pool[:20], pool[5:25]
        sign = neardup.dart_signatures(np.concatenate([left, right]), np.ones(40), np.repeat([0, 1], 20), 2, 32)
        same += (sign[0] == sign[1]).sum()
        total += 32
    assert abs(same / total - 15 / 25) < 0.05


def test_weights_count():
    rng = np.random.default_rng(4)
    same = 0
    for n in range(80):
        pool = rng.integers(1, 2**63, 10).astype(np.uint64)
        sign = neardup.dart_signatures(np.concatenate([pool, pool]), np.concatenate([np.full(10, 2.5), np.full(10, 1.0)]), np.repeat([0, 1], 10), 2, 16)
        same += (sign[0] == sign[1]).sum()
    assert abs(same / (80 * 16) - 1 / 2.5) < 0.06
    assert (neardup.dart_signatures(np.zeros(0, np.uint64), np.zeros(0), np.zeros(0, np.int64), 2, 4) == 0).all()


def test_pairs_against_brute_force(spark):
    rng = np.random.default_rng(7)
    vocabulary = [f"w{k}" for k in range(60)]
    texts = []
    for _ in range(40):
        base = list(rng.choice(vocabulary, rng.integers(1, 120)))
        texts.append(" ".join(base))
        for _ in range(4):
            own = [w for w in base if rng.random() > 0.06]
            own += list(rng.choice(vocabulary, rng.integers(0, max(1, len(base) // 12) + 1)))
            rng.shuffle(own)
            texts.append(" ".join(own).upper())
    rows = [(k, t, "x") for k, t in enumerate(texts)] + [(900, None, "x"), (901, " ", "x"), (902, "?!", "x"), (0, texts[0], "y"), (903, texts[0], "z"), (904, "w1 " * 3_000, "x"), (905, "w1 " * 2_999, "x")]
    frame = spark.createDataFrame(rows, "query_id bigint, query string, tokens string")
    got = {tuple(r) for r in neardup.near_duplicate_pairs(frame, "query_id", "query").collect()}
    own = {k: t for k, t, _ in rows if words(t)}
    keys = sorted(own)
    truth = {(a, b) for i, a in enumerate(keys) for b in keys[i + 1 :] if similarity(own[a], own[b]) >= 0.8 - 1e-12}
    assert got == truth and len(truth) > 60
    links, members = neardup.near_duplicate_links(frame, "query_id", "query")
    classes = {r["query_id"]: r["class_id"] for r in members.collect()}
    assert classes[903] == 0 and set(classes) == set(keys)
    assert all(r["a"] < r["b"] and r["common"] / r["total"] >= 0.8 for r in links.collect())
    assert neardup.near_duplicate_pairs(frame.where("false"), "query_id", "query").count() == 0


def test_a_hot_group_of_copies_stays_a_class(spark):
    frame = spark.range(3_000).selectExpr("id as query_id", "'the same text again and again' as query")
    links, members = neardup.near_duplicate_links(frame, "query_id", "query")
    assert links.count() == 0 and members.select("class_id").distinct().count() == 1
