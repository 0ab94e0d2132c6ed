"""Hard negatives: against all scores."""

import math
import random

import numpy as np
import pytest

from cloakframe.llm import hard_negatives, queries

SF = "/root/testdata/sf0.001"
KINDS = "vec_id long, label int, embedding array<float>"


def brute(rows, is_anchor, scale=256):
    kept = []
    for id_, label, v in rows:
        if id_ is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((id_, label, [math.floor(scale * float(np.float32(x))) for x in v]))
    anchors = {}
    for id_, label, v in sorted(kept):
        if is_anchor(id_):
            anchors.setdefault(id_, (label, v))
    out = []
    for a, (label, v) in anchors.items():
        long = 2**63 - 1
        scored = sorted((-max(-long, min(long, sum(x * y for x, y in zip(v, w)))), i, lab) for i, lab, w in kept if len(w) == len(v))
        positives = [(i, -s) for s, i, lab in scored if lab == label and i != a][:5]
        for p, ps in positives:
            inside = [(i, -s) for s, i, lab in scored if lab != label and 80 * ps <= -100 * s <= 100 * ps][:5]
            out += [(a, p, k + 1, i, ps, s) for k, (i, s) in enumerate(inside)]
    return sorted(out)


def near(rng, width, centre, spread):
    return [float(np.float32(c + rng.gauss(0, spread))) for c in centre[:width]]


def made(seed, n, width, spread):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.3) for _ in range(width)] for _ in range(4)]
    rows = [(k, rng.randrange(3), near(rng, width, rng.choice(centres), spread)) for k in range(n)]
    common = near(rng, width, centres[0], spread)
    return rows + [(n + k, k % 2, common) for k in range(n // 3)]


@pytest.mark.parametrize("seed, n, width, spread, block, slot", [(1, 400, 64, 0.1, 50, 7), (2, 300, 13, 0.02, 1000, 1000), (3, 300, 1, 0.3, 64, 3), (4, 300, 40, 0.0, 100, 10), (5, 60, 2, 1.0, 5, 2)])
def test_the_best_rows_in_every_band(spark, seed, n, width, spread, block, slot):
    rows = made(seed, n, width, spread)
    df = spark.createDataFrame(rows, KINDS).repartition(3)
    got = hard_negatives.mine(df, lambda i: i % 10 == 0, block_rows=block, anchors_per_slot=slot)
    assert sorted(map(tuple, got.drop("positive_rank").collect())) == brute(rows, lambda i: i % 10 == 0)


@pytest.mark.parametrize("width", [1, 3, 16, 17, 64, 100])
def test_bounds_hold_on_every_level(width):
    rng = np.random.default_rng(width)
    v = np.floor(rng.normal(size=(80, width)) * 200)
    block = hard_negatives.Block(np.arange(80), np.zeros(80, int), v, *hard_negatives.summaries(v))
    exact, last = v @ v[0], np.full(80, np.inf)
    for level in range(len(block.levels)):
        low, high = hard_negatives.bounds(block, 0, block, np.arange(80), level)
        assert (low <= exact).all() and (exact <= high).all()
        assert (high - low <= last + 3).all()  # finer segments bound more closely
        last = high - low


def test_bounds_rule_out_most_rows_of_other_clusters():
    rng = np.random.default_rng(1)
    centres = np.repeat(rng.normal(size=(10, 8)) * 50, 8, axis=1)
    v = np.floor(np.concatenate([c + rng.normal(size=(100, 64)) * 5 for c in centres]))
    block = hard_negatives.Block(np.arange(1000), np.zeros(1000, int), v, *hard_negatives.summaries(v))
    seen = []
    exact = hard_negatives.scores
    hard_negatives.scores = lambda a, k, b, rows: seen.append(len(rows)) or exact(a, k, b, rows)
    try:
        rows, _ = hard_negatives.positives_of(block, 0, block, np.arange(1000), 5)
    finally:
        hard_negatives.scores = exact
    assert seen == [sum(seen)] and seen[0] < 200 and set(rows.tolist()) <= set(range(100))


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = made(9, 60, 8, 0.1) + [
        (None, 1, [1.0] * 8), (100, None, [1.0] * 8), (110, 1, None), (120, 1, [1.0, None] * 4), (130, 1, [nan] * 8), (140, 1, [inf] * 8), (150, 1, []), (151, 1, []), (152, 0, []),
        (160, 1, [0.0] * 8), (170, 2, [1.0] * 5), (171, 2, [1.0] * 5), (172, 0, [0.9] * 5), (0, 1, [0.5] * 8), (0, 1, [0.5] * 8), (180, 0, [-1.0] * 8),
        (190, 1, [3e7] * 3), (191, 1, [3e7] * 3), (192, 0, [2.9e7] * 3), (193, 0, [2.6e7, 3e7, 2.5e7]),
    ]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], f"{KINDS}, id string, score int")
    got = hard_negatives.mine(df, lambda i: i % 10 == 0, block_rows=20, anchors_per_slot=3)
    assert sorted(map(tuple, got.drop("positive_rank").collect())) == brute(rows, lambda i: i % 10 == 0)
    assert hard_negatives.mine(df.limit(0), lambda i: i % 10 == 0).count() == 0
    assert hard_negatives.mine(df, lambda i: i < 0).count() == 0


def test_the_query_on_all_rows(spark):
    rows = [(r.vec_id, (r.label + 1) % 10 if r.label is not None and r.vec_id % 7 == 0 else r.label, r.embedding) for r in queries.table(spark, SF, "embeddings").collect()]
    assert sorted(map(tuple, queries.op13_hard_negatives(spark, SF).collect())) == brute(rows, lambda i: i % 100 == 0)
