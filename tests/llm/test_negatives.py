from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from offerlift.llm import negatives, vectors
from test_topk import whole


def brute(rows, every, scale=256):
    made = [(i, whole(v, scale), label) for i, v, label in rows if i is not None]
    made = [r for r in made if r[1] is not None and r[2] is not None]
    anchors = {}
    for i, v, label in made:
        if i % every == 0:
            anchors[i] = min(anchors.get(i, (v, label)), (v, label))
    out = []
    for a, (v, label) in anchors.items():
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, m) for i, w, m in made if i != a)
        for score, p, _ in [s for s in scored if s[2] == label][:5]:
            far = [s for s in scored if s[2] != label and 80 * -score <= 100 * -s[0] <= 100 * -score]
            out += [(a, p, r + 1, i, -score, -s) for r, (s, i, _) in enumerate(far[:5])]
    return sorted(out)


def table():
    rng = random.Random(12)
    centre = [[rng.gauss(0, 1) for _ in range(21)] for _ in range(4)]
    rows = []
    for i in range(400):
        c = rng.randrange(4)
        v = [x + rng.gauss(0, 0.4) for x in centre[c]]
        rows.append((i, v, c if rng.random() < 0.7 else rng.randrange(4)))
    rows += [(i, [0.5] * 21, i % 3) for i in range(1000, 1040)]
    rows += [(None, [1.0] * 21, 1), (501, None, 1), (502, [None] * 21, 1), (503, [math.nan] * 21, 1)]
    rows += [(504, [math.inf] * 21, 1), (505, [], 1), (506, [2.0, 3.0], 1), (507, [1.0] * 21, None)]
    rows += [(510, [0.1] * 21, None), (-10, [0.25] * 21, 1), (520, [0.0] * 21, 2)]
    return rows + [rows[7], rows[20], (20, [9.0] * 21, 1)]


@pytest.mark.parametrize("block", [vectors.BLOCK, 7])
def test_equals_brute_force(spark, block):
    rows = table()
    frame = spark.createDataFrame(
        [(*r, 1, "x") for r in rows],
        "vec_id long, embedding array<double>, label int, score int, sums string",
    )
    got = negatives.hard_negatives(frame, F.col("label"), every=10, block=block)
    assert sorted(map(tuple, got.collect())) == brute(rows, 10)


def test_summaries_bound_every_product(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(-300, 300, (60, 21)).astype(float)
    frame = spark.createDataFrame([(v,) for v in x.astype(int).tolist()], "v array<long>")
    made = frame.select(*[c.alias(n) for c, n in zip(negatives.summaries(F.col("v"), 21), "ab")])
    sums, squares = (np.array(c) for c in zip(*made.collect()))
    ends = negatives.segment_ends(21)
    exact, before = x @ x.T, np.inf
    for joined in negatives.LEVELS:
        mean, spread = negatives._factors(sums, squares, ends, joined)
        middle, reach = mean @ mean.T, spread @ spread.T + 1e-6
        assert (middle - reach <= exact).all() and (exact <= middle + reach).all()
        assert reach.mean() < before
        before = reach.mean()


def test_bounds_leave_pairs_unscored(spark):
    """Vectors far apart in their means are never scored exactly."""
    rng = random.Random(4)
    rows = []
    for i in range(4000):
        sign = 1 if i % 10 == 0 else -1
        rows.append((i, [sign * (1 + rng.random() / 10) for _ in range(32)], i % 2))
    frame = spark.createDataFrame(rows, "key long, embedding array<double>, label int")
    made = vectors.whole_vectors(frame, "key", "embedding", 256, {"label": F.col("label").cast("long")})
    made = made.select("*", *[c.alias(n) for c, n in zip(negatives.summaries(F.col("v"), 32), "ab")])
    asked = made.where("key = 0").first()
    wanted = negatives.Wanted(
        keys=np.array([0]),
        labels=np.array([0]),
        vectors=np.array([asked["v"]], float),
        sums=np.array([asked["a"]]),
        squares=np.array([asked["b"]]),
        bound=1e7,
        same_label=True,
        low=np.array([[1]]),
        high=np.array([[1 << 60]]),
        most=5,
    )
    assert made.count() == 4000
    pairs = negatives._best(made.repartition(1), wanted).first()["pairs"]
    assert pairs <= 400


def test_no_anchor_and_empty_table(spark):
    kinds = "vec_id long, embedding array<float>, label int"
    empty = spark.createDataFrame([], kinds)
    got = negatives.hard_negatives(empty, F.col("label"))
    assert got.columns[:4] == ["anchor_id", "positive_id", "rank", "negative_id"]
    assert got.count() == 0
    frame = spark.createDataFrame([(1, [1.0], 1), (2, [2.0], 2)], kinds)
    assert negatives.hard_negatives(frame, F.col("label")).count() == 0
