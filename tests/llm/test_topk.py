from __future__ import annotations

import math
import random

import pytest

from offerlift.llm import topk, vectors


def whole(v, scale):
    if v is None or any(x is None or not math.isfinite(x) for x in v):
        return None
    return [math.floor(scale * x) for x in v]


def brute(rows, k, scale, every):
    made = [(i, whole(v, scale)) for i, v in rows if i is not None]
    made = [(i, v) for i, v in made if v is not None]
    asked = {}
    for i, v in made:
        if i % every == 0:
            asked[i] = min(asked.get(i, v), v)
    out = []
    for q, v in asked.items():
        scored = [(-sum(x * y for x, y in zip(v, w)), i) for i, w in made if i != q]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def table():
    rng = random.Random(13)
    rows = [(i, [rng.gauss(0, 1) for _ in range(9)]) for i in range(300)]
    rows += [(i, [0.5] * 9) for i in range(1000, 1060)]  # many equal scores
    rows += [(None, [1.0] * 9), (401, None), (402, [None] * 9), (403, [math.nan] * 9)]
    rows += [(404, [math.inf] * 9), (405, []), (406, [2.0, 3.0]), (-10, [0.25] * 9)]
    rows += [rows[7], rows[20], (20, [9.0] * 9), (30, [-9.0] * 9)]
    return rows


@pytest.mark.parametrize("block", [vectors.BLOCK, 7])
@pytest.mark.parametrize("k", [1, 10, 1000])
def test_equals_brute_force(spark, k, block):
    rows = table()
    frame = spark.createDataFrame(
        [(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, score int, v string"
    )
    got = topk.top_k(frame, k, scale=16, every=10, block=block).collect()
    assert sorted(map(tuple, got)) == brute(rows, k, 16, 10)


def test_large_numbers_stay_exact(spark):
    rng = random.Random(5)
    rows = [(i, [float(rng.randrange(-(1 << 29), 1 << 29)) for _ in range(4)]) for i in range(60)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_k(frame, 5, scale=1, every=10).collect()
    assert sorted(map(tuple, got)) == brute(rows, 5, 1, 10)
    with pytest.raises(ValueError, match="do not fit"):
        topk.top_k(frame, 5, scale=1 << 20, every=10)


def test_few_rows_are_selected_where_all_scores_are_equal(spark):
    frame = spark.range(5000).selectExpr("id as vec_id", "array(1D, 2D) as embedding")
    got = topk.top_k(frame, 10, every=1000)
    want = [(q, r) for q in range(0, 5000, 1000) for r in [i for i in range(11) if i != q][:10]]
    assert sorted((r["query_id"], r["vec_id"]) for r in got.collect()) == sorted(want)


def test_no_query_and_empty_table(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(empty).columns == ["query_id", "rank", "vec_id", "score"]
    assert topk.top_k(empty).count() == 0
    frame = spark.createDataFrame([(1, [1.0]), (2, [2.0])], "vec_id long, embedding array<double>")
    assert topk.top_k(frame).count() == 0
