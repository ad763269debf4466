from __future__ import annotations

import math

import numpy as np
import pytest

from playlens.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, score long, block int"


def brute(rows, k, every):
    sound = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in {i for i, _ in sound if i % every == 0}:
        for own in {tuple(v) for i, v in sound if i == q}:
            scored = sorted(((-sum(a * b for a, b in zip(own, v)), i) for i, v in sound if i != q))
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def found(spark, rows, **settings):
    df = spark.createDataFrame([(i, v, 0, 1, 2) for i, v in rows], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in topk.top_k(df, **settings).collect())


@pytest.fixture(scope="module")
def vectors():
    draw = np.random.default_rng(1)
    rows = [(i, draw.normal(0, 0.2, 9).astype(np.float32).tolist()) for i in range(200)]
    rows += [(i, rows[3][1]) for i in range(300, 340)]  # ties
    rows += [(400, None), (401, [1.0, None]), (402, [float("nan")] * 9), (403, [float("inf")] * 9), (None, rows[0][1]), (405, []), (420, [0.5])]
    return rows


def test_brute_force(spark, vectors):
    assert found(spark, vectors, k=5, every=20) == brute(vectors, 5, 20)


def test_small_blocks_and_chunks(spark, vectors):
    assert found(spark, vectors, k=20, every=20, block_rows=30, chunk_queries=4) == brute(vectors, 20, 20)


def test_repeated_rows_take_ranks(spark, vectors):
    rows = [*vectors, *[vectors[7]] * 4, *[vectors[20]] * 2]
    assert found(spark, rows, k=6, every=20) == brute(rows, 6, 20)


def test_fewer_candidates_and_none(spark):
    rows = [(0, [1.0, 2.0]), (1, [0.5, -3.0])]
    assert found(spark, rows, k=20, every=20) == [(0, 1, 1, 64 * 32 - 128 * 192)]
    assert found(spark, rows[:1], k=20, every=20) == []
    df = spark.createDataFrame([], SCHEMA)
    assert topk.top_k(df, 5, 20).count() == 0


@pytest.mark.parametrize("scale", [1, 1000])
def test_slices_add_up(scale):
    draw = np.random.default_rng(scale)
    values = draw.integers(-3 * scale, 5 * scale, (130, 6))
    index, least = topk.slices_of(values)
    weights = draw.integers(-40, 40, 6)
    slices = topk.score_slices(index, weights)
    got = sum((np.unpackbits(s.view(np.uint8), bitorder="little")[:130].astype(int) << w) for w, s in enumerate(slices))
    exact = values @ weights
    assert (got - exact == (got - exact)[0]).all()
    for k in (1, 7, 129, 130, 500):
        best = topk.top(slices, topk.bitmap(np.ones((1, 130), np.uint8))[0], 130, k)
        assert sorted(best) == sorted(sorted(range(130), key=lambda i: (-exact[i], i))[:k])


def test_wide_components(spark, vectors):
    rows = [*vectors, (1000, [1e9, 1.0], ), (1001, [-3e8, 0.5]), (1020, [1e9, -1e9, 2.0])]
    small = [r for r in rows if r[0] is not None and (r[0] < 40 or r[0] >= 1000)]
    narrow = [(i, v) for i, v in small if i != 1020]
    assert found(spark, narrow, k=5, every=20) == brute(narrow, 5, 20)
    with pytest.raises(Exception, match="does not fit a long"):
        found(spark, small, k=5, every=20)
    far = [(0, [0.5, 0.5]), (20, [1e9, -1e9]), (21, [1.0, 2.0]), (22, [3.0, -2.0])]
    assert found(spark, far, k=2, every=20) == brute(far, 2, 20)
