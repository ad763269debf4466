"""Hard-negative mining against all pairs, and what the tree may skip."""

from __future__ import annotations

import math

import numpy as np
import pytest

from playlens.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, score long, block int, h string, cell int"


def sound(rows):
    good = {
        (i, tuple(math.floor(256 * float(np.float32(x))) for x in v), y) for i, v, y in rows
        if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    }
    return sorted(good)


def brute(rows, every=100, positives=5, negatives=10, low=30, high=90):
    rows, out = sound(rows), []
    for i, v, y in rows:
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, z == y) for j, w, z in rows if j != i)
        for p, j, _ in [x for x in scored if x[2]][:positives]:
            hard = [(s, m) for s, m, same in scored if not same and -low * p <= -100 * s <= -high * p]
            out += [(i, j, r, m, -p, -s) for r, (s, m) in enumerate(hard[:negatives], 1)]
    return sorted(out)


def found(spark, rows, **settings):
    df = spark.createDataFrame([(i, v, y, 1, 2, "x", 3) for i, v, y in rows], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in hn.mine(df, **settings).collect())


@pytest.fixture(scope="module")
def vectors():
    draw = np.random.default_rng(2)
    middles = draw.normal(0, 0.4, (6, 8))
    rows = [(i, (middles[i % 6] + draw.normal(0, 0.1, 8)).astype(np.float32).tolist(), int(draw.integers(0, 4))) for i in range(900)]
    rows += [(i, rows[3][1], i % 3) for i in range(1000, 1120)]  # one very common vector
    rows += [(1200, None, 1), (1300, [1.0, None], 1), (1400, [float("nan")] * 8, 1), (1500, [float("inf")] * 8, 1), (None, rows[0][1], 1)]
    rows += [(1600, rows[5][1], None), (1700, [], 1), (1800, [0.5], 2), (1900, [0.0] * 8, 3), (-100, rows[6][1], 2), (-101, rows[7][1], 2)]
    rows += [rows[12]] * 3 + [(100, rows[100][1], rows[100][2])]  # the same row again
    return rows


def test_brute_force(spark, vectors):
    assert found(spark, vectors) == brute(vectors)


def test_many_cells_blocks_and_chunks(spark, vectors):
    assert found(spark, vectors, block_rows=60, chunk_anchors=3, every=50) == brute(vectors, every=50)


def test_other_windows(spark, vectors):
    given = {"every": 300, "positives": 2, "negatives": 30, "low": 80, "high": 110}
    assert found(spark, vectors, block_rows=200, **given) == brute(vectors, **given)


def test_rows_sharing_an_id(spark):
    draw = np.random.default_rng(3)
    rows = [(i % 40 * 10, draw.normal(0, 0.3, 4).astype(np.float32).tolist(), int(i % 2)) for i in range(80)]
    assert found(spark, rows) == brute(rows)


def test_wide_values(spark):
    draw = np.random.default_rng(4)
    rows = [(i, draw.normal(0, 1, 3).astype(np.float32).tolist(), i % 2) for i in range(60)]
    rows += [(200, [1e9, 1.0, 0.0], 0), (201, [3e4, 0.0, 1.0], 1), (300, [1e6, -1e6, 2.0], 1)]
    assert found(spark, rows) == brute(rows)
    with pytest.raises(Exception, match="does not fit a long"):
        found(spark, [(0, [1e30], 0), (1, [1e30], 0), (2, [1e30], 1)])


def test_few_rows(spark):
    assert found(spark, []) == []
    assert found(spark, [(0, [1.0], 1)]) == []
    assert found(spark, [(0, [1.0], 1), (1, [1.0], 1)]) == []
    assert found(spark, [(0, [1.0], 1), (1, [1.0], 1), (2, [0.5], 2)]) == [(0, 1, 1, 2, 65536, 32768)]
    assert found(spark, [(0, [1.0], 1), (1, [-1.0], 1), (2, [-0.5], 2)]) == []


def test_tree_covers_and_separates():
    draw = np.random.default_rng(5)
    values = np.floor(draw.normal(0, 60, (700, 5)))
    tree = hn.grow(values, fan=8, leaf=10)
    assert sorted(tree.rows.tolist()) == list(range(700))
    lengths = (values**2).sum(axis=1)
    points = np.column_stack([values, np.sqrt(tree.norm2 - lengths)])
    for i in range(len(tree.radius)):
        own = points[tree.rows[tree.first[i] : tree.last[i]]]
        centre = np.append(tree.centre[i], np.sqrt(max(tree.norm2 - (tree.centre[i] ** 2).sum(), 0)))
        assert np.linalg.norm(own - centre, axis=1).max() <= tree.radius[i] + 1e-6
        kids = range(tree.child[i], tree.child[i] + tree.children[i])
        assert sum(tree.last[c] - tree.first[c] for c in kids) == (len(own) if tree.children[i] else 0)
        if tree.children[i]:
            heads = np.stack([tree.centre[c] for c in kids])
            assert (heads[0] == tree.centre[i]).all()  # the first centre stays


def test_descent_skips_clusters(monkeypatch):
    draw = np.random.default_rng(6)
    middles = draw.normal(0, 200, (40, 12))
    values = np.floor(np.concatenate([m + draw.normal(0, 6, (100, 12)) for m in middles]))
    tree = hn.grow(values)
    ordered, ids = values[tree.rows], tree.rows
    seen = []
    whole = hn.exact
    monkeypatch.setattr(hn, "exact", lambda v, q, peak: (seen.append(len(v)), whole(v, q, peak))[1])
    for q in values[::400]:
        scores = (values @ q).astype(int)
        best = sorted(zip((-scores).tolist(), range(len(values))))[:5]
        got = hn.best_in_windows(tree, ordered, ids, np.ones(len(ids), bool), q, [(None, None)], 5)
        assert got == [[(-s, i) for s, i in best]]
    assert sum(seen) < 0.4 * len(values) * 10
