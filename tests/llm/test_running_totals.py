from __future__ import annotations

import random

from playlens.llm.common import fresh, running_totals


def test_every_width_gives_the_running_sum(spark):
    draw = random.Random(3)
    keys = [draw.choice([draw.randrange(50), draw.randrange(2**20), draw.randrange(-(2**62), 2**62)]) for _ in range(300)]
    rows = [(k, draw.randrange(5), i) for i, k in enumerate([*keys, None, None, 7, 7])]
    df = spark.createDataFrame(rows, "id long, n long, tie long")
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
    expected, total = {}, 0
    for r in order:
        expected[r[2]] = total
        total += r[1]
    for widths in ((10, 18, 18), (2, 3), ()):
        found = running_totals(df, "id", ["n"], ["tie"], widths=widths).collect()
        assert {r.tie: r.before_n for r in found} == expected


def test_groups_with_null(spark):
    df = spark.createDataFrame([("a", 1, 5), (None, 1, 7), ("a", 3000, 1), (None, 9000, 2)], "g string, k long, n long")
    found = running_totals(df, "k", ["n"], [], by=["g"]).collect()
    assert {(r.g, r.k): r.before_n for r in found} == {("a", 1): 0, ("a", 3000): 5, (None, 1): 0, (None, 9000): 7}


def test_fresh_names():
    assert fresh(["A", "a_", "b"], "a", "c", "a") == ["a__", "c", "a___"]
