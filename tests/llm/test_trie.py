"""The conversation trie against a plain one, with components split by Spark jobs and in tasks."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from playlens.llm import trie

TURNS = "conv_id long, turn long, role string, text string"
#: Its first turn would come from a conversation that is not there.
TURNLESS = next(c for c in range(501, 600) if zlib.crc32(str(c).encode()) % 6)
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [(r, t) for _, r, t in sorted(x)] for c, x in own.items()}
    members, ends = {}, {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        whole = tuple(own.get(base, [])[:h] + turns[h:])
        for d in range(len(whole) + 1):
            members.setdefault(whole[:d], []).append(c)
        ends.setdefault(whole, []).append(c)
    children, leaves, saved = {}, {}, {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] = leaves.get(p[:d], 0) + (p not in children)
            saved[p[:d]] = saved.get(p[:d], 0) + ((len(m) - 1) * len(p[-1][1]) if p else 0)
    return sorted(
        (
            min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children.get(p, [])), leaves[p], saved[p],
            hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest(),
        )
        for p, m in members.items()
    )


def order(rows):
    return sorted(rows, key=lambda r: (r[0], r[1]))


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(5)
    out = []
    for c in [*range(-3, 230), 300, 305, 999, 12_345, 12_300]:
        for t in range(draw.randrange(1, 7)):
            out.append((c, t, draw.choice(["user", "assistant"]), draw.choice(["a", "bb", "", "é😀"])))
    out += [(c, t, "user", "same") for c in range(400, 460) for t in range(9)]  # one very common conversation
    out += [(205, 1, "user", "again")] * 3 + [(207, None, None, None), (207, None, "x", None), (None, 0, "user", "no id")]
    out += [(TURNLESS, 0, "user", "short"), (600, 0, "user", "short")]
    out += [(700, t, "user", f"line {t % 7}") for t in range(2500)]  # a long chain
    out += [(701, t, "user", f"line {t % 7}") for t in range(1800)] + [(702, t, "user", f"line {t % 7}") for t in range(2200)]
    return out


@pytest.fixture(scope="module")
def expected(rows):
    short = [r for r in rows if r[0] not in (700, 701, 702)]
    return brute(short)


def found(spark, rows, local_nodes=trie.LOCAL_NODES):
    df = spark.createDataFrame(rows, TURNS).selectExpr("*", "'x' AS depth", "1 AS ka", "2 AS pos", "3 AS h").repartition(3)
    made = trie.trie(*trie.rebuilt(df), local_nodes=local_nodes)
    assert made.columns == list(COLUMNS)
    return order(tuple(r) for r in made.collect())


@pytest.mark.parametrize("local_nodes", [trie.LOCAL_NODES, 150])
def test_brute_force(spark, rows, expected, local_nodes):
    short = [r for r in rows if r[0] not in (700, 701, 702)]
    assert found(spark, short, local_nodes) == order(expected)


@pytest.mark.parametrize("local_nodes", [trie.LOCAL_NODES, 700])
def test_long_chains(spark, rows, local_nodes):
    long = [r for r in rows if r[0] in (700, 701, 702, TURNLESS)]  # what they take from 700 is what they have
    got = found(spark, long, local_nodes)
    root = got[[r[1] for r in got].index(0)]
    assert len(got) == 1 + 2500 and max(r[1] for r in got) == 2500
    assert root[3] == 4 and root[5] == 1
    saved = sum(len(f"line {t % 7}") for t in range(1800)) + sum(len(f"line {t % 7}") for t in range(2200))
    assert root[6] == saved
    by_depth = {r[1]: r for r in got}
    assert by_depth[2200][3] == 2 and by_depth[2201][3] == 1 and by_depth[1900][6] == sum(len(f"line {t % 7}") for t in range(1899, 2200))


def test_empty(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, 0, "user", "x")]) == []


def test_only_turnless(spark):
    rows = [(TURNLESS, 0, "user", "short")]
    assert found(spark, rows) == order(brute(rows)) and len(brute(rows)) == 1


@pytest.mark.parametrize("seed", range(5))
def test_centroids_sum_subtrees(seed):
    draw = random.Random(seed)
    n = 200
    reach = [1, 3, 50, 200, 10][seed]
    parent = [-1] + [draw.randrange(max(0, i - reach), i) for i in range(1, n)]
    parent[n // 2] = -1
    weights = np.array([[draw.randrange(100), 1] for _ in range(n)])
    expected = weights.copy()
    for v in reversed(range(n)):
        if parent[v] >= 0:
            expected[parent[v]] += expected[v]
    assert (trie.decomposed(parent, weights) == expected).all()


def test_node_that_ends_many(spark):
    """A node's ids are hashed over several pieces."""
    rows = [(c, t, "user", "x") for c in range(0, 9000) for t in range(6)]
    got = found(spark, rows)
    assert got == order(brute(rows))
