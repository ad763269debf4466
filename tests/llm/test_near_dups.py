"""Shingles, fingerprints and near-duplicate classes against brute force."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from brute import jaccard, near_classes, shingle_set

from playlens.llm import fingerprints, near_dups, shingles

WORDS = [f"w{i}" for i in range(400)]


def text(draw, n):
    return " ".join(draw.choices(WORDS, k=n))


def edit(draw, words, share):
    return [draw.choice(WORDS) if draw.random() < share else w for w in words]


@pytest.fixture(scope="module")
def copies():
    """A base with many near copies that are often less than 0.8 from each other, chains, exact
    copies, short and long texts."""
    draw = random.Random(7)
    rows, base = [], text(draw, 300).split()
    rows += [" ".join(edit(draw, base, 0.012)) for _ in range(60)] + [" ".join(base)]
    chain = text(draw, 200).split()
    for i in range(12):
        chain[i * 15 : i * 15 + 5] = text(draw, 5).split()
        rows.append(" ".join(chain))
    cut = text(draw, 260).split()  # parts of one text: links of which neither shares what the whole lacks
    rows += [" ".join(cut[:n]) for n in range(100, 261, 8)] + [" ".join(cut[n:]) for n in range(8, 150, 8)]
    family = [" ".join(edit(draw, edit(draw, base, 0.03), 0.008)) for _ in range(3)]
    rows += [" ".join(edit(draw, f.split(), 0.02)) for f in family for _ in range(20)] + family
    rows += [text(draw, draw.randrange(1, 80)) for _ in range(60)] + [rows[0]] * 20 + ["", "", " \n", "one", "one", "two three", None, None]
    rows += ["stop " * 5000, "stop " * 4000, text(draw, 30_000)]
    draw.shuffle(rows)
    return [(i, t) for i, t in enumerate(rows)]


def test_shingles_are_five_words_whatever_the_step(monkeypatch):
    draw = random.Random(1)
    texts = ["", "a b", "a  b", " \n a b c d e f\n g h", "x", None, "été b c d e", "  ", *[text(draw, draw.randrange(60)) for _ in range(80)], "y" * 900]
    hashes, counts = shingles.shingles(pa.array(texts))
    expected = [shingle_set(t) for t in texts]
    assert [len(set(hashes[a:b].tolist())) for a, b in zip(np.cumsum(counts) - counts, np.cumsum(counts))] == [len(s) for s in expected]
    assert len(set(hashes.tolist())) == len(set().union(*expected))
    for step in (1, 7, 300):
        monkeypatch.setattr(shingles, "STEP_BYTES", step)
        again, same = shingles.shingles(pa.array(texts))
        assert (again == hashes).all() and (same == counts).all()
    sliced, _ = shingles.shingles(pa.array(texts)[3:9])
    assert (sliced == hashes[counts[:3].sum() : counts[:9].sum()]).all()


def test_signatures_estimate_the_probability_jaccard():
    draw = np.random.default_rng(5)
    elements = draw.integers(1, 2**48, 300).astype(np.uint64)
    x, y = draw.choice([0, 1, 2, 5], 300), draw.choice([0, 1, 3], 300)
    exact = sum(1 / np.maximum(x / a, y / b).sum() for a, b in zip(x, y) if a and b)
    parts = [(np.full((v > 0).sum(), i), elements[v > 0], v[v > 0]) for i, v in enumerate((x, y))]
    kept = near_dups.signatures(*[np.concatenate(p) for p in zip(*parts)], 2, 4096)
    assert abs((kept[0] == kept[1]).mean() - exact) < 0.03
    scaled = near_dups.signatures(parts[0][0], elements[x > 0], 7 * x[x > 0], 1, 4096)
    assert (scaled[0] == kept[0]).all()  # only the proportions of the weights count
    assert near_dups.signatures(np.empty(0, int), np.empty(0, np.uint64), np.empty(0), 2, 8).any() == False  # noqa: E712


def test_classes_match_all_pairs(documents, copies):
    found = near_dups.classes(documents(copies)).collect()
    expected = near_classes(copies)
    assert {r.doc_id: r.class_id for r in found} == expected
    sizes = {c: sum(v == c for v in expected.values()) for c in expected.values()}
    assert all(r.class_size == sizes[r.class_id] for r in found)


def test_one_of_each_class_stays(documents, copies):
    repeated = [*copies, copies[3], copies[3], (None, "no id"), (None, "no id"), (None, "other")]
    df = documents(repeated)
    stay = near_dups.one_of_each(df)
    assert stay.columns == df.columns
    expected = near_classes(copies)
    rows = stay.collect()
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == sorted(set(expected.values()))
    assert sorted(r.text for r in rows if r.doc_id is None) == ["no id", "other"]
    assert {(r.doc_id, r.text) for r in rows} <= set(repeated)


def test_empty_table(documents):
    none = documents([(1, "x")]).limit(0)
    assert near_dups.classes(none).count() == near_dups.one_of_each(none).count() == fingerprints.near_edits(none).count() == 0


def test_nulls_alone(documents):
    assert {(r.doc_id, r.class_id) for r in near_dups.classes(documents([(1, None), (2, None)])).collect()} == {(1, 1), (2, 2)}


@pytest.mark.parametrize("links", [[(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)], [(5, 3), (9, 8), (3, 8), (1, 2)]])
def test_components(spark, links):
    name = lambda i: bytes([i])
    df = spark.createDataFrame([(name(max(p)), name(min(p))) for p in links], "pivot binary, node binary")
    found = {bytes(r.node)[0]: bytes(r.label)[0] for r in near_dups.components(df).collect()}
    parent = {i: i for p in links for i in p}
    for _ in links:
        for a, b in links:
            parent[a] = parent[b] = min(parent[a], parent[b])
    assert found == parent


@pytest.mark.parametrize("length", [1, 5, 9])
def test_pairs_stay_together_where_groups_merge_in_a_chain(spark, length):
    # weights rise along the chain, so every pivot but the last is in a heavier pivot's group; only the first two are a link
    names = [bytes([i]) for i in range(length + 1)]
    rows = [(i, names[k], 1 + 10 * k) for i in range(length) for k in (i, i + 1)]
    meetings = spark.createDataFrame(rows, "bucket long, node binary, size long")
    held = [np.arange(50) + 1000 * max(1, i) for i in range(length + 1)]
    sets = spark.createDataFrame([(n, near_dups.packed(h)) for n, h in zip(names, held)], "node binary, set binary")
    found = {frozenset((bytes(r.pivot), bytes(r.node))) for r in near_dups.links(meetings, sets, 0.8).collect()}
    assert found == {frozenset(names[:2])}


def test_equal_sets_meet_however_often_shingles_repeat():
    draw = random.Random(11)
    for n in range(40):
        head, loop = [f"h{n}_{i}" for i in range(76)], [f"l{n}_{i}" for i in range(10)]
        pair = [" ".join(head + loop * times + loop[:4]) for times in (1, draw.choice([400, 1000, 4000]))]
        assert shingle_set(pair[0]) == shingle_set(pair[1])
        sizes, lists = near_dups.buckets(pa.array([*pair, None, "one", pair[0]]), near_dups.BANDS, near_dups.ROWS)
        a, b, none, one, again = lists.to_pylist()
        assert sizes.tolist() == [86, 86, 0, 1, 86] and none == [] and len(one) == near_dups.BANDS and a == again
        assert len(set(a)) == len(a) and len(set(b)) == len(b) and set(a) <= set(b)  # all bands of the plain signature


def test_near_edits(documents, copies):
    rows = [(d * 3 - 40, t) for d, t in copies]
    found = {r.doc_id: r for r in fingerprints.near_edits(documents(rows)).collect()}
    order = sorted(((d, t or "") for d, t in rows), reverse=True)
    assert len(found) == len(rows)
    errors = []
    for (d, t), (_, after) in zip(order, [*order[1:], order[0]]):
        half = len(t) // 2
        changed = t[: len(t) - half] + after[:half]
        r = found[d]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        for near, other in ((r.near_edited, changed), (r.near_next, after)):
            assert 0 <= near <= 1
            if t == other:
                assert near == 1
            if len(shingle_set(t)) > 200:
                errors.append(abs(near - jaccard(shingle_set(t), shingle_set(other))))
    assert np.mean(errors) < 0.05
    prints = {}
    for d, t in rows:
        assert prints.setdefault(t or "", found[d].fingerprint) == found[d].fingerprint


def test_one_document_is_its_own_next(documents):
    (r,) = fingerprints.near_edits(documents([(5, "a b c d e f")])).collect()
    assert (r.near_next, r.n_chars, r.edited_sha256) == (1, 11, hashlib.sha256(b"a b c a b c").hexdigest())


def test_repeated_and_missing_ids(documents):
    rows = [(1, "b b"), (1, "a a"), (1, "a a"), (None, "n n"), (2, None)]
    found = fingerprints.near_edits(documents(rows)).collect()
    # order: 2, then id 1 by text (a a, a a, b b), then the missing id, then 2 again
    assert sorted(r.edited_sha256 for r in found) == sorted(hashlib.sha256(t.encode()).hexdigest() for t in ["", "a a", "a b", "b n", "n "])


def test_containment_of_very_unequal_texts():
    draw = random.Random(2)
    large = text(draw, 40_000).split()
    small = " ".join(large[100:3100])
    (a, b), (x, y) = fingerprints.sketch(pa.array([small, " ".join(large)]))
    near, inside, covered = fingerprints.likeness(a, x, b, y)
    assert inside == 1 and abs(covered - 0.075) < 0.02 and near < 0.1
    both, kept = fingerprints.sketch(pa.array([small + " " + " ".join(large)]))
    assert set(kept[0].tolist()) >= set(x.tolist()) | set(y.tolist())
    assert fingerprints.sketch(pa.array([None, ""]))[0] == ["0.0."] * 2


def _compared_pairs(spark, monkeypatch, held):
    """Links of sets that all meet in one bucket, and how many pairs were compared for them."""
    names, asked = [i.to_bytes(2, "big") for i in range(len(held))], []
    meetings = spark.createDataFrame([(1, n, 100_000 - i) for i, n in enumerate(names)], "bucket long, node binary, size long")
    sets = spark.createDataFrame([(n, near_dups.packed(np.sort(h))) for n, h in zip(names, held)], "node binary, set binary")
    plain = near_dups._compared
    monkeypatch.setattr(near_dups, "_compared", lambda pairs, *more: (asked.append(pairs.count()), plain(pairs, *more))[1])
    found = near_dups.links(meetings, sets, 0.8).collect()
    return {frozenset(int.from_bytes(x, "big") for x in (r.pivot, r.node)) for r in found}, sum(asked)


def test_parts_of_a_large_text_are_compared_with_parts_of_their_size(spark, monkeypatch):
    # all lost the end of the pivot, so any two have lost the same shingles; only the last two are a link
    whole = np.arange(1, 2401) * 7919
    parts = [whole[: int(20 * 1.3**k)] for k in range(18)]
    found, pairs = _compared_pairs(spark, monkeypatch, [whole, *parts, parts[-1][1:]])
    assert found == {frozenset((18, 19))}
    assert pairs < 2 * len(parts)


def test_a_passage_that_many_share_does_not_pair_them(spark, monkeypatch):
    # all share a passage with the pivot and another that it lacks; only the last two are a link
    draw = np.random.default_rng(3)
    hashes = draw.choice(2**40, 6000, replace=False)
    first, second, rest = hashes[:40], hashes[40:70], hashes[70:]
    held = [np.concatenate([first, second, rest[40 * i : 40 * i + 40]]) for i in range(60)]
    found, pairs = _compared_pairs(spark, monkeypatch, [np.concatenate([first, rest[-80:]]), *held, held[-1][:-1]])
    assert found == {frozenset((60, 61))}
    assert pairs < 2 * len(held)
