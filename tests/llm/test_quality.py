"""The additive quality model: features against plain counting, tables, held-out labels, odd rows."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from brute import BLANK

from playlens.llm import quality, shingles

LABELS = "doc_id long, quality int, toxic int, text string, h long"
AT = {name: i for i, name in enumerate(quality.FEATURES)}


def text_of(draw, good: bool) -> str:
    words = ["".join(draw.choice("abcdeiou") for _ in range(draw.randrange(2, 9))) for _ in range(draw.randrange(20, 90))]
    if good:
        return " ".join(words) + "."
    return draw.choice([
        " ".join(w + draw.choice(["###", "$$$", "%%"]) for w in words), " ".join(w.upper() + "!!" for w in words),
        " ".join([words[0]] * len(words)),
    ])


@pytest.fixture(scope="module")
def sample():
    draw = random.Random(3)
    return [(i, text_of(draw, i % 6 > 0), int(i % 6 > 0)) for i in range(600)]


def test_features_count_whole_texts():
    long = "word " * 500_000 + "End of IT! #x 12"
    texts = [None, "", " \n", "One two two\nthree!!! é", "a b c", long, "x" * 3_000_000]
    rows = quality.features(pa.array(texts))
    assert np.isfinite(rows).all() and (rows[0] == 0).all() and (rows[1] == 0).all()
    for text, row in zip(texts, rows):
        words = BLANK.findall(text or "")
        seen, n = Counter(words), max(1, len(words))
        assert np.isclose(np.expm1(row[AT["bytes"]]), len((text or "").encode()))
        assert np.isclose(np.expm1(row[AT["words"]]), len(words))
        assert np.isclose(row[AT["different words"]], len(seen) / n)
        assert np.isclose(row[AT["commonest word"]], max(seen.values(), default=0) / n)
        assert np.isclose(row[AT["different word pairs"]], len(set(zip(words, words[1:]))) / max(1, len(words) - 1))
        assert np.isclose(np.expm1(row[AT["longest word"]]), max((len(w.encode()) for w in words), default=0))
        symbols = [w for w in words if any(c.isascii() and not c.isalnum() and c not in ".,;:?'\"()-" for c in w)]
        assert np.isclose(row[AT["words with symbols"]], len(symbols) / n)


def test_steps_do_not_change_features(monkeypatch, sample):
    texts = pa.array([t for _, t, _ in sample[:50]])
    whole = quality.features(texts)
    monkeypatch.setattr(shingles, "STEP_BYTES", 100)
    assert np.allclose(quality.features(texts), whole)


def test_pairs_learn_what_single_features_cannot():
    draw = np.random.default_rng(0)
    rows = draw.random((3000, 4))
    labels = ((rows[:, 1] > 0.5) != (rows[:, 2] > 0.5)).astype(float)
    model = quality.fit(rows, labels)
    assert model.paired[0][:2] == (1, 2)
    test = draw.random((1000, 4))
    assert np.mean((model.score(test) > 0.5) == ((test[:, 1] > 0.5) != (test[:, 2] > 0.5))) > 0.97


def test_held_out_labels(spark, documents, sample):
    labels = [(i, y, 0, "x", 1) for i, _, y in sample]
    docs = documents([(i, t) for i, t, _ in sample])
    model = quality.learn(docs, spark.createDataFrame(labels, LABELS))
    found = quality.score(docs, model)
    assert found.columns == [*[c for c in docs.columns if c != "score"], "score", "predicted"]
    rows = {r.doc_id: r for r in found.collect()}
    held = [(i, y) for i, _, y in sample if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(held) > 50 and np.mean([rows[i].predicted == y for i, y in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows.values())
    # wrong labels of held-out rows change nothing
    wrong = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y, 0, "x", 1) for i, _, y in sample]
    again = quality.score(docs, quality.learn(docs, spark.createDataFrame(wrong, LABELS)))
    assert {r.doc_id: r.score for r in again.collect()} == {i: r.score for i, r in rows.items()}


def test_bounded_sample(spark, documents, sample):
    labels = spark.createDataFrame([(i, y, 0, "x", 1) for i, _, y in sample], LABELS)
    docs = documents([(i, t) for i, t, _ in sample])
    model = quality.learn(docs, labels, sample_rows=200)
    rows = {r.doc_id: r.predicted for r in quality.score(docs, model).collect()}
    assert np.mean([rows[i] == y for i, _, y in sample]) > 0.9


def test_odd_rows(spark, documents, sample):
    rows = [(1, None), (2, ""), (2, ""), (None, "plain words here"), (3, "x" * 200_000), *[(i, t) for i, t, _ in sample[10:40]]]
    docs = documents(rows)
    for labels in ([], [(10, 1, 0, "x", 1)], [(None, 1, 0, "x", 1), (11, None, 0, "x", 1), (12, 7, 0, "x", 1)], [(99, 0, 0, "x", 1)]):
        model = quality.learn(docs, spark.createDataFrame(labels, LABELS))
        got = quality.score(docs, model).collect()
        assert len(got) == len(rows) and len({r.score for r in got}) == 1
    doubled = [(i, y, 0, "x", 1) for i, _, y in sample[10:40]] * 2
    model = quality.learn(docs, spark.createDataFrame(doubled, LABELS))
    assert quality.score(docs, model).filter("score IS NULL").count() == 0
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert quality.score(empty, model).count() == 0
    assert quality.score(docs, quality.learn(empty, spark.createDataFrame(doubled, LABELS))).count() == len(rows)
