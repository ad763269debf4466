"""The registered queries of the subpackage over whole small tables."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from brute import BLANK, jaccard, near_classes, shingle_set, targets
from compare import connect, differences

import __spark_entry__ as contract
from playlens.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def docs(folder):
    return duckdb.connect().sql(f"SELECT doc_id, text, source, lang FROM '{folder}/documents.parquet' ORDER BY doc_id").fetchall()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, folder, name):
    assert differences(QUERIES[name](spark, folder), connect(folder), ORACLES[name]) == []


def test_all_are_registered():
    names = set(contract.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}


def test_mixing(spark, folder, docs):
    rows = QUERIES["op2_mixing"](spark, folder).collect()
    sizes, taken = Counter(), Counter()
    for _, t, s, _ in docs:
        sizes[s] += len(BLANK.findall(t or ""))
    expected = targets(dict(sizes))
    assert sorted(r.doc_id for r in rows) == [d for d, *_ in docs]
    for r in rows:
        assert abs(r.target - expected[r.source]) < 1e-6 and r.taken <= 3 * r["size"]
        taken[r.source] += r.taken
    assert all(abs(taken[s] - expected[s]) <= max(30, 0.01 * expected[s]) for s in sizes)


def test_token_queries(spark, folder, docs, library):
    ids = {d: np.array(library.encode(t or "", add_special_tokens=False).ids, "<u4") for d, t, *_ in docs}
    start, expected = 0, []
    for d, *_ in docs:
        whole = np.append(ids[d], 0).astype("<u4")
        expected.append((d, start, len(whole), zlib.crc32(whole.tobytes())))
        start += len(whole)
    assert sorted(map(tuple, QUERIES["op3_token_files"](spark, folder).collect())) == expected
    digest = lambda x: hashlib.sha256(x).hexdigest()
    expected = [(d, len(ids[d]), digest(ids[d].tobytes()), digest((t or "").encode())) for d, t, *_ in docs]
    assert sorted(map(tuple, QUERIES["op6_bpe"](spark, folder).collect())) == expected
    bins = Counter((s, len(ids[d])) for d, _, s, _ in docs)
    assert {(r.source, r.n_tokens): r.n_docs for r in QUERIES["op9_token_counts"](spark, folder).collect()} == bins


def test_near_queries(spark, folder, docs):
    found = {r.doc_id: r.class_id for r in QUERIES["op10_near_dups"](spark, folder).collect()}
    assert found == near_classes([(d, t) for d, t, *_ in docs])
    rows = {r.doc_id: r for r in QUERIES["op5_fingerprints"](spark, folder).collect()}
    order = [(d, t or "") for d, t, *_ in reversed(docs)]
    for (d, t), (_, after) in zip(order, [*order[1:], order[0]]):
        half = len(t) // 2
        changed = t[: len(t) - half] + after[:half]
        assert (rows[d].n_chars, rows[d].edited_sha256) == (len(t), hashlib.sha256(changed.encode()).hexdigest())
        if len(shingle_set(t)) > 300:
            assert abs(rows[d].near_edited - jaccard(shingle_set(t), shingle_set(changed))) < 0.25


def test_language_query(spark, folder, docs):
    lang = {d: x for d, _, _, x in docs}
    rows = QUERIES["op7_language_id"](spark, folder).collect()
    assert len(rows) == len(docs)
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {d for d in lang if zlib.crc32(str(d).encode()) % 3 == 1}
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.95
