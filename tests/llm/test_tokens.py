"""BPE encoding, token files and token counts against the tokenizers library."""

from __future__ import annotations

import random
import hashlib
import zlib
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from playlens.llm import bpe, presplit, token_counts, token_files
from playlens.llm import automaton, encoding
from playlens.llm.bpe import automaton_encoder
from playlens.llm.encoding import tokenizers_encoder

ODD = [
    "", "  a  b", "it's 'll we'll 'sabc ''s's x'RE it'rex\n\n y\n z", "\t\t a　b 12abc<|endoftext|> <|endoftext|>q <|endo",
    "aaaaaaaaaa" * 50, " " * 7, "aᲉb ́e ½Ⅷ٣", "'", "x '", "é'tout'", "\x1c\x1d a\x85b  \n", " \n \n", "日本語 テスト😀😀  '",
    "a\x00b", "end  ", "\n\n'd", "<|endoftext|>",
]
ROWS = [(i, t) for i, t in enumerate(ODD)] + [(50, None), (7, "repeated id"), (50, None), (None, "no id")]


def ids(library, text):
    return np.array(library.encode(text or "", add_special_tokens=False).ids, "<u4")


@pytest.fixture(params=[automaton_encoder, tokenizers_encoder])
def encoder(request, bpe_path):
    return request.param(Path(bpe_path).read_text(encoding="utf-8"))


def test_odd_texts(encoder, library):
    assert list(encoder.encode(ODD)) == [ids(library, t).tobytes() for t in ODD]


@settings(max_examples=300, deadline=None)
@given(text=st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\t'sdmtlreva1é"))))
def test_any_text(text, bpe_path, library):
    spec = Path(bpe_path).read_text(encoding="utf-8")
    for make in (automaton_encoder, tokenizers_encoder):
        encoder = make(spec)
        (found,) = encoder.encode([text])
        assert found == ids(library, text).tobytes()
    assert automaton_encoder(spec).cache.text(found) == library.decode(np.frombuffer(found, "<u4").tolist(), skip_special_tokens=False)


def test_long_text_is_cut_between_words(encoder, library, monkeypatch):
    monkeypatch.setattr(presplit, "BATCH_CHARS", 50)
    text = "It's a long text  with\n\nbreaks, <|endoftext|> and words. " * 20 + "x" * 300
    assert list(encoder.encode(["short", text, ""])) == [ids(library, t).tobytes() for t in ("short", text, "")]


def test_small_memory_of_words(encoder, library, monkeypatch):
    monkeypatch.setattr(encoder.cache, "limit", 3)
    texts = [f"word{i} other{i % 5} again" for i in range(40)] * 2
    for t in texts:
        assert list(encoder.encode([t])) == [ids(library, t).tobytes()]


def test_broken_bytes_become_the_replacement_sign(bpe_path, library):
    encoder = automaton_encoder(Path(bpe_path).read_text(encoding="utf-8"))
    some = ids(library, "😀é").tolist()
    for cut in (some[:1], some[1:], some[:1] + some[-1:]):
        assert encoder.cache.text(np.array(cut, "<u4").tobytes()) == library.decode(cut, skip_special_tokens=False)


def test_two_merges_of_one_token_are_refused(bpe_path):
    import json

    from playlens.llm.automaton import TokenAutomaton

    spec = {"model": {"type": "BPE", "vocab": {"a": 0, "aa": 1, "aaa": 2}, "merges": [["a", "a"], ["a", "aa"], ["aa", "a"]]}}
    with pytest.raises(ValueError):
        TokenAutomaton(json.dumps(spec))


def test_digests_and_decoding(documents, bpe_path, library):
    rows = bpe.digests(documents(ROWS), bpe_path, ["doc_id", "size"]).collect()
    expected = []
    for d, t in ROWS:
        found = ids(library, t)
        expected.append((d, "x", len(found), hashlib.sha256(found.tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    key = lambda r: (r[0] is None, r[0] or 0, r[3])
    assert sorted(map(tuple, rows), key=key) == sorted(expected, key=key)
    decoded = bpe.encode(documents(ROWS), bpe_path, ["doc_id"]).collect()
    assert sorted((r.decoded for r in decoded)) == sorted(t or "" for _, t in ROWS)


def test_files_hold_ids_in_order(spark, documents, bpe_path, library, tmp_path):
    path = str(tmp_path / "ids")
    token_files.write_tokens(documents(ROWS), path, bpe_path)
    rows = token_files.token_rows(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in rows] == sorted((d for d, _ in ROWS), key=lambda d: (d is not None, d or 0))
    start = 0
    for r in rows:
        assert r.start == start
        start += r.n_tokens
    crc = sorted(zlib.crc32(np.append(ids(library, t), 0).astype("<u4").tobytes()) for _, t in ROWS)
    assert sorted(r.ids_crc32 for r in rows) == crc
    (one,) = token_files.lookup(spark, path, [2]).collect()
    assert one.ids == [*ids(library, ODD[2]).tolist(), 0]


def test_files_of_an_empty_table(spark, documents, bpe_path, tmp_path):
    path = str(tmp_path / "none")
    token_files.write_tokens(documents([(1, "x")]).limit(0), path, bpe_path)
    assert token_files.token_rows(spark, path).count() == 0


def test_histogram(documents, bpe_path, library):
    rows = [(i, "word " * (i % 7), s) for i, s in enumerate(["a", "b", None] * 12)] + [(99, None, "a")]
    lengths = token_counts.encoded_lengths(documents(rows), bpe_path, ["source"])
    histogram = token_counts.length_histogram(lengths, ["source"])
    found = histogram.collect()
    by = {}
    for _, t, s in rows:
        by.setdefault(s, []).append(len(ids(library, t)))
    assert {(r.source, r.n_tokens) for r in found} == {(s, n) for s, ns in by.items() for n in ns}
    for r in found:
        own, limit = by[r.source], r.n_tokens
        assert r.n_docs == own.count(limit) and r.docs_total == len(own) and r.tokens_total == sum(own)
        assert r.docs_at_least == sum(n >= limit for n in own)
        assert r.tokens_at_least == sum(n for n in own if n >= limit)
        assert r.truncated_total == sum(min(n, limit) for n in own)
        assert r.share_up_to == sum(n <= limit for n in own) / len(own)
    half = {r.source: r.n_tokens for r in token_counts.quantile(histogram, ["source"], 0.5).collect()}
    assert half == {s: sorted(ns)[(len(ns) - 1) // 2] for s, ns in by.items()}
    whole = token_counts.length_histogram(lengths.limit(0), ["source"])
    assert whole.count() == 0
    cut = histogram.agg(token_counts.truncated_total(histogram, 3).alias("n")).first().n
    assert cut == sum(min(n, 3) for ns in by.values() for n in ns)


def test_words_together_alone_and_in_pieces(bpe_path, library, monkeypatch):
    """The same ids however words are run: many at a time, one by one, a long one in pieces, the table begun anew."""
    spec = Path(bpe_path).read_text(encoding="utf-8")
    made = automaton.TokenAutomaton(spec)
    draw = random.Random(11)
    words = ["".join(draw.choice("abcdeorstinühéж ") for _ in range(draw.randrange(1, 90))) for _ in range(400)]
    words = [w.replace(" ", "") or "a" for w in words]
    expected = [np.array(library.encode(w, add_special_tokens=False).ids, "<u4").tobytes() for w in words]
    assert made.encoded(words) == expected
    monkeypatch.setattr(automaton, "LONG", 0)
    monkeypatch.setattr(automaton, "PIECE", 7)
    assert made.encoded(words) == expected
    states, labels = np.array(draw.choices(range(256, 40_000), k=3000)), np.array(draw.choices(range(256, 40_000), k=3000))
    assert made.have_arcs(states, labels).tolist() == [made.has_arc(a, b) for a, b in zip(states.tolist(), labels.tolist())]


def test_table_of_words_finds_what_was_added():
    draw = np.random.default_rng(3)
    table = encoding.WordTable(2000)
    names = draw.integers(0, 2**63, (2, 1500)).astype(np.uint64)
    names[0, 1000:] = names[0, :500]  # half of two names is equal
    names[0, :50] = np.uint64(2**64 - 1)  # probes run over the end
    for k in range(0, 1500, 500):
        table.add(names[:, k : k + 500], [np.full(i % 4, i, "<u4").tobytes() for i in range(k, k + 500)])
    at = table.find(names)
    assert at.tolist() == list(range(1500))
    for i in (0, 1, 499, 1003, 1499):
        assert table.ids[table.begins[i] : table.begins[i] + table.sizes[i]].tolist() == [i] * (i % 4)
    assert (table.find(draw.integers(0, 2**63, (2, 300)).astype(np.uint64)) == -1).all()
