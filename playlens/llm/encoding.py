"""Encoding whole texts in Spark tasks, word by word through a bounded cache of words."""

from __future__ import annotations

import os
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

from .common import freeing, ship, slices
from .presplit import GAP, Presplitter
from .shingles import mix

#: Words a worker remembers; beyond that it begins anew.  About 50 bytes each.
CACHED_WORDS = 1_000_000
#: Bytes of text handled at once in a task.
SLICE_BYTES = 4 << 20


class WordTable:
    """Ids of words by the 128-bit hash of the word, in arrays: an open-addressed table of bounded size."""

    def __init__(self, limit: int = CACHED_WORDS):
        self.limit = limit
        self.forget()

    def forget(self, room: int = 0) -> None:
        room = max(self.limit, room)
        self.bits = (2 * room).bit_length()
        self.slots = np.full(1 << self.bits, -1, np.int32)
        self.names = np.empty((2, room), np.uint64)
        self.begins, self.sizes = np.empty(room, np.int64), np.empty(room, np.int32)
        self.ids, self.n, self.used = np.empty(4 * room, "<u4"), 0, 0

    def _probe(self, names: np.ndarray) -> np.ndarray:
        return (names[0] >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, names: np.ndarray) -> np.ndarray:
        """The number of each word, -1 if it is not there.  ``names`` are two rows of hashes."""
        out = np.full(names.shape[1], -1, np.int64)
        todo, slot, last = np.arange(names.shape[1]), self._probe(names), (1 << self.bits) - 1
        while len(todo):
            at = self.slots[slot]
            same = (at >= 0) & (self.names[0, at] == names[0, todo]) & (self.names[1, at] == names[1, todo])
            out[todo[same]] = at[same]
            further = (at >= 0) & ~same
            todo, slot = todo[further], slot[further] + 1 & last
        return out

    def add(self, names: np.ndarray, found: list[bytes]) -> np.ndarray:
        """Numbers of new words, which differ from each other and those that are there."""
        m = names.shape[1]
        number = np.arange(self.n, self.n + m)
        sizes = np.fromiter(map(len, found), np.int64, m) // 4
        ends = self.used + np.cumsum(sizes)
        if m and ends[-1] > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty(max(len(self.ids), int(ends[-1])), "<u4")])
        if m:
            self.ids[self.used : ends[-1]] = np.frombuffer(b"".join(found), "<u4")
            self.used = int(ends[-1])
        self.names[:, number], self.begins[number], self.sizes[number] = names, ends - sizes, sizes
        self.n += m
        todo, slot, last = np.arange(m), self._probe(names), (1 << self.bits) - 1
        while len(todo):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = number[todo[free]]
            lost = self.slots[slot] != number[todo]
            todo, slot = todo[lost], slot[lost] + 1 & last
        return number


class Words:
    """Encodes words; ``table`` remembers them."""

    def __init__(self, limit: int = CACHED_WORDS):
        self.limit, self.table = limit, WordTable(limit)

    def encoded(self, words: list[str]) -> list[bytes]:
        """Ids of each word as little-endian 32-bit integers."""
        raise NotImplementedError


class TokenizersWords(Words):
    """Encodes a word by the tokenizers library."""

    def __init__(self, spec: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_str(spec)
        self.model.no_truncation()
        self.model.no_padding()

    def encoded(self, words: list[str]) -> list[bytes]:
        """A blank and letters are a word wherever they stand, so such words go to the library as one text."""
        out: dict[str, bytes] = {}
        plain = [w for w in words if w[0] == " " and w[1:].isalpha()]
        for k in range(0, len(plain), 4096):
            some = plain[k : k + 4096]
            found = self.model.encode("".join(some), add_special_tokens=False)
            numbers = np.array(found.word_ids, np.int64)
            if len(numbers) and numbers[-1] + 1 == len(some) and len(np.unique(numbers)) == len(some):
                ids, ends = np.array(found.ids, "<u4").tobytes(), np.cumsum(4 * np.bincount(numbers)).tolist()
                out.update((w, ids[a:b]) for w, a, b in zip(some, [0, *ends], ends))
        rest = [w for w in words if w not in out]
        for k in range(0, len(rest), 4096):
            found = self.model.encode_batch_fast(rest[k : k + 4096], add_special_tokens=False)
            out.update((w, array("I", x.ids).tobytes()) for w, x in zip(rest[k:], found))
        return [out[w] for w in words]


class TextEncoder:
    """Ids of whole texts: pre-split, words numbered by numpy, each distinct word once by ``words``."""

    def __init__(self, spec: str, words: Words):
        self.splitter, self.cache = Presplitter(spec), words
        self.special = {k: array("I", [v]).tobytes() for k, v in self.splitter.special.items()} | {chr(GAP): b""}

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        begun = b""
        for whole, points, bounds, n, more in self.splitter.cuts(texts):
            ids, ends = self._ids(whole, points, bounds)
            cuts = ends[np.flatnonzero(points[bounds[:-1]] == GAP)].tolist() if n > 1 else []
            for k, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(ids)]), 1):
                made = begun + ids[a:b].tobytes()
                begun = made if more and k == n else b""
                if not (more and k == n):
                    yield made

    def _ids(self, whole: str, points: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, and how many there are up to each word's end."""
        if not whole:
            return np.empty(0, "<u4"), np.zeros(0, np.int64)
        table = self.cache.table
        names = word_names(points, bounds)
        _, first, number = np.unique(names[0], return_index=True, return_inverse=True)
        if (names[1][first][number] != names[1]).any():  # half of two names is equal
            _, first, number = np.unique(names, axis=1, return_index=True, return_inverse=True)
        names = names[:, first]
        at = table.find(names)
        new = np.flatnonzero(at < 0)
        if table.n + len(new) > self.cache.limit:
            table.forget(len(first))
            new = np.arange(len(first))
        if len(new):
            begin = first[new]
            words = [whole[a:b] for a, b in zip(bounds[begin].tolist(), bounds[begin + 1].tolist())]
            plain = self.cache.encoded([w for w in words if w not in self.special])
            rest = iter(plain)
            at[new] = table.add(names[:, new], [self.special[w] if w in self.special else next(rest) for w in words])
        size = table.sizes[at].astype(np.int64)[number]
        ends = np.cumsum(size)
        return table.ids[np.repeat(table.begins[at][number] - ends + size, size) + np.arange(size.sum())], ends


_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def word_names(points: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Two rows of hashes, 128 bits a word: sums over its characters, each mixed with its place."""
    begin, size = bounds[:-1], np.diff(bounds)
    place = (np.arange(len(points)) - np.repeat(begin, size)).astype(np.uint64)
    mixed = mix((place << np.uint64(24) | points) * _GOLDEN)
    other = mixed * np.uint64(0xD1342543DE82EF95)
    return np.stack([np.add.reduceat(mixed, begin), np.add.reduceat(other ^ other >> np.uint64(31), begin)])


@lru_cache(maxsize=2)
def tokenizers_encoder(spec: str) -> TextEncoder:
    """One per worker and tokenizer, kept between tasks."""
    return TextEncoder(spec, TokenizersWords(spec))


def shared_spec(spark: SparkSession, path: str):
    """The tokenizer file, read on the driver and sent to each executor once (a vocabulary
    has a fixed size, about 1.5 MB)."""
    ship(spark)
    return spark.sparkContext.broadcast(Path(path).read_text(encoding="utf-8"))


def over_texts(
    batches: Iterator[pa.RecordBatch], schema: pa.Schema, rows: Callable[[list[str]], dict[str, object]],
) -> Iterator[pa.RecordBatch]:
    """Runs ``rows`` over runs of texts (null: empty) and appends its columns to the others."""
    for batch in freeing(batches):
        texts = batch.column("text")
        kept = [f.name for f in batch.schema if f.name != "text"]
        for a, b in slices(texts, SLICE_BYTES):
            made = rows([t or "" for t in texts[a:b].to_pylist()])
            columns = {n: batch.column(n)[a:b] for n in kept} | made
            yield pa.RecordBatch.from_arrays(
                [columns[f.name] if isinstance(columns[f.name], pa.Array) else pa.array(columns[f.name], f.type)
                 for f in schema],
                schema=schema,
            )
