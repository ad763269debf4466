"""Cuts texts into the pre-token words of a byte-level BPE, for a whole batch at once.

The words are those of the pattern that byte-level tokenizers use by default: the English
contractions, an optional blank with a run of letters, of digits or of other signs, and
white space, whose last character goes with what follows.  Boundaries are found with numpy
over the code points; the words themselves are slices of the text.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer

OTHER, LETTER, DIGIT, SPACE, BREAK, ASK = 0, 1, 2, 3, 4, 9
#: Lone surrogates cannot occur in a text that was UTF-8; they mark gaps and special tokens.
GAP, FIRST_MARK = 0xD800, 0xD801
#: Characters of one batch of texts; a longer text is cut between two words.
BATCH_CHARS = 1 << 20

# Unicode white space, and the endings that follow an apostrophe.
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
ONE_LETTER, TWO_LETTERS = "stmd", ("re", "ve", "ll")


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """The class of every code point; unassigned ones are to be asked of the tokenizer."""
    first = {"L": LETTER, "N": DIGIT}
    table = np.zeros(0x110000, np.uint8)
    for i in range(0x110000):
        kind = unicodedata.category(chr(i))
        table[i] = ASK if kind == "Cn" else first.get(kind[0], OTHER)
    table[WHITE] = SPACE
    table[0xD800:0xE000] = BREAK
    return table


class Presplitter:
    """Pre-splitting as the tokenizer described by ``spec`` (its JSON text) does it."""

    def __init__(self, spec: str):
        made = json.loads(spec)
        kind = made.get("pre_tokenizer") or {}
        plain = kind.get("type") == "ByteLevel" and kind.get("use_regex", True) and not kind.get("add_prefix_space")
        odd = [t for t in made.get("added_tokens", []) if t["single_word"] or t["lstrip"] or t["rstrip"]]
        if not plain or made.get("normalizer") or odd:
            raise ValueError("a byte-level tokenizer without normalizer and stripping tokens is needed")
        self.ask = Tokenizer.from_str(spec).pre_tokenizer
        self.marks = {t["content"]: chr(FIRST_MARK + k) for k, t in enumerate(made.get("added_tokens", []))}
        self.special = {self.marks[t["content"]]: t["id"] for t in made.get("added_tokens", [])}
        self.contents = {self.marks[c]: c for c in self.marks}
        longest = sorted(self.marks, key=len, reverse=True)
        self.pattern = re.compile("|".join(map(re.escape, longest))) if longest else None
        self.table = classes().copy()

    def cuts(self, texts: list[str]) -> Iterator[tuple[str, np.ndarray, np.ndarray, int, bool]]:
        """Some texts at a time: they joined by ``GAP`` with special tokens as their marks, its code points, where
        words begin (and the end), how many texts it holds and whether the last goes on in the next part."""
        held: list[str] = []
        size = 0
        for text in texts:
            if held and size + len(text) > BATCH_CHARS:
                yield *self._cut([self._marked(t) for t in held]), len(held), False
                held, size = [], 0
            if len(text) > BATCH_CHARS:
                pieces = list(_pieces(self._marked(text)))
                for i, piece in enumerate(pieces, 1):
                    yield *self._cut([piece]), 1, i < len(pieces)
            else:
                held.append(text)
                size += len(text)
        if held:
            yield *self._cut([self._marked(t) for t in held]), len(held), False

    def words(self, texts: list[str]) -> Iterator[list[list[str]]]:
        """The words of each text, some texts at a time; a special token is one word, its mark."""
        gap, begun = chr(GAP), []
        for whole, _, bounds, n, more in self.cuts(texts):
            found: list[list[str]] = [begun]
            for a, b in zip(bounds.tolist(), bounds[1:].tolist()):
                if n > 1 and whole[a:b] == gap:
                    found.append([])
                else:
                    found[-1].append(whole[a:b])
            begun = found[-1] if more else []
            if not more:
                yield found

    def _marked(self, text: str) -> str:
        if self.pattern is not None and any(c in text for c in self.marks):
            return self.pattern.sub(lambda m: self.marks[m[0]], text)
        return text

    def _cut(self, texts: list[str]) -> tuple[str, np.ndarray, np.ndarray]:
        whole = chr(GAP).join(texts)
        if not whole:
            return whole, np.empty(0, np.uint32), np.zeros(1, np.int64)
        points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
        kinds = self.table[points]
        if (kinds == ASK).any():
            for i in np.unique(points[kinds == ASK]).tolist():
                self.table[i] = self._kind(chr(i))
            kinds = self.table[points]
        return whole, points, np.append(np.flatnonzero(self._starts(points, kinds)), len(whole))

    def _kind(self, c: str) -> int:
        """An unassigned sign joins a letter, a digit or a sign in the tokenizer's own eyes."""
        for before, kind in (("a", LETTER), ("1", DIGIT), ("!", OTHER)):
            if len(self.ask.pre_tokenize_str(before + c)) == 1:
                return kind
        return SPACE

    @staticmethod
    def _starts(points: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        before = np.empty_like(kinds)
        before[0], before[1:] = BREAK, kinds[:-1]
        content, white = kinds <= DIGIT, kinds == SPACE
        after_blank = np.zeros(len(points), bool)
        after_blank[1:] = points[:-1] == 32
        start = content & (kinds != before) & ~after_blank
        start |= white & (before != SPACE)
        start[:-1] |= white[:-1] & content[1:]
        start |= kinds == BREAK
        start[0] = True
        marks = np.flatnonzero((points == 39) & start)
        for i in marks.tolist():
            tail = "".join(map(chr, points[i + 1 : i + 3].tolist()))
            taken = 1 if tail[:1] and tail[0] in ONE_LETTER else 2 if tail in TWO_LETTERS else 0
            if taken:
                start[i + 1] = False
                if i + 1 + taken < len(points) and kinds[i + 1 + taken] == LETTER:
                    start[i + 1 + taken] = True
        return start


def _pieces(text: str) -> Iterator[str]:
    """Cuts a long text before single blanks between other characters: words stay whole."""
    begin, n = 0, len(text)
    while n - begin > BATCH_CHARS:
        cut = begin + BATCH_CHARS
        while cut < n - 1 and not (text[cut] == " " and not text[cut - 1].isspace() and not text[cut + 1].isspace()):
            cut += 1
        if cut >= n - 1:
            break
        yield text[begin:cut]
        begin = cut
    yield text[begin:]
