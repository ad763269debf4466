"""BPE encoding and decoding by a tokenization automaton.

The automaton reads token labels and accepts exactly the token sequences that byte-pair
encoding produces.  It starts as one state with a loop for each byte and grows by one gadget
per merge (u, v) -> w, in order of rank:

* the state after u loses its arc v, since the pair would have been merged;
* a new state "after w" is made as a copy of the state after v as it was before this merge;
* every state that still has the arc u gets the arc w.

Copies share what they copied: a state keeps the state it came from and the moment of the
copy, an arc the arc it came with, and a removed arc its moment.  The compiled automaton is a
few arrays: these, an open-addressed table of the removed arcs, and a trie of the labels.  Whether
a state has an arc follows by unwinding gadgets in them; written out, the table of arcs would
have 2.5 billion cells.

Many words are encoded at a time, by numpy.  The trie finds every label that stands anywhere in
them.  Then all words advance together, a byte a step, and each prefix gets the state reached:
the one state whose label ends there and whose arc leaves a state reached before.  Words longer
than ``LONG`` bytes are run one by one.  Decoding emits the labels of the arcs.
"""

from __future__ import annotations

import json
from array import array

import numpy as np

from .encoding import Words

#: Arcs of long words remembered before they are forgotten.
TABLE_ARCS = 300_000
#: Bytes of a word that is encoded together with others, and how many words are.
LONG, TOGETHER = 64, 20_000
#: Bytes of a long word whose labels are looked up at once.
PIECE = 1 << 17
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


class Lookup:
    """Whole numbers to whole numbers, open-addressed; unknown keys give ``none``."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, none: int):
        self.bits = (4 * max(1, len(keys))).bit_length()
        self.keys, self.values = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, none, np.int64)
        todo, slot = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            free = self.keys[slot] < 0
            self.keys[slot[free]] = keys[todo[free]]
            won = self.keys[slot] == keys[todo]
            self.values[slot[won]] = values[todo[won]]
            todo, slot = todo[~won], slot[~won] + 1 & (1 << self.bits) - 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * _SPREAD >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        out = self.values[slot]
        there = self.keys[slot]
        todo = np.flatnonzero((there != keys) & (there >= 0))
        slot = slot[todo]
        while len(todo):
            slot = slot + 1 & (1 << self.bits) - 1
            there = self.keys[slot]
            out[todo] = self.values[slot]
            further = (there != keys[todo]) & (there >= 0)
            todo, slot = todo[further], slot[further]
        return out


def byte_signs() -> dict[str, int]:
    """Printable stand-in -> byte: the bytes that print stand for themselves, the others are
    numbered behind the first 256 code points."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class TokenAutomaton(Words):
    """Encodes a word by table-driven transitions; also the memory of encoded words."""

    def __init__(self, spec: str):
        super().__init__()
        made = json.loads(spec)
        model, signs = made["model"], byte_signs()
        odd = [k for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges") if model.get(k)]
        if model["type"] != "BPE" or odd:
            raise ValueError("a plain byte-level BPE is needed")
        spell = lambda token: bytes(signs[c] for c in token)
        self.vocab = {spell(t): i for t, i in model["vocab"].items()}
        size = max([*model["vocab"].values(), *[t["id"] for t in made.get("added_tokens", [])]]) + 1
        self.label: list[bytes] = [b""] * size
        for word, i in self.vocab.items():
            self.label[i] = word
        self.longest = max(map(len, self.vocab))
        #: Per state: the moment it was made and the state it copies; per label: the label it comes with.
        self.made, self.copied, self.comes_with = [0] * size, [-1] * size, [-1] * size
        self.removed: dict[tuple[int, int], int] = {}
        self.rows: dict[int, dict[int, bool]] = {}
        self.arcs = 0
        for moment, pair in enumerate(model["merges"], 1):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            u, v = self.vocab[spell(left)], self.vocab[spell(right)]
            self._gadget(moment, u, v, self.vocab[self.label[u] + self.label[v]])
        self._compile()
        for token in made.get("added_tokens", []):
            self.label[token["id"]] = token["content"].encode()

    def _compile(self) -> None:
        """The arrays that words are run through together."""
        self.born, self.copy_of = np.array(self.made, np.int64), np.array(self.copied, np.int64)
        self.came_with = np.array(self.comes_with, np.int64)
        pairs = np.array([u << 32 | v for u, v in self.removed], np.int64)
        self.lost = Lookup(pairs, np.array(list(self.removed.values()), np.int64), len(self.removed) + 1)
        # the trie: nodes of one depth are made from those above, node 0 is the root
        nodes: dict[bytes, int] = {b"": 0}
        for word in self.vocab:
            for i in range(1, len(word) + 1):
                nodes.setdefault(word[:i], len(nodes))
        keys = np.array([nodes[w[:-1]] << 8 | w[-1] for w in nodes if w], np.int64)
        self.step = Lookup(keys, np.array([n for w, n in nodes.items() if w], np.int64), -1)
        self.token_at = np.full(len(nodes), -1, np.int64)
        for word, i in self.vocab.items():
            self.token_at[nodes[word]] = i

    def have_arcs(self, states: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """``has_arc`` of many states and labels."""
        out = np.ones(len(states), bool)
        todo, until = np.arange(len(states)), np.full(len(states), len(self.removed) + 1)
        while len(todo):
            gone = self.lost(states << 32 | labels) < until
            out[todo[gone]] = False
            born, came = self.born[states], self.born[labels]
            open_ = ~gone & ((born > 0) | (came > 0))
            todo, states, labels, born, came = todo[open_], states[open_], labels[open_], born[open_], came[open_]
            copy = born > came  # the state is a copy, taken before its own merge removed an arc
            until = np.where(copy, born, came + 1)
            states, labels = np.where(copy, self.copy_of[states], states), np.where(copy, labels, self.came_with[labels])
        return out

    def together(self, words: list[bytes]) -> list[bytes]:
        """Ids of short words."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        ends = np.cumsum(sizes)
        begins, last = ends - sizes, np.repeat(ends, sizes)
        first, end, label = self.labels(data, np.arange(len(data)), last)
        word_begin = np.repeat(begins, sizes)
        step = end - word_begin[first]  # bytes of the word up to the label's end
        order = np.argsort(step, kind="stable")
        first, end, label, step = first[order], end[order], label[order], step[order]
        cuts = np.searchsorted(step, np.arange(1, int(sizes.max(initial=0)) + 2))
        # the state after each byte, and where its label begins
        reached, origin = np.full(len(data) + 1, -1), np.zeros(len(data) + 1, np.int64)
        for a, b in zip(cuts, cuts[1:]):
            x, y, v = first[a:b], end[a:b], label[a:b]
            start = x == word_begin[x]
            before = np.where(start, -1, reached[x - 1])
            good = start.copy()
            ask = np.flatnonzero(~start & (before >= 0))
            good[ask] = self.have_arcs(before[ask], v[ask])
            reached[y[good] - 1], origin[y[good] - 1] = v[good], x[good]
        # back from the ends of the words, all at a time
        here, owner = ends - 1, np.arange(len(words))
        ids, owners = [], []
        while len(here):
            ids.append(reached[here])
            owners.append(owner)
            more = origin[here] > begins[owner]
            here, owner = origin[here[more]] - 1, owner[more]
        owner = np.concatenate(owners)[::-1]
        order = np.argsort(owner, kind="stable")
        whole = np.concatenate(ids)[::-1][order].astype("<u4").tobytes()
        bounds = (4 * np.cumsum(np.bincount(owner, minlength=len(words)))).tolist()
        return [whole[a:b] for a, b in zip([0, *bounds], bounds)]

    def _gadget(self, moment: int, u: int, v: int, w: int) -> None:
        if self.made[w] or len(self.label[w]) < 2:
            raise ValueError("two merges make the same token")
        self.removed[u, v] = moment
        self.made[w], self.copied[w], self.comes_with[w] = moment, v, u

    def has_arc(self, state: int, label: int) -> bool:
        """Whether ``label`` may follow ``state`` once all gadgets are in place."""
        row = self.rows.get(state)
        if row is None:
            row = self.rows[state] = {}
        known = row.get(label)
        if known is None:
            known = row[label] = self._unwound(state, label)
            self.arcs += 1
        return known

    def _unwound(self, state: int, label: int) -> bool:
        until = len(self.removed) + 1  # the arc must be there before this moment
        while True:
            if self.removed.get((state, label), until) < until:
                return False
            born, came = self.made[state], self.made[label]
            if not born and not came:
                return True
            if born > came:  # the state is a copy, taken before its own merge removed an arc
                state, until = self.copied[state], born
            else:  # the arc came with another one, which its own merge may have removed
                label, until = self.comes_with[label], came + 1

    def ids(self, word: bytes) -> list[int]:
        """Ids of one word of any length, ``PIECE`` bytes of it at a time."""
        n = len(word)
        data, last = np.frombuffer(word, np.uint8).astype(np.int64), np.full(n, n)
        reached = [-1] * (n + 1)
        for piece in range(0, n, PIECE):
            first, end, label = self.labels(data, np.arange(piece, min(n, piece + PIECE)), last)
            order = np.argsort(end, kind="stable")
            for f, e, v in zip(first[order].tolist(), end[order].tolist(), label[order].tolist()):
                if f == 0 or (reached[f] >= 0 and self.has_arc(reached[f], v)):
                    reached[e] = v
        out, end = [], n
        while end:
            out.append(reached[end])
            end -= len(self.label[reached[end]])
        return out[::-1]

    def labels(self, data: np.ndarray, at: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All labels that stand in the bytes from ``at`` on, none beyond its word's end (``last``): where they
        begin and end, and which they are."""
        node, depth = np.zeros(len(at), np.int64), 0
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(at):
            node = self.step(node << 8 | data[at + depth])
            depth += 1
            on = node >= 0
            at, node = at[on], node[on]
            token = self.token_at[node]
            some = token >= 0
            found.append((at[some], at[some] + depth, token[some]))
            on = at + depth < last[at]
            at, node = at[on], node[on]
        first, end, label = (np.concatenate(x) for x in zip(*found))
        return first, end, label

    def encoded(self, words: list[str]) -> list[bytes]:
        if self.arcs > TABLE_ARCS:
            self.rows, self.arcs = {}, 0
        spelled = [word.encode() for word in words]
        out: list[bytes] = [b""] * len(words)
        short = [i for i, w in enumerate(spelled) if 0 < len(w) <= LONG]
        for k in range(0, len(short), TOGETHER):
            some = short[k : k + TOGETHER]
            for i, ids in zip(some, self.together([spelled[i] for i in some])):
                out[i] = ids
        for i, w in enumerate(spelled):
            if len(w) > LONG:
                out[i] = array("I", self.ids(w)).tobytes()
        return out

    def text(self, ids: bytes) -> str:
        """The labels of the arcs, joined; bytes that are no UTF-8 become the replacement sign."""
        labels = self.label
        return b"".join([labels[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")
