"""Plain Python versions of what the operators compute."""

from __future__ import annotations

import re
from collections import Counter

BLANK = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text: str | None) -> set[tuple[str, ...]]:
    words = BLANK.findall(text or "")
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)}


def jaccard(a: set, b: set) -> float:
    return len(a & b) / len(a | b) if a | b else 1.0


def near_classes(docs: list[tuple[int, str | None]], similarity: float = 0.8) -> dict[int, int]:
    """Smallest id of each document's class, all pairs compared through an inverted index."""
    parent = {d: d for d, _ in docs}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def join(a, b):
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)

    first: dict[str, int] = {}
    sets, having = {}, {}
    for d, text in docs:
        if text is None:
            continue
        if text in first:
            join(d, first[text])
            continue
        first[text] = d
        sets[d] = shingle_set(text)
        shared = Counter(o for s in sets[d] for o in having.get(s, ()))
        for o, n in shared.items():
            if n >= similarity * (len(sets[d]) + len(sets[o]) - n):
                join(d, o)
        for s in sets[d]:
            having.setdefault(s, []).append(d)
    return {d: find(d) for d, _ in docs}


def deduped(docs: list[tuple[int, str | None]]) -> dict[int, str | None]:
    seen, out = set(), {}
    for d, text in sorted(docs, key=lambda x: x[0]):
        if text is None:
            out[d] = None
            continue
        lines = text.split("\n")
        full = [i for i, x in enumerate(lines) if x.strip(" \t\r")]
        lost = set()
        for a, b, c in zip(full, full[1:], full[2:]):
            window = tuple(lines[i].strip(" \t\r") for i in (a, b, c))
            if window in seen:
                lost |= {a, b, c}
            seen.add(window)
        out[d] = "\n".join(x for i, x in enumerate(lines) if i not in lost)
    return out


def targets(sizes: dict, weights=(5, 2, 1), most=3) -> dict:
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while len(fixed) < len(order):
        level = (total - sum(fixed.values())) / sum(weight[s] for s in order if s not in fixed)
        over = {s: most * sizes[s] for s in order if s not in fixed and level * weight[s] > most * sizes[s]}
        if not over:
            return {s: fixed.get(s, level * weight[s]) for s in order}
        fixed |= over
    return fixed
