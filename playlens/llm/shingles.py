"""Hashes of word shingles for a batch of texts, with numpy over the bytes of the batch.

Words are runs of bytes without ASCII white space; a shingle is five words in a row.  A text
of one to four words has one shingle of all its words, a text without words has none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WIDTH = 5
#: Bytes hashed at once; a longer text is hashed in several steps.
STEP_BYTES = 2 << 20
#: Bits of a shingle's hash that are kept beside the number of its text.
HASH_BITS = 48
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0x5851F42D4C957F2D)
_PLACES = np.array([pow(0xD1342543DE82EF95, k + 1, 2**64) for k in range(WIDTH)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit integers (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def word_hashes(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word; ``begins``: first bytes of texts, where words end."""
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    fresh = np.empty(len(data), bool)
    fresh[0], fresh[1:] = True, blank[:-1]
    fresh[begins] = True
    first = np.flatnonzero(fresh & ~blank)
    if not len(first):
        return np.empty(0, np.uint64), first
    own = np.diff(first, append=len(data))
    place = np.arange(first[0], len(data)) - np.repeat(first, own)
    values = data[first[0] :].astype(np.uint64) + np.uint64(1)
    values[blank[first[0] :]] = 0
    # trailing blanks of a word are zero, so only their number matters, which is the same for none
    hashes = np.add.reduceat(values * _powers(int(own.max()))[place], first - first[0])
    return mix(hashes + _GOLDEN), first


def steps(data: np.ndarray, begins: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cuts the bytes before a word: behind white space or where a text begins."""
    at = 0
    while at < len(data):
        end = at + STEP_BYTES
        if end < len(data):
            blanks = np.flatnonzero((data[at:end] == 32) | ((data[at:end] >= 9) & (data[at:end] <= 13)))
            cuts = begins[(begins > at) & (begins <= end)]
            best = max(blanks[-1] + 1 + at if len(blanks) else 0, cuts[-1] if len(cuts) else 0)
            if best <= at:  # one word longer than a step
                rest = data[end:]
                far = np.flatnonzero((rest == 32) | ((rest >= 9) & (rest <= 13)))
                later = begins[begins > end]
                best = min(far[0] + 1 + end if len(far) else len(data), later[0] if len(later) else len(data))
            end = int(best)
        end = min(end, len(data))
        yield at, end
        at = end


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The shingle hashes (64 bits) of all texts in order, and how many each text has."""
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.empty(0, np.uint8)
    begins = offsets[:-1] - offsets[0]
    hashes, firsts = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for a, b in steps(data, begins):
        inside = begins[(begins >= a) & (begins < b)] - a
        found, first = word_hashes(data[a:b], inside)
        hashes.append(found)
        firsts.append(first + a)
    words, first = np.concatenate(hashes), np.concatenate(firsts)
    bounds = np.searchsorted(first, np.append(begins, len(data)))
    counts = np.diff(bounds)
    if not len(words):
        return words, counts
    sums = np.zeros(len(words), np.uint64)
    for k in range(WIDTH):
        sums[: len(words) - k] += words[k:] * _PLACES[k]
    place = np.arange(len(words)) - np.repeat(bounds[:-1], counts)
    left = np.repeat(counts, counts) - place
    whole = left >= WIDTH
    for i in np.flatnonzero((counts > 0) & (counts < WIDTH)).tolist():
        at, size = bounds[i], int(counts[i])
        sums[at] = (words[at : at + size] * _PLACES[:size]).sum(dtype=np.uint64) + np.uint64(size)
        whole[at] = True
    made = np.where(counts >= WIDTH, counts - WIDTH + 1, np.minimum(counts, 1))
    return mix(sums[whole]), made


def distinct(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text the distinct hashes, ascending: (number of the text, hash of 48 bits, how often)."""
    if len(counts) >= 1 << (64 - HASH_BITS):
        raise ValueError("too many texts at once")
    text = np.repeat(np.arange(len(counts), dtype=np.uint64), counts)
    keyed = np.sort((text << np.uint64(HASH_BITS)) | (hashes >> np.uint64(64 - HASH_BITS)))
    first = np.flatnonzero(np.diff(keyed, prepend=keyed[:1] ^ np.uint64(1)) != 0) if len(keyed) else np.empty(0, int)
    often = np.diff(first, append=len(keyed))
    keyed = keyed[first]
    return (keyed >> np.uint64(HASH_BITS)).astype(np.int64), keyed & np.uint64((1 << HASH_BITS) - 1), often
