"""Word shingles of many texts at once, as 64-bit hashes, computed on UTF-8 bytes.

Words are runs of bytes other than blanks, tabs and line ends, with A to Z in lower case. A
shingle is five words in a row; a text of one to four words is one shingle as a whole.
"""

from __future__ import annotations

import numpy as np

WORDS = 5

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _series(start: int, count: int) -> np.ndarray:
    return mix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(start))


_BYTE = _series(1, 256)
_PLACE = _series(2, WORDS) | np.uint64(1)
_SHORT = _series(3, WORDS)
_BASE = np.uint64(0x2545F4914F6CDD1D)


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash per word, and the number of words per text."""
    texts = len(offsets) - 1
    inside = ~_SPACE[raw]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    firsts = offsets[:-1][offsets[1:] > offsets[:-1]]
    begins[firsts] = inside[firsts]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(texts, np.int64)
    at = np.flatnonzero(inside)
    first = np.flatnonzero(begins[at])
    length = np.diff(first, append=len(at))
    place = np.arange(len(at)) - np.repeat(first, length)
    powers = np.cumprod(np.full(int(length.max()), _BASE, np.uint64))
    hashed = np.add.reduceat(_BYTE[_LOWER[raw[at]]] * powers[place], first)
    count = np.bincount(np.searchsorted(offsets, starts, side="right") - 1, minlength=texts)
    return mix(hashed + length.astype(np.uint64)), count


def shingle_sets(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different shingles of every text, ascending within a text, and their number per text."""
    return weighed_sets(raw, offsets, lambda words: np.zeros(len(words), np.int64))[:2]


def weighed_sets(raw: np.ndarray, offsets: np.ndarray, weigh) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``shingle_sets``, with the sum of its words' weights for every shingle.

    ``weigh`` gives whole numbers for hashes of words, so a shingle has one weight in all texts.
    """
    words, count = word_hashes(raw, offsets)
    if not len(words):
        return np.zeros(0, np.uint64), count, np.zeros(0, np.int64)
    weights = weigh(words)
    weight = np.zeros(len(words), np.int64)
    ends = np.cumsum(count)
    text = np.repeat(np.arange(len(count)), count)
    left = np.repeat(ends, count) - np.arange(len(words))  # words from here to the text's end
    total = np.zeros(len(words), np.uint64)
    for k in range(min(WORDS, len(words))):
        inside = left[: len(words) - k] > k
        total[: len(words) - k] += np.where(inside, words[k:] * _PLACE[k], np.uint64(0))
        weight[: len(words) - k] += np.where(inside, weights[k:], 0)
    # Whole windows, and the only window of a short text, marked by its number of words.
    size = count[text]
    first = left == size
    total += np.where(size < WORDS, _SHORT[np.minimum(size, WORDS) - 1], np.uint64(0))
    taken = (left >= WORDS) | (first & (size < WORDS))
    text, total, weight = text[taken], mix(total[taken]), weight[taken]
    order = np.lexsort((total, text))
    text, total, weight = text[order], total[order], weight[order]
    fresh = np.ones(len(text), bool)
    fresh[1:] = (text[1:] != text[:-1]) | (total[1:] != total[:-1])
    return total[fresh], np.bincount(text[fresh], minlength=len(count)), weight[fresh]


def signatures(sets: np.ndarray, count: np.ndarray) -> np.ndarray:
    """One 64-bit hash per set, whatever the order of its members."""
    total = np.zeros(len(sets) + 1, np.uint64)
    np.cumsum(mix(sets ^ np.uint64(0xA5A5A5A5A5A5A5A5)), out=total[1:])
    ends = np.cumsum(count)
    return mix(total[ends] - total[ends - count] + count.astype(np.uint64))
