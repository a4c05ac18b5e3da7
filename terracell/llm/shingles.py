"""Word shingles as sets of 64-bit hashes, for whole batches at once."""

from __future__ import annotations

import numpy as np

U = np.uint64
#: Odd multipliers of the polynomial and of the mixers (fixed: links must not change between runs).
BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(BASE, -1, 1 << 64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _powers(base: int, n: int) -> np.ndarray:
    found = np.ones(n, dtype=np.uint64)
    if n > 1:
        found[1:] = U(base)
        np.multiply.accumulate(found, out=found)
    return found


def word_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every word of texts data[starts[i]:stops[i]], in order; A-Z count as a-z.

    starts and stops are those of adjoining texts, ascending. Words are
    maximal runs of bytes other than 0x20 and 0x09 to 0x0D.
    """
    if not len(starts):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    first, last = int(starts[0]), int(stops[-1])
    body = data[first:last].copy()
    starts, stops = starts - first, stops - first
    upper = (body >= 65) & (body <= 90)
    body[upper] += 32
    inside = ~((body == 32) | ((body >= 9) & (body <= 13)))
    # A word starts where a text or a space ends.
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = starts[starts < stops]
    begins[edges] = inside[edges]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    edges = stops[starts < stops] - 1
    ends[edges] = inside[edges]
    at, to = np.flatnonzero(begins), np.flatnonzero(ends)
    length = to - at + 1
    if not len(at):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    # Sum of byte * BASE ** place over the word, then divided by BASE ** start (all modulo 2 ** 64).
    span = 1 << 16
    found = np.empty(len(at), dtype=np.uint64)
    values = mixed(np.arange(256, dtype=np.uint64) + U(0x632BE59BD9B4E019))
    powers = _powers(BASE, span)
    inverse = _powers(_INVERSE, span)
    total = np.zeros(len(body) + 1, dtype=np.uint64)
    for low in range(0, len(body), span):
        piece = body[low : low + span]
        np.add.accumulate(values[piece] * powers[: len(piece)], out=total[low + 1 : low + 1 + len(piece)])
    # total restarts at each span, so a word across a border is put together from two spans.
    low = at // span
    same = to // span == low
    head = np.where(at % span == 0, U(0), total[at])
    found = (total[to + 1] - head) * inverse[at % span]
    for w in np.flatnonzero(~same):
        h, place = 0, 0
        for b in values[body[at[w] : to[w] + 1]].tolist():
            h = (h + b * pow(BASE, place, 1 << 64)) & 0xFFFFFFFFFFFFFFFF
            place += 1
        found[w] = h
    text = np.searchsorted(stops, at, side="right")
    return text, mixed(found ^ (length.astype(np.uint64) * U(0xD6E8FEB86659FD93)))


def shingle_sets(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every distinct shingle of each text, by text and hash.

    A text of fewer words than a shingle has its whole sequence as its one
    shingle; a text without words has none.
    """
    text, h = word_hashes(data, starts, stops)
    n = len(text)
    if not n:
        return text, h
    count = np.bincount(text, minlength=len(starts))
    sizes = np.minimum(count, words)
    # Fold as many words as the text's shingles have, from the left.
    place = np.arange(n)
    firsts = np.concatenate(([0], np.cumsum(count)[:-1]))
    whole = place - firsts[text] <= count[text] - sizes[text]
    at = place[whole]
    size = sizes[text[at]]
    folded = mixed(h[at] + U(1))
    for k in range(1, words):
        more = size > k
        folded[more] = mixed(folded[more] * U(0x9FB21C651E98DF25) + h[at[more] + k])
    text = text[at]
    folded = mixed(folded ^ (size.astype(np.uint64) << U(56)))
    order = np.lexsort((folded, text))
    text, folded = text[order], folded[order]
    keep = np.ones(len(text), dtype=bool)
    keep[1:] = (text[1:] != text[:-1]) | (folded[1:] != folded[:-1])
    return text[keep], folded[keep]
