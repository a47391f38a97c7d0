"""Hashes of the words of many texts at once, and the five-word shingles made of them."""

from __future__ import annotations

import re

import numpy as np

SHINGLE = 5
BASE = 0x9E3779B97F4A7C15
#: Bytes of one text that are hashed at a time.
LONG = 1 << 20
_BREAK = re.compile(rb"[ \t-\r]")
_POWERS = [np.uint64(pow(BASE, j + 1, 1 << 64)) for j in range(SHINGLE)]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"): ord("Z") + 1] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and owner of each run of bytes that are not space or 09 to 0D, in order.

    A word's code is the sum of its bytes times powers of an odd number, freed of its place by the inverse
    power; no word crosses from one owner to the next.
    """
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    inside = ~_SPACE[data]
    edge = np.ones(len(data), bool)
    edge[1:] = owner[1:] != owner[:-1]
    starts = inside & edge
    starts[1:] |= inside[1:] & ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= edge[1:] | ~inside[1:]
    first, last = np.flatnonzero(starts), np.flatnonzero(ends)
    with np.errstate(over="ignore"):
        up = np.full(len(data), np.uint64(BASE))
        down = np.full(len(data), np.uint64(pow(BASE, -1, 1 << 64)))
        up[0] = down[0] = 1
        np.cumprod(up, out=up)
        np.cumprod(down, out=down)
        up *= data.astype(np.uint64) + np.uint64(1)
        total = np.concatenate([[np.uint64(0)], np.cumsum(up)])
        return mixed((total[last + 1] - total[first]) * down[first]), owner[first]


def joined_bytes(values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts behind each other, and the number of the text that each byte belongs to."""
    owner = np.repeat(np.arange(len(values), dtype=np.int32), [len(v) for v in values])
    return np.frombuffer(b"".join(values), np.uint8), owner


def stretches(data: bytes) -> list[bytes]:
    """Parts of about LONG bytes that end after white space (a word longer than that is one part)."""
    out, start = [], 0
    while len(data) - start > LONG:
        found = _BREAK.search(data, start + LONG)
        end = found.end() if found else len(data)
        out.append(data[start:end])
        start = end
    return [*out, data[start:]]


def _words_of(data: bytes) -> np.ndarray:
    """Word hashes of one text, a stretch at a time."""
    found = [np.frombuffer(part, np.uint8) for part in stretches(data)]
    return np.concatenate([word_hashes(_LOWER[part], np.zeros(len(part), np.int8))[0] for part in found])


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """Sorted distinct hashes of the five-word shingles of each text, A to Z lower-cased.

    A text of one to four words has its whole sequence as one shingle; a text without words has none.
    """
    values = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data, owner = joined_bytes([v if len(v) <= LONG else b"" for v in values])
    words, of = word_hashes(_LOWER[data], owner)
    n = np.bincount(of, minlength=len(texts)) if len(of) else np.zeros(len(texts), np.int64)
    begin = np.concatenate([[0], np.cumsum(n)])
    whole = _shingles(words)
    out = []
    for i, value in enumerate(values):
        if len(value) > LONG:
            out.append(_set_of(own := _words_of(value), _shingles(own)))
        else:
            lo, hi = int(begin[i]), int(begin[i + 1])
            out.append(_set_of(words[lo:hi], whole[lo: max(lo, hi - SHINGLE + 1)]))
    return out


def _shingles(words: np.ndarray) -> np.ndarray:
    n = max(0, len(words) - SHINGLE + 1)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for j, power in enumerate(_POWERS):
            out += words[j: j + n] * power
    return mixed(out)


def _set_of(words: np.ndarray, shingles: np.ndarray) -> np.ndarray:
    if len(words) >= SHINGLE or not len(words):
        return np.unique(shingles)
    code = np.uint64(len(words))
    with np.errstate(over="ignore"):
        for word, power in zip(words, _POWERS):
            code = code + word * power
    return mixed(np.array([code ^ np.uint64(BASE)], np.uint64))
