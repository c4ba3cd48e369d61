"""Hashes of the words of many texts at once, as arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

# A to Z in lower case, and the white space that ends words.
LOWER = bytes(code + 32 if 65 <= code <= 90 else code for code in range(256))
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
_SPACES = (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")

_PART = 1 << 19
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def _powers(base: int, size: int) -> np.ndarray:
    steps = np.full(size, base, np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


_POWERS = _powers(_BASE, _PART + 1)
_INVERSES = _powers(pow(_BASE, -1, 1 << 64), _PART + 1)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Running sums of a polynomial in the bytes, from 0; of half a MiB at most."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(data * _POWERS[: len(data)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the bytes between ``starts`` and ``ends``, alike wherever they stand."""
    value = (sums[ends] - sums[starts]) * _INVERSES[starts]
    return mixed(value ^ mixed((ends - starts).astype(np.uint64)))


def _parts(data: bytes) -> Iterator[bytes]:
    """``data`` in parts of about half a MiB, cut at white space; a longer word is a part."""
    at = 0
    while len(data) - at > _PART:
        stop = at + _PART
        cut = max(data.rfind(space, at + 1, stop) for space in _SPACES)
        if cut <= 0:
            after = [data.find(space, stop) for space in _SPACES]
            cut = min((place for place in after if place >= 0), default=len(data))
        yield data[at:cut]
        at = cut
    yield data[at:]


def word_hashes(texts: list[bytes]) -> list[np.ndarray]:
    """For each text the hashes of its words, in order.

    Texts go through together in parts of about half a MiB, so memory stays bounded. A word
    that is longer is a part of its own, whose sum goes on from block to block.
    """
    found: list[np.ndarray] = []
    group: list[bytes] = []
    size = 0
    for text in texts:
        if size + len(text) > _PART and group:
            found += _group(group)
            group, size = [], 0
        if len(text) >= _PART:
            found.append(np.concatenate([_of_part(part) for part in _parts(text)]))
        else:
            group.append(text)
            size += len(text) + 1
    return found + (_group(group) if group else [])


def _of_part(part: bytes) -> np.ndarray:
    word = part.strip(b"".join(_SPACES))
    if len(word) <= _PART:
        # Not the part: it may be longer than the powers by the space before its word.
        return _group([word])[0]
    total, factor = 0, 1
    for at in range(0, len(word), _PART):
        block = np.frombuffer(word[at : at + _PART], np.uint8)
        total += factor * int(prefix_sums(block)[-1])
        factor = factor * int(_POWERS[_PART - 1]) * _BASE & _MASK
    value = np.array([total & _MASK], np.uint64)
    return mixed(value ^ mixed(np.array([len(word)], np.uint64)))


def _group(texts: list[bytes]) -> list[np.ndarray]:
    data = np.frombuffer(b" ".join(texts), np.uint8)
    space = np.concatenate(([True], _IS_SPACE[data], [True]))
    change = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = change[::2], change[1::2]
    sums = prefix_sums(data)
    hashes = span_hashes(sums, starts, ends)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    begins = np.cumsum(sizes + 1) - sizes - 1
    cuts = np.searchsorted(starts, begins[1:])
    return np.split(hashes, cuts)


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """The distinct hashes of runs of ``size`` words, sorted.

    Fewer words are one shingle together; no words have none.
    """
    if not len(words):
        return np.zeros(0, np.uint64)
    count = max(len(words) - size + 1, 1)
    value = np.full(count, min(size, len(words)), np.uint64)
    for step in range(min(size, len(words))):
        value = mixed(value * np.uint64(0x9E3779B97F4A7C15) + words[step : step + count])
    return np.unique(value)
