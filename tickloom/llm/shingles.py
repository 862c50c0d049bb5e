"""Word shingles of whole texts as 64-bit hashes, computed over arrays of bytes."""

from __future__ import annotations

import numpy as np

#: ASCII white space.
SPACES = b"\t\n\x0b\x0c\r "
#: Bytes hashed at once; longer texts are cut between words.
SLICE = 1 << 17

_U = np.uint64
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUES = np.random.Generator(np.random.PCG64(20)).integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_VALUES[_IS_SPACE] = 0
_BYTE_VALUES = _VALUES[_LOWER]
_BASE = _U(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every input bit moves about half of the output bits."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_powers = np.cumprod(np.full(64, _BASE))


def _powers_to(n: int) -> np.ndarray:
    global _powers
    if n > len(_powers):
        _powers = np.cumprod(np.full(2 * n, _BASE))
    return _powers


def _slice_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    space = _IS_SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]])))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return starts, np.empty(0, np.uint64)
    size = np.diff(np.append(starts, len(data)))
    place = np.arange(starts[0], len(data)) - np.repeat(starts, size)
    terms = _BYTE_VALUES[data[starts[0] :]] * _powers_to(int(size.max()) + 1)[place]
    return starts, mix(np.add.reduceat(terms, starts - starts[0]) + (ends - starts).astype(np.uint64))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (letters A-Z count as small ones) and, for each text and the end, its first word's number."""
    data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    begins = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
    starts, hashes, low = [], [], 0
    while low < len(data):
        high = min(low + SLICE, len(data))
        while high < len(data) and not _IS_SPACE[data[high - 1]]:
            after = np.flatnonzero(_IS_SPACE[data[high : high + SLICE]])
            high = high + int(after[0]) + 1 if len(after) else min(high + SLICE, len(data))
        s, h = _slice_words(data[low:high])
        starts.append(s + low)
        hashes.append(h)
        low = high
    starts, hashes = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (starts, hashes))
    return hashes.astype(np.uint64), np.searchsorted(starts, begins)


def shingle_sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    """Each text's distinct shingles as sorted hashes; with fewer words than asked, the whole sequence is one shingle."""
    hashes, first = word_hashes([(t or "").encode() for t in texts])
    if len(hashes) >= words:
        n = len(hashes) - words + 1
        joined = np.full(n, _U(words))
        for k in range(words):
            joined = (joined + hashes[k : k + n]) * (_BASE + _U(2 * k))
            joined ^= joined >> _U(29)
        joined = mix(joined)
    out = []
    for low, high in zip(first[:-1], first[1:], strict=True):
        if high - low >= words:
            out.append(np.unique(joined[low : high - words + 1]))
        elif high > low:
            short = _U(high - low)
            for h in hashes[low:high]:
                with np.errstate(over="ignore"):
                    short = (short + h) * _BASE
                short ^= short >> _U(29)
            out.append(mix(np.array([short])))
        else:
            out.append(np.empty(0, np.uint64))
    return out
