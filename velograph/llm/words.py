"""Hashes of the words of UTF-8 text, vectorised. A word is what stands between white space, ASCII letters in lower case."""

from __future__ import annotations

import re

import numpy as np

#: Bytes of text hashed at once.
CHUNK = 1 << 20

_U = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
GAP = re.compile(rb"[\x20\x09-\x0D]")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


BYTE_CODE = mixed(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
POWERS = np.cumprod(np.full(1 << 16, 0xD6E8FEB86659FD93, _U))


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Of each word of lower-cased text: its hash and where it starts."""
    b = LOWER[np.frombuffer(raw, np.uint8)]
    space = SPACE[b]
    edge = np.diff(np.concatenate(([True], space, [True])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(starts):
        return np.zeros(0, _U), starts
    place = np.zeros(len(b), np.int64)
    place[starts[0] :] = np.arange(starts[0], len(b)) - np.repeat(starts, np.diff(np.append(starts, len(b))))
    code = BYTE_CODE[b] * POWERS[place & 0xFFFF] * ((place >> 16).astype(_U) * _U(2) + _U(1))
    code[space] = 0
    return mixed(np.add.reduceat(code, starts) + (ends - starts).astype(_U)), starts


def hash_words(raw: bytes) -> np.ndarray:
    """The hashes of a text's words, in order; a long text is hashed in parts that end at white space."""
    parts, at = [], 0
    while len(raw) - at > 4 * CHUNK and (gap := GAP.search(raw, at + 2 * CHUNK)):
        parts.append(word_hashes(raw[at : gap.start()])[0])
        at = gap.start()
    parts.append(word_hashes(raw[at:])[0])
    return np.concatenate(parts)


def hash_each(texts: list[bytes]) -> list[np.ndarray]:
    """hash_words() of each text, many short ones at once."""
    out: list[np.ndarray] = []
    start = 0
    while start < len(texts):
        end, size = start, 0
        while end < len(texts) and (end == start or size + len(texts[end]) < CHUNK):
            size += len(texts[end]) + 1
            end += 1
        if end == start + 1:
            out.append(hash_words(texts[start]))
        else:
            hashes, starts = word_hashes(b"\n".join(texts[start:end]))
            ends = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts[start:end]]))
            out += [hashes[a:z] for a, z in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]
        start = end
    return out
