"""A run-compressed Burrows-Wheeler index of a set of strings, and the matching statistics that stream from it.

Strings are arrays of unsigned numbers (bytes, or codes of words); the largest number of their type ends a string and is no symbol. The suffixes of all strings are sorted (separators end a suffix; ties go by position). Only the ends of the transform's
runs are sampled: at a run's first row the longest common prefix with the row above, at its last row that with the row
below. Within a string, both lengths fall by one from a position to the next unless that position is sampled, so one pass
over the samples in text order gives, for every position, the longest match that it has anywhere else in the set.
"""

from __future__ import annotations

import numpy as np


class RunIndex:
    def __init__(self, strings: list[np.ndarray]):
        kind = strings[0].dtype
        self.end = end = np.array([np.iinfo(kind).max], kind)
        self.starts = np.cumsum([0] + [len(s) + 1 for s in strings])[:-1]
        t = self.text = np.concatenate([x for s in strings for x in (s, end)])
        n = self.n = len(t)
        ends = np.flatnonzero(t == end)
        self.left = (np.repeat(ends, np.diff(np.concatenate(([-1], ends)))) - np.arange(n)).astype(np.int32)
        # the first sort is by as many symbols as 64 bits hold
        per, bits = 8 // kind.itemsize, np.uint64(8 * kind.itemsize)
        padded = np.concatenate((t, np.repeat(end, per))).astype(np.uint64)
        key = np.zeros(n, np.uint64)
        for j in range(per):
            key = (key << bits) | padded[j : j + n]
        short = np.flatnonzero(self.left < per)
        key[short] |= np.uint64(0xFFFFFFFFFFFFFFFF) >> (self.left[short].astype(np.uint64) * bits)
        order = np.argsort(key)
        rank, tied = self.ranked(key[order], order, np.zeros(n, np.int32))
        self.levels: list[tuple[int, np.ndarray]] = [(per, rank)]
        h, longest = per, int(self.left.max(initial=0))
        while h < longest:
            # only suffixes that are still tied are sorted on, by the rank of what follows their first h bytes
            going = self.left[tied] >= h
            second = np.zeros(len(tied), np.int64)
            second[going] = rank[tied[going] + h] + 1
            key = rank[tied].astype(np.int64) * (n + 2) + second
            order = np.argsort(key)
            rank, tied = self.ranked(key[order], tied[order], rank)
            h *= 2
            self.levels.append((h, rank))
        order = self.order = np.argsort(rank, kind="stable")
        before = t[order - 1]  # end at the first of a string: its predecessor is a separator, or for the very first the last one
        change = np.concatenate(([True], (before[1:] != before[:-1]) | (before[1:] == end), [True]))
        self.heads, self.tails = np.flatnonzero(change[:-1]), np.flatnonzero(change[1:])

    def ranked(self, keys: np.ndarray, places: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks after a sort of some places, and the places that are still tied. A rank is the number of suffixes before its
        tie; places come in order of their ranks before and then of their keys."""
        n, rank = len(places), before.copy()
        if not n:
            return rank, places
        fresh = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        old = before[places]
        group = np.flatnonzero(np.concatenate(([True], old[1:] != old[:-1])))
        own = np.repeat(fresh, np.diff(np.append(fresh, n)))
        rank[places] = old + own - np.repeat(group, np.diff(np.append(group, n)))
        alone = np.diff(np.append(fresh, n)) == 1
        return rank, places[~np.repeat(alone, np.diff(np.append(fresh, n)))]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Lengths of the common prefixes of the suffixes at a and b; strings end at their separators."""
        a, b, out = a.copy(), b.copy(), np.zeros(len(a), np.int64)
        for h, rank in reversed(self.levels):
            for _ in range(2 if h == self.levels[-1][0] else 1):
                hit = (rank[a] == rank[b]) & (self.left[a] >= h) & (self.left[b] >= h)
                a, b, out = a + hit * h, b + hit * h, out + hit * h
        going = np.ones(len(a), bool)
        for _ in range(self.levels[0][0] - 1):
            going &= (self.left[a] > 0) & (self.left[b] > 0) & (self.text[a] == self.text[b])
            a, b, out = a + going, b + going, out + going
        return out

    def streamed(self, rows: np.ndarray, step: int) -> np.ndarray:
        """Of every position, the common prefix with the neighbour row, from samples at rows alone."""
        other = rows + step
        inside = (other >= 0) & (other < self.n)
        value, at = np.zeros(self.n, np.int32), np.zeros(self.n, np.int32)
        own = self.order[rows]
        value[own[inside]] = self.common(self.order[rows[inside]], self.order[other[inside]])
        at[own] = own
        last = np.maximum.accumulate(at)
        return value[last] - (np.arange(self.n, dtype=np.int32) - last)

    def matching_statistics(self) -> np.ndarray:
        """Of every position, the length of its longest match that starts anywhere else."""
        return np.maximum(self.streamed(self.heads, -1), self.streamed(self.tails, 1))


def long_matches(strings: list[bytes] | list[np.ndarray], length: int) -> list[np.ndarray]:
    """Of each string, which of its positions start a match of length or more."""
    if not strings:
        return []
    strings = [np.frombuffer(s, np.uint8) if isinstance(s, bytes) else s for s in strings]
    index = RunIndex(strings)
    hit = index.matching_statistics() >= length
    return [hit[s : s + len(x)] for s, x in zip(index.starts, strings, strict=True)]
