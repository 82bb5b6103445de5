"""Two-stage suffix sorting of many short byte strings, with common prefixes of neighbours."""

from __future__ import annotations

import numpy as np


def _words(s: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one big-endian number; the string is taken to go on with zeros."""
    padded = np.concatenate([s, np.zeros(8, "u1")])
    w = np.zeros(len(s) + 1, "u8")
    for k in range(8):
        w |= padded[k : k + len(w)].astype("u8") << np.uint64(56 - 8 * k)
    return w


class Suffixes:
    """Suffixes of strings that lie one after another in ``s``; string j ends before ``ends[j]``, which is also where the next begins.

    A suffix ends with its string. Orders and prefixes count the first ``depth`` bytes.
    """

    def __init__(self, s: np.ndarray, ends: np.ndarray, depth: int):
        self.s, self.depth = s, depth
        self.end = np.repeat(ends, np.diff(ends, prepend=0))  # of each place's string
        self.words = _words(s)

    def word(self, at: np.ndarray, k: int) -> np.ndarray:
        """Bytes 8 k to 8 k + 7 of each suffix, zeros beyond its end and beyond ``depth``."""
        place = at + 8 * k
        left = np.minimum(self.end[at] - place, self.depth - 8 * k)
        w = self.words[np.minimum(place, len(self.s))]
        cut = np.uint64(8) * (8 - np.clip(left, 0, 8)).astype("u8")
        return np.where(left <= 0, 0, w >> np.minimum(cut, 63) << np.minimum(cut, 63))

    def smaller_than_next(self) -> np.ndarray:
        """Which suffixes are smaller than the one a byte later. A string's end is smaller than any suffix."""
        s, n = self.s, len(self.s)
        if not n:
            return np.zeros(0, bool)
        last = np.arange(1, n + 1) == self.end
        rises = np.zeros(n, bool)
        rises[:-1] = s[:-1] < s[1:]
        decided = last.copy()
        decided[:-1] |= s[:-1] != s[1:]
        # In a run of equal bytes all are as the run's last one.
        at = np.where(decided, np.arange(n), n)
        at = np.minimum.accumulate(at[::-1])[::-1]
        return rises[at] & ~last[at]

    def direct(self, at: np.ndarray) -> np.ndarray:
        """``at`` in the order of its suffixes: sorted by eight bytes at a time, from the second round on only where tied."""
        if not len(at):
            return at
        first = self.word(at, 0)
        order = np.argsort(first, kind="stable")
        out, keys = at[order], first[order]
        group = np.cumsum(np.diff(keys, prepend=keys[:1]) != 0)
        for k in range(1, -(-self.depth // 8)):
            same = np.zeros(len(out), bool)
            same[1:] = group[1:] == group[:-1]
            same[:-1] |= same[1:]
            tied = np.flatnonzero(same)
            if not len(tied):
                break
            w = self.word(out[tied], k)
            order = np.lexsort((w, group[tied]))
            out[tied], w = out[tied][order], w[order]
            new = np.ones(len(out), bool)
            new[1:] = group[1:] != group[:-1]
            differs = np.ones(len(tied), bool)
            differs[1:] = (w[1:] != w[:-1]) | (group[tied][1:] != group[tied][:-1])
            new[tied] |= differs
            group = np.cumsum(new)
        return out

    def order(self, wanted: np.ndarray) -> np.ndarray:
        """The places for which ``wanted`` holds, in the order of their suffixes.

        Only suffixes smaller than their successors are sorted directly. Every other one is induced: buckets of first bytes are
        scanned from the smallest, each first through its induced suffixes, then through its sorted ones, and the suffix a byte
        before the scanned one takes the next place of its own bucket. Behind the last wanted suffix of a string the
        scan needs the suffixes up to the next sorted one, or to the string's end, and no more.
        """
        s, n = self.s, len(self.s)
        small = self.smaller_than_next()
        need = wanted.copy()
        stop = np.where(small, np.arange(n), n)
        stop = np.minimum(np.minimum.accumulate(stop[::-1])[::-1] if n else stop, self.end - 1)
        ends = np.flatnonzero(wanted & ~np.append(wanted[1:], False))
        change = np.zeros(n + 1, "i8")
        np.add.at(change, ends, 1)
        np.add.at(change, stop[ends] + 1, -1)
        need |= np.cumsum(change)[:n] > 0
        sorted_ = self.direct(np.flatnonzero(need & small))
        bounds = np.searchsorted(s[sorted_], np.arange(257))
        induced = need & ~small
        pending: list[list[np.ndarray]] = [[] for _ in range(256)]

        def before(at: np.ndarray) -> np.ndarray:
            at = at[at > 0] - 1
            return at[induced[at]]

        def deal(at: np.ndarray) -> None:
            byte = s[at]
            order = np.argsort(byte, kind="stable")
            at, byte = at[order], byte[order]
            cuts = np.flatnonzero(np.diff(byte)) + 1
            for part in np.split(at, cuts) if len(at) else ():
                pending[s[part[0]]].append(part)

        whole = np.unique(self.end[need]) if n else np.zeros(0, "i8")
        deal(before(whole))  # the empty suffixes, which are smallest
        out = []
        for c in range(256):
            wave = np.concatenate(pending[c]) if pending[c] else np.zeros(0, "i8")
            waves = []
            while len(wave):  # runs of the byte itself
                waves.append(wave)
                p = before(wave)
                p = p[self.end[p] == self.end[np.minimum(p + 1, n - 1)]]
                wave = p[s[p] == c]
            scanned = np.concatenate([*waves, sorted_[bounds[c] : bounds[c + 1]]])
            if len(scanned):
                out.append(scanned)
                p = scanned[scanned > 0]
                p = p[self.end[p - 1] == self.end[p]] - 1
                p = p[induced[p]]
                deal(p[s[p] > c])
        places = np.concatenate(out) if out else np.zeros(0, "i8")
        return places[wanted[places]]

    def common(self, at: np.ndarray) -> np.ndarray:
        """How many bytes, up to ``depth``, each suffix of ``at`` has in common with the one before it; 0 for the first."""
        got = np.zeros(len(at), "i8")
        open_ = np.arange(1, len(at))
        for k in range(-(-self.depth // 8)):
            if not len(open_):
                break
            a, b = at[open_ - 1], at[open_]
            x = self.word(a, k) ^ self.word(b, k)
            left = np.minimum(np.minimum(self.end[a] - a, self.end[b] - b), self.depth) - 8 * k
            equal = np.full(len(open_), 8, "i8")
            for j in range(7, -1, -1):
                equal[(x >> np.uint64(56 - 8 * j)) != 0] = j
            equal = np.minimum(equal, np.maximum(left, 0))
            got[open_] += equal
            open_ = open_[equal == 8]
        return got
