"""Suffix automaton of a shard of reference texts, built and walked by array operations.

A state is the set of ends at which a string stands. With all prefixes of the references sorted by their characters from
right to left, every such set is a range of that order, so a state is a range [a, b): the whole order for the empty string.
Appending a character is two binary searches among the prefixes by (last character, prefix before it). A suffix link leads to
the smallest wider range, found from the lengths of the common endings of neighbours in the order.
"""

from __future__ import annotations

import numpy as np


def _codes(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def _smaller_before(v: np.ndarray) -> np.ndarray:
    """For each position the last one before it with a smaller value; v[0] is smaller than all others."""
    p = np.maximum(np.arange(len(v)) - 1, 0)
    todo = np.arange(1, len(v))
    while len(todo := todo[v[p[todo]] >= v[todo]]):
        p[todo] = p[p[todo]]
    return p


class ShardAutomaton:
    """The automaton of ``texts`` (none empty); text i stands in documents from lo[i] to hi[i] at the ends."""

    def __init__(self, texts: list[str], lo: np.ndarray, hi: np.ndarray):
        size = np.array([len(t) for t in texts], dtype=np.int64)
        self.alphabet, symbol = np.unique(_codes(texts), return_inverse=True)
        before = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)  # characters before each one in its text
        # ranks of the last 1, 2, 4, ... characters of every prefix; 0 stands for "no character"
        levels = [(symbol + 1).astype(np.int32)]
        reach = 1
        while reach < size.max(initial=0):
            last = levels[-1].astype(np.int64)
            earlier = np.zeros_like(last)
            has = np.flatnonzero(before >= reach)
            earlier[has] = last[has - reach]
            levels.append((np.unique(last * (last.max() + 1) + earlier, return_inverse=True)[1] + 1).astype(np.int32))
            reach *= 2
        self.rank = levels[-1]  # of whole prefixes; 0 is the empty one
        self.n = n = int(self.rank.max(initial=0)) + 1
        at = np.zeros(n, dtype=np.int64)  # a position that ends the prefix of each rank
        at[self.rank] = np.arange(len(self.rank))
        source = np.where(before[at[1:]] > 0, self.rank[at[1:] - 1], 0).astype(np.int64)
        self.edges = symbol[at[1:]].astype(np.int64) * (n + 1) + source  # in order of rank, hence sorted
        # common endings of neighbours in the order; below all at both ends
        common = np.full(n + 1, -1, dtype=np.int64)
        x, y, shared = at[1:-1].copy(), at[2:].copy(), np.zeros(max(0, n - 2), dtype=np.int64)
        left_x, left_y = before[x] + 1, before[y] + 1
        for j in range(len(levels) - 1, -1, -1):
            same = np.flatnonzero((left_x > 0) & (left_y > 0))
            same = same[levels[j][x[same]] == levels[j][y[same]]]
            for v in (x, y, left_x, left_y):
                v[same] -= 1 << j
            shared[same] += 1 << j
        common[1:n], common[2:n] = 0, shared
        self.common = common
        self.lower = _smaller_before(common[:n])
        self.upper = np.concatenate([[n], (n - _smaller_before(common[:0:-1]))[::-1]])
        # the one document of each prefix, and how far in the order it is the only one
        low, high = np.full(n, np.iinfo(np.int64).max), np.full(n, np.iinfo(np.int64).min)
        np.minimum.at(low, self.rank, np.repeat(lo, size))
        np.maximum.at(high, self.rank, np.repeat(hi, size))
        self.owner, self.owned = low, (low == high)
        edge = np.flatnonzero(np.concatenate([[True], (low[1:] != low[:-1]) | ~self.owned[1:] | ~self.owned[:-1]]))
        self.owner_end = np.repeat(np.concatenate([edge[1:], [n]]), np.diff(np.concatenate([edge, [n]])))

    def link(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The states' suffix links and the lengths of their longest strings."""
        va, vb = self.common[a], self.common[b]
        longest = np.maximum(va, vb)
        return np.where(va == longest, self.lower[a], a), np.where(vb == longest, self.upper[b], b), longest

    def long_matches(self, texts: list[str], own: np.ndarray, apart: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, begin, end) of the longest runs of positions in matches of at least ``least`` characters.

        The matching statistic at each position is the length of the longest string ending there that stands in a reference
        of a document other than own[i] (of any document where apart[i] is false). All texts advance together, one
        character at a time, so that a step is a handful of array operations.
        """
        size = np.array([len(t) for t in texts], dtype=np.int64)
        order = np.argsort(-size, kind="stable")
        first = (np.cumsum(size) - size)[order]
        codes = _codes(texts)
        place = np.minimum(np.searchsorted(self.alphabet, codes), len(self.alphabet) - 1)
        symbol = np.where(self.alphabet[place] == codes, place, -1)
        own, apart = own[order], apart[order]
        a, b, length = np.zeros(len(texts), np.int64), np.full(len(texts), self.n, np.int64), np.zeros(len(texts), np.int64)
        running, begin = np.zeros(len(texts), bool), np.zeros(len(texts), np.int64)
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        live = len(texts)
        for t in range(int(size.max(initial=0))):
            ended = live
            while live and size[order[live - 1]] <= t:
                live -= 1
            done = live + np.flatnonzero(running[live:ended])
            out.append((done, begin[done], size[order[done]]))
            running[live:ended] = False
            s = symbol[first[:live] + t]
            todo = np.arange(live)
            while len(todo):
                na = np.searchsorted(self.edges, s[todo] * (self.n + 1) + a[todo]) + 1
                nb = np.searchsorted(self.edges, s[todo] * (self.n + 1) + b[todo]) + 1
                ok = (na < nb) & (s[todo] >= 0)
                good = todo[ok]
                a[good], b[good] = na[ok], nb[ok]
                length[good] += 1
                todo = todo[~ok]
                a[todo[length[todo] == 0]], b[todo[length[todo] == 0]] = 0, self.n
                todo = todo[length[todo] > 0]
                if len(todo):
                    a[todo], b[todo], length[todo] = self.link(a[todo], b[todo])
            todo = np.flatnonzero(apart[:live])
            while len(todo := todo[self.owned[a[todo]] & (self.owner[a[todo]] == own[todo]) & (self.owner_end[a[todo]] >= b[todo])]):
                a[todo], b[todo], length[todo] = self.link(a[todo], b[todo])
            long = length[:live] >= least
            starts = np.flatnonzero(long & ~running[:live])
            begin[starts] = t - length[starts] + 1
            stops = np.flatnonzero(running[:live] & ~long)
            out.append((stops, begin[stops], np.full(len(stops), t)))
            running[:live] = long
        done = np.flatnonzero(running)
        out.append((done, begin[done], size[order[done]]))
        which, begins, ends = (np.concatenate(x) if out else np.empty(0, np.int64) for x in zip(*out, strict=True))
        return order[which], begins.astype(np.int32), ends.astype(np.int32)
