"""Similarity by longest common subsequence (normalised indel), bit-parallel, over Arrow batches.

``lcs``, ``ratio`` and ``partial_ratio`` say what is computed for one pair; ``ratios`` and ``partial_ratios`` give the same numbers
for many pairs by array operations, where all pairs and all windows advance together, one character at a time.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _places(a: str) -> dict[str, int]:
    """The places of each character of a, as the bits of an integer."""
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | (1 << i)
    return where


def _lcs_with(where: dict[str, int], n: int, b: str) -> int:
    """Length of the longest common subsequence of b and a text of n characters with these places; the bit vector is one integer,
    updated once for each character of b."""
    full = (1 << n) - 1
    state = full
    for c in b:
        if hit := state & where.get(c, 0):
            state = ((state + hit) | (state - hit)) & full
    return n - state.bit_count()


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence."""
    if len(a) > len(b):
        a, b = b, a
    return _lcs_with(_places(a), len(a), b)


def ratio(a: str, b: str) -> float:
    """100 * 2 * lcs / (lengths); two empty texts are equal."""
    if a == b:
        return 100.0
    total = len(a) + len(b)
    return 200.0 * lcs(a, b) / total if total else 100.0


def partial_ratio(a: str, b: str, cutoff: float = 0.0) -> float:
    """The best ratio of the shorter text against the windows of its length in the longer one, windows cut off at the ends
    included; 0 where one of two is empty or nothing reaches the cutoff.

    The characters that short text and window share, order aside, bound the score; that bound moves with the window in
    constant time, and only windows whose bound can still win are compared.
    """
    if not a or not b:
        return 100.0 if a == b else 0.0
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    if short in long:
        return 100.0
    n, size, best = len(short), len(long), 0.0
    where, need = _places(short), Counter(short)
    common, left = 0, dict(need)
    for end in range(1, size + n):
        if end <= size and (c := long[end - 1]) in left:
            if left[c] > 0:
                common += 1
            left[c] -= 1
        if end > n and (c := long[end - n - 1]) in left:
            left[c] += 1
            if left[c] > 0:
                common -= 1
        lo, hi = max(0, end - n), min(end, size)
        bound = 200.0 * common / (n + hi - lo)
        if bound <= best or bound < cutoff:
            continue
        best = max(best, 200.0 * _lcs_with(where, n, long[lo:hi]) / (n + hi - lo))
    return best if best >= cutoff else 0.0


ROOM = 600_000  # windows times words handled at a time
WIDE = 2  # short texts of more words are compared one by one, as whole integers: their steps are many and their pairs few
ALPHABET = 56  # characters counted one by one in the bound; rarer ones count together


def _flat(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(characters of all texts, the text of each, its place there)."""
    size = np.array([len(t) for t in texts], dtype=np.int64)
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    of = np.repeat(np.arange(len(texts)), size)
    return codes, of, np.arange(len(codes)) - np.repeat(np.cumsum(size) - size, size)


def _masks(shorts: Sequence[str], longs: Sequence[str], words: int) -> np.ndarray:
    """For each character of the longs, by words of 64 bits: the places of that character in the short text of its pair."""
    codes, of, place = _flat(shorts)
    key = (of << 21) | codes
    order = np.argsort(key, kind="stable")
    known, first = np.unique(key[order], return_index=True)
    long_codes, long_of, _ = _flat(longs)
    asked = (long_of << 21) | long_codes
    at = np.minimum(np.searchsorted(known, asked), len(known) - 1)
    hit = known[at] == asked
    bit = np.uint64(1) << (place & 63).astype(np.uint64)
    out = np.zeros((words, len(asked)), dtype=np.uint64)
    for w in range(words):
        table = np.bitwise_or.reduceat(np.where(place >> 6 == w, bit, np.uint64(0))[order], first)
        out[w] = np.where(hit, table[at], np.uint64(0))
    return out


def _lcs_of(masks: np.ndarray, start: np.ndarray, size: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Lengths of the longest common subsequences of windows (start and size in the characters of ``masks``) with short texts of n."""
    words = len(masks)
    order = np.argsort(-size, kind="stable")
    start, size, n = start[order], size[order], n[order]
    state = np.full((words, len(start)), ~np.uint64(0), dtype=np.uint64)
    live = len(start)
    for t in range(int(size[0]) if live else 0):
        live = int(np.searchsorted(-size, -t, side="left"))  # windows with size > t
        carry = None
        for w in range(words):
            s = state[w, :live]
            hit = s & masks[w, start[:live] + t]
            total = s + hit
            over = total < s
            if carry is not None:
                total = total + carry
                over |= total < carry
            state[w, :live] = total | (s - hit)
            carry = over.astype(np.uint64)
    ones = np.zeros(len(start), dtype=np.int64)
    for w in range(words):
        inside = np.clip(n - 64 * w, 0, 64).astype(np.uint64)
        full = np.where(inside == 64, ~np.uint64(0), (np.uint64(1) << (inside & np.uint64(63))) - np.uint64(1))
        ones += np.bitwise_count(state[w] & full)
    out = np.empty(len(start), dtype=np.int64)
    out[order] = n - ones
    return out


def _portions(shorts: list[str], longs: list[str], weight: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """Places of pairs that are handled together, with the number of words of their short texts."""
    words = np.array([(len(x) + 63) // 64 for x in shorts])
    for k in np.unique(words):
        places = np.flatnonzero(words == k)
        part = np.cumsum(weight[places] * k) // ROOM
        for x in np.unique(part):
            yield places[part == x], int(k)


def ratios(a: Sequence[str], b: Sequence[str]) -> np.ndarray:
    """``ratio`` of each pair."""
    out = np.array([100.0 if x == y else 0.0 for x, y in zip(a, b, strict=True)])
    todo = [i for i in range(len(a)) if a[i] and b[i] and a[i] != b[i]]
    shorts = [min(a[i], b[i], key=len) for i in todo]
    longs = [max(b[i], a[i], key=len) for i in todo]
    total = np.array([len(x) + len(y) for x, y in zip(shorts, longs, strict=True)], dtype=np.int64)
    for places, words in _portions(shorts, longs, total):
        own, other = [shorts[i] for i in places], [longs[i] for i in places]
        if words > WIDE:
            out[np.array(todo)[places]] = [ratio(x, y) for x, y in zip(own, other, strict=True)]
            continue
        size = np.array([len(x) for x in other], dtype=np.int64)
        n = np.array([len(x) for x in own], dtype=np.int64)
        out[np.array(todo)[places]] = 200.0 * _lcs_of(_masks(own, other, words), np.cumsum(size) - size, size, n) / total[places]
    return out


def partial_ratios(a: Sequence[str], b: Sequence[str], cutoff: float = 0.0) -> np.ndarray:
    """``partial_ratio`` of each pair.

    The characters that a window shares with the short text, order aside, bound its score; they are counted for all windows at
    once. Windows are then compared, the most promising ones of each pair first, the others if they can still win.
    """
    out = np.array([100.0 if x == y or (x and y and (x in y or y in x)) else 0.0 for x, y in zip(a, b, strict=True)])
    todo = [i for i in range(len(a)) if a[i] and b[i] and out[i] == 0.0]
    shorts = [a[i] if len(a[i]) <= len(b[i]) else b[i] for i in todo]
    longs = [b[i] if len(a[i]) <= len(b[i]) else a[i] for i in todo]
    weight = np.array([len(x) + len(y) for x, y in zip(shorts, longs, strict=True)], dtype=np.int64)
    for places, words in _portions(shorts, longs, weight):
        own, other = [shorts[i] for i in places], [longs[i] for i in places]
        n, size = np.array([len(x) for x in own], dtype=np.int64), np.array([len(x) for x in other], dtype=np.int64)
        base = np.cumsum(size) - size
        of = np.repeat(np.arange(len(own)), size + n - 1)
        end = np.arange(len(of)) - np.repeat(np.cumsum(size + n - 1) - (size + n - 1), size + n - 1) + 1
        lo, hi = np.maximum(0, end - n[of]), np.minimum(end, size[of])
        begin, width = base[of] + lo, hi - lo
        codes, of_short, _ = _flat(own)
        long_codes, long_of, _ = _flat(other)
        letters, times = np.unique(codes, return_counts=True)
        common = np.zeros(len(of), dtype=np.int32)
        alone = letters[np.argsort(-times, kind="stable")[:ALPHABET]]
        for c in [*alone, None] if len(letters) > ALPHABET else alone:
            mine, theirs = (codes == c, long_codes == c) if c is not None else (~np.isin(codes, alone), ~np.isin(long_codes, alone))
            need = np.bincount(of_short[mine], minlength=len(own)).astype(np.int32)
            so_far = np.concatenate([[0], np.cumsum(theirs)]).astype(np.int32)
            common += np.minimum(so_far[begin + width] - so_far[begin], need[of])
        bound = 200.0 * common / (n[of] + width)
        able = np.flatnonzero((common > 0) & (bound >= cutoff))
        able = able[np.lexsort((-bound[able], of[able]))]
        best = np.zeros(len(own))
        if words > WIDE:
            cuts = np.searchsorted(of[able], np.arange(len(own) + 1))
            for i in range(len(own)):
                where = _places(own[i]) if cuts[i] < cuts[i + 1] else {}
                for w in able[cuts[i] : cuts[i + 1]].tolist():
                    if bound[w] <= best[i]:
                        break
                    best[i] = max(best[i], 200.0 * _lcs_with(where, len(own[i]), other[i][lo[w] : hi[w]]) / (n[i] + width[w]))
            out[np.array(todo)[places]] = np.where(best >= cutoff, best, 0.0)
            continue
        rank = np.arange(len(able)) - np.searchsorted(of[able], of[able])
        masks = _masks(own, other, words)
        for first, last in ((0, 2), (2, 16), (16, 1 << 60)):
            now = able[(rank >= first) & (rank < last)]
            now = now[bound[now] > best[of[now]]]
            score = 200.0 * _lcs_of(masks, begin[now], width[now], n[of[now]]) / (n[of[now]] + width[now])
            np.maximum.at(best, of[now], score)
        out[np.array(todo)[places]] = np.where(best >= cutoff, best, 0.0)
    return out


def _both(a: pd.Series, b: pd.Series, score) -> pd.Series:
    """score of the pairs without nulls, null for the others."""
    good = (a.notna() & b.notna()).to_numpy()
    out = np.full(len(a), np.nan)
    if good.any():
        out[good] = score(a[good].tolist(), b[good].tolist())
    return pd.Series(out)


@F.pandas_udf(T.DoubleType())
def _ratio_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return _both(a, b, ratios)


def _partial_udf(cutoff: float):
    @F.pandas_udf(T.DoubleType())
    def score(a: pd.Series, b: pd.Series) -> pd.Series:
        return _both(a, b, lambda x, y: partial_ratios(x, y, cutoff))

    return score


def similarity(a: Column, b: Column) -> Column:
    """ratio of two columns; equal values never leave the JVM."""
    other = ~a.eqNullSafe(b)
    return F.when(a == b, 100.0).otherwise(_ratio_udf(F.when(other, a), F.when(other, b)))


def partial_similarity(a: Column, b: Column, cutoff: float = 0.0) -> Column:
    """partial_ratio of two columns, 0 below the cutoff; contained texts never leave the JVM."""
    inside = F.when((a == "") | (b == ""), a == b).otherwise(F.contains(a, b) | F.contains(b, a))
    return F.when(inside, 100.0).otherwise(_partial_udf(cutoff)(F.when(~inside, a), F.when(~inside, b)))
