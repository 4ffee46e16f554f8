"""Shared spans against brute force."""

from __future__ import annotations

import random

import pytest

import numpy as np

from quire.llm.automaton import ShardAutomaton
from quire.llm.spans import gram_hashes, runs, shared_portions, shared_spans, spans_removed


def brute(rows, least):
    seen = {}
    for d, t in rows:
        for i in range(len(t) - least + 1):
            seen.setdefault(t[i : i + least], set()).add(d)
    out = set()
    for d, t in rows:
        hit = [False] * (len(t) + 1)
        for i in range(len(t) - least + 1):
            if len(seen[t[i : i + least]]) > 1:
                hit[i : i + least] = [True] * least
        i = 0
        while i < len(t):
            j = i
            while hit[j]:
                j += 1
            if j > i:
                out.add((d, i, j))
            i = j + 1
    return out


def frame(spark, rows):
    return spark.createDataFrame([(d, t, 1, "c") for d, t in rows], "doc_id long, text string, h int, lo string")


@pytest.mark.parametrize("seed", range(4))
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    base = "".join(rng.choices("abc ", k=150))
    rows = []
    for d in range(45):
        parts = []
        for _ in range(8):
            a = rng.randint(0, 120)
            parts.append(base[a : a + rng.randint(5, 70)] if rng.random() < 0.7 else rng.choice(["xyz", "z" * 70, "q", "é😀"]))
        rows.append((d, "".join(parts)))
    rows += [(3, rows[3][1]), (52, rows[7][1]), (53, "z" * 400), (54, "z" * 90)]
    got = {tuple(r) for r in shared_spans(frame(spark, [*rows, (50, ""), (51, None), (None, rows[1][1])]), "doc_id", "text", 20, 8).collect()}
    assert got == brute(rows, 20)
    # shards of a few texts, and hashes larger than a shard, give the same
    for chars in (200, 30):
        small = shared_spans(frame(spark, rows), "doc_id", "text", 20, 8, shard_chars=chars)
        assert {tuple(r) for r in small.collect()} == brute(rows, 20)


@pytest.mark.parametrize("seed", range(6))
def test_matching_statistics(seed):
    """Own text in the shard, and texts with strings and characters that the shard has not."""
    rng = random.Random(seed)
    texts = list(dict.fromkeys("".join(rng.choices("ab", k=rng.randint(1, 40))) for _ in range(25)))
    docs = np.array([rng.randint(1, 8) for _ in texts])
    hi = np.where(np.array([rng.random() < 0.2 for _ in texts]), docs + 1, docs)
    asked = [*texts, "abxab" * 6, "b" * 30, "yyy"]
    own = np.concatenate([np.where(docs == hi, docs, -1), [-1, 3, 3]])
    apart = np.concatenate([docs == hi, [False, True, True]])
    which, begins, ends = ShardAutomaton(texts, docs, hi).long_matches(asked, own, apart, 4)
    got = {(int(w), int(b), int(e)) for w, b, e in zip(which, begins, ends, strict=True)}
    want = set()
    for i, t in enumerate(asked):
        there = [x for x, a, b in zip(texts, docs, hi, strict=True) if not apart[i] or a != own[i] or b != own[i]]
        hit = [False] * (len(t) + 1)
        for j in range(len(t) - 3):
            if any(t[j : j + 4] in x for x in there):
                hit[j : j + 4] = [True] * 4
        j = 0
        while j < len(t):
            k = j
            while hit[k]:
                k += 1
            if k > j:
                want.add((i, j, k))
            j = k + 1
    cover = lambda spans: {(i, p) for i, b, e in spans for p in range(b, e)}
    assert cover(got) == cover(want)


def test_removed(spark):
    text = "".join(random.Random(5).choices("abcdefgh ", k=400))
    rows = [(1, "one " + text[:150] + " two " + text[200:320] + " three"), (2, text), (3, "nothing"), (4, None)]
    got = {r["doc_id"]: (r["text_left"], r["removed_chars"]) for r in spans_removed(frame(spark, rows), "doc_id", "text").collect()}
    assert got == {1: ("one  two  three", 270), 2: (text[150:200] + text[320:], 270), 3: ("nothing", 0), 4: (None, None)}


def test_groups_of_copies(spark):
    text = "".join(random.Random(9).choices("abcdefgh ", k=3000))
    rows = [(i, text) for i in range(60)] + [(100 + i, f"{i}" + text[500:800] + "end") for i in range(20)]
    got = {tuple(r) for r in shared_spans(frame(spark, rows), "doc_id", "text").collect()}
    assert got == {(i, 0, 3000) for i in range(60)} | {(100 + i, *((1, 301) if i < 10 else (2, 302))) if False else (100 + i, s, e) for i in range(20) for d, s, e in brute(rows[-20:] + rows[:1], 100) if d == 100 + i}


def test_edges(spark):
    assert shared_spans(frame(spark, []), "doc_id", "text").count() == 0
    same = "x" * 99
    assert shared_spans(frame(spark, [(1, same), (2, same)]), "doc_id", "text").count() == 0
    long = "".join(random.Random(2).choices("abcdefghij ", k=300_000))
    got = shared_spans(frame(spark, [(1, long), (2, "zz" + long[1000:1100]), (2, "zz" + long[1000:1100])]), "doc_id", "text")
    assert {tuple(r) for r in got.collect()} == {(1, 1000, 1100), (2, 2, 102)}
    share = {r["doc_id"]: r for r in shared_portions(frame(spark, [(1, long), (2, long[:200]), (3, None), (4, "")]), "doc_id", "text").collect()}
    assert share[2]["share"] == 1.0 and share[1]["shared_chars"] == 200 and share[3]["n_chars"] == share[4]["n_chars"] == 0
    with pytest.raises(ValueError):
        shared_spans(frame(spark, []), "doc_id", "text", 100, 100)


def test_runs_cover_all_windows():
    import numpy as np

    rng = random.Random(4)
    for text in ["".join(rng.choices("ab", k=rng.randint(100, 400))) for _ in range(30)] + ["a" * 500]:
        h, s, n = runs(text, 100, 40)
        assert s[0] == 0 and (s[1:] == s[:-1] + n[:-1]).all() and s[-1] + n[-1] == len(text) - 99 and n.max() <= 61
        codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
        g = gram_hashes(codes, 40)
        assert len(g) == len(text) - 39
        for hh, ss, nn in zip(h, s, n, strict=True):
            assert all(g[i : i + 61].min() == hh for i in range(ss, ss + nn))
