"""Water-filling and the mixture."""

from __future__ import annotations

from pathlib import Path

import pytest

from quire.llm.mixing import exact_total, mix_sources, water_fill
from quire.llm.tokens import VOCABULARY


def test_water_fill():
    w, cap = {"a": 0.5, "b": 0.3, "c": 0.2}, {"a": 1000.0, "b": 30.0, "c": 1000.0}
    got = water_fill(500, w, cap)
    assert got["b"] == 30 and got["a"] == pytest.approx(470 * 5 / 7) and got["c"] == pytest.approx(470 * 2 / 7)
    assert sum(water_fill(1e9, w, cap).values()) == 2030
    assert water_fill(100, w, {"a": 0.0}) == {"a": 0.0, "b": 0.0, "c": 0.0}
    assert exact_total(w, cap) == 100 and exact_total({}, {}) == 0


@pytest.mark.skipif(not Path(VOCABULARY).exists(), reason="no vocabulary")
def test_mix(spark):
    docs = [(i, f"word{i} some text of a document number {i}. " * (1 + i % 7), "abc"[i % 3], "x") for i in range(900)]
    docs += [(9000, None, "a", "x"), (9001, "", "a", "x"), (9002, "t", None, "x"), (9003, "t", "zzz", "x"), (9004, "t " * 50_000, "d", "x"), (1, docs[1][1], "b", "x")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, weight string")
    targets = spark.createDataFrame([("a", 0.6, 1), ("b", 0.3, 3), ("c", 0.1, None), ("none", 0.2, 4), (None, 0.1, 1)], "source string, weight double, max_repeats int")
    mix = mix_sources(df, targets)
    shares = {r["source"]: r for r in mix.shares.collect()}
    for s, w in (("a", 0.6), ("b", 0.3), ("c", 0.1)):
        assert shares[s]["share"] == pytest.approx(w, abs=0.02)
    assert shares["none"]["used"] == 0 and abs(sum(r["share"] for r in shares.values()) - 1) < 1e-9
    rows = mix.rows.collect()
    assert all(1 <= r["repeats"] <= {"a": 1, "b": 3, "c": 1}[r["source"]] for r in rows) and not {9000, 9001, 9002, 9003, 9004} & {r["doc_id"] for r in rows}
    again = mix_sources(df.repartition(7), targets).rows
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again.collect()))
    # as many tokens as a, b and c have: a is clamped at one epoch, its excess goes to b and c by 3 to 1, c is clamped too
    filled = mix_sources(df, targets, "available")
    part = {r["source"]: r for r in filled.shares.collect()}
    have = {s: part[s]["available"] for s in "abc"}
    assert part["a"]["goal"] == have["a"] and part["a"]["epochs"] == 1.0 and part["a"]["share"] < 0.6 - 0.1
    assert part["b"]["epochs"] > 1.0 and sum(part[s]["goal"] for s in "abc") == pytest.approx(sum(have.values()))
    assert part["b"]["used"] == pytest.approx(part["b"]["goal"], rel=0.02) and part["c"]["used"] == pytest.approx(part["c"]["goal"], rel=0.02)
    full = mix_sources(df, targets, 1e12)
    assert {r["source"]: round(r["epochs"], 6) for r in full.shares.collect()} == {"a": 1.0, "b": 3.0, "c": 1.0, "none": 0.0}
    assert mix_sources(df.where("false"), targets).rows.count() == 0 and mix_sources(df, targets.where("false")).rows.count() == 0
