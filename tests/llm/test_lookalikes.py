"""Look-alike text: forms, nulls, long texts."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quire.llm.lookalikes import FORMS, consistent_rows, consistent_text, odd_rows, unify


@pytest.mark.parametrize(
    ("given", "want", "kinds"),
    [
        ("ＡＢ１", "AB1", "wide"), ("é", "é", "mark"), ("a​b﻿", "ab", "zero"), ("a b　c", "a b c", "space"), ("pаge", "page", "mixed"), ("Αnchor", "Anchor", "mixed"), ("Ночь Θήκη", "Ночь Θήκη", ""),
        ("ſ ½ ² × … ª № ™ é “x” – ‐", "ſ ½ ² × … ª № ™ é “x” – ‐", ""), ("a\tb\r\nc", "a\tb\r\nc", ""), ("", "", ""), ("Жuk", "Жuk", "mixed"), ("до́м", "до́м", "mark"), ("тест2a", "тест2a", ""),
    ],
)
def test_unify(given, want, kinds):
    assert unify(given, FORMS, {}) == (want, kinds)


def test_table(spark, rows):
    data = [(1, "plain"), (2, None), (3, ""), (4, "x​y"), (4, "x​y"), (5, "word " * 200_000 + "ｗ"), (None, " "), (6, "Λόγος")]
    df = spark.createDataFrame([(i, t, "c", [1]) for i, t in data], "region_id long, text string, row_id string, kinds2 array<int>")
    assert rows(odd_rows(df.drop("row_id"), "regions", "region_id", "text").select("row_id")) == sorted([(4,), (4,), (5,), (None,)], key=repr)
    out = consistent_text(df, "text")
    assert out.count() == len(data)
    assert {r["text_norm"] for r in out.where("region_id = 4").collect()} == {"xy"}
    assert consistent_text(df.where("false"), "text").count() == 0


def test_quote_equals_region(spark):
    a = spark.createDataFrame([("Deep Wizаrd", 1)], "text string, i int")
    b = spark.createDataFrame([("D​ｅep Wizard", 1)], "text string, i int")
    norm = lambda df: consistent_text(df, "text").first()["text_norm"]
    assert norm(a) == norm(b) == "Deep Wizard"


def test_rows_of_a_table(spark, rows):
    df = spark.createDataFrame([(1, "the \u0430 D\u200beep \u0441\u043e\u0441\u043e here"), (2, "Ночь Θήκη"), (3, None), (4, "\u039d\u03bf\u03c4\u03b1"), (5, "p\u0430ge"), (6, ""), (7, "x\u0585y of")], "ext_id long, quote string")
    got = {r["row_id"]: (r["tbl"], r["text_norm"], r["kinds"]) for r in consistent_rows(df, "extractions", "ext_id", "quote").collect()}
    want = [(1, "the a Deep coco here", ["zero", "whole"]), (2, "Ночь Θήκη", []), (3, None, []), (4, "\u039d\u03bf\u03c4\u03b1", []), (5, "page", ["mixed"]), (6, "", []), (7, "xoy of", ["foreign"])]
    assert got == {i: ("extractions", t, k) for i, t, k in want}
    assert rows(odd_rows(df, "extractions", "ext_id", "quote").select("row_id")) == [(1,), (5,)]


def test_words_wholly_of_look_alikes():
    """Latin only among Latin words; ordinary beside words of their own script, at the border, and alone."""
    soso, ra = "\u0441\u043e\u0441\u043e", "\u0440\u0430"
    for given, want in ((f"the {soso} tree", "the coco tree"), (f"{soso} tree", "coco tree"), (f"{soso} {ra} tree", "coco pa tree"), (f"Ночь {soso}", f"Ночь {soso}"), (f"the {soso} tree Ночь", f"the {soso} tree Ночь"), (soso, soso), (f"{soso} {ra}", f"{soso} {ra}")):
        assert unify(given, FORMS, {}) == (want, "whole" if want != given else "")


def test_query_has_quotes_and_texts(spark):
    from quire.llm.queries import queries

    out = queries()["p3_text"](spark, "/root/testdata/sf0.001")
    tables = {r["tbl"]: r["n"] for r in out.groupBy("tbl").agg(F.count("*").alias("n")).collect()}
    assert tables == {t: spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").count() for t in ("regions", "extractions")}
