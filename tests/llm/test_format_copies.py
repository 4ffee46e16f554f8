"""Copies in other writing against brute force."""

from __future__ import annotations

import json

from quire.llm.format_copies import canonical_json, collapse_copies, copy_counts, copy_pairs, inventory_cells, letters_and_digits, trait_cells

ITEMS = "item_id long, doc_id string, schema_name string, anchor string, page int, region_ids array<long>, section string, section_page int, raw string, canon string, field string"


def items(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], ITEMS)


def test_letters():
    assert letters_and_digits("Étude_No 5²!\n") == "étudeno5"
    assert letters_and_digits("STRASSE") == letters_and_digits("Straße")
    assert canonical_json({"b": None, "a": [1.0, "X y", {"k": None}]}) == {"a": [1, "sxy", {}]}


def test_inventory(spark, rows):
    data = [
        (1, "d", "s", "Dark Vision", 1, [1, 2], "A", 1), (2, "d", "s", " dark-vision.", 1, [1, 2], "a ", 1), (3, "d", "s", "Dark Vision", 1, [2, 1], "A", 1), (4, "d", "s", "Dark Visión", 1, [1, 2], "A", 1),
        (5, "d", "s", None, None, None, None, None), (6, "d", "s", None, None, None, None, None), (7, None, None, None, None, None, None, None), (8, None, None, None, None, None, None, None), (9, "d", "s", "", None, None, None, None),
        (10, "d", "s", "…", None, [], None, None), (11, "d", "s", "!", None, [], None, None), (1, "d", "s", "Dark Vision", 1, [1, 2], "A", 1), (None, "d", "s", "Dark Vision", 1, [1, 2], "A", 1), (12, "d", "s", "DARK\tVISION" + " " * 100_000, 1, [1, 2], "A", 1),
    ]
    got = collapse_copies(inventory_cells(items(spark, data)))
    assert rows(copy_pairs(got).select("keep_id", "dup_id")) == sorted([(1, 2), (1, 12), (5, 6), (7, 8), (10, 11)], key=repr)
    assert {(r["keep_id"], r["n_copies"]) for r in copy_counts(got).collect()} == {(1, 3), (3, 1), (4, 1), (5, 2), (7, 2), (9, 1), (10, 2)}
    assert collapse_copies(inventory_cells(items(spark, []))).count() == 0


def test_hot_group_is_split(spark, monkeypatch):
    import quire.llm.format_copies as m

    monkeypatch.setattr(m, "salted_lookup", lambda *a: __import__("quire.operators.skew", fromlist=["x"]).salted_lookup(*a, rows_per_task=10))
    data = [(i, "d", "s", "same" if i % 3 == 0 else f"a{i}", 1, None, None, None) for i in range(120)]
    got = copy_pairs(collapse_copies(inventory_cells(items(spark, data)))).collect()
    assert {(r["keep_id"], r["dup_id"]) for r in got} == {(0, i) for i in range(3, 120, 3)}


def test_records(spark, rows):
    r = [
        {"id": "a_b", "n": 1, "e": [{"kind": "x", "t": ["fire"]}], "note": None}, {"e": [{"t": ["Fire!"], "kind": "X"}], "n": 1.0, "id": "A b"},
        {"id": "a_b", "n": 1, "e": [{"kind": "x", "t": ["fire", "cold"]}]}, {"id": "a_b", "n": 1, "e": [{"kind": "x", "t": ["fire"], "u": None}]}, {"id": "a_b", "n": "1", "e": [{"kind": "x", "t": ["fire"]}]},
    ]
    texts = [json.dumps(r[0]), json.dumps(r[1], indent=2), json.dumps(r[2]), json.dumps(r[3]), json.dumps(r[4]), None, None, "{broken", "{ BROKEN", "[1, 2]", "", "{}", json.dumps({"a": chr(0xD800) + "x"}), json.dumps({"a": "X"})]
    df = spark.createDataFrame([(i, "d", t, "q") for i, t in enumerate(texts)], "trait_id long, doc_id string, record_json string, tbl string")
    got = rows(copy_pairs(collapse_copies(trait_cells(df.drop("tbl")))).select("keep_id", "dup_id"))
    # the empty text is a value without letters; null and {} have no fields
    assert got == sorted([(0, 1), (0, 3), (5, 6), (5, 11), (7, 8), (12, 13)], key=repr)
