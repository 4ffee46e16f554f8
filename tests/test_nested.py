"""Flat tables of nested effects."""

from __future__ import annotations

import json

from quire.operators.nested_tables import DAMAGE, EFFECT, LEAF, damage_rows, effect_sources, nested_rows, stored_tables, tagged_rows, typed, visit_effects, visit_leaves, write_tables

EFFECTS = "array<struct<kind: string, amount: int, damageTypes: array<string>, options: array<struct<kind: string, damageTypes: array<string>>>>>"


def extractions(spark, values):
    return spark.createDataFrame([(i, v, "tag", "x") for i, v in enumerate(values)], "ext_id long, value_json string, tag string, payload string")


def tagged(spark, values):
    return tagged_rows(extractions(spark, values), "ext_id", "value_json", visit_effects)


def test_places_and_depth(spark, rows):
    deep = {"kind": "leaf", "damageTypes": ["x"]}
    for _ in range(60):
        deep = {"kind": "choice", "options": [deep]}
    values = [
        json.dumps([{"kind": "a", "damageTypes": ["fire", "cold"]}, {"kind": None, "damageTypes": "acid"}, {}]),
        json.dumps({"effects": [{"kind": "b", "options": [{"damageTypes": []}, {"kind": "c", "options": [{"kind": "d", "damageTypes": ["x"]}]}]}]}),
        json.dumps({"value": [{"kind": "e"}]}), json.dumps({"effects": {"value": [{"kind": "f"}], "quote": "q"}}),
        None, "", "[{", '"text"', "3", "[1, 2]", "[]", "{}", json.dumps([deep]),
    ]
    df = tagged(spark, values).withColumn("tbl", __import__("pyspark.sql.functions", fromlist=["lit"]).lit("extractions"))
    got = rows(damage_rows(df).where("row_id < 12").select("row_id", "effect_path", "kind", "dmg_pos", "damage_type"))
    want = [(0, "0", "a", 0, "fire"), (0, "0", "a", 1, "cold"), (0, "1", "", 0, "acid"), (0, "2", "", -1, ""), (1, "0", "b", -1, ""), (1, "0.0", "", -1, ""), (1, "0.1", "c", -1, ""), (1, "0.1.0", "d", 0, "x"), (2, "0", "e", -1, ""), (3, "0", "f", -1, "")]
    assert got == sorted(want, key=repr)
    assert damage_rows(df).where("row_id = 12").count() == 61


def test_typed_tables_keep_links(spark, tmp_path):
    t = tagged(spark, [json.dumps([{"kind": "a", "amount": 3, "damageTypes": ["fire", None], "options": [{"kind": "b"}]}])] * 2)
    write_tables(t, str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    effects, damage = typed(stored, "effect", EFFECT), typed(stored, "damage", DAMAGE)
    assert effects.join(effects.selectExpr("row_id", "pk as parent"), ["row_id", "parent"], "left_anti").where("parent is not null").count() == 0
    assert damage.join(effects.selectExpr("row_id", "pk as parent"), ["row_id", "parent"]).count() == damage.count() == 2
    assert {r["amount"] for r in effects.collect()} == {"3", None}


def test_both_sources(spark):
    traits = spark.createDataFrame([(1, [("k", 1, None, [("o", ["fire"])])], "x"), (2, None, "x"), (3, [], "x")], f"trait_id long, effects {EFFECTS}, payload string")
    got = damage_rows(effect_sources(traits, extractions(spark, []))).collect()
    assert {(r["tbl"], r["row_id"], r["effect_path"], r["dmg_pos"]) for r in got} == {("race_traits", 1, "0", -1), ("race_traits", 1, "0.0", 0)}


def test_arrays_and_errors_have_tables(spark):
    values = [json.dumps([{"kind": "a", "abilities": ["str", None, "dex"], "skills": "stealth", "options": [{"skills": ["arcana"]}]}]), "[{", "[" * 200_000 + "]" * 200_000, None]
    t = stored_tables(tagged(spark, values))
    assert {(r["pk"], r["parent"], r["ability"]) for r in t["ability"].collect()} == {("0/abilities/0", "0", "str"), ("0/abilities/2", "0", "dex")}
    assert {(r["parent"], r["skill"]) for r in t["skill"].collect()} == {("0", "stealth"), ("0.0", "arcana")}
    assert {(r["row_id"], r["reason"]) for r in t["error"].collect()} == {(1, "no valid JSON"), (2, "too deep")}


def test_leaves_and_back(spark, rows):
    """Any path: a.b[0].c; gaps in lists come back as empty objects."""
    leaf = lambda v, q="q": {"value": v, "quote": q}
    record = {"a": {"b": [{"c": leaf(1)}, {"d": leaf("x")}, 3, None]}, "t": [leaf([1]), {"u": leaf(None, None)}], "void": {"value": None, "quote": "q"}, "n": None, "s": "text"}
    found = tagged_rows(extractions(spark, [json.dumps(record), json.dumps(leaf(5)), "[1]", "3"]), "ext_id", "value_json", visit_leaves)
    assert rows(typed(found, "leaf", LEAF).select("row_id", "pk", "value")) == sorted([(0, "a.b[0].c", "1"), (0, "a.b[1].d", '"x"'), (0, "t[0]", "[1]"), (0, "t[1].u", None), (1, "<root>", "5")], key=repr)
    flat = [("d", "a.b[0].c", "1"), ("d", "a.b[2].d", '{"value": 2}'), ("d", "t[2].u", '"z"'), ("d", "t[0]", '{"value": 3}'), ("d", "t[0].w", "4"), ("d", "t$inventory", "5"), ("d", None, "6"), ("d", "k", None)]
    got = nested_rows(spark.createDataFrame(flat, "doc string, path string, leaf string"), ["doc"], "path", "leaf")
    assert {(r["field"], r["idx"]): json.loads(r["node"]) for r in got.collect()} == {("a", None): {"b": [{"c": 1}, {}, {"d": {"value": 2}}]}, ("t", 0): {"value": 3, "w": 4}, ("t", 1): {}, ("t", 2): {"u": "z"}}
