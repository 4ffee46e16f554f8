"""Text, number, box and fuzzy functions against plain definitions, and the operators without SQL against brute force."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions import boxes, fuzzy, numbers, schemas, text
from quire.operators import evaluate, gates, ordering, packing, reconcile, skew, states, versions
from quire.sources import external, payloads
from quire.session import Settings


def one(spark, schema, rows, expr):
    return [r["v"] for r in spark.createDataFrame(rows, schema).select(expr.alias("v")).collect()]


def test_normalize(spark):
    given = ["Épée ½, İstanbul", "ABC_d  e-f", None, "", "ſtone ﬁ №5", "Стол"]
    assert one(spark, "s string", [(g,) for g in given], text.normalize(F.col("s"))) == [text.normalize_py(g) for g in given]


@pytest.mark.parametrize(("token", "value"), [("1.234,50", 1234.5), ("1,234.50", 1234.5), ("1.234", 1234.0), ("1.5", 1.5), ("1,234", 1.234), ("0.125", 125.0), ("1,234,567", None), ("12", 12.0), ("-3", -3.0)])
def test_number_value(spark, token, value):
    assert one(spark, "s string", [(token,)], numbers.number_value(F.col("s"))) == [value]


def test_numbers_and_identifiers(spark):
    assert one(spark, "s string", [("−42 or - 42, 2024-03-15",), (None,)], numbers.signed_numbers(F.col("s"))) == [[-42.0, -42.0, 2024.0, -3.0, -15.0], []]
    assert one(spark, "s string", [("Contratto n. 44/B del 2024-03-15",)], numbers.identifier_tokens(F.col("s"))) == [["44/B", "2024-03-15"]]
    assert one(spark, "s string", [('{"a1": [1, -2.5, "7"], "b": {"c": 3e2}}',)], numbers.json_numbers(F.col("s"))) == [[1.0, -2.5, 300.0]]


def test_slug(spark):
    got = one(spark, "a string, b string, c string", [("Dwarf", None, "Dwarven Resilience"), ("Dwarf", "Hill Dwarf", "Dwarven  Toughness"), ("Dwarf", "Dwarf", "x")], text.slug("race", F.col("a"), F.col("b"), F.col("c")))
    assert got == ["race_dwarf_dwarven_resilience", "race_dwarf_hill_dwarf_dwarven_toughness", "race_dwarf_x"]


def test_boxes(spark):
    df = spark.createDataFrame([("[0,0,10,10]", "[5,5,15,15]"), ("[0,0,0,0]", "[0,0,0,0]"), ("[1,2]", None)], "a string, b string")
    got = df.select(boxes.iou(boxes.box(F.col("a")), boxes.box(F.col("b"))).alias("v")).collect()
    assert got[0]["v"] == pytest.approx(25 / 175) and got[1]["v"] == 0.0
    turned = df.limit(1).select(boxes.rotate(boxes.box(F.col("a")), F.lit(90.0), 10, 10).alias("v")).first()["v"]
    assert [round(x, 6) for x in turned] == [0.0, 0.0, 10.0, 10.0]


def slow_lcs(a, b):
    p = [0] * (len(b) + 1)
    for x in a:
        q = [0]
        for j, y in enumerate(b):
            q.append(p[j] + 1 if x == y else max(p[j + 1], q[j]))
        p = q
    return p[-1]


def test_fuzzy_against_brute_force(spark):
    rng = random.Random(2)
    for _ in range(400):
        a, b = "".join(rng.choices("abcd", k=rng.randint(1, 9))), "".join(rng.choices("abcde", k=rng.randint(1, 20)))
        assert fuzzy.lcs(a, b) == slow_lcs(a, b)
        s, t = sorted((a, b), key=len)
        best = max(200 * slow_lcs(s, w) / (len(s) + len(w)) for i in range(1 - len(s), len(t)) if (w := t[max(0, i) : i + len(s)]))
        assert fuzzy.partial_ratio(a, b) == pytest.approx(best)
    for letters, short, long in (("abcd", 30, 60), ("abcdefghij éж😀", 150, 400), ("".join(map(chr, range(97, 300))), 80, 200)):
        pairs = [("".join(rng.choices(letters, k=rng.randint(0, short))), "".join(rng.choices(letters, k=rng.randint(0, long)))) for _ in range(60)]
        pairs += [(x, y[:9] + x[:-1] + "#" + y) for x, y in pairs] + [(x, x) for x, _ in pairs[:3]]
        a, b = [x for x, _ in pairs], [y for _, y in pairs]
        assert fuzzy.ratios(a, b).tolist() == [fuzzy.ratio(x, y) for x, y in pairs]
        for cutoff in (0.0, 70.0, 90.0):
            assert fuzzy.partial_ratios(a, b, cutoff).tolist() == [fuzzy.partial_ratio(x, y, cutoff) for x, y in pairs]
    assert fuzzy.ratios([], []).tolist() == fuzzy.partial_ratios([], []).tolist() == []
    df = spark.createDataFrame([("ab", "xxabyy"), ("ab", None), ("", "a"), ("", ""), ("abcd", "abed")], "a string, b string")
    assert [r["v"] for r in df.select(fuzzy.partial_similarity(F.col("a"), F.col("b")).alias("v")).collect()] == [100.0, None, 0.0, 100.0, 75.0]


def test_windows(spark, rows):
    """Expected windows by hand; first and last are positions."""
    cases = {"even": [100] * 7, "large first": [900, 10], "large middle": [10, 900, 10, 10], "one": [5], "fits": [100, 100, 100], "zero": [0, 0, 320, 0]}
    want = {
        "even": [(0, 0, 2), (1, 2, 4), (2, 4, 6)], "large first": [(0, 0, 0), (1, 1, 1)], "large middle": [(0, 0, 0), (1, 1, 1), (2, 2, 3)],
        "one": [(0, 0, 0)], "fits": [(0, 0, 2)], "zero": [(0, 0, 3)],
    }
    df = spark.createDataFrame([(d, i, x) for d, xs in cases.items() for i, x in enumerate(xs)], "doc_id string, pos long, size int")
    assert rows(packing.greedy_windows(packing.ordered_blocks(df.withColumnRenamed("pos", "at"), ["at"]), 320)) == sorted(((d, *w) for d, ws in want.items() for w in ws), key=repr)
    assert packing.greedy_windows(packing.ordered_blocks(df.withColumnRenamed("pos", "at").where("at < 0"), ["at"]), 320).count() == 0


def test_windows_hold_their_properties(spark):
    """Every page is covered, windows fit, could not be longer, and overlap by one page unless one stands alone."""
    rng = random.Random(8)
    sizes = {f"d{k}": [rng.choice([1, 30, 60, 99, 140]) for _ in range(rng.randint(1, 90))] for k in range(6)}
    df = spark.createDataFrame([(d, i, x) for d, xs in sizes.items() for i, x in enumerate(xs)], "doc_id string, pos long, size int")
    got = {}
    for r in packing.greedy_windows(packing.ordered_blocks(df.withColumnRenamed("pos", "at"), ["at"]), 130).collect():
        got.setdefault(r["doc_id"], {})[r["window"]] = (r["first"], r["last"])
    for d, xs in sizes.items():
        ws = [got[d][k] for k in range(len(got[d]))]
        assert ws[0][0] == 0 and ws[-1][1] == len(xs) - 1
        for first, last in ws:
            assert sum(xs[first : last + 1]) <= 130 or first == last
            assert last + 1 == len(xs) or sum(xs[first : last + 2]) > 130
        for (f, last), (g, _) in zip(ws, ws[1:], strict=False):
            assert g == (last if last > f else last + 1)


def test_running_sums(spark):
    rng = random.Random(3)
    data = [(rng.choice("aab"), i, float(rng.randint(0, 9))) for i in range(200)]
    got = {(r["g"], r["i"]): (r["s"], r["n"]) for r in skew.running_within(spark.createDataFrame(data, "g string, i int, v double"), ["g"], ["i"], "v", "s", "n").collect()}
    for g, i, _ in data:
        assert got[g, i] == (sum(v for h, j, v in data if h == g and j <= i), sum(h == g and j < i for h, j, _ in data))


def test_folds(spark):
    rng = random.Random(4)
    data = [("d", 1, i, "table", "x" * rng.randint(0, 60), i) for i in range(30)]
    df = spark.createDataFrame(data, "doc_id string, page_no int, region_id long, region_type string, text string, order_idx int")
    used, want = 0, []
    for r in data:
        if used + len(r[4]) <= 200:
            used += len(r[4])
            want.append(r[2])
    assert sorted(r["region_id"] for r in packing.tables_in_budget(df, 200).collect()) == want
    sizes = [60, 20, 30, 200, 10, 10, 75, 15]  # with a heading of 10 and a budget of 100
    parts = spark.createDataFrame([("d", 1, i, i, 10, x) for i, x in enumerate(sizes)], "doc_id string, page_no int, order_idx int, region_id long, head int, size int")
    assert [r["block"] for r in packing.page_blocks(parts, 100).orderBy("region_id").collect()] == [0, 0, 1, 2, 3, 3, 4, 4]


def test_prefix_duplicates(spark):
    data = [(1, "d", 1, "speed", [5]), (2, "d", 1, "speed your base", [5]), (3, "d", 1, "speed", [6]), (4, "d", 1, "speed", None), (5, "d", 2, "speed", [5]), (6, "d", 1, "darkvision", [])]
    df = spark.createDataFrame(data, "item_id long, doc_id string, page int, anchor string, region_ids array<long>")
    assert sorted(r["item_id"] for r in packing.prefix_duplicates(df).collect()) == [1, 3, 5, 6]
    # 2 falls to 1, so 3 stays although it agrees with 2
    data = [(1, "d", 1, "ab", [1]), (2, "d", 1, "abc", None), (3, "d", 1, "abcd", [2]), (4, "d", 1, "abcd", [2]), (5, None, None, None, None)]
    assert sorted(r["item_id"] for r in packing.prefix_duplicates(spark.createDataFrame(data, df.schema)).collect()) == [1, 3, 5]


BOX = "page int, idx int, box struct<x0: double, y0: double, x1: double, y1: double>, flow boolean"


def test_reading_order_by_hand(spark):
    """Pages with the order a reader would take, head margin up to 50 and foot margin from 950 of 1000."""
    wide, left, right = (0.0, 100.0), (0.0, 45.0), (55.0, 100.0)
    box = lambda x, y, h=10.0: (x[0], float(y), x[1], float(y) + h)
    pages = {
        # two columns, the engine has put a heading before the paragraph above it
        1: ([box(left, 300), box(left, 100), box(right, 100), box(right, 300)], None, [1, 0, 2, 3]),
        # the columns keep the engine's order
        2: ([box(right, 100), box(left, 100), box(left, 60)], None, [0, 2, 1]),
        # a full-width band cuts the page
        3: ([box(left, 600), box(right, 100), box(wide, 500), box(left, 100), box(right, 600)], None, [1, 3, 2, 0, 4]),
        # page number below and running title above stay at the ends
        4: ([box(left, 960), box(left, 300), box(right, 100), box(left, 100), box(left, 20)], None, [4, 3, 1, 2, 0]),
        # an empty wide box under the left column does not join the columns, and comes last
        5: ([box(left, 300), (10.0, 310.0, 68.0, 900.0), box(left, 100), box(right, 200)], [True, False, True, True], [2, 0, 3, 1]),
        # a missing box, in flow or not: the engine's order, out-of-flow boxes in their places
        6: ([box(left, 300), None, box(left, 100)], None, [0, 1, 2]),
        7: ([box(left, 300), None, box(left, 100)], [True, False, True], [0, 1, 2]),
        # fewer than two boxes in flow
        8: ([box(left, 300), box(left, 100), box(left, 60)], [False, True, False], [0, 1, 2]),
        # no width
        9: ([(5.0, 300.0, 5.0, 310.0), (5.0, 100.0, 5.0, 110.0)], None, [0, 1]),
        10: ([box(wide, 300), box(wide, 100)], None, [1, 0]),
    }
    data = [(p, i, b, flow is None or flow[i]) for p, (bs, flow, _) in pages.items() for i, b in enumerate(bs)]
    got = {}
    for r in ordering.reading_order(spark.createDataFrame(data, BOX), ["page"], "idx", "box", "flow", 1000.0).collect():
        got.setdefault(r["page"], {})[r["new_idx"]] = r["idx"]
    assert {p: [o[k] for k in range(len(o))] for p, o in got.items()} == {p: want for p, (_, _, want) in pages.items()}


def test_reading_order_properties(spark):
    """On random pages: a permutation; blocks of one x range without wider ones between are read from top to bottom."""
    rng = random.Random(6)
    data = []
    for page in range(60):
        for i in range(rng.randint(2, 9)):
            x, y = rng.choice([0.0, 55.0]), float(rng.randint(100, 800))
            data.append((page, i, (x, y, x + 45.0, y + 10.0), True))
    got = {}
    for r in ordering.reading_order(spark.createDataFrame(data, BOX), ["page"], "idx", "box", "flow", 1000.0).collect():
        got.setdefault(r["page"], []).append((r["new_idx"], r["idx"], r["box"]["x0"], r["box"]["y0"]))
    for order in got.values():
        order.sort()
        assert [o[0] for o in order] == list(range(len(order)))
        first = min(order, key=lambda o: o[1])  # the column of the engine's first box is read first
        columns = [o[2] for o in order]
        assert columns == sorted(columns, key=lambda x: x != first[2])
        for x in (0.0, 55.0):
            ys = [(o[3], o[1]) for o in order if o[2] == x]
            assert ys == sorted(ys)


def test_reconcile(spark):
    data = [("d", 1, 1, 0, "a", "[0,0,10,10]", "Impofto: 100 EUR"), ("d", 1, 2, 0, "b", "[0,0,10,10]", "Importo: 100 EUR"), ("d", 1, 3, 1, "a", None, "same words here"), ("d", 1, 4, 1, "b", None, "same words here"), ("d", 1, 5, 2, "a", None, "other")]
    df = spark.createDataFrame(data, "doc_id string, page_no int, region_id long, order_idx int, engine string, bbox string, text string")
    got = {(r["id_a"], r["id_b"], r["outcome"]) for r in reconcile.reconcile_pages(df).collect()}
    assert got == {(1, 2, "conflict"), (3, 4, "by_text"), (5, None, "alone")}
    # one box claimed twice goes to the earlier region; the later one takes its next choice, an equal text
    data = [("d", 1, 1, 0, "a", "[0,0,10,10]", "alpha"), ("d", 1, 2, 1, "a", "[0,0,10,9]", "beta"), ("d", 1, 3, 0, "b", "[0,0,10,9]", "alpha"), ("d", 1, 4, 1, "b", None, "beta"), ("d", 2, 5, 0, "a", None, None), ("d", 2, 6, 0, "b", None, "")]
    df = spark.createDataFrame(data, df.schema)
    assert {(r["id_a"], r["id_b"], r["outcome"]) for r in reconcile.reconcile_pages(df).collect()} == {(1, 3, "accepted"), (2, 4, "by_text"), (5, 6, "by_text")}


def test_gates(spark):
    df = spark.createDataFrame([("42", "it is −42"), ("42", "it is 42"), ('"EUR"', "Importo in euro"), ("null", None), (None, "x"), ('[{"kind":"speed_bonus","amount":5}]', "35 feet"), ('"x"', None)], "v string, q string")
    assert [r["ok"] for r in df.select(gates.value_in_quote(F.col("v"), F.col("q")).alias("ok")).collect()] == [False, True, True, True, False, True, False]
    cases = [("Contratto N. 44/B", "CONTRATTO N. 45/B", False), ("Contratto N. 44/B", "il CONTRATTO N. 44/B e", True), ("darkvlsion you can see", "Darkvision you can see in the dark", True), (None, "x", False), ("x", None, False), ("", "x", False)]
    rows = spark.createDataFrame([(i, q, "clash") for i, (q, _, _) in enumerate(cases)] + [(99, "q", "no page")], "i int, quote string, page string").drop("page")
    pages = spark.createDataFrame([(i, p) for i, (_, p, _) in enumerate(cases)], "i int, page string")
    assert [r["ok"] for r in gates.grounded(rows, pages, ["i"]).orderBy("i").collect()] == [*(ok for _, _, ok in cases), False]


def test_versions(spark, tmp_path):
    df = spark.createDataFrame([("d", "p", 1, "x"), ("d", "p", 2, None)], "doc_id string, field_path string, attempt int, v string")
    fix = spark.createDataFrame([("d", "p", "new"), ("e", "q", "n")], "doc_id string, field_path string, new_value string")
    assert {(r["doc_id"], r["attempt"]) for r in versions.corrected(df, ["doc_id", "field_path"], fix).collect()} == {("d", 3), ("e", 1)}
    versions.write_partitions(df, str(tmp_path / "t"), ["doc_id"])
    versions.write_partitions(df.where("attempt = 2"), str(tmp_path / "t"), ["doc_id"])
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1


def test_external_call_keeps_errors(spark):
    def fn(v):
        if v == "bad":
            raise ValueError("no")
        return v.upper()

    df = spark.createDataFrame([(1, "a"), (2, "bad"), (3, None)], "i int, s string")
    assert [(r["i"], r["payload"], r["error"]) for r in external.call(df, "s", fn).orderBy("i").collect()] == [(1, "A", None), (2, None, "ValueError: no"), (3, None, None)]


def test_logs_and_files(spark, tmp_path):
    (tmp_path / "a.log").write_text("INFO ok\nError one\nError one\nMemory 3\n")
    (tmp_path / "b.log").write_text("INFO ok\nError one\nError one\nMemory 3\n")
    assert {(r["line"], r["times"]) for r in external.log_excerpt(spark, str(tmp_path / "a.log")).collect()} == {("Error one", 2), ("Memory 3", 1)}
    found = payloads.files_by_content(spark, str(tmp_path)).collect()
    assert len(found) == 1 and found[0]["path"].endswith("a.log") and found[0]["doc_id"].startswith("doc_")


def test_schemas():
    s = schemas.envelope("raceName", "subraceName")
    assert not any(f.nullable is False for f in schemas.relax(s).fields)
    assert schemas.narrow(s, ["featureName"]).names == ["featureName"]
    assert schemas.leaf_paths(T.StructType().add("a", schemas.leaf(T.StringType())).add("p", T.ArrayType(T.StructType().add("n", schemas.leaf(T.StringType()))))) == ["a", "p[].n"]


def test_settings(spark):
    spark.conf.set("quire.grounding_min", "80")
    assert Settings.from_session(spark).grounding_min == 80
    spark.conf.unset("quire.grounding_min")
    assert Settings.from_session(spark) == Settings()


def test_payload_shapes(spark, rows):
    block = '{"index": 0, "block_label": "seal", "block_bbox": [1, 2, 3, 4], "block_content": "x"}'
    page = f'{{"parsing_res_list": [{block}]}}'
    table_block = '{"block_label": "table", "block_bbox": null, "table": {"rows": [[1]]}}'
    cases = {
        1: ('{"parsing_res_list": []}', []), 2: (f'{{"res": {page}}}', [(0, "stamp", 4, "x", None)]), 3: ("nothing", None),
        4: (json.dumps(page), [(0, "stamp", 4, "x", None)]), 5: (f"[{page}, {{\"res\": {page}}}]", [(0, "stamp", 4, "x", None), (1, "stamp", 4, "x", None)]),
        6: ('[{"bbox": [1, 2, 3, 4], "type": "formula", "text": "f"}, {"text": "t"}]', [(0, "formula", 4, "f", None), (1, "text", None, "t", None)]), 7: ("[]", []),
        8: ('{"parsing_res_list": [{"block_label": "title", "block_bbox": [1, 2], "block_content": null}, {"x": 1}]}', [(0, "text", 2, "", "box"), (1, "text", None, "", "block")]),
        9: (f'{{"parsing_res_list": [{table_block}]}}', [(0, "table", None, '{"rows":[[1]]}', None)]), 10: (f"[{page}, 3]", None), 11: ("3", None), 12: (None, None),
        13: ('{"parsing_res_list": [{"block_label": "Table_Title", "block_content": "T"}]}', [(0, "table", None, "T", None)]),
    }
    df = spark.createDataFrame([("d", p, v) for p, (v, _) in cases.items()], "doc_id string, page_no int, payload string")
    got = {}
    for r in payloads.explode_blocks(df).orderBy("page_no", "pos").collect():
        got.setdefault(r["page_no"], []).append(tuple(r)[2:])
    want = {p: [(None, None, None, None, "unrecognised")] if x is None else x for p, (_, x) in cases.items() if x != []}
    assert got == want


def test_grounding_errors(spark, rows):
    good = "<|ref|>title<|/ref|><|det|>[[0, 0, 999, 999]]<|/det|>Head"
    texts = [good + "<|end\u2581of\u2581sentence|>", "plain text", "  ", None, good.replace("[[0, 0, 999, 999]]", "[[1, 2]]"), good.replace("[[0, 0, 999, 999]]", "x"), "<|ref|>image<|/ref|><|det|>x<|/det|>"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    assert rows(payloads.grounding_errors(df, "i", "t")) == [(1, "untagged"), (4, "box"), (5, "box")]
    assert [r["text"] for r in payloads.grounding_regions(df.where("i = 0"), "i", "t").collect()] == ["Head"]


def test_states(spark, rows):
    now = spark.createDataFrame([("a", "extracted"), ("b", "done"), ("c", "needs_review")], "doc_id string, status string")
    asked = spark.createDataFrame([("a", "extracted", "validated"), ("a", "validated", "done"), ("b", "done", "failed"), ("c", "needs_review", "extracted"), ("x", "ingested", "failed"), ("b", None, "done")], "doc_id string, src string, dst string")
    assert rows(states.illegal_transitions(asked, now, ["doc_id"]).select("doc_id", "src", "reason")) == sorted([("a", "validated", "stale"), ("c", "needs_review", "not allowed"), ("x", "ingested", "stale"), ("b", None, "not allowed")], key=repr)
    decide = now.union(spark.createDataFrame([("d", "ocr_a"), ("e", None), ("f", "enumerated")], now.schema))
    assert rows(decide.select("doc_id", states.skip_decision(F.col("status"), "enumerated", "extracted"))) == [("a", "skip"), ("b", "skip"), ("c", "skip"), ("d", "error"), ("e", "error"), ("f", "run")]
    answers = [("d", "t[0]", 2, None, [("x", 9), ("y", 1)]), ("d", "t[1]", None, None, [("x", None)]), ("e", "t[0]", None, "timeout", None), ("e", "t[1]", None, None, [("x", None), ("y", 1)])]
    df = spark.createDataFrame(answers, "doc_id string, task string, task_page int, error string, fields array<struct<field: string, page: int>>")
    pages = spark.createDataFrame([("d", 1), ("d", 2), ("e", 1)], "doc_id string, page_no int")
    want = [("d", "t[0]", "ok", None, "x", 2), ("d", "t[0]", "ok", None, "y", 1), ("d", "t[1]", "failed", "left out: y", None, None), ("e", "t[0]", "failed", "timeout", None, None), ("e", "t[1]", "ok", None, "x", 1), ("e", "t[1]", "ok", None, "y", 1)]
    assert rows(states.routed(df, ["x", "y"], pages)) == sorted(want, key=repr)


def test_taxonomy(spark, rows):
    """One of two properties, amounts of 0, damage types; at any depth."""
    bad = [
        {"kind": "save_bonus", "condition": "always"}, {"kind": "save_bonus", "amount": 2, "fromAbilityModifier": "con"}, {"kind": "save_bonus", "amount": 2}, {"kind": "speed_bonus", "amount": -5}, {"kind": "speed_bonus", "amount": 0},
        {"kind": "ac_bonus", "amount": 0, "skills": []}, {"kind": "resistance", "damageTypes": ["associated with your ancestry"]}, {"kind": "resistance", "damageTypes": ["Poison", "fire"]}, {"definitions": [{"effects": [{"kind": "choice", "options": [{"damageType": "rust"}]}]}]}, {"kind": "x"}, 3,
    ]
    df = spark.createDataFrame([(i, json.dumps(v)) for i, v in enumerate(bad)] + [(90, None), (91, "{")], "i long, v string")
    got = {(r["row_id"], r["path"]): r["errors"] for r in gates.taxonomy_errors(df, "i", "v").collect()}
    assert got == {(0, "$"): "one_of", (1, "$"): "one_of", (2, "$"): "", (3, "$"): "", (4, "$"): "no_effect", (5, "$"): "", (6, "$"): "damage_type", (7, "$"): "", (8, "$.definitions[0].effects[0]"): "", (8, "$.definitions[0].effects[0].options[0]"): "damage_type", (9, "$"): ""}


def test_values_and_derived_speeds(spark):
    cases = [('[{"kind":"speed_bonus","amount":5}]', "35 feet", True), ('[{"amount":5,"kind":"speed_bonus"}]', "5 feet", True), ('[{"kind":"ac_bonus","amount":5}]', "35 feet", False), ('{"kind":"resistance","amount":2}', "32 miles", False), ('{"a":{"kind":"speed_bonus","byLevel":{"amount":5}}}', "35", False), ("true", "it is true", True), ("false", "it is true", False), ("[]", "x", True), ("[1, true]", "only 1", True), ("[1", "1", False)]
    df = spark.createDataFrame([(i, v, q) for i, (v, q, _) in enumerate(cases)], "i int, v string, q string")
    assert [r["ok"] for r in df.select("i", gates.value_in_quote(F.col("v"), F.col("q")).alias("ok")).orderBy("i").collect()] == [ok for _, _, ok in cases]


def test_compared_forms(spark):
    cases = [("Hill Dwarf", "HillDwarf", False), (" Hill Dwarf\n", "hill dwarf", True), ('[{"kind":"a","condition":"always","n":1}]', '[ {"n": 1, "kind": "a"} ]', True), ('{"kind":"a","condition":"dark"}', '{"kind":"a"}', False), (None, "", True), ("[broken", "[BROKEN ", True)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(cases)], "i int, a string, b string")
    assert [r["x"] for r in df.select("i", (evaluate.plain(F.col("a")) == evaluate.plain(F.col("b"))).alias("x")).orderBy("i").collect()] == [x for _, _, x in cases]


def test_metrics_of_runs(spark, rows):
    """The same numbers as comparing each run with all of gold, answers left out and null values included."""
    rng = random.Random(12)
    value = lambda: rng.choice(["x", "X ", "y", "", None])
    gold = [(f, i, value()) for f in "fg" for i in range(12)]
    pred = [(r, f, i, value()) for r in range(4) for f in "fg" for i in range(15) if rng.random() < 0.7 and (r, f) != (3, "g")]
    g = spark.createDataFrame(gold, "field string, item int, value string")
    p = spark.createDataFrame(pred, "run long, field string, item int, value string")
    want = []
    for r in range(4):
        one = evaluate.metrics(evaluate.compared(p.where(F.col("run") == r), g), ["field"])
        want += [(r, *x) for x in rows(one.select("field", "n", "tp", "fp", "fn", "precision", "recall", "exact"))]
    got = rows(evaluate.metrics_of_runs(p, g).select("run", "field", "n", "tp", "fp", "fn", "precision", "recall", "exact"))
    assert got == sorted((x for x in want if (x[0], x[1]) != (3, "g")), key=repr)
