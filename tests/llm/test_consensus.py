"""Consensus on planted annotators; hot items, ties, nulls."""

from __future__ import annotations

import json
import random

from pyspark.sql import functions as F

from quire.llm.consensus import consensus, doubtful, worksheet_votes

SHEET = "label_id long, item_id long, doc_id string, annotator_id long, anchor string, page int, featureName struct<value: string>, effects struct<value: string>, labelled_at timestamp, field string, answer string"
GOLD = "item_id long, doc_id string, anchor string, page int, raceName struct<value: string>, featureName struct<value: string>, grantedAtLevel struct<value: int>, effects struct<value: string>"


def planted(spark, items=150, people=16, bad=(2, 5, 7)):
    rng, sheet, gold, label = random.Random(3), [], [], 0
    from datetime import datetime, timedelta

    when = datetime(2025, 1, 1)
    for i in range(items):
        right, effect = f"Feature {i}", json.dumps([{"kind": "a", "amount": i % 5}])
        for a in range(people):
            if rng.random() < 0.55:
                ok = rng.random() < (0.25 if a in bad else 0.92)
                f = right.upper() if ok else rng.choice(["Feature", "Other", None])
                e = json.dumps(json.loads(effect), indent=1) if ok else json.dumps([{"kind": "b", "amount": rng.randint(0, 9)}])
                label += 1
                sheet.append((label, i, "d", a, "x", 1, (f,), (e,), when + timedelta(hours=label), "c", "c"))
                if rng.random() < 0.1:
                    sheet.append((label, i, "d", a, "x", 1, ("old",), ("old",), when, "c", "c"))
        gold.append((i, "d", "x", 1, (None,), ("wrong" if i % 30 == 0 else right,), (1,), ("DA COMPILARE" if i % 7 == 0 else effect,)))
    sheet += [(None, None, None, 1, None, None, None, None, None, None, None), (label + 1, 3, "d", None, None, None, None, None, None, None, None), (label + 2, 900, "d", 1, None, None, ("DA COMPILARE",), (None,), None, None, None)]
    return spark.createDataFrame(sheet, SHEET), spark.createDataFrame(gold, GOLD)


def test_planted(spark):
    sheet, gold = planted(spark)
    got = {(r["subject"], r["subject_id"]) for r in doubtful(sheet, gold).collect()}
    assert {x for x in got if x[0] == "annotator"} == {("annotator", a) for a in (2, 5, 7)}
    assert {x for x in got if x[0] == "featureName"} >= {("featureName", i) for i in range(30, 150, 30)}
    assert sum(x[0] != "annotator" for x in got) <= 8
    found = consensus(worksheet_votes(sheet))
    assert found.annotators.where("annotator = 5").first()["theta"] < 0.6 < found.annotators.where("annotator = 1").first()["theta"]
    label = found.labels.where("field = 'featureName' and item = 3").first()
    assert label["answer"] == "tfeature3" and 0 < label["agreement"] <= 1 and label["dependable"]
    assert found.labels.where("field = 'effects' and item = 900").first()["answer"] == "null"
    assert found.labels.where("field = 'featureName' and item = 900").count() == 0


def test_empty_single_and_tie(spark):
    sheet, gold = planted(spark, items=1, people=1)
    assert doubtful(sheet.where("false"), gold).count() == 0
    assert doubtful(sheet.where("false"), gold.where("false")).count() == 0
    votes = spark.createDataFrame([("f", 1, 1, "x"), ("f", 1, 2, "y")], "field string, item long, annotator long, answer string")
    assert consensus(votes).labels.first()["answer"] == "x"


def test_hot_item(spark):
    """One item with a third of all votes."""
    rows = [("f", 0, a, "right" if a % 10 else f"w{a}") for a in range(400)]
    rows += [("f", 1 + i, (i * 7 + k) % 400, "r" if k else "q") for i in range(160) for k in range(5)]
    votes = spark.createDataFrame(rows, "field string, item long, annotator long, answer string")
    labels = consensus(votes, rounds=2).labels
    assert labels.where("item = 0").first()["answer"] == "right"
    assert labels.where(F.col("item") > 0).where("answer <> 'r'").count() == 0


def test_adversary(spark):
    """Who always gives another of two answers has a reliability below 0 and no say."""
    rng, rows = random.Random(11), []
    for i in range(300):
        right = rng.choice("xy")
        for a in range(9):
            if rng.random() < 0.7:
                good = rng.random() < (0.04 if a == 3 else 0.93)
                rows.append(("f", i, a, right if good else "xy".replace(right, "")))
    found = consensus(spark.createDataFrame(rows, "field string, item long, annotator long, answer string"))
    people = {r["annotator"]: r for r in found.annotators.collect()}
    assert people[3]["theta"] < -0.7 and people[3]["reliability"] < 0.15
    assert all(people[a]["theta"] > 0.7 for a in people if a != 3)
