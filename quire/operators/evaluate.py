"""Evaluation of predictions against gold values, comparison of runs and annotations."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY = ["field", "item"]


DEFAULTS = {"condition": "always"}  # fixed value: properties of effects that mean the same when left out


def bare(v: object) -> object:
    """A JSON value without properties of effects that stand at their default, at any depth."""
    if isinstance(v, list):
        return [bare(x) for x in v]
    if isinstance(v, dict):
        return {k: bare(x) for k, x in v.items() if "kind" not in v or k not in DEFAULTS or x != DEFAULTS[k]}
    return v


@F.pandas_udf(T.StringType())
def _structure(s: pd.Series) -> pd.Series:
    def one(v: str | None) -> str | None:
        try:
            return None if v is None else json.dumps(bare(json.loads(v)), sort_keys=True, ensure_ascii=False)
        except (ValueError, RecursionError):
            return v.strip().lower()

    return s.map(one)


def plain(v: Column) -> Column:
    """A value in the form that is compared: arrays and objects as JSON with sorted keys and without defaults, others without letter
    case and outer white space; null is ''."""
    inner = v.rlike(r"^\s*[\[{]")
    edges = F.lower(F.regexp_replace(v, r"^\s+|\s+$", ""))
    return F.coalesce(F.when(inner, _structure(F.when(inner, v))).otherwise(edges), F.lit(""))


def compared(pred: DataFrame, gold: DataFrame) -> DataFrame:
    """One row for each (field, item) of either side: expected (whether gold has it), hit, wrong (a value where another or none is
    right), missed (no or another value where gold has one)."""
    p = pred.select(*KEY, F.col("value").alias("p"), F.lit(True).alias("has_p"))
    g = gold.select(*KEY, F.col("value").alias("g"), F.lit(True).alias("has_g"))
    both = p.join(g, KEY, "full_outer")
    same = F.col("has_g").isNotNull() & (plain(F.col("p")) == plain(F.col("g")))
    return both.select(*KEY, F.col("has_g").isNotNull().alias("expected"), same.alias("hit"), (~same & F.col("p").isNotNull()).alias("wrong"), (~same & F.col("g").isNotNull()).alias("missed"))


def metrics(rows: DataFrame, by: list[str]) -> DataFrame:
    """n, tp, fp, fn, precision, recall, exact for each group; an empty precision or recall is 1, an empty exact 0."""
    s = lambda c: F.count_if(F.col(c))
    return _shares(rows.groupBy(*by).agg(s("expected").alias("n"), s("hit").alias("tp"), s("wrong").alias("fp"), s("missed").alias("fn")))


def _shares(out: DataFrame) -> DataFrame:
    share = lambda a, b, empty: F.when(b > 0, F.round(a / b, 6)).otherwise(empty)
    tp, fp, fn, n = (F.col(c) for c in ("tp", "fp", "fn", "n"))
    return out.withColumns({"precision": share(tp, tp + fp, 1.0), "recall": share(tp, tp + fn, 1.0), "exact": share(tp, n, 0.0)})


def path_metrics(pred: DataFrame, gold: DataFrame) -> DataFrame:
    """``metrics`` of each field with ``silent``, the wrong values of high confidence. pred: field, doc_id, field_path, value, confidence;
    gold: gold_field, doc_id, field_path, value. A value at a path that gold has not is invented; a null there is an absence."""
    p = pred.select("doc_id", "field_path", "field", "confidence", F.col("value").alias("p"))
    g = gold.select("doc_id", "field_path", "gold_field", F.col("value").alias("g"), F.lit(True).alias("has_g"))
    both = p.join(g, ["doc_id", "field_path"], "full_outer").where("has_g or p is not null")
    same = F.coalesce(F.col("has_g"), F.lit(False)) & (plain(F.col("p")) == plain(F.col("g")))
    wrong = ~same & F.col("p").isNotNull()
    rows = both.select(F.coalesce("gold_field", "field").alias("field"), F.col("has_g").isNotNull().alias("expected"), same.alias("hit"), wrong.alias("wrong"), (~same & F.col("g").isNotNull()).alias("missed"), (wrong & (F.col("confidence") == "high")).alias("s"))
    return metrics(rows, ["field"]).join(rows.groupBy("field").agg(F.count_if("s").alias("silent")), "field")


def metrics_of_runs(pred: DataFrame, gold: DataFrame) -> DataFrame:
    """``metrics`` of every run (pred: run, field, item, value) against the same gold (field, item, value): run, field, n, tp, fp, fn,
    precision, recall, exact. An item that a run has no answer to counts as a null one.

    Gold is not repeated for each run: what a run left out follows from the totals of gold and the answers it gave.
    """
    empty, some = plain(F.col("g")) == "", F.col("g").isNotNull()
    g = gold.select(*KEY, F.col("value").alias("g"), F.lit(True).alias("has_g"))
    count = lambda c, name: F.count_if(c).alias(name)
    totals = g.groupBy("field").agg(F.count("*").alias("n"), count(empty, "e"), count(some, "s"), count(empty & some, "es"))
    both = pred.select("run", *KEY, F.col("value").alias("p")).join(g, KEY, "left")
    given = F.col("has_g").isNotNull()
    same = given & (plain(F.col("p")) == plain(F.col("g")))
    of = both.groupBy("run", "field").agg(count(same, "h"), count(same & some, "hs"), count(given & empty, "ae"), count(given & empty & some, "aes"), count(~same & F.col("p").isNotNull(), "fp"))
    rows = of.join(F.broadcast(totals), "field", "left").na.fill(0)  # one row for each field
    tp, fn = F.col("h") + F.col("e") - F.col("ae"), F.col("s") - F.col("hs") - F.col("es") + F.col("aes")
    return _shares(rows.select("run", "field", "n", tp.alias("tp"), "fp", fn.alias("fn")))


def run_delta(a: DataFrame, b: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """The groups in which two runs differ, with the differences b - a; a missing side counts as 0."""
    left, right = a.select(*by, *[F.col(c).alias(f"a_{c}") for c in columns]), b.select(*by, *[F.col(c).alias(f"b_{c}") for c in columns])
    zero = F.lit(0)
    delta = lambda c: F.round(F.coalesce(f"b_{c}", zero) - F.coalesce(f"a_{c}", zero), 6)
    out = left.join(right, by, "full_outer").select(*by, *[delta(c).alias(f"d_{c}") for c in columns])
    return out.where(" or ".join(f"d_{c} <> 0" for c in columns))


def annotation_diff(a: DataFrame, b: DataFrame, placeholder: str, absent: str = "<absent>", key: list[str] | None = None) -> DataFrame:
    """key (field and item unless given), a, b where two annotations differ; a placeholder on either side is left out."""
    key = key or KEY
    left, right = a.select(*key, F.col("value").alias("a"), F.lit(True).alias("ha")), b.select(*key, F.col("value").alias("b"), F.lit(True).alias("hb"))
    both = left.join(right, key, "full_outer")
    shown = lambda v, h: F.when(F.col(h).isNull(), absent).otherwise(F.coalesce(v, F.lit("")))
    both = both.select(*key, shown(F.col("a"), "ha").alias("a"), shown(F.col("b"), "hb").alias("b"))
    return both.where((F.col("a") != placeholder) & (F.col("b") != placeholder) & (plain(F.col("a")) != plain(F.col("b"))))
