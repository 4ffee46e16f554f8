"""Checks of extracted values against their quotes and pages: cheap native tests first, fuzzy ones for what is left."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import boxes, fuzzy, numbers, text
from quire.operators.nested_tables import Emit, tagged_rows
from quire.storage import shared_table

# fixed values: the closed list of damage types, the kinds that need exactly one of two properties, and those without effect at
# amount 0
DAMAGE_TYPES = ("acid", "bludgeoning", "cold", "fire", "force", "lightning", "necrotic", "piercing", "poison", "psychic", "radiant", "slashing", "thunder")
ONE_OF = {"speed_bonus": ("amount", "byLevel"), "ac_bonus": ("amount", "fromAbilityModifier"), "attack_bonus": ("amount", "byLevel"), "save_bonus": ("amount", "fromAbilityModifier"), "resource_cost": ("amount", "variableAmount")}
NO_OP_AT_ZERO = ("speed_bonus", "ac_bonus", "attack_bonus", "save_bonus", "damage_bonus", "initiative_bonus", "hp_bonus_per_level", "ability_score_bonus", "spell_attack_bonus", "spell_save_dc_bonus", "check_modifier")


def value_in_quote(value_json: Column, quote: Column) -> Column:
    """Whether a value can be derived from its quote: both null; a number that stands in the quote; a string or boolean whose normal
    form is part of the quote's; an array or object each of whose numbers has a witness in the quote (``numbers.witnesses``).
    Only arrays and objects leave the JVM."""
    v = F.trim(value_json)
    null = value_json.isNull() | (v == "null")
    said = numbers.signed_numbers(quote)
    near = lambda n: F.exists(said, lambda x: F.abs(x - n) < 1e-6)
    number = v.try_cast("double")
    quoted = v.rlike('^"')
    string = text.normalize(F.when(quoted, F.get_json_object(F.concat(F.lit('{"v":'), v, F.lit("}")), "$.v")).otherwise(v))
    inner = v.rlike(r"^[\[{]")
    nested = F.coalesce(F.forall(numbers.witnesses(F.when(inner, v)), lambda w: F.exists(w, near)), F.lit(False))
    said_so = (string != "") & F.contains(text.normalize(quote), string)
    return F.when(null & quote.isNull(), True).when(null | quote.isNull(), False).when(inner, nested).when(quoted | v.isin("true", "false"), said_so).otherwise(F.coalesce(near(number), F.lit(False)))


def by_page(df: DataFrame) -> DataFrame:
    """df partitioned by page in as many parts as the session shuffles to: work in Python weighs more than the bytes suggest that
    adaptive execution would merge partitions by. The join by page that follows needs no other shuffle of df."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "doc_id", "page_no")


def grounded(rows: DataFrame, pages: DataFrame, on: list[str], threshold: float = 90.0) -> DataFrame:
    """rows (on, quote) with ``ok``: the quote is (nearly) verbatim on its page. pages: on (one row each), page (text).

    A page is normalised and its numbers are read once; its raw text is not shuffled. Native tests come first: both texts
    present, the quote not longer than the page, all its identifiers and signed numbers on the page. Only quotes that pass and
    are not contained word by word go to the fuzzy score. A null or blank quote, or one without a page, is not grounded.
    """
    facts = pages.select(*on, text.normalize(F.col("page")).alias("__p"), numbers.signed_numbers(F.col("page")).alias("__n"))
    rows = rows.withColumn("__q", text.normalize(F.col("quote"))).join(facts, on, "left")
    ids = F.forall(numbers.identifier_tokens(F.col("quote")), lambda t: F.contains(F.col("__p"), F.trim(F.regexp_replace(F.regexp_replace(F.lower(t), "[^a-z0-9_]", " "), " +", " "))))
    nums = F.size(F.array_except(numbers.signed_numbers(F.col("quote")), F.col("__n"))) == 0
    cheap = (F.col("__q") != "") & (F.length("__q") <= F.length("__p")) & ids & nums
    rows = rows.withColumn("__cheap", F.coalesce(cheap, F.lit(False)))
    inside = F.contains("__p", "__q")
    ask = F.col("__cheap") & ~inside
    score = fuzzy.partial_similarity(F.when(ask, F.col("__q")), F.when(ask, F.col("__p")), threshold)
    return rows.withColumn("ok", F.when(~F.col("__cheap"), False).when(inside, True).otherwise(F.coalesce(score >= threshold, F.lit(False)))).drop("__q", "__p", "__n", "__cheap")


def anchored(items: DataFrame, pages: DataFrame, threshold: float = 90.0) -> DataFrame:
    """The items (doc_id, page, anchor, normalised and not empty) whose anchor their page has with a partial ratio of at least the
    threshold; pages: doc_id, page, norm (normalised). Anchors that the page contains are not scored."""
    parts = int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = items.repartition(parts, "doc_id", "page").join(pages, ["doc_id", "page"])
    return pairs.where(fuzzy.partial_similarity(F.col("anchor"), F.col("norm"), threshold) >= threshold).drop("norm")


def located(quotes: DataFrame, regions: DataFrame, threshold: float = 80.0) -> DataFrame:
    """id, region_id, bbox, score of the region of the quote's page that matches it best (first region among equals); bbox null if
    the score is below the threshold (then 0) or the region has none. quotes: id, doc_id, page_no, q (normalised); regions:
    doc_id, page_no, region_id, order_idx, bbox, r (normalised).

    A quote contained in a region, or containing one, scores 100 by a native test; only the other quotes are scored.
    """
    pairs = by_page(quotes).join(regions, ["doc_id", "page_no"])
    whole = F.contains("r", "q") | F.contains("q", "r")
    first = pairs.where(whole).groupBy("id").agg(F.min_by(F.struct("region_id", "bbox"), F.struct("order_idx", "region_id")).alias("b"))
    sure = shared_table(first.select("id", "b.region_id", "b.bbox", F.lit(100.0).alias("score")), "located")
    rest = pairs.join(sure.select("id"), "id", "left_anti").withColumn("score", fuzzy.partial_similarity(F.col("q"), F.col("r"), threshold))
    best = rest.groupBy("id").agg(F.max_by(F.struct("region_id", "bbox", "score"), F.struct("score", -F.col("order_idx"), -F.col("region_id"))).alias("b"))
    return sure.unionByName(best.select("id", "b.region_id", F.when(F.col("b.score") >= threshold, F.col("b.bbox")).alias("bbox"), F.round("b.score", 4).alias("score")))


def effect_errors(e: Column) -> Column:
    """What the loader's rules find wrong with an effect, as a sorted array of codes: not exactly one of two properties, an amount
    of 0 without anything else, an unknown damage type. e: struct<kind, amount, alone, has, types> as ``object_rows`` gives it."""
    some = lambda k: F.array_contains(e["has"], k)
    one_of = F.coalesce(F.array_max(F.array(*[((e["kind"] == k) & (some(a) == some(b))) for k, (a, b) in ONE_OF.items()])), F.lit(False))
    no_op = e["kind"].isin(*NO_OP_AT_ZERO) & (e["amount"] == 0) & e["alone"]
    unknown = F.exists(e["types"], lambda t: ~F.lower(t).isin(*DAMAGE_TYPES))
    return F.array_compact(F.array(F.when(unknown, "damage_type"), F.when(no_op, "no_effect"), F.when(one_of, "one_of")))


def visit_objects(record: Any, emit: Emit) -> None:
    """Emits ``object`` for each JSON object at any depth that has a kind or damage types: pk its path, payload what the
    loader's rules look at: kind, amount, alone (no property but kind, condition and amount), has (properties that are not
    null), types (its damage types)."""
    todo = [("$", record)]
    while todo:
        path, v = todo.pop()
        if isinstance(v, list):
            todo += [(f"{path}[{i}]", x) for i, x in reversed(list(enumerate(v)))]
        if not isinstance(v, dict):
            continue
        todo += [(f"{path}.{k}", x) for k, x in reversed(list(v.items()))]
        given = [t for k in ("damageType", "damageTypes") for t in (v[k] if isinstance(v.get(k), list) else [v.get(k)]) if isinstance(t, str)]
        if given or isinstance(v.get("kind"), str):
            amount = v.get("amount")
            number = amount if isinstance(amount, (int, float)) and not isinstance(amount, bool) else None
            emit("object", path, None, {"kind": v.get("kind") if isinstance(v.get("kind"), str) else None, "amount": number, "alone": set(v) <= {"kind", "condition", "amount"}, "has": [k for k, x in v.items() if x is not None], "types": given})


OBJECT = "kind string, amount double, alone boolean, has array<string>, types array<string>"


def taxonomy_errors(df: DataFrame, row_id: str, value: str) -> DataFrame:
    """row_id, path, kind, errors (codes joined by commas, '' where there are none) of every object of the taxonomy in a JSON column,
    options and other nested ones included. Null values and text that is no JSON have no objects."""
    found = tagged_rows(df, row_id, value, visit_objects).where("tag = 'object'")
    rows = found.select("row_id", F.col("pk").alias("path"), F.from_json("payload", OBJECT).alias("e"))
    return rows.select("row_id", "path", "e.kind", F.array_join(effect_errors(F.col("e")), ",").alias("errors"))


def dependents(changed: DataFrame, extractions: DataFrame) -> DataFrame:
    """ext_id of the extractions whose box overlaps a changed region of their page; changed: doc_id, page_no, box."""
    pairs = extractions.join(changed.withColumnRenamed("box", "rbox"), ["doc_id", "page_no"])
    return pairs.where(boxes.iou(F.col("box"), F.col("rbox")) > 0).select("ext_id").distinct()


def dependents_by_quote(changed: DataFrame, extractions: DataFrame, threshold: float = 90.0) -> DataFrame:
    """ext_id of the extractions whose quote stands (nearly) in the old text of a changed region of their page; changed: doc_id,
    page_no, r (normalised); extractions: ext_id, doc_id, page_no, q (normalised, not empty)."""
    pairs = by_page(extractions).join(changed.where("r <> ''"), ["doc_id", "page_no"])
    return pairs.where(fuzzy.partial_similarity(F.col("q"), F.col("r"), threshold) >= threshold).select("ext_id").distinct()


def retried(rows: DataFrame, check: Callable[[DataFrame], Column], ask: Callable[[DataFrame], DataFrame], rounds: int = 3) -> DataFrame:
    """rows with ``attempt`` and ``state``: every row that fails the check is asked again and checked as the next attempt, at most
    ``rounds`` attempts in all; what fails the last one needs review.

    check gives a boolean column of a DataFrame, ask replaces the columns of failed rows by new answers. The rounds are a
    fixed number of passes; failed rows of a round are written once, so no round repeats the work of an earlier one.
    """
    todo, out = rows.withColumn("attempt", F.lit(1)), None
    for k in range(1, rounds + 1):
        tried = shared_table(todo.withColumn("__ok", F.coalesce(check(todo), F.lit(False))), "attempt")
        done = tried.where("__ok").drop("__ok").withColumn("state", F.lit("validated"))
        out = done if out is None else out.unionByName(done)
        failed = tried.where("not __ok").drop("__ok")
        if k == rounds:
            return out.unionByName(failed.withColumn("state", F.lit("needs_review")))
        todo = ask(failed).withColumn("attempt", F.lit(k + 1))
    return out
