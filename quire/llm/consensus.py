"""Consensus of several annotators' labels (problem 7).

Triplet moments: the agreement of an annotator with two groups of other annotators and of these groups with each other,
corrected for chance, are products of reliabilities; three of them give the annotator's own. Votes are then combined with
log-odds weights.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.format_copies import letters_and_digits
from quire.operators.skew import salted_lookup
from quire.storage import shared_table

UNFILLED = "DA COMPILARE"  # fixed value: the placeholder of a worksheet cell


@F.pandas_udf(T.StringType())
def text_form(s: pd.Series) -> pd.Series:
    """Letters and digits, letter case aside; null is an answer of its own."""
    return s.map(lambda v: "null" if v is None or v != v else "t" + letters_and_digits(v))


@F.pandas_udf(T.StringType())
def json_form(s: pd.Series) -> pd.Series:
    """JSON with sorted keys and without layout; a value that is no JSON stays as it is."""

    def one(v: object) -> str:
        if v is None or v != v:
            return "null"
        try:
            return "j" + json.dumps(json.loads(v), sort_keys=True, ensure_ascii=False)
        except (ValueError, RecursionError):
            return "r" + v

    return s.map(one)


@dataclass
class Consensus:
    """labels: field, item, answer, agreement (share of the answers that equal it), n_answers, dependable (whether a
    dependable annotator holds it). annotators: annotator, theta (triplet reliability, chance-corrected), n_values,
    n_wrong, reliability (share of values equal to a dependable consensus)."""

    labels: DataFrame
    annotators: DataFrame


def triplet_reliability(votes: DataFrame, rounds: int = 5) -> DataFrame:
    """annotator, theta, chance: reliabilities by triplet moments; votes: field, item, annotator, answer (one row each).

    In each round annotators fall into three groups by a seeded hash. For the values of annotator i, the rates at which i
    agrees with the members of the two other groups, and these with each other, less what chance gives, are
    theta_i*theta_X, theta_i*theta_Y and theta_X*theta_Y. theta_i has the sign of its agreements: who agrees with others less
    than by chance is below 0; agreements of different signs give 0. It is averaged over the rounds, and null where i never
    shares an item with both groups. No pair of annotators is ever formed: all rates come from counts by answer and group, so an
    item with any number of answers is no burden; lookups of hot items are split over tasks.
    """
    chance = votes.groupBy("field", "answer").agg(F.count("*").alias("n")).groupBy("field").agg((F.sum(F.col("n").cast("double") * F.col("n")) / F.pow(F.sum("n"), F.lit(2))).alias("chance"))
    seeded = votes.withColumn("s", F.explode(F.array(*map(F.lit, range(rounds))))).withColumn("g", F.pmod(F.xxhash64("s", "annotator"), F.lit(3)).cast("int"))
    count = lambda k: F.count_if(F.col("g") == k).alias(f"c{k}")
    by_answer = shared_table(seeded.groupBy("field", "item", "s", "answer").agg(count(0), count(1), count(2)), "by-answer")
    total = lambda k: F.sum(f"c{k}").alias(f"n{k}")
    cross = lambda i, j: F.sum(F.col(f"c{i}").cast("double") * F.col(f"c{j}")).alias(f"p{i}{j}")
    by_item = shared_table(by_answer.groupBy("field", "item", "s").agg(total(0), total(1), total(2), cross(0, 1), cross(0, 2), cross(1, 2)), "by-item")
    rows = salted_lookup(seeded, by_answer.withColumn("n", F.col("c0") + F.col("c1") + F.col("c2")), ["field", "item", "s", "answer"], "n", F.col("annotator"))
    rows = salted_lookup(rows, by_item.withColumn("n", F.col("n0") + F.col("n1") + F.col("n2")), ["field", "item", "s"], "n", F.col("annotator"))
    rows = rows.join(F.broadcast(chance), "field")  # one row for each field

    def pick(form: str, shift: int) -> Column:
        return F.when(F.col("g") == 0, F.col(form.format(shift % 3))).when(F.col("g") == 1, F.col(form.format((1 + shift) % 3))).otherwise(F.col(form.format((2 + shift) % 3)))

    corrected = lambda hit, of: F.when(of > 0, (hit / of - F.col("chance")) / (1 - F.col("chance")))
    cx, cy, nx, ny = pick("c{}", 1), pick("c{}", 2), pick("n{}", 1), pick("n{}", 2)
    cross_xy = F.when(F.col("g") == 0, F.col("p12")).when(F.col("g") == 1, F.col("p02")).otherwise(F.col("p01"))
    means = rows.groupBy("annotator", "s").agg(F.avg(corrected(cx, nx)).alias("ax"), F.avg(corrected(cy, ny)).alias("ay"), F.avg(corrected(cross_xy, nx * ny)).alias("xy"), F.avg("chance").alias("chance"))
    square = F.greatest(F.col("ax") * F.col("ay"), F.lit(0.0)) / F.greatest("xy", F.lit(0.01))
    theta = F.when(F.col("ax").isNotNull() & F.col("ay").isNotNull() & F.col("xy").isNotNull(), F.signum(F.col("ax") + F.col("ay")) * F.least(F.sqrt(square), F.lit(1.0)))
    return means.groupBy("annotator").agg(F.avg(theta).alias("theta"), F.avg("chance").alias("chance"))


def _vote(votes: DataFrame, accuracy: DataFrame) -> DataFrame:
    """field, item, answer, agreement, n_answers, dependable by log-odds weights; accuracy: annotator, p, n.

    Annotators with p at most one half have no weight; where no other answered, their answers count by number and the
    label is not dependable. Ties go to the answer with more votes, then to the smaller one.
    """
    p = F.least(F.greatest("p", F.lit(0.02)), F.lit(0.98))
    weighed = salted_lookup(votes, accuracy.select("annotator", F.greatest(F.log(p / (1 - p)), F.lit(0.0)).alias("w"), "n"), ["annotator"], "n", F.xxhash64("item", "field"))
    sums = weighed.groupBy("field", "item", "answer").agg(F.sum("w").alias("w"), F.count("*").alias("n"))
    best = sums.groupBy("field", "item").agg(F.min_by(F.struct("answer", "w", "n"), F.struct(-F.col("w"), -F.col("n"), F.col("answer"))).alias("b"), F.sum("n").alias("n_answers"))
    return best.select("field", "item", "b.answer", (F.col("b.n") / F.col("n_answers")).alias("agreement"), "n_answers", (F.col("b.w") > 0).alias("dependable"))


def _scored(votes: DataFrame, labels: DataFrame) -> DataFrame:
    right = labels.where("dependable").select("field", "item", F.col("answer").alias("label"), F.col("n_answers").alias("n"))
    checked = salted_lookup(votes, right, ["field", "item"], "n", F.col("annotator"))
    return checked.groupBy("annotator").agg(F.count("*").alias("n_values"), F.count_if(F.col("answer") != F.col("label")).alias("n_wrong"))


def consensus(votes: DataFrame, rounds: int = 5) -> Consensus:
    """Consensus labels and annotators' reliabilities; votes: field, item, annotator, answer (not null), one row for each
    annotator, item and field.

    The vote's accuracies are those of the triplet moments, chance + (1 - chance) * theta, and nothing else: no share of
    agreement with an earlier vote enters. An annotator for whom the moments say nothing counts as 0.7. Wrong values are
    counted against the labels so found.
    """
    votes = shared_table(votes, "votes")
    sizes = votes.groupBy("annotator").agg(F.count("*").alias("n"))
    theta = shared_table(triplet_reliability(votes, rounds).join(sizes, "annotator"), "theta")
    accuracy = theta.select("annotator", "n", "theta", F.coalesce(F.col("chance") + (1 - F.col("chance")) * F.col("theta"), F.lit(0.7)).alias("p"))
    labels = shared_table(_vote(votes, accuracy), "labels")
    final = accuracy.select("annotator", "theta").join(_scored(votes, labels), "annotator", "left").na.fill(0, ["n_values", "n_wrong"])
    return Consensus(labels, final.withColumn("reliability", F.when(F.col("n_values") > 0, 1 - F.col("n_wrong") / F.col("n_values"))))


def worksheet_votes(sheet: DataFrame) -> DataFrame:
    """field (featureName, effects), item, annotator, answer from the worksheet: each annotator's latest answer to an item
    (largest label_id among equal times, null times first); values ``DA COMPILARE`` left out, null values kept as the
    answer "absent". Rows without item or annotator are left out."""
    rows = sheet.where("item_id is not null and annotator_id is not null")
    latest = rows.groupBy("item_id", "annotator_id").agg(F.max_by(F.struct(F.col("featureName.value").alias("f"), F.col("effects.value").alias("e")), F.struct("labelled_at", "label_id")).alias("v"))
    both = latest.select(F.col("item_id").alias("item"), F.col("annotator_id").alias("annotator"), F.explode(F.array(F.struct(F.lit("featureName").alias("field"), F.col("v.f").alias("raw")), F.struct(F.lit("effects").alias("field"), F.col("v.e").alias("raw")))).alias("x")).select("item", "annotator", "x.*")
    filled = both.where(~F.col("raw").eqNullSafe(F.lit(UNFILLED)))
    return filled.select("field", "item", "annotator", F.when(F.col("field") == "effects", json_form("raw")).otherwise(text_form("raw")).alias("answer"))


def doubtful(sheet: DataFrame, gold: DataFrame) -> DataFrame:
    """p7_found: subject, subject_id. ``annotator`` with more than half of the filled-in values wrong; ``featureName`` or
    ``effects`` with the item_id whose filled-in gold value is not the dependable annotators' one. A null gold value is
    filled in and says "absent"; items without a dependable answer are not judged."""
    found = consensus(worksheet_votes(sheet))
    people = found.annotators.where("n_wrong * 2 > n_values").select(F.lit("annotator").alias("subject"), F.col("annotator").alias("subject_id"))
    field = lambda n, form: F.struct(F.lit(n).alias("field"), F.col(f"{n}.value").alias("raw"), form(F.col(f"{n}.value")).alias("gold"))
    cells = gold.where("item_id is not null").select(F.col("item_id").alias("item"), F.explode(F.array(field("featureName", text_form), field("effects", json_form))).alias("x")).select("item", "x.*")
    cells = cells.where(~F.col("raw").eqNullSafe(F.lit(UNFILLED)))
    wrong = cells.join(found.labels.where("dependable"), ["field", "item"]).where("gold <> answer")
    return people.unionByName(wrong.select(F.col("field").alias("subject"), F.col("item").alias("subject_id")).distinct())
