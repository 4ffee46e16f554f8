"""Mixing sources to target weights (problem 9): capped water-filling, then seeded whole and fractional repetitions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.tokens import VOCABULARY, token_ids
from quire.storage import shared_table

BITS, LEVELS = 12, 2  # the sampling threshold is found on a histogram of 2^BITS buckets, LEVELS times


def water_fill(total: float, weight: dict[str, float], cap: dict[str, float]) -> dict[str, float]:
    """Tokens of each source: total is handed out by weight; a source whose part exceeds its cap is clamped there and the
    excess goes to the others in proportion to their weights, until every part is feasible or all sources are full."""
    got = dict.fromkeys(weight, 0.0)
    free, left = {s for s in weight if cap.get(s, 0) > 0 and weight[s] > 0}, total
    while free and left > 0:
        sum_w = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / sum_w > cap[s]}
        if not over:
            return got | {s: left * weight[s] / sum_w for s in free}
        for s in sorted(over):
            got[s] = float(cap[s])
            left -= cap[s]
        free -= over
    return got


def exact_total(weight: dict[str, float], cap: dict[str, float]) -> float:
    """The largest total at which no source with tokens falls short of its weight among the sources with tokens."""
    has = [s for s in weight if cap.get(s, 0) > 0 and weight[s] > 0]
    return min((cap[s] * sum(weight[x] for x in has) / weight[s] for s in has), default=0.0)


@dataclass
class Mix:
    """rows: doc_id, source, n_tokens, repeats (at least 1); shares: one row for each target."""

    rows: DataFrame
    shares: DataFrame


def mix_sources(docs: DataFrame, targets: DataFrame, total_tokens: float | str | None = None, seed: int = 7, path: str = VOCABULARY) -> Mix:
    """Documents with their numbers of repetitions, so that each source has its weight of the tokens.

    total_tokens None: the largest total at which every source that has tokens reaches its weight exactly (within one
    document). Otherwise that total, or with "available" as many tokens as the sources with a target have, is filled by
    ``water_fill``: sources that would exceed max_repeats epochs are clamped there, and the rest goes to the others. A source with a target and no tokens contributes nothing
    and its weight goes to the others in proportion; documents whose source is null or has no target stay out, as do those
    without tokens (null or empty text). max_repeats null or below 1 counts as 1; weights null or below 0 as 0; repeated
    target rows of a source as their sum of weights and smallest max_repeats. No document is used more than max_repeats
    times. The same seed gives the same mix whatever the partitioning.

    targets goes to the driver (a handful of rows by nature). Documents are tokenised once, to (id, source, size); the
    fractional repetition takes the documents whose seeded hash lies below a threshold of the source, found from bucket
    sums of a fixed number of buckets, so neither a sort nor a source's rows ever lie in one task.
    """
    spark = docs.sparkSession
    wanted = {}
    for r in targets.select("source", F.col("weight").cast("double"), F.col("max_repeats").cast("int")).where("source is not null").collect():
        w, m = wanted.get(r["source"], (0.0, None))
        times = max(1, r["max_repeats"] or 1)
        wanted[r["source"]] = (w + max(0.0, r["weight"] or 0.0), times if m is None else min(m, times))
    inside = docs.where(F.col("source").isin(list(wanted))) if wanted else docs.where(F.lit(False))
    sized = token_ids(inside, "doc_id", "text", path, keep=["source"], count_only=True).where("ids > 0")
    u = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id"), 64 - BITS * LEVELS).alias("u")
    sized = shared_table(sized.select("doc_id", "source", F.col("ids").alias("n_tokens"), u), "sized")
    have = {r["source"]: r["n"] for r in sized.groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()}
    weight, cap = {s: w for s, (w, _) in wanted.items()}, {s: float(have.get(s, 0) * m) for s, (_, m) in wanted.items()}
    total = exact_total(weight, cap) if total_tokens is None else float(sum(have.get(s, 0) for s in wanted)) if total_tokens == "available" else float(total_tokens)
    goal = water_fill(total, weight, cap)
    epochs = {s: min(goal[s] / have[s], wanted[s][1]) if have.get(s) else 0.0 for s in wanted}
    whole = {s: int(e + 1e-9) for s, e in epochs.items()}
    rest = {s: max(0.0, (epochs[s] - whole[s]) * have.get(s, 0)) for s in wanted}
    limit = dict.fromkeys(wanted, 0)  # documents with u below it get one more repetition
    below = dict.fromkeys(wanted, 0.0)
    for level in range(1, LEVELS + 1):
        width = BITS * (LEVELS - level)
        prefix = F.shiftright("u", width)
        open_ = [s for s in wanted if rest[s] > 0.5]
        if not open_:
            break
        near = F.lit(False)
        for s in open_:
            near |= (F.col("source") == s) & (F.shiftright("u", width + BITS) == limit[s] >> (width + BITS))
        sums: dict[str, dict[int, int]] = {s: {} for s in open_}
        for r in sized.where(near).groupBy("source", prefix.alias("p")).agg(F.sum("n_tokens").alias("n")).collect():
            sums[r["source"]][r["p"]] = r["n"]
        for s in open_:
            for p in sorted(sums[s]):
                if below[s] + sums[s][p] > rest[s]:
                    limit[s] = p << width
                    if level == LEVELS and below[s] + sums[s][p] - rest[s] < rest[s] - below[s]:
                        below[s] += sums[s][p]
                        limit[s] += 1
                    break
                below[s] += sums[s][p]
                limit[s] = (p + 1) << width
    plan = spark.createDataFrame([(s, w, m, int(have.get(s, 0)), whole[s], int(limit[s]), float(goal[s])) for s, (w, m) in wanted.items()], "source string, weight double, max_repeats int, available long, whole int, lim long, goal double")
    picked = sized.join(F.broadcast(plan.select("source", "whole", "lim", "max_repeats")), "source")
    repeats = F.least(F.col("whole") + (F.col("u") < F.col("lim")).cast("int"), F.col("max_repeats")).cast("int")
    rows = picked.select("doc_id", "source", "n_tokens", repeats.alias("repeats")).where("repeats > 0")
    used = rows.groupBy("source").agg(F.sum(F.col("n_tokens").cast("long") * F.col("repeats")).alias("used"))
    shares = plan.join(used, "source", "left").select("source", "weight", "max_repeats", "available", "goal", F.coalesce("used", F.lit(0)).alias("used"))
    reached = {r["t"] for r in shares.agg(F.sum("used").alias("t")).collect()}.pop() or 0
    shares = shares.withColumn("share", F.when(F.lit(reached) > 0, F.col("used") / F.lit(float(reached or 1))).otherwise(0.0)).withColumn("epochs", F.when(F.col("available") > 0, F.col("used") / F.col("available")).otherwise(0.0))
    return Mix(rows, shares)
