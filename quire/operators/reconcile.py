"""Two readings of a page: alignment, vote, conflicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import boxes, fuzzy
from quire.functions.text import normalize


def best_overlap(a: DataFrame, b: DataFrame, page: list[str], least: float = 0.5) -> DataFrame:
    """id_a, id_b, iou: for each row of a the row of b on its page with the largest overlap (first index among equals).

    a and b: page columns, id, idx, box. The join is on the page, so the pairs are those of one page's boxes.
    """
    left = a.select(*page, F.col("id").alias("id_a"), F.col("box").alias("ba"))
    right = b.select(*page, F.col("id").alias("id_b"), F.col("idx").alias("ib"), F.col("box").alias("bb"))
    pairs = left.join(right, page).select("id_a", "id_b", "ib", boxes.iou(F.col("ba"), F.col("bb")).alias("iou")).where(F.col("iou") >= least)
    return pairs.groupBy("id_a").agg(F.max_by(F.struct("id_b", "iou"), F.struct(F.col("iou"), -F.col("ib"), -F.col("id_b"))).alias("m")).select("id_a", "m.id_b", "m.iou")


def vote(a: Column, b: Column, c: Column) -> Column:
    """The text two of three readings agree on exactly, else a."""
    return F.when(a.eqNullSafe(b) | a.eqNullSafe(c), a).when(b.eqNullSafe(c), b).otherwise(a)


def vote_kind(a: Column, b: Column, c: Column) -> Column:
    return F.when(a.eqNullSafe(b) | a.eqNullSafe(c) | b.eqNullSafe(c), "majority").otherwise("divergent_low")


def reconcile_pages(regions: DataFrame, least: float = 0.5, accept: float = 0.95) -> DataFrame:
    """doc_id, page_no, id_a, id_b, outcome for each region of engine a: accepted or conflict (paired by an overlap of at least
    ``least``, with texts at least or less than ``accept`` similar), by_text (paired by that similarity) or alone.

    Each region of a has a ranked list of partners: those that overlap enough, by overlap, then those whose text is similar
    enough, by similarity; the one earlier in engine b's order wins a tie. In engine a's order each region gets the first
    partner of its list that is still free. Only that last step depends on the order; it is a fold over the lists of a page.
    Texts whose lengths alone rule the similarity out, and equal ones, are not scored. Null boxes overlap nothing; null texts
    count as empty.
    """
    page = ["doc_id", "page_no"]
    side = lambda e: regions.where(F.col("engine") == e).select(*page, "region_id", F.coalesce("order_idx", F.lit(-1)).alias("at"), boxes.box(F.col("bbox")).alias("box"), normalize(F.col("text")).alias("text"))
    a, b = side("a"), side("b")
    other = b.select(*page, F.col("region_id").alias("id_b"), F.col("at").alias("at_b"), F.col("box").alias("box_b"), F.col("text").alias("text_b"))
    iou = F.coalesce(boxes.iou(F.col("box"), F.col("box_b")), F.lit(0.0))
    n, m = F.length("text"), F.length("text_b")
    possible = 2 * F.least(n, m) >= accept * (n + m)
    pairs = a.join(other, page).withColumns({"iou": iou, "possible": possible}).where((F.col("iou") >= least) | F.col("possible"))
    pairs = pairs.select(*page, "region_id", "id_b", "at_b", "iou", fuzzy.similarity(F.when(F.col("possible"), F.col("text")), F.when(F.col("possible"), F.col("text_b"))).alias("score"))
    close = F.coalesce(F.col("score") >= 100 * accept, F.lit(False))
    wish = F.when(F.col("iou") >= least, F.struct(F.lit(0).alias("kind"), (-F.col("iou")).alias("by"), F.col("at_b").alias("at"), F.col("id_b").alias("id"), F.when(close, "accepted").otherwise("conflict").alias("outcome")))
    wish_text = F.when(close, F.struct(F.lit(1).alias("kind"), (-F.col("score")).alias("by"), F.col("at_b").alias("at"), F.col("id_b").alias("id"), F.lit("by_text").alias("outcome")))
    lists = pairs.groupBy("region_id").agg(F.array_sort(F.array_compact(F.flatten(F.collect_list(F.array(wish, wish_text))))).alias("wishes"))
    ranked = a.select(*page, "at", "region_id").join(lists, "region_id", "left")
    turns = ranked.groupBy(*page).agg(F.array_sort(F.collect_list(F.struct("at", "region_id", "wishes"))).alias("turns"))

    def turn(done: Column, x: Column) -> Column:
        free = F.get(F.filter(x["wishes"], lambda v: ~F.array_contains(done["taken"], v["id"])), F.lit(0))
        taken = F.when(free.isNotNull(), F.array_append(done["taken"], free["id"])).otherwise(done["taken"])
        row = F.struct(x["region_id"].alias("id_a"), free["id"].alias("id_b"), F.coalesce(free["outcome"], F.lit("alone")).alias("outcome"))
        return F.struct(taken.alias("taken"), F.array_append(done["rows"], row).alias("rows"))

    start = F.struct(F.array().cast("array<bigint>").alias("taken"), F.array().cast("array<struct<id_a:bigint,id_b:bigint,outcome:string>>").alias("rows"))
    return turns.select(*page, F.inline(F.aggregate("turns", start, turn, lambda done: done["rows"])))
