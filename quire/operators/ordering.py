"""Reading order of the boxes of a page, by windows over the page."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# fixed values: shares of page or column size
MARGIN, FULL_WIDTH, GAP = 0.05, 0.6, 0.02


def reading_order(df: DataFrame, page: list[str], index: str, box: str, in_flow: str, height: float | None) -> DataFrame:
    """df with ``new_idx``, the position of each box in its page's reading order.

    A page where any box is null or fewer than two boxes are in flow keeps its order. Otherwise out-of-flow boxes come last, and
    the boxes in flow keep their order if they have no width together. Else head margin, body and foot margin follow each other;
    in the body, boxes of at least 0.6 of the width cut the page into sections; sections are read column by column, a column from
    top to bottom. A page is one window group: its size is that of a page.
    """
    w = W.partitionBy(*page)
    b = F.col(box)
    flow = F.col(in_flow)
    x0, y0, x1, y1 = (F.when(flow, b[c]) for c in ("x0", "y0", "x1", "y1"))
    df = df.withColumns({"__w": F.max(x1).over(w) - F.min(x0).over(w), "__as_is": F.max(b.isNull()).over(w) | (F.count_if(flow).over(w) < 2)})
    keep = F.col("__as_is") | (F.col("__w") <= 0) | F.col("__w").isNull()
    head = b["y1"] <= MARGIN * height if height else F.lit(False)
    foot = b["y0"] >= (1 - MARGIN) * height if height else F.lit(False)
    df = df.withColumn("__band", F.when(F.col("__as_is"), 1).when(~flow, 3).when(keep, 1).when(head, 0).when(foot, 2).otherwise(1))
    body = (F.col("__band") == 1) & ~keep
    spanner = body & (b["x1"] - b["x0"] >= FULL_WIDTH * F.col("__w"))
    df = df.withColumn("__span", F.coalesce(spanner, F.lit(False)))
    by_place = W.partitionBy(*page, "__span").orderBy(b["y0"], b["x0"], index)
    df = df.withColumn("__rank", F.when(F.col("__span"), F.row_number().over(by_place) - 1))
    height_of = F.when(F.col("__span"), b["y1"]).otherwise((b["y0"] + b["y1"]) / 2)
    above = F.count_if(F.col("__span")).over(w.orderBy(height_of, ~F.col("__span"), index).rowsBetween(W.unboundedPreceding, 0))
    df = df.withColumn("__section", F.when(~body, 0).when(F.col("__span"), 2 * F.col("__rank") + 1).otherwise(2 * above))
    in_section = W.partitionBy(*page, "__band", "__section").orderBy(b["x0"], index)
    before = F.max(b["x1"]).over(in_section.rowsBetween(W.unboundedPreceding, -1))
    df = df.withColumn("__new", (body & ~F.col("__span") & (b["x0"] > before + GAP * F.col("__w"))).cast("int"))
    df = df.withColumn("__col", F.sum(F.coalesce("__new", F.lit(0))).over(in_section.rowsBetween(W.unboundedPreceding, 0)))
    first = F.min(index).over(W.partitionBy(*page, "__band", "__section", "__col"))
    df = df.withColumn("__first", F.when(body, first))
    key = [F.col("__band"), F.col("__section"), F.when(body, F.col("__first")), F.when(body, b["y0"]), F.when(body, b["x0"]), F.col(index)]
    out = df.withColumn("new_idx", F.row_number().over(w.orderBy(*key)) - 1)
    return out.drop("__w", "__as_is", "__band", "__span", "__rank", "__section", "__new", "__col", "__first")


def page_text(df: DataFrame, page: list[str], order: str, text: str, name: str = "text") -> DataFrame:
    """The texts of each page in order, joined by line ends; null texts are left out."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t"))))
    return df.groupBy(*page).agg(F.array_join(F.transform(F.filter(parts, lambda p: p["t"].isNotNull()), lambda p: p["t"]), "\n").alias(name))
