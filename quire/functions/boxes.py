"""Boxes as struct<x0, y0, x1, y1> columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def box(json_text: Column) -> Column:
    """The box of a JSON array of four numbers, null for anything else."""
    v = F.from_json(json_text, "array<double>")
    return F.when((F.size(v) == 4) & ~F.exists(v, lambda x: x.isNull()), F.struct(v[0].alias("x0"), v[1].alias("y0"), v[2].alias("x1"), v[3].alias("y1")))


def area(b: Column) -> Column:
    return F.greatest(b["x1"] - b["x0"], F.lit(0.0)) * F.greatest(b["y1"] - b["y0"], F.lit(0.0))


def union(a: Column, b: Column) -> Column:
    return F.struct(F.least(a["x0"], b["x0"]).alias("x0"), F.least(a["y0"], b["y0"]).alias("y0"), F.greatest(a["x1"], b["x1"]).alias("x1"), F.greatest(a["y1"], b["y1"]).alias("y1"))


def expand(b: Column, margin: float, width: float, height: float) -> Column:
    """b with a margin, clamped to the page."""
    return F.struct(F.greatest(F.lit(0.0), b["x0"] - margin).alias("x0"), F.greatest(F.lit(0.0), b["y0"] - margin).alias("y0"), F.least(F.lit(float(width)), b["x1"] + margin).alias("x1"), F.least(F.lit(float(height)), b["y1"] + margin).alias("y1"))


def iou(a: Column, b: Column) -> Column:
    """Intersection over union, 0 where the union is empty."""
    w = F.greatest(F.lit(0.0), F.least(a["x1"], b["x1"]) - F.greatest(a["x0"], b["x0"]))
    h = F.greatest(F.lit(0.0), F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"]))
    both = w * h
    total = area(a) + area(b) - both
    return F.when(total > 0, both / total).otherwise(0.0)


def rotate(b: Column, degrees: Column, width: float, height: float) -> Column:
    """The upright box around b rotated about the page's centre; angle 0 or null leaves b as it is."""
    cx, cy = width / 2.0, height / 2.0
    cos, sin = F.cos(F.radians(degrees)), F.sin(F.radians(degrees))
    corners = [(b["x0"], b["y0"]), (b["x1"], b["y0"]), (b["x1"], b["y1"]), (b["x0"], b["y1"])]
    xs = [cx + (x - cx) * cos - (y - cy) * sin for x, y in corners]
    ys = [cy + (x - cx) * sin + (y - cy) * cos for x, y in corners]
    turned = F.struct(F.least(*xs).alias("x0"), F.least(*ys).alias("y0"), F.greatest(*xs).alias("x1"), F.greatest(*ys).alias("y1"))
    return F.when(F.coalesce(degrees, F.lit(0.0)) == 0, b).otherwise(turned)
