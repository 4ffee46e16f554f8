"""Items larger than a limit, cut at natural boundaries with an overlap (problem 4).

Dynamic programming over boundary positions minimises the sum of cut penalties and size imbalance, subject to the maximum
length and the overlap.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: penalty of a cut by the kind of boundary before the position
PARAGRAPH, SENTENCE_LINE, SENTENCE, LINE, CLAUSE, WORD, INSIDE = 0.0, 0.1, 0.2, 0.5, 0.6, 1.0, 4.0
_BOUNDARY = re.compile(r"\n\s*\n\s*|(?<=[.!?…:;])[\"'”»)\]]*\s*\n|(?<=[.!?…])[\"'”»)\]]*\s+|(?<![-‐¬\s])[^\S\n]*\n|(?<=[,;:)])\s+")
_SPACE = re.compile(r"\s+")


def boundaries(text: str) -> dict[int, float]:
    """Cut positions (a piece ends before them) and their penalties: paragraph, sentence, line and clause ends."""
    found: dict[int, float] = {}
    for m in _BOUNDARY.finditer(text):
        gap, before = m[0], text[m.start() - 1 : m.start()]
        ends = before in ".!?…" or gap[:1] in "\"'”»)]"
        lines = gap.count("\n")
        found[m.end()] = PARAGRAPH if lines > 1 else SENTENCE_LINE if lines and ends else LINE if lines else SENTENCE if ends else CLAUSE
    return found


def cut_positions(text: str, limit: int, overlap: int, balance: float = 1.0) -> list[int]:
    """Ends of the pieces of text; the last is len(text). One piece where text is no longer than limit.

    Piece i covers [end(i-1) - overlap, end(i)), the first one [0, end(0)). Word ends, and positions inside words at
    penalty 4, become candidates only in stretches that have no better boundary, so that a piece can always end.
    """
    n = len(text)
    if n <= limit:
        return [n]
    step = limit - overlap  # new characters of a piece but the first
    if step < 1 or overlap < 0:
        raise ValueError("overlap must be smaller than limit")
    found = {p: c for p, c in boundaries(text).items() if overlap <= p < n}
    reach = max(1, step // 3)  # a stretch of that length without a boundary gets finer candidates
    for finer, penalty in ((_SPACE, WORD), (None, INSIDE)):
        known = [0, *sorted(found), n]
        for a, b in zip(known, known[1:]):
            if b - a > reach:
                at = (m.end() for m in finer.finditer(text, a, b)) if finer else range(a + reach // 2, b, max(1, reach // 2))
                found.update({p: penalty for p in at if max(a, overlap, 1) <= p < b and p not in found})
    pos = np.array([0, *sorted(found), n])
    pen = np.array([0.0, *[found[p] for p in sorted(found)], 0.0])
    pieces = 1 + -(-(n - limit) // step)
    want = (n + (pieces - 1) * overlap) / pieces
    best, back = np.full(len(pos), np.inf), np.zeros(len(pos), dtype=int)
    best[0] = -balance * 0.0
    low = np.searchsorted(pos, pos - step, "left")
    for j in range(1, len(pos)):
        lo = low[j]
        at = pos[lo:j]
        size = pos[j] - at + overlap
        cost = best[lo:j] + pen[j] + balance * ((size - want) / limit) ** 2 + 0.05
        if pos[j] <= limit:  # as the first piece, which has no overlap
            first = pen[j] + balance * ((pos[j] - want) / limit) ** 2 + 0.05
            if lo == 0:
                cost[0] = first
            elif first < (cost.min() if len(cost) else np.inf):
                best[j], back[j] = first, 0
                continue
        elif lo == 0:
            cost[0] = np.inf
        if len(cost):
            k = int(cost.argmin())
            best[j], back[j] = cost[k], lo + k
    ends, j = [], len(pos) - 1
    while j:
        ends.append(int(pos[j]))
        j = back[j]
    return ends[::-1]


def _places(limit: int, overlap: int):
    @F.pandas_udf(T.ArrayType(T.ArrayType(T.IntegerType())))
    def places(texts: pd.Series) -> pd.Series:
        def one(t: str | None) -> list | None:
            if t is None:
                return None
            ends = cut_positions(t, limit, overlap)
            return [[start, end] for start, end in zip([0, *(e - overlap for e in ends)], ends, strict=False)]

        return texts.map(one)

    return places


def pieces(df: DataFrame, row_id: str, text: str, limit: int = 2000, overlap: int = 150) -> DataFrame:
    """row_id, piece (from 0), start, end (code points), text: the pieces of every item.

    Every piece has at most ``limit`` characters; each but the first starts with the last ``overlap`` characters of the one
    before. Items within the limit, the empty one included, come out whole as piece 0; null texts give no piece. The result
    depends on the text alone; repeated rows give repeated pieces. One scan without a shuffle: only texts over the limit go to
    Python, which gives back the places of their pieces.
    """
    rows = df.select(F.col(row_id).cast("long").alias("row_id"), F.col(text).alias("text")).where("text is not null")
    size = F.length("text")
    places = F.coalesce(_places(limit, overlap)(F.when(size > limit, F.col("text"))), F.array(F.array(F.lit(0), size)))
    cut = rows.select("row_id", "text", F.posexplode(places).alias("piece", "at"))
    start, end = F.col("at")[0], F.col("at")[1]
    return cut.select("row_id", "piece", start.alias("start"), end.alias("end"), F.substring(F.col("text"), start + 1, end - start).alias("text"))


def oversized(df: DataFrame, tbl: str, row_id: str, text: str, limit: int = 2000, overlap: int = 150) -> DataFrame:
    """p4_found of one table: tbl, row_id of the items that come out in more than one piece."""
    return pieces(df.where(F.length(text) > limit), row_id, text, limit, overlap).where("piece = 1").select(F.lit(tbl).alias("tbl"), "row_id")


P4_SQL = "select 'pages' as tbl, page_id as row_id from pages where length(full_text) > 2000 union all select 'regions', region_id from regions where length(text) > 2000"
