"""Differences between two copies of a dataset whose keys may repeat.

Identical rows cancel by multiplicity; the rows left over within a key are paired by minimum-cost assignment, the cost of a
pair being the number of fields that differ; what has no partner is missing on the other side.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.operators.skew import rank_within, salted_lookup
from quire.storage import shared_table


def digest(c: Column) -> Column:
    """16 bytes that stand for a string's exact value; null stays null. Two strings share one with odds of 2^-128."""
    return F.unhex(F.substring(F.sha2(c, 256), 1, 32))


def assign(cost: np.ndarray) -> list[tuple[int, int]]:
    """Minimum-cost pairs (row, column) of a cost matrix, min(rows, columns) of them; shortest augmenting paths."""
    if cost.shape[0] > cost.shape[1]:
        return [(i, j) for j, i in assign(cost.T)]
    n, m = cost.shape
    u, v = np.zeros(n + 1), np.zeros(m + 1)
    owner = np.zeros(m + 1, dtype=int)
    for i in range(1, n + 1):
        owner[0], j0 = i, 0
        best, back, used = np.full(m + 1, np.inf), np.zeros(m + 1, dtype=int), np.zeros(m + 1, dtype=bool)
        while owner[j0]:
            used[j0] = True
            reduced = cost[owner[j0] - 1] - u[owner[j0]] - v[1:]
            closer = ~used[1:] & (reduced < best[1:])
            best[1:][closer], back[1:][closer] = reduced[closer], j0
            j1 = int(np.where(used[1:], np.inf, best[1:]).argmin()) + 1
            delta = best[j1]
            u[owner[used]] += delta
            v[used] -= delta
            best[~used] -= delta
            j0 = j1
        while j0:
            owner[j0] = owner[back[j0]]
            j0 = back[j0]
    return sorted((int(owner[j]) - 1, j - 1) for j in range(1, m + 1) if owner[j])


def _reached(cost: np.ndarray, tail: np.ndarray, head: np.ndarray, flow: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Cheapest way from the start nodes (boolean) to each node: along an arc at its cost, back along one with flow at minus its cost."""
    far = np.iinfo(np.int64).max // 4
    dist = np.where(start, 0, far)
    back = flow > 0
    u, v, c = np.concatenate([tail, head[back]]), np.concatenate([head, tail[back]]), np.concatenate([cost, -cost[back]])
    while True:
        before = dist.copy()
        np.minimum.at(dist, v, np.where(dist[u] < far, dist[u] + c, far))
        if (dist == before).all():
            return dist


def _push(tail: np.ndarray, head: np.ndarray, cost: np.ndarray, flow: np.ndarray, free_a: np.ndarray, free_b: np.ndarray, first_b: int, dist: np.ndarray, target: int) -> None:
    """Raises flow, as far as it goes, along the cheapest ways (of cost target) from free a nodes to free b nodes; Dinic's levels."""
    n, arcs = len(dist), len(tail)
    while True:
        back = flow > 0
        use_f, use_b = dist[tail] + cost == dist[head], back & (dist[head] - cost == dist[tail])
        u, v = np.concatenate([tail[use_f], head[use_b]]), np.concatenate([head[use_f], tail[use_b]])
        name = np.concatenate([np.flatnonzero(use_f), arcs + np.flatnonzero(use_b)])
        ends = np.zeros(n, dtype=bool)
        ends[first_b:] = (free_b > 0) & (dist[first_b:] == target)
        level = np.full(n, -1)
        level[: len(free_a)][free_a > 0] = 0
        k = 0
        while not (ends & (level >= 0)).any():
            nxt = v[(level[u] == k)]
            nxt = nxt[level[nxt] < 0]
            if not len(nxt):
                return
            k += 1
            level[nxt] = k
        keep = level[v] == level[u] + 1
        keep &= level[u] >= 0
        u, v, name = u[keep], v[keep], name[keep]
        order = np.argsort(u, kind="stable")
        at = np.searchsorted(u[order], np.arange(n + 1)).tolist()
        to, arc, end = v[order].tolist(), name[order].tolist(), ends.tolist()
        pointer = at[:-1]
        for s in np.flatnonzero(free_a > 0).tolist():
            while free_a[s] > 0:
                path, x = [], s
                while not (end[x] and free_b[x - first_b] > 0):
                    if pointer[x] < at[x + 1]:
                        path.append(x)
                        x = to[pointer[x]]
                    elif path:
                        x = path.pop()
                        pointer[x] += 1
                    else:
                        break
                else:
                    used = [arc[pointer[y]] for y in path]
                    most = min([int(free_a[s]), int(free_b[x - first_b]), *(int(flow[e - arcs]) for e in used if e >= arcs)])
                    if not most:  # the way back is used up
                        y = next(i for i, e in enumerate(used) if e >= arcs and not flow[e - arcs])
                        pointer[path[y]] += 1
                        continue
                    for e in used:
                        flow[e - arcs if e >= arcs else e] += -most if e >= arcs else most
                    free_a[s] -= most
                    free_b[x - first_b] -= most
                    continue
                break


def assign_values(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Minimum-cost pairs (row of a, row of b), min(rows) of them; a and b hold a number for each field's value, the cost of a pair
    is the number of fields that differ, and no row of a equals one of b.

    The cost matrix is never built. Rows of equal values are one node; for every subset of the fields, each combination of values
    that both sides have is a node between the rows of a and b that share it, so the arcs are 2^fields for each distinct row. The flow of
    least cost in that network is the assignment: a way costs fields - |subset|, and ways of each cost, 1 to fields - 1, are used up
    in turn (flows by primal-dual phases). What is left then shares no field that helps, so any pairs of it are right.
    """
    fields = a.shape[1]
    pa, ia = np.unique(a, axis=0, return_inverse=True)
    pb, ib = np.unique(b, axis=0, return_inverse=True)
    ia, ib = ia.ravel(), ib.ravel()
    free_a, free_b = np.bincount(ia, minlength=len(pa)), np.bincount(ib, minlength=len(pb))
    into, out, price, hubs = [], [], [], 0
    for mask in range(1, 2**fields - 1):
        own = [k for k in range(fields) if mask >> k & 1]
        _, code = np.unique(np.concatenate([pa[:, own], pb[:, own]]), axis=0, return_inverse=True)
        code = code.ravel()
        ca, cb = code[: len(pa)], code[len(pa) :]
        both = np.intersect1d(ca, cb)
        ha, hb = np.flatnonzero(np.isin(ca, both)), np.flatnonzero(np.isin(cb, both))
        into.append((ha, hubs + np.searchsorted(both, ca[ha])))
        out.append((hubs + np.searchsorted(both, cb[hb]), hb))
        price.append(np.full(len(ha), fields - len(own), dtype=np.int64))
        hubs += len(both)
    pairs: list[tuple[int, int, int]] = []
    if hubs:
        first_b = len(pa) + hubs
        tail = np.concatenate([x for x, _ in into] + [len(pa) + x for x, _ in out])
        head = np.concatenate([len(pa) + y for _, y in into] + [first_b + y for _, y in out])
        cost = np.concatenate([*price, np.zeros(len(tail) - sum(map(len, price)), dtype=np.int64)])
        flow = np.zeros(len(tail), dtype=np.int64)
        while free_a.any() and free_b.any():
            start = np.zeros(first_b + len(pb), dtype=bool)
            start[: len(pa)] = free_a > 0
            dist = _reached(cost, tail, head, flow, start)
            target = int(dist[first_b:][free_b > 0].min())
            if target >= fields:
                break
            _push(tail, head, cost, flow, free_a, free_b, first_b, dist, target)
        waiting: dict[int, list[list[int]]] = {}
        for e in np.flatnonzero(flow).tolist():  # arcs into the middle nodes come before those out of them
            if head[e] < first_b:
                waiting.setdefault(int(head[e]), []).append([int(tail[e]), int(flow[e])])
                continue
            n, queue = int(flow[e]), waiting[int(tail[e])]
            while n:
                take = min(n, queue[-1][1])
                pairs.append((queue[-1][0], int(head[e]) - first_b, take))
                n -= take
                queue[-1][1] -= take
                if not queue[-1][1]:
                    queue.pop()
    rest = iter(np.repeat(np.arange(len(pb)), free_b).tolist())
    pairs += [(x, y, 1) for x, y in zip(np.repeat(np.arange(len(pa)), free_a).tolist(), rest, strict=False)]
    rows = lambda inverse, n: [x.tolist()[::-1] for x in np.split(np.argsort(inverse, kind="stable"), np.cumsum(np.bincount(inverse, minlength=n))[:-1])]
    ra, rb = rows(ia, len(pa)), rows(ib, len(pb))
    return sorted((ra[x].pop(), rb[y].pop()) for x, y, n in pairs for _ in range(n))


def _pair_key(fields: int, block: int):
    def pair(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", kind="stable")
        code: list[dict[bytes | None, int]] = [{} for _ in range(fields)]
        values = np.array([[code[k].setdefault(None if f is None else bytes(f), len(code[k])) for k, f in enumerate(v)] for v in pdf["vals"]], dtype=np.int64).reshape(-1, fields)
        of_a = (pdf["side"] == "a").to_numpy()
        va, vb, ids = values[of_a], values[~of_a], pdf["id"].to_numpy()
        ia, ib = ids[of_a].tolist(), ids[~of_a].tolist()
        out, done_a, done_b = [], set(), set()
        if ia and ib:
            small = max(len(ia), len(ib)) <= block
            for i, j in assign((va[:, None, :] != vb[None, :, :]).sum(axis=2).astype(float)) if small else assign_values(va, vb):
                done_a.add(i)
                done_b.add(j)
                out.append((ia[i], ib[j], np.flatnonzero(va[i] != vb[j]).tolist()))
        out += [(x, None, None) for i, x in enumerate(ia) if i not in done_a] + [(None, x, None) for j, x in enumerate(ib) if j not in done_b]
        return pd.DataFrame({"id_a": pd.array([x[0] for x in out], dtype="Int64"), "id_b": pd.array([x[1] for x in out], dtype="Int64"), "changed": [x[2] for x in out]})

    return pair


def diff_copies(a: DataFrame, b: DataFrame, key: list[str], fields: dict[str, Column], row_id: str, block: int = 200) -> DataFrame:
    """The differences between copies a and b: columns id_a, id_b (long), changed (array of field names).

    key: columns both copies have; rows belong together where all of them are equal, nulls being equal to nulls.
    fields: the fields to compare, by name, as expressions over either copy that give a string, number or array; null
    equals null only. row_id: long column that names a row. A row of the result is a pair with at least one changed field,
    or a row of one side alone (the other id and ``changed`` null). Keys may repeat on either side: identical rows cancel
    one to one, the rest is paired by minimum cost (number of changed fields, ties by row_id). An empty copy makes every
    row of the other one missing. Other columns, whatever their names, are not read.

    Rows travel as digests, never as texts. Counts are combined before the shuffle, so identical copies of any number are
    one row; keys with one row left on each side need no further work. Only keys with more go on: up to ``block`` rows a side
    as one cost matrix, larger keys as one flow over shared values (``assign_values``), of minimum cost over the whole key too. All
    left-over rows of one key are in one task: 16 bytes a field for each, and in the larger keys about 2^fields arcs.
    """
    names = list(fields)
    vals = F.array(*[F.when(c.isNotNull(), digest(c.cast("string"))) for c in fields.values()])
    k = digest(F.to_json(F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(key)])))
    side = lambda df, s: df.select(k.alias("k"), vals.alias("vals"), F.col(row_id).cast("long").alias("id"), F.lit(s).alias("side"))
    rows = side(a, "a").unionByName(side(b, "b"))
    groups = rows.groupBy("k", "vals").agg(F.count_if(F.col("side") == "a").alias("na"), F.count_if(F.col("side") == "b").alias("nb"), F.min("id").alias("id"))
    left = shared_table(groups.where("na <> nb"), "diff-left")
    single = left.where("na + nb = 1").select("k", "vals", "id", F.when(F.col("na") == 1, "a").otherwise("b").alias("side"))
    repeated = left.where("na + nb > 1")
    if not repeated.isEmpty():  # which rows of a repeated value are left over: those with the largest ids
        counts = repeated.select("k", "vals", "na", "nb", (F.col("na") + F.col("nb")).alias("n"))
        over = shared_table(salted_lookup(rows, counts, ["k", "vals"], "n", F.col("id")), "diff-repeated")
        over = rank_within(over, ["k", "vals", "side"], ["id"]).where(F.col("rank") >= F.least("na", "nb"))
        single = shared_table(single.unionByName(over.select("k", "vals", "id", "side")), "diff-single")
    one = lambda s: F.max(F.when(F.col("side") == s, F.struct("id", "vals"))).alias(s)
    by_key = single.groupBy("k").agg(F.count_if(F.col("side") == "a").alias("na"), F.count_if(F.col("side") == "b").alias("nb"), one("a"), one("b"))
    by_key = shared_table(by_key, "diff-keys")
    changed = F.filter(F.array(*[F.when(~F.col("a.vals")[i].eqNullSafe(F.col("b.vals")[i]), n) for i, n in enumerate(names)]), lambda x: x.isNotNull())
    out = by_key.where("na <= 1 and nb <= 1").select(F.col("a.id").alias("id_a"), F.col("b.id").alias("id_b"), F.when(F.col("a").isNotNull() & F.col("b").isNotNull(), changed).alias("changed"))
    several = by_key.where("na > 1 or nb > 1").select("k", "na", "nb", (F.col("na") + F.col("nb")).alias("n"))
    if not several.isEmpty():
        rest = shared_table(salted_lookup(single, several, ["k"], "n", F.col("id")), "diff-several")
        paired = rest.groupBy("k").applyInPandas(_pair_key(len(names), block), "id_a long, id_b long, changed array<int>")
        out = out.unionByName(paired.withColumn("changed", F.transform("changed", lambda i: F.element_at(F.array(*map(F.lit, names)), i + 1))))
    return out


def engine_differences(regions: DataFrame, conflicts: DataFrame) -> DataFrame:
    """p2_found: region_id, diff. Engine a's regions against engine b's by (doc_id, page_no, order_idx), then the conflict
    entries against the pairs whose text differs.

    diff is only_a, only_b, region_type, bbox (compared as numbers), text, conflict_missing, text_a, text_b or
    conflict_extra. Rows of other or null engines play no part; null equals null only; an entry with a null region_id is
    conflict_extra.
    """
    numbers = F.when(F.col("bbox").isNotNull(), F.coalesce(F.from_json("bbox", "array<double>").cast("string"), F.col("bbox")))
    engine = lambda e: regions.where(F.col("engine") == e).select("region_id", "doc_id", "page_no", "order_idx", "region_type", "bbox", "text")
    found = diff_copies(engine("a"), engine("b"), ["doc_id", "page_no", "order_idx"], {"region_type": F.col("region_type"), "bbox": numbers, "text": F.col("text")}, "region_id")
    found = shared_table(found, "engine-diff")
    alone = F.when(F.col("id_b").isNull(), F.array(F.lit("only_a"))).when(F.col("id_a").isNull(), F.array(F.lit("only_b"))).otherwise(F.col("changed"))
    rows = found.select(F.coalesce("id_a", "id_b").alias("region_id"), F.explode(alone).alias("diff"))
    entries = conflicts.select("region_id", digest(F.col("text_a")).alias("ca"), digest(F.col("text_b")).alias("cb"), F.lit(True).alias("entry"))
    texts = found.where("id_a is not null and id_b is not null and array_contains(changed, 'text')").select("id_a", "id_b")
    known = lambda s: regions.where(F.col("engine") == s).select(F.col("region_id").alias(f"id_{s}"), digest(F.col("text")).alias(f"t{s}"))
    texts = texts.join(known("a"), "id_a").join(known("b"), "id_b")
    both = texts.join(entries, texts["id_a"] == entries["region_id"], "full_outer")
    same = lambda x, y: F.col(x).eqNullSafe(F.col(y))
    kinds = F.when(F.col("id_a").isNull(), F.array(F.lit("conflict_extra"))).when(F.col("entry").isNull(), F.array(F.lit("conflict_missing"))).otherwise(F.array_compact(F.array(F.when(~same("ca", "ta"), "text_a"), F.when(~same("cb", "tb"), "text_b"))))
    return rows.unionByName(both.select(F.coalesce("id_a", "region_id").alias("region_id"), F.explode(kinds).alias("diff")))


P2_SQL = """
with a as (select * from regions where engine = 'a'), b as (select * from regions where engine = 'b'),
j as (select a.region_id ra, b.region_id rb, a.region_type rta, b.region_type rtb,
        cast(a.bbox as json)::double[] ba, cast(b.bbox as json)::double[] bb, a.text ta, b.text tb
      from a full join b on a.doc_id is not distinct from b.doc_id and a.page_no is not distinct from b.page_no and a.order_idx is not distinct from b.order_idx),
d as (select ra, rb, ta, tb from j where ra is not null and rb is not null and ta is distinct from tb),
c as (select d.ra, d.ta, d.tb, k.region_id kid, k.text_a, k.text_b from d full join region_conflicts k on d.ra = k.region_id)
select ra as region_id, 'only_a' as diff from j where rb is null
union all select rb, 'only_b' from j where ra is null
union all select ra, 'region_type' from j where ra is not null and rb is not null and rta is distinct from rtb
union all select ra, 'bbox' from j where ra is not null and rb is not null and ba is distinct from bb
union all select ra, 'text' from d
union all select ra, 'conflict_missing' from c where kid is null
union all select ra, 'text_a' from c where ra is not null and kid is not null and text_a is distinct from ta
union all select ra, 'text_b' from c where ra is not null and kid is not null and text_b is distinct from tb
union all select kid, 'conflict_extra' from c where ra is null
"""
