"""Copies with repeated keys: brute force, hot keys, nulls and clashing columns."""

from __future__ import annotations

import itertools
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from quire.operators.diff import assign, assign_values, diff_copies, engine_differences
from quire.operators.skew import rank_within, salted_lookup

SCHEMA = "id long, k string, x string, y int, k0 string"


def run(spark, a, b, **kw):
    make = lambda rows: spark.createDataFrame([(i, k, x, y, "extra") for i, k, x, y in rows], SCHEMA)
    return [tuple(r) for r in diff_copies(make(a), make(b), ["k"], {"x": F.col("x"), "y": F.col("y")}, "id", **kw).collect()]


def cost_of(a, b):
    """Smallest number of differing fields over all pairings of one key's rows, identical rows cancelled first."""
    ca, cb = Counter((x, y) for _, _, x, y in a), Counter((x, y) for _, _, x, y in b)
    ra, rb = list((ca - cb).elements()), list((cb - ca).elements())
    if len(ra) > len(rb):
        ra, rb = rb, ra
    return min((sum(sum(p != q for p, q in zip(u, v, strict=True)) for u, v in zip(ra, perm, strict=False)) for perm in itertools.permutations(rb, len(ra))), default=0)


def test_assignment_is_minimal():
    rng = np.random.default_rng(3)
    for _ in range(60):
        n, m = rng.integers(1, 5, 2)
        cost = rng.integers(0, 4, (n, m)).astype(float)
        got = assign(cost)
        assert len(got) == min(n, m) and len({i for i, _ in got}) == len({j for _, j in got}) == len(got)
        small = cost if n <= m else cost.T
        best = min(sum(small[i, p[i]] for i in range(len(small))) for p in itertools.permutations(range(small.shape[1]), len(small)))
        assert sum(cost[i, j] for i, j in got) == best


def test_against_brute_force(spark):
    rng = random.Random(1)
    a = [(i, f"k{i % 8}" if i % 8 else None, rng.choice(["u", "v", None]), rng.randint(0, 2)) for i in range(30)]
    b = [(100 + i, f"k{i % 8}" if i % 8 else None, rng.choice(["u", "v", None]), rng.randint(0, 2)) for i in range(26)]
    got = run(spark, a, b)
    ids_a, ids_b = {r[0]: r for r in a}, {r[0]: r for r in b}
    for key in {r[1] for r in a + b}:
        mine = [(x, y, c) for x, y, c in got if (ids_a.get(x) or ids_b.get(y))[1] == key]
        ra, rb = [r for r in a if r[1] == key], [r for r in b if r[1] == key]
        assert sum(len(c) for x, y, c in mine if c) == cost_of(ra, rb)
        assert sum(y is None for x, y, c in mine) - sum(x is None for x, y, c in mine) == len(ra) - len(rb)
    assert all(c for x, y, c in got if x is not None and y is not None)


def test_hot_key_keeps_counts(spark):
    a = [(i, "hot", str(i), 1) for i in range(700)] + [(9000, "one", "x", 1)]
    b = [(10000 + i, "hot", str(i + 3), 1) for i in range(650)] + [(9000, "one", "x", 1)]
    got = run(spark, a, b, block=50)
    assert sum(y is None for x, y, c in got) - sum(x is None for x, y, c in got) == 50
    assert len({x for x, _, _ in got if x is not None}) == sum(x is not None for x, _, _ in got)


def test_empty_and_equal(spark):
    a = [(1, "k", "x", 1), (2, "k", "x", 1)]
    assert run(spark, [], []) == []
    assert sorted(run(spark, a, []), key=repr) == [(1, None, None), (2, None, None)]
    assert run(spark, a, a) == []
    assert run(spark, [*a, (3, "k", "x", 1)], a) == [(3, None, None)]


def test_engines(spark, rows):
    schema = "region_id long, doc_id string, page_no int, bbox string, region_type string, text string, engine string, order_idx int, diff string"
    r = [
        (1, "d", 1, "[1,2,3,4]", "text", "t", "a", 0, "z"), (2, "d", 1, "[1.0, 2, 3, 4]", "text", "t", "b", 0, "z"),
        (3, "d", 1, None, "text", "t", "a", 1, "z"), (4, "d", 1, "[1,2,3,4]", "table", "u", "b", 1, "z"),
        (5, None, None, None, None, None, "a", None, None), (6, None, None, None, None, None, "b", None, None),
        (7, "d", 2, None, None, None, "a", 0, None), (8, "d", 3, None, None, "", "b", 0, None), (9, "d", 2, None, None, "q", None, 0, None),
        (10, "d", 4, None, None, None, "a", 0, None), (11, "d", 4, None, None, "", "b", 0, None),
    ]
    c = [(3, "t", "stale"), (1, "t", "t"), (None, "a", "b"), (99, None, None)]
    got = rows(engine_differences(spark.createDataFrame(r, schema), spark.createDataFrame(c, "region_id long, text_a string, text_b string")))
    want = [(3, "region_type"), (3, "bbox"), (3, "text"), (3, "text_b"), (7, "only_a"), (8, "only_b"), (10, "text"), (10, "conflict_missing"), (1, "conflict_extra"), (None, "conflict_extra"), (99, "conflict_extra")]
    assert got == sorted(want, key=repr)
    empty = engine_differences(spark.createDataFrame([], schema), spark.createDataFrame([], "region_id long, text_a string, text_b string"))
    assert empty.count() == 0


def test_lookup_and_rank(spark, rows):
    left = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(300)], "id long, k string")
    right = left.groupBy("k").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    want = rows(left.join(right.drop("n"), "k").select("id", "first"))
    assert rows(salted_lookup(left, right, ["k"], "n", F.col("id"), rows_per_task=20).select("id", "first")) == want
    ranked = rank_within(left, ["k"], ["id"])
    by = {}
    for i, k in sorted((r["id"], r["k"]) for r in left.collect()):
        by.setdefault(k, []).append(i)
    assert {(r["k"], r["id"], r["rank"]) for r in ranked.collect()} == {(k, i, n) for k, ids in by.items() for n, i in enumerate(ids)}
    assert rank_within(left.where("false"), ["k"], ["id"]).count() == 0


def test_values_are_assigned_like_the_matrix():
    rng = np.random.default_rng(5)
    for i in range(150):
        fields, top = int(rng.integers(1, 5)), int(rng.integers(2, 9))
        a, b = rng.integers(0, top, (int(rng.integers(1, 40)), fields)), rng.integers(0, top, (int(rng.integers(1, 40)), fields))
        shared = {tuple(x) for x in a.tolist()} & {tuple(x) for x in b.tolist()}
        a = np.array([x for x in a.tolist() if tuple(x) not in shared]).reshape(-1, fields)
        b = np.array([x for x in b.tolist() if tuple(x) not in shared]).reshape(-1, fields)
        if not len(a) or not len(b):
            continue
        cost = (a[:, None, :] != b[None, :, :]).sum(axis=2).astype(float)
        got = assign_values(a, b)
        assert len(got) == min(cost.shape) and len({x for x, _ in got}) == len({y for _, y in got}) == len(got)
        assert sum(cost[p] for p in got) == sum(cost[p] for p in assign(cost))


def test_hot_key_is_of_least_cost(spark):
    rng = random.Random(7)
    n = 300
    a = [(i, f"t{rng.random()}", i % 5, f"z{i}") for i in range(n)]
    b = [(1000 + i, f"u{rng.random()}", y, z) for i, _, y, z in a]  # the first field differs, so sorting brings no partners together
    make = lambda rows: spark.createDataFrame([("hot", *r) for r in rows], "k string, id long, x string, y int, z string")
    got = diff_copies(make(a), make(b), ["k"], {c: F.col(c) for c in "xyz"}, "id", block=20).collect()
    assert sorted((r["id_a"], r["id_b"], tuple(r["changed"])) for r in got) == [(i, 1000 + i, ("x",)) for i in range(n)]
