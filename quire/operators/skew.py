"""Joins and ranks that survive a key which holds a large part of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def salted_lookup(left: DataFrame, right: DataFrame, keys: list[str], count: str, spread: Column, rows_per_task: int = 200_000) -> DataFrame:
    """Left rows with the columns of the one right row of their key (inner join); right has one row for each key.

    ``count`` names right's column with the number of left rows of the key. Keys with more than rows_per_task left rows are
    split: right's row is repeated once for each part and left's rows are spread over the parts by ``spread``, an
    expression that varies within a key. The parts of a key are found from right alone, through a broadcast table of the hot
    keys: there are at most (left's rows / rows_per_task) of them, so its bytes are at
    most left's key bytes / rows_per_task.
    Null keys match nothing. right is read twice, so it should be a written table or cheap to make.
    """
    hot = right.where(F.col(count) > rows_per_task).select(*keys, F.ceil(F.col(count) / rows_per_task).cast("int").alias("__parts"))
    if hot.isEmpty():
        return left.join(right.drop(count), keys)
    left = left.join(F.broadcast(hot), keys, "left").withColumn("__part", F.when(F.col("__parts").isNull(), 0).otherwise(F.pmod(F.xxhash64(spread), F.col("__parts")).cast("int"))).drop("__parts")
    parts = F.when(F.col(count) > rows_per_task, F.ceil(F.col(count) / rows_per_task).cast("int")).otherwise(1)
    right = right.withColumn("__part", F.explode(F.sequence(F.lit(0), parts - 1))).drop(count)
    return left.join(right, [*keys, "__part"]).drop("__part")


def _in_order(df: DataFrame, keys: list[str]) -> DataFrame:
    """df range-partitioned and sorted by keys, written, with ``__p`` (its partition) and ``__i`` (its place in it)."""
    from quire.storage import shared_table

    parts = df.repartitionByRange(*[F.col(k) for k in keys]).sortWithinPartitions(*keys)
    rows = shared_table(parts.withColumn("__seq", F.monotonically_increasing_id()), "ordered")
    return rows.withColumns({"__p": F.shiftright("__seq", 33), "__i": F.col("__seq").bitwiseAND((1 << 33) - 1)}).drop("__seq")


def rank_within(df: DataFrame, group: list[str], order: list[str], name: str = "rank") -> DataFrame:
    """df with the rank (from 0) of each row in its group by ``order``, without holding a group in one task.

    Rows are range-partitioned and sorted by group and order; a row's global position is its position in its partition
    plus the sizes of the partitions before (one number for each partition goes to the driver); the group's first position
    is taken off. Ties get different ranks. df must be deterministic, e.g. a written table.
    """
    from quire.storage import shared_table

    spark = df.sparkSession
    rows = _in_order(df, [*group, *order])
    offsets, total = {}, 0
    for p, n in rows.groupBy("__p").agg(F.count("*")).orderBy("__p").collect():
        offsets[p], total = total, total + n
    small = spark.createDataFrame(list(offsets.items()) or [(0, 0)], "__p long, __off long")
    rows = rows.join(F.broadcast(small), "__p").withColumn("__pos", F.col("__off") + F.col("__i")).drop("__p", "__off", "__i")
    firsts = shared_table(rows.groupBy(*group).agg(F.min("__pos").alias("__first"), F.count("*").alias("__n")), "firsts")
    return salted_lookup(rows, firsts, group, "__n", F.col("__pos")).withColumn(name, F.col("__pos") - F.col("__first")).drop("__pos", "__first")


def running_within(df: DataFrame, group: list[str], order: list[str], value: str, name: str, rank: str | None = None) -> DataFrame:
    """df with the sum of ``value`` over the rows of its group up to each row by ``order`` and, where asked for, the row's rank (from
    0), without holding a group in one task.

    Rows are range-partitioned and sorted by group and order. Inside a partition sum and rank are windows over (partition,
    group); to a partition's first group those of its last rows before are added: one row for each partition goes to the
    driver. Ties in ``order`` must not occur. Null groups and null values give no defined sum.
    """
    spark = df.sparkSession
    rows = _in_order(df, [*group, *order])
    own = W.partitionBy("__p", *group).orderBy("__i")
    rows = rows.withColumns({name: F.sum(value).over(own.rowsBetween(W.unboundedPreceding, 0)), "__n": F.row_number().over(own)})
    key = F.to_json(F.struct(*group))
    last = lambda c: F.max_by(c, "__i").alias(c)
    edges = rows.groupBy("__p").agg(F.min_by(key, "__i").alias("first"), F.max_by(key, "__i").alias("last"), last(name), last("__n")).orderBy("__p").collect()
    carry, before = [], (None, 0.0, 0)
    for r in edges:
        held = before[1:] if r["first"] == before[0] else (0.0, 0)
        carry.append((r["__p"], r["first"], float(held[0]), int(held[1])))
        whole = held if r["first"] == r["last"] else (0.0, 0)
        before = (r["last"], r[name] + whole[0], r["__n"] + whole[1])
    small = spark.createDataFrame(carry or [(0, "", 0.0, 0)], "__p long, __key string, __held double, __rows long")
    rows = rows.join(F.broadcast(small), "__p")
    more = lambda c: F.when(key == F.col("__key"), F.col(c)).otherwise(0)
    rows = rows.withColumn(name, F.col(name) + more("__held"))
    if rank:
        rows = rows.withColumn(rank, F.col("__n") - 1 + more("__rows"))
    return rows.drop("__p", "__i", "__n", "__key", "__held", "__rows")
