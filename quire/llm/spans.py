"""Long exact spans shared between records (problem 10).

Suffix automata of reference shards, against which documents are streamed for matching statistics. Every window of ``least``
characters has a smallest k-gram by hash value, and windows with equal text have equal smallest k-grams. Consecutive windows
with one smallest k-gram form a run; a run's text is a reference of the shard its hash belongs to, and is streamed against
the automaton of that shard alone, where all text it can share stands. Runs of hashes that one document alone has share
nothing and are left out before.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.llm.automaton import ShardAutomaton
from quire.operators.skew import salted_lookup
from quire.storage import discard, shared_table

GRAM = 40
SHARD_CHARS = 250_000  # characters of references in one automaton, about 100 bytes of memory each while it is built
PIECE = 4_000_000  # characters of contexts handed over at a time


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    return x


def gram_hashes(codes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k characters from each position (the last k - 1 positions are missing), by doubling."""
    power, hashes = 1, _mix(codes + np.uint64(0x51ED2701))
    done, at = None, 0
    while True:
        if k & power:
            done = hashes if done is None else _mix(done[: len(hashes) - at] * np.uint64(0xD6E8FEB86659FD93) + hashes[at : len(done)]) if len(hashes) > at else done[:0]
            at += power
        if at == k:
            return done[: max(0, len(codes) - k + 1)]
        hashes = _mix(hashes[: max(0, len(hashes) - power)] * np.uint64(0xD6E8FEB86659FD93) + hashes[power:])
        power *= 2


def runs(text: str, least: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first window, number of windows) of each run of consecutive windows with the same smallest k-gram hash; runs
    longer than the windows of one k-gram (periodic text) are cut."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    if len(codes) < least:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    low, width, size = gram_hashes(codes, k), least - k + 1, 1
    while size * 2 <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if width > size:
        low = np.minimum(low[: len(low) - (width - size)], low[width - size :])
    starts = np.concatenate([[0], np.flatnonzero(low[1:] != low[:-1]) + 1])
    lengths = np.diff(np.concatenate([starts, [len(low)]]))
    if lengths.max() > width:
        cuts = [np.arange(s, s + n, width) for s, n in zip(starts, lengths, strict=True)]
        starts = np.concatenate(cuts)
        lengths = np.diff(np.concatenate([starts, [len(low)]]))
    return low[starts], starts, lengths


def _anchors(least: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [runs(t.as_py(), least, k) for t in batch.column("text")]
            sizes = [len(h) for h, _, _ in found]
            doc = np.repeat(batch.column("doc").to_numpy(zero_copy_only=False), sizes)
            cat = lambda i: np.concatenate([f[i] for f in found]) if found else np.empty(0, np.int64)
            h, s, n = cat(0).astype(np.uint64).view(np.int64), cat(1).astype(np.int64), cat(2).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(h), pa.array((s << 8) | n)], names=["doc", "h", "run"])

    return run


def _contexts(least: int):
    schema = pa.schema([("doc", pa.int64()), ("h", pa.int64()), ("s", pa.int64()), ("n", pa.int32()), ("ctx", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        held = 0
        for batch in batches:
            for row in range(batch.num_rows):
                doc, text = batch.column("doc")[row].as_py(), batch.column("text")[row].as_py()
                for h, r in zip(batch.column("hs")[row].as_py(), batch.column("rs")[row].as_py(), strict=True):
                    s, n = r >> 8, r & 255
                    part = text[s : s + n + least - 1]
                    if len(part) == n + least - 1:
                        out.append((doc, h, s, n, part))
                        held += len(part)
                        if held >= PIECE:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema)
                            out, held = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema)

    return run


def _matched(least: int):
    def shard(pdf: pd.DataFrame) -> pd.DataFrame:
        lo, hi = pdf["lo"].to_numpy(), pdf["hi"].to_numpy()
        texts = pdf["ctx"].tolist()
        which, begins, ends = ShardAutomaton(texts, lo, hi).long_matches(texts, np.where(lo == hi, lo, -1), lo == hi, least)
        order = np.argsort(which, kind="stable")
        which, begins, ends = which[order], begins[order], ends[order]
        rows, first = np.unique(which, return_index=True)
        found = pdf.iloc[rows][["h", "dig", "c"]].reset_index(drop=True)
        lists = lambda x: pd.Series(np.split(x, first[1:]) if len(rows) else [], dtype=object)
        return found.assign(begins=lists(begins), ends=lists(ends))

    return shard


def _by_windows(references: DataFrame, least: int) -> DataFrame:
    """h, dig, c, begins, ends of references whose hash has more text than a shard holds, by digests of their windows."""
    windows = references.select("h", "dig", "c", "lo", "hi", "ctx", F.explode(F.sequence(F.lit(0), F.length("ctx") - least)).alias("i"))
    windows = shared_table(windows.select("h", "dig", "c", "lo", "hi", "i", F.unhex(F.md5(F.substring(F.col("ctx"), F.col("i") + 1, F.lit(least)).cast("binary"))).alias("w")), "windows")
    several = windows.groupBy("w").agg(F.min("lo").alias("wlo"), F.max("hi").alias("whi"), F.count("*").alias("times")).where("wlo <> whi").select("w", "times")
    hit = salted_lookup(windows, several, ["w"], "times", F.struct("h", "dig", "i"))
    found = hit.groupBy("h", "dig", "c").agg(F.array_sort(F.collect_set("i")).alias("begins"))
    return found.withColumn("ends", F.transform("begins", lambda i: i + least))


def shared_spans(df: DataFrame, doc_id: str, text: str, least: int = 100, k: int = GRAM, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """doc_id, span_start, span_end: the longest runs of positions that lie in a stretch of ``least`` characters that also
    stands, exactly so, in a document with another doc_id. Exact; no stretch is sampled or capped.

    Null texts, null ids and texts shorter than ``least`` give nothing. Rows that repeat a doc_id are one document. Texts
    of any length are processed whole; k + 1 < least <= k + 254.

    Cost: one hash pass over all text (NumPy over Arrow batches) gives one run for about (least - k) / 2 characters; runs
    go through one aggregation and one join by hash. Only runs with a hash of two or more documents meet their text again.
    Equal run texts become one reference, with the least and largest doc_id that has it, so pairs are never formed and a
    passage that a third of all documents has is one reference. References are spread over shards by hash; each automaton
    goes to one task together with the runs that can match it. Sending every automaton to every document would be quadratic.
    A hash with more reference text than shard_chars is no shard's: its windows are compared by digest over all tasks.
    """
    if not k + 1 < least <= k + 254:
        raise ValueError("least must lie between k + 2 and k + 254")
    spark = df.sparkSession
    docs = df.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text")).where((F.length("text") >= least) & F.col("doc").isNotNull())
    anchors = shared_table(docs.mapInArrow(_anchors(least, k), "doc long, h long, run long"), "runs")
    known = anchors.groupBy("h").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"), F.count("*").alias("c"))
    known = shared_table(known.where("lo <> hi").select("h", "c"), "shared-hashes")
    hit = salted_lookup(anchors, known, ["h"], "c", F.col("run"))
    by_doc = hit.groupBy("doc").agg(F.collect_list("h").alias("hs"), F.collect_list("run").alias("rs"))  # as long as the document's text allows
    contexts = docs.join(by_doc, "doc").mapInArrow(_contexts(least), "doc long, h long, s long, n int, ctx string")
    contexts = shared_table(contexts.withColumn("dig", F.unhex(F.md5(F.col("ctx").cast("binary")))), "contexts")
    discard(anchors)
    references = contexts.groupBy("h", "dig").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"), F.count("*").alias("c"), F.first("ctx").alias("ctx"))
    references = shared_table(references.where("lo is not null"), "references")
    chars = references.groupBy("h").agg(F.sum(F.length("ctx")).alias("chars"), F.count("*").alias("m"))
    large = shared_table(chars.where(F.col("chars") > shard_chars).select("h", "m"), "large-hashes")
    total = references.agg(F.sum(F.length("ctx"))).collect()[0][0] or 0
    shards = max(1, 2 * total // shard_chars)
    rest, more = references, None
    if not large.isEmpty():
        rest = references.join(large, "h", "left_anti")
        more = _by_windows(salted_lookup(references, large, ["h"], "m", F.col("dig")), least)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = rest.withColumn("shard", F.pmod(F.xxhash64("h"), F.lit(shards))).repartition(tasks, "shard")
    found = placed.groupBy("shard").applyInPandas(_matched(least), "h long, dig binary, c long, begins array<int>, ends array<int>")
    found = shared_table(found if more is None else found.unionByName(more), "matches")
    rows = salted_lookup(contexts.select("doc", "s", "h", "dig"), found, ["h", "dig"], "c", F.struct("doc", "s"))
    parts = rows.select("doc", "s", F.explode(F.arrays_zip("begins", "ends")).alias("p"))
    starts = parts.select("doc", (F.col("s") + F.col("p.begins")).alias("a"), (F.col("s") + F.col("p.ends")).alias("e")).distinct()
    order = W.partitionBy("doc").orderBy("a", "e")  # a document's own spans: as many as its length allows
    before = F.max("e").over(order.rowsBetween(W.unboundedPreceding, -1))
    islands = starts.withColumn("new", (before.isNull() | (F.col("a") > before)).cast("int")).withColumn("island", F.sum("new").over(order.rowsBetween(W.unboundedPreceding, 0)))
    return islands.groupBy("doc", "island").agg(F.min("a").alias("span_start"), F.max("e").alias("span_end")).select(F.col("doc").alias(doc_id), "span_start", "span_end")


def shared_portions(df: DataFrame, doc_id: str, text: str, least: int = 100, k: int = GRAM) -> DataFrame:
    """doc_id, n_chars, shared_chars, share for every document: how much of it is shared elsewhere. An empty or null text
    has 0 characters and share 0; of rows that repeat a doc_id the longest text counts."""
    spans = shared_spans(df, doc_id, text, least, k).groupBy(doc_id).agg(F.sum(F.col("span_end") - F.col("span_start")).alias("shared_chars"))
    sizes = df.where(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).cast("long").alias(doc_id)).agg(F.max(F.coalesce(F.length(text), F.lit(0))).cast("long").alias("n_chars"))
    both = sizes.join(spans, doc_id, "left").na.fill(0, ["shared_chars"])
    return both.withColumn("share", F.when(F.col("n_chars") > 0, F.col("shared_chars") / F.col("n_chars")).otherwise(0.0))


def spans_removed(df: DataFrame, doc_id: str, text: str, least: int = 100, k: int = GRAM) -> DataFrame:
    """doc_id, text_left, removed_chars for every row: its text without the maximal shared spans, and their characters.

    A text without shared spans stays as it is; null stays null; a text that is shared as a whole becomes empty. Rows with
    a null doc_id keep their text. Rows that repeat a doc_id lose the spans of all texts of that doc_id.
    """
    spans = shared_spans(df, doc_id, text, least, k).groupBy(doc_id).agg(F.array_sort(F.collect_list(F.struct("span_start", "span_end"))).alias("spans"))
    rows = df.select(F.col(doc_id).cast("long").alias("__id"), F.col(text).alias("__text")).join(spans.withColumnRenamed(doc_id, "__id"), "__id", "left")
    begin = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("parts"))
    piece = lambda a, n: F.substring(F.col("__text"), (a + 1).cast("int"), n.cast("int"))
    cut = lambda acc, x: F.struct(x["span_end"].alias("at"), F.array_append(acc["parts"], piece(acc["at"], x["span_start"] - acc["at"])).alias("parts"))
    left = F.aggregate("spans", begin, cut, lambda acc: F.concat(F.array_join(acc["parts"], ""), piece(acc["at"], F.length("__text") - acc["at"])))
    out = rows.select(F.col("__id").alias(doc_id), F.col("__text"), F.when(F.col("spans").isNull(), F.col("__text")).otherwise(left).alias("text_left"))
    return out.select(doc_id, "text_left", (F.length("__text") - F.length("text_left")).alias("removed_chars"))


# every window of every text: quadratic in memory, for small tables only
_SPANS_SQL = """w as (select doc_id, unnest(range(1, length(text) - 98)) as i, text from documents where length(text) >= 100 and doc_id is not null),
x as (select doc_id, i - 1 as a, md5(substr(text, i, 100)) as s from w), g as (select s from x group by s having min(doc_id) <> max(doc_id)),
h as (select distinct doc_id, a from x where s in (select s from g)), n as (select *, coalesce((a > lag(a) over (partition by doc_id order by a) + 100)::int, 1) as fresh from h),
o as (select *, sum(fresh) over (partition by doc_id order by a) as island from n), sp as (select doc_id, min(a) as span_start, max(a) + 100 as span_end from o group by doc_id, island)"""
FOUND_SQL = f"with {_SPANS_SQL} select * from sp"
PORTIONS_SQL = f"""with {_SPANS_SQL}, z as (select doc_id, max(coalesce(length(text), 0)) as n_chars from documents where doc_id is not null group by doc_id), t as (select doc_id, sum(span_end - span_start)::bigint as shared_chars from sp group by doc_id)
select z.doc_id, n_chars, coalesce(shared_chars, 0) as shared_chars, case when n_chars > 0 then coalesce(shared_chars, 0) / n_chars else 0 end::double as share from z left join t on z.doc_id = t.doc_id"""
REMOVED_SQL = f"""with {_SPANS_SQL}, k as (select *, lag(span_end, 1, 0) over (partition by doc_id order by span_start) as begins, max(span_end) over (partition by doc_id) as final from sp),
r as (select k.doc_id, string_agg(substr(d.text, begins + 1, span_start - begins), '' order by span_start) || substr(any_value(d.text), any_value(final) + 1) as t from k join documents d on d.doc_id = k.doc_id group by k.doc_id)
select d.doc_id, coalesce(r.t, d.text) as text_left, length(d.text) - length(coalesce(r.t, d.text)) as removed_chars from documents d left join r on r.doc_id = d.doc_id"""
