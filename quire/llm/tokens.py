"""Token ids of whole corpora by a public byte-level BPE tokenizer (problem 8).

Texts are cut into overlapping chunks that are pre-tokenised each for itself; neighbouring chunks are stitched at a position
of their overlap where both begin a pre-token. From a common beginning on, pre-tokens depend on the text after it only, so
the pieces between stitches can be encoded one by one, and their ids one after the other are those of the whole text.
"""

from __future__ import annotations

import base64
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.storage import shared_table

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# fixed value: the published pre-token pattern of byte_bpe_50k
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CHUNK, OVERLAP, EDGE = 3_000, 400, 4
SPREAD = 1_000_000  # the chunks of a text longer than that go to different tasks


def encoder(path: str):
    """The tokenizer of a tiktoken vocabulary file, once for each Python worker; special-token look-alikes are ordinary text."""
    cache = sys.__dict__.setdefault("_quire_encoders", {})  # outlives the function, which every task unpickles anew
    if path not in cache:
        import regex
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        cache[path] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), regex.compile(PATTERN.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
    return cache[path]


def decode(ids: list[int], path: str = VOCABULARY) -> str:
    """The text of ids: the tokens' raw bytes one after the other."""
    return encoder(path)[0].decode_bytes(ids).decode("utf-8", "replace")


def chunk_starts(size: int, chunk: int = CHUNK, overlap: int = OVERLAP) -> range:
    """Where the chunks of a text of ``size`` characters begin; each reaches ``overlap`` characters into the next."""
    return range(0, max(1, size - overlap), chunk)


def beginnings(part: str, start: int, first: bool, last: bool, path: str = VOCABULARY, chunk: int = CHUNK, overlap: int = OVERLAP) -> tuple[list[int], list[int]]:
    """The positions, in its text, at which a chunk that begins at ``start`` sees pre-tokens begin: those in the overlap with the
    chunk before, and those in the overlap with the one after.

    Positions after white space are left out, as white space at the end of a piece would be one pre-token, and so are those
    in the last EDGE characters of a chunk that is cut off, which may be wrong.
    """
    seen = [m.start() for m in encoder(path)[1].finditer(part)]
    good = [p for p in seen if p and not part[p - 1].isspace()]
    head = [] if first else [start + p for p in good if p < overlap]
    tail = [] if last else [start + p for p in good if chunk <= p <= len(part) - EDGE]
    return head, tail


def stitches(chunks: list[tuple[list[int], list[int]]]) -> list[int] | None:
    """Where a text is cut into pieces: for each two neighbouring chunks, given by their beginnings, the first common one; None
    where two have none."""
    cuts = []
    for (_, tail), (head, _) in zip(chunks, chunks[1:], strict=False):
        common = min(set(tail) & set(head), default=None)
        if common is None:
            return None
        cuts.append(common)
    return cuts


def pieces(text: str, path: str = VOCABULARY, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[str]:
    """The pieces of a text that can be encoded one by one. A text without stitches (a pre-token longer than the overlap) is
    one piece."""
    starts = chunk_starts(len(text), chunk, overlap)
    if len(starts) == 1:
        return [text]
    cuts = stitches([beginnings(text[s : s + chunk + overlap], s, s == 0, s == starts[-1], path, chunk, overlap) for s in starts])
    at = [0, *(cuts or []), len(text)]
    return [text[i:j] for i, j in zip(at, at[1:], strict=False)]


def encode_text(text: str, path: str = VOCABULARY, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[int]:
    """ids of one text by way of its pieces."""
    bpe = encoder(path)[0]
    return [i for piece in pieces(text, path, chunk, overlap) for i in bpe.encode_ordinary(piece)]


def _encoded(path: str, chunk: int, overlap: int, count_only: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [np.asarray(encode_text(t.as_py(), path, chunk, overlap) if t.is_valid else [], dtype=np.int32) for t in batch.column("__text")]
            sizes = np.array([len(x) for x in out], dtype=np.int32)
            if count_only:
                value = pa.array(sizes)
            else:
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                value = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(out) if out else np.empty(0, np.int32)))
            names = [n for n in batch.schema.names if n != "__text"]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], value], names=[*names, "ids"])

    return run


def _seen(path: str, chunk: int, overlap: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            both = [beginnings(t, s, k == 0, k + 1 == n, path, chunk, overlap) for t, s, k, n in zip(pdf["part"], pdf["start"], pdf["k"], pdf["n"], strict=True)]
            yield pd.DataFrame({"key": pdf["key"], "k": pdf["k"], "head": [h for h, _ in both], "tail": [t for _, t in both]})

    return run


def _spread_over_tasks(long: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """key, ids of long texts (key, text): chunks are pre-tokenised, and pieces encoded, wherever there is room; a shuffle of
    positions brings the beginnings of a text together, one of ids its pieces."""
    size = F.length("text")
    n = F.ceil((size - overlap) / chunk).cast("int")
    cut = long.select("key", "text", n.alias("n"), F.explode(F.sequence(F.lit(0), n - 1)).alias("k"))
    start = F.col("k").cast("long") * chunk
    cut = cut.select("key", "n", "k", start.alias("start"), F.substring(F.col("text"), (start + 1).cast("int"), F.lit(chunk + overlap)).alias("part")).repartition("key", "k")
    seen = shared_table(cut.mapInPandas(_seen(path, chunk, overlap), "key long, k int, head array<long>, tail array<long>"), "beginnings")
    following = seen.select("key", (F.col("k") - 1).alias("k"), F.col("head").alias("next"))
    common = seen.join(following, ["key", "k"]).select("key", "k", F.array_min(F.array_intersect("tail", "next")).alias("at"))
    whole = common.where("at is null").select("key").distinct()
    cuts = common.join(whole, "key", "left_anti").groupBy("key").agg(F.array_sort(F.collect_list("at")).alias("cuts"))
    rows = long.join(cuts, "key", "left").withColumn("at", F.concat(F.array(F.lit(0).cast("long")), F.coalesce("cuts", F.array().cast("array<long>")), F.array(size.cast("long"))))
    rows = rows.select("key", "text", "at", F.posexplode(F.slice("at", 1, F.size("at") - 1)).alias("k", "a"))
    piece = F.substring(F.col("text"), (F.col("a") + 1).cast("int"), (F.get("at", F.col("k") + 1) - F.col("a")).cast("int"))
    parts = rows.select("key", "k", piece.alias("__text")).repartition("key", "k").mapInArrow(_encoded(path, 1 << 62, 0, False), "key long, k int, ids array<int>")
    return parts.groupBy("key").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("k", "ids"))), lambda x: x["ids"])).alias("ids"))


def token_ids(df: DataFrame, row_id: str, text: str, path: str = VOCABULARY, chunk: int = CHUNK, overlap: int = OVERLAP, spread: int = SPREAD, keep: list[str] | None = None, count_only: bool = False) -> DataFrame:
    """row_id, the columns ``keep`` and ids (array<int>; with count_only their number) for every row.

    An empty text and a null text both give the empty list. No special tokens; look-alikes are encoded as ordinary text.
    Rows keep their multiplicity, null ids included. path: a tiktoken vocabulary that every worker can read.

    Every text goes by way of chunks and pieces; one no longer than a chunk and an overlap is one of each. Texts up to
    ``spread`` characters do so within the task that reads them, without a shuffle. The chunks and pieces of longer ones, if
    there are any, go to different tasks.
    """
    keep = keep or []
    rows = df.select(F.col(row_id), *keep, F.col(text).alias("__text"))
    schema = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes if c != "__text") + f", ids {'int' if count_only else 'array<int>'}"
    limit = max(spread, chunk + overlap)
    short = rows.where(F.col("__text").isNull() | (F.length("__text") <= limit)).mapInArrow(_encoded(path, chunk, overlap, count_only), schema)
    long = rows.where(F.length("__text") > limit)
    if long.isEmpty():
        return short
    long = shared_table(long.withColumn("__key", F.monotonically_increasing_id()), "long-texts")
    done = _spread_over_tasks(long.select(F.col("__key").alias("key"), F.col("__text").alias("text")), path, chunk, overlap).withColumnsRenamed({"key": "__key", "ids": "__ids"})
    value = F.size("__ids") if count_only else F.col("__ids")
    return short.unionByName(long.drop("__text").join(done, "__key").select(row_id, *keep, value.alias("ids")))
