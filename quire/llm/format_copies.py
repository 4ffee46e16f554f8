"""Records that are identical but for white space, letter case, punctuation or field order (problem 1).

Columns are dictionary-encoded: each distinct value of a field is brought to its canonical form once, and field and form
get an integer; records become sorted tuples of these integers, and equal tuples are copies.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from hashlib import md5

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.operators.skew import salted_lookup
from quire.storage import discard, shared_table

ASCII_DIGITS = frozenset("0123456789")


def letters_and_digits(s: str) -> str:
    """The letters (Unicode) and digits (0-9) of s, letter case aside; accented letters stay other letters."""
    return "".join(c for c in s if c.isalpha() or c in ASCII_DIGITS).casefold()


def canonical_json(v: object) -> object:
    """v with strings reduced to letters and digits and null fields dropped; numbers and array order stay."""
    if isinstance(v, str):
        return "s" + letters_and_digits(v)
    if isinstance(v, float) and v.is_integer():
        return int(v)
    if isinstance(v, list):
        return [canonical_json(x) for x in v]
    if isinstance(v, dict):
        return {k: canonical_json(x) for k, x in v.items() if x is not None}
    return v


def canonical(kind: str, raw: str) -> str:
    """The canonical form of a raw value: kind t is text, j JSON, z null; JSON that cannot be read counts as text."""
    if kind == "z":
        return "z"
    if kind == "j":
        try:
            return "j" + json.dumps(canonical_json(json.loads(raw)), sort_keys=True, ensure_ascii=False)
        except (ValueError, RecursionError):
            pass
    return "t" + letters_and_digits(raw)


def _canonical(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        forms = (canonical(kind, raw) for kind, raw in zip(pdf["kind"].tolist(), pdf["raw"].tolist(), strict=True))
        yield pdf[["field", "dig", "n"]].assign(canon=[md5(x.encode("utf-8", "surrogatepass")).digest() for x in forms])


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The members of JSON records as cells; a record that is no JSON object is one cell of text."""
    for batch in batches:
        ids, fields, kinds, raws = [], [], [], []
        for rid, record in zip(batch.column("id").to_pylist(), batch.column("record").to_pylist(), strict=True):
            try:
                found = json.loads(record)
            except (ValueError, RecursionError):
                found = None
            if isinstance(found, dict):
                cells = [("." + json.dumps(k)[1:-1], "j", json.dumps(v)) for k, v in found.items() if v is not None]
            else:
                cells = [(".", "t", record)]
            ids += [rid] * len(cells)
            for f, k, r in cells:
                fields.append(f)
                kinds.append(k)
                raws.append(r)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(fields, pa.string()), pa.array(kinds, pa.string()), pa.array(raws, pa.string())], names=["id", "field", "kind", "raw"])


def record_cells(df: DataFrame, tbl: str, row_id: str, texts: dict[str, Column], exact: dict[str, Column] | None = None, record: Column | None = None) -> DataFrame:
    """tbl, id, field, kind, raw: the cells of every row with an id; see ``collapse_copies``. A null field has no cell but the
    first of texts, whose cell then has the kind z, so that every row has one."""
    cell = lambda name, kind, c: F.struct(F.lit(name).alias("field"), kind.alias("kind"), c.cast("string").alias("raw"))
    rows = df.where(F.col(row_id).isNotNull())
    (name, first), *others = texts.items()
    always = cell(name, F.when(first.isNull(), "z").otherwise("t"), F.coalesce(first.cast("string"), F.lit("")))
    some = F.array(always, *[cell(n, F.lit("t"), c) for n, c in others], *[cell(n, F.lit("j"), c) for n, c in (exact or {}).items()])
    own = F.col(row_id).cast("long").alias("id")
    flat = rows.select(own, F.explode(F.filter(some, lambda x: x["raw"].isNotNull())).alias("c")).select("id", "c.*")
    if record is not None:
        flat = flat.unionByName(rows.select(own, record.alias("record")).where("record is not null").mapInArrow(_members, "id long, field string, kind string, raw string"))
    return flat.select(F.lit(tbl).alias("tbl"), "id", "field", "kind", "raw")


def collapse_copies(cells: DataFrame) -> DataFrame:
    """tbl, row_id, keep_id, n_copies for every row of ``record_cells`` of one or more tables: keep_id is the smallest id of the row's
    copies in its table, n_copies their number.

    texts: string fields, equal when their letters and digits are, letter case aside. exact: numbers and arrays, as JSON or
    plain text, equal as they are. record: JSON text whose top-level members are further fields; strings in it compare as
    texts, key order and layout do not matter, 1 and 1.0 are equal. A null field equals a missing one; an empty string, an
    empty array and a string without letters are values. A record that is no JSON object is compared as one string. Rows
    with a null id are left out. Repeated ids are one row each.

    A cell travels as a digest of its raw text (128 bits) with its field and the id of its row; raw texts are shuffled once for
    each distinct value and task. Hot values and hot groups of copies (e.g. one doc_id with a third of all rows) are counted
    before the join and split over tasks.
    """
    flat = shared_table(cells.withColumn("dig", F.unhex(F.md5(F.concat("kind", "raw").cast("binary")))), "cells")
    # the dictionary: a distinct value of a field is canonicalised once; field and canonical form share one integer
    values = flat.groupBy("field", "dig").agg(F.first("kind").alias("kind"), F.first("raw").alias("raw"), F.count("*").alias("n"))
    canon = shared_table(values.mapInPandas(_canonical, "field string, dig binary, n long, canon binary"), "values")
    ids = shared_table(canon.select("field", "canon").distinct().withColumn("value_id", F.monotonically_increasing_id()), "value-ids")
    coded = shared_table(canon.join(ids, ["field", "canon"]).select("field", "dig", "n", "value_id"), "coded")
    pairs = salted_lookup(flat.select("tbl", "id", "field", "dig"), coded, ["field", "dig"], "n", F.col("id"))
    # the record: its sorted tuple of field-value integers
    tuples = pairs.groupBy("tbl", "id").agg(F.array_sort(F.collect_set("value_id")).alias("key"))
    tuples = shared_table(tuples, "tuples")
    discard(flat)
    groups = shared_table(tuples.groupBy("tbl", "key").agg(F.min("id").alias("keep_id"), F.count("*").alias("n_copies")), "groups")
    out = salted_lookup(tuples, groups.withColumn("n", F.col("n_copies")), ["tbl", "key"], "n", F.col("id"))
    return out.select("tbl", F.col("id").alias("row_id"), "keep_id", "n_copies")


def inventory_cells(items: DataFrame) -> DataFrame:
    """The cells of list_items."""
    texts = {c: F.col(c) for c in ("doc_id", "schema_name", "anchor", "section")}
    exact = {"page": F.col("page"), "section_page": F.col("section_page"), "region_ids": F.to_json("region_ids")}
    return record_cells(items, "list_items", "item_id", texts, exact)


def trait_cells(traits: DataFrame) -> DataFrame:
    """The cells of race_traits: its doc_id and all members of record_json."""
    return record_cells(traits, "race_traits", "trait_id", {"doc_id": F.col("doc_id")}, None, F.col("record_json"))


def copy_counts(copies: DataFrame) -> DataFrame:
    """One entry for each group: tbl, keep_id, n_copies."""
    return copies.where("row_id = keep_id").select("tbl", "keep_id", "n_copies")


def copy_pairs(copies: DataFrame) -> DataFrame:
    """p1_found: tbl, keep_id, dup_id; one row for each row of a group but its smallest."""
    return copies.where("row_id <> keep_id").select("tbl", "keep_id", F.col("row_id").alias("dup_id"))


INVENTORY_SQL = """
with k as (
  select item_id, lower(regexp_replace(doc_id, '[^\\pL0-9]', '', 'g')) a, lower(regexp_replace(schema_name, '[^\\pL0-9]', '', 'g')) b,
    lower(regexp_replace(anchor, '[^\\pL0-9]', '', 'g')) c, lower(regexp_replace(section, '[^\\pL0-9]', '', 'g')) d, page, section_page, region_ids
  from list_items),
g as (select min(item_id) keep_id, list(item_id) ids from k group by a, b, c, d, page, section_page, region_ids)
select 'list_items' as tbl, keep_id, len(ids)::bigint as n_copies from g
"""

_COPIES_SQL = """
i as (select 'list_items' as tbl, item_id as id, concat_ws(chr(1), coalesce(lower(regexp_replace(doc_id, '[^\\pL0-9]', '', 'g')), chr(2)), coalesce(lower(regexp_replace(schema_name, '[^\\pL0-9]', '', 'g')), chr(2)),
    coalesce(lower(regexp_replace(anchor, '[^\\pL0-9]', '', 'g')), chr(2)), coalesce(lower(regexp_replace(section, '[^\\pL0-9]', '', 'g')), chr(2)), coalesce(page::varchar, chr(2)), coalesce(section_page::varchar, chr(2)), coalesce(region_ids::varchar, chr(2))) as k from list_items),
l as (select t.trait_id, j.fullkey || ' ' || case when j.type in ('UBIGINT', 'BIGINT', 'HUGEINT', 'DOUBLE') then 'n' || j.atom::varchar::double when j.type = 'VARCHAR' then 's' || lower(regexp_replace(j.value->>'$', '[^\\pL0-9]', '', 'g')) else j.type || coalesce(j.atom::varchar, '') end as leaf
  from race_traits t, lateral json_tree(t.record_json::json) j where json_valid(t.record_json) and j.type <> 'NULL'),
r as (select trait_id, string_agg(leaf, chr(1) order by leaf) as leaves from l group by trait_id),
t as (select 'race_traits' as tbl, t.trait_id as id, coalesce(lower(regexp_replace(t.doc_id, '[^\\pL0-9]', '', 'g')), chr(2)) || chr(1) || coalesce(r.leaves, chr(2)) as k from race_traits t left join r on r.trait_id = t.trait_id),
c as (select *, min(id) over (partition by tbl, k) as keep_id, count(*) over (partition by tbl, k) as n_copies from (select * from i union all select * from t))"""
FOUND_SQL = f"with {_COPIES_SQL} select tbl, keep_id, id as dup_id from c where id <> keep_id"
COUNTS_SQL = f"with {_COPIES_SQL} select tbl, keep_id, n_copies from c where id = keep_id"
