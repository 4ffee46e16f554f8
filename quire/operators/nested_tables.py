"""Deeply nested records to related flat tables, in one pass.

A depth-first visitor emits, for each object or array of interest, one tagged row: table tag, primary key, parent key and
payload. The rows of all tables come out of one scan; ``write_tables`` stores them partitioned by tag and ``typed`` gives each
table its own columns.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.storage import shared_path, shared_table

Emit = Callable[[str, str, str | None, dict[str, Any]], None]
Visitor = Callable[[Any, Emit], None]
TAGGED = "tag string, pk string, parent string, payload string"


ERRORS = "error"  # the tag of records that could not be read


def tagged_rows(df: DataFrame, row_id: str, value: str, visitor: Visitor) -> DataFrame:
    """One row (row_id, tag, pk, parent, payload) for each emission of the visitor over the JSON column ``value``.

    pk and parent are unique within a record; row_id names the record. Null values emit nothing. A value that is no valid JSON
    or nested deeper than the parser goes emits one row with the tag ``error`` and the reason. Only the
    two named columns are read. The work is a map over Arrow batches, handed on in pieces: no shuffle, no batch held twice.
    """
    columns = ["row_id", "tag", "pk", "parent", "payload"]

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        for pdf in batches:
            for rid, text in zip(pdf["row_id"].tolist(), pdf["value"].tolist(), strict=True):
                if text is None:
                    continue
                begin = len(out)
                try:
                    visitor(json.loads(text), lambda tag, pk, parent, payload, rid=rid: out.append((rid, tag, pk, parent, json.dumps(payload, ensure_ascii=False))))
                except (ValueError, RecursionError) as e:
                    del out[begin:]
                    reason = "too deep" if isinstance(e, RecursionError) else "no valid JSON"
                    out.append((rid, ERRORS, "$", None, json.dumps({"reason": reason, "n_chars": len(text)})))
                if len(out) >= 20_000:
                    yield pd.DataFrame(out, columns=columns)
                    out = []
        yield pd.DataFrame(out, columns=columns)

    return df.select(F.col(row_id).cast("long").alias("row_id"), F.col(value).alias("value")).mapInPandas(visit, f"row_id long, {TAGGED}")


def write_tables(tagged: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Stores tagged rows partitioned by tag, so that reading one table touches its files only."""
    tagged.write.mode(mode).partitionBy("tag").parquet(path)


def typed(tagged: DataFrame, tag: str, schema: str) -> DataFrame:
    """One flat table: the tagged rows' own columns and the payload's by a DDL schema; fields a record lacks are null."""
    own = [c for c in tagged.columns if c not in ("tag", "payload")]
    return tagged.where(F.col("tag") == tag).select(*own, F.from_json("payload", schema).alias("p")).select(*own, "p.*")


def _children(v: Any) -> list:
    return v if isinstance(v, list) else []


def visit_effects(record: Any, emit: Emit) -> None:
    """Emits tables ``effect`` (pk = path such as 0.1, parent = path of the effect that offers it) and ``damage``
    (pk = path#position, parent = the effect's path).

    Effects are the record itself when it is an array of objects, or stand under ``effects``, under ``value``, or under
    ``effects`` and then ``value``. Entries of an effect array that are no objects keep their position and emit nothing. A
    damage type given as a single string counts as an array of one; one that is null is skipped, its position kept; a
    number or other scalar is written as text. A missing or null kind is ''. Tables ``ability`` and ``skill`` (pk =
    path/name/position) hold the entries of the arrays of that name in the same way.
    """
    effects = record
    if isinstance(record, dict):
        effects = record["effects"] if record.get("effects") is not None else record.get("value")
        if isinstance(effects, dict):
            effects = effects.get("value")
    stack = [(f"{i}", None, e) for i, e in reversed(list(enumerate(_children(effects))))]
    while stack:  # an explicit stack: depth is bounded by the parser alone
        path, parent, effect = stack.pop()
        if not isinstance(effect, dict):
            continue
        kind = effect.get("kind")
        kind = "" if kind is None else kind if isinstance(kind, str) else json.dumps(kind)
        types = effect.get("damageTypes")
        types = [types] if isinstance(types, str) else _children(types)
        named = [(i, t if isinstance(t, str) else json.dumps(t)) for i, t in enumerate(types) if t is not None]
        scalars = {k: v for k, v in effect.items() if k in ("amount", "base", "condition")}
        emit("effect", path, parent, {"kind": kind, "n_damage": len(named), **scalars})
        for i, t in named:
            emit("damage", f"{path}#{i}", path, {"kind": kind, "dmg_pos": i, "damage_type": t})
        for tag, name in LISTS.items():
            values = effect.get(name)
            values = [values] if isinstance(values, str) else _children(values)
            for i, t in enumerate(values):
                if t is not None:
                    emit(tag, f"{path}/{name}/{i}", path, {"pos": i, tag: t if isinstance(t, str) else json.dumps(t)})
        stack += [(f"{path}.{i}", path, e) for i, e in reversed(list(enumerate(_children(effect.get("options")))))]


LISTS = {"ability": "abilities", "skill": "skills"}
SCHEMAS = {
    "effect": "kind string, n_damage int, amount string, base string, condition string",
    "damage": "kind string, dmg_pos int, damage_type string",
    "ability": "pos int, ability string",
    "skill": "pos int, skill string",
    ERRORS: "reason string, n_chars int",
}
EFFECT, DAMAGE = SCHEMAS["effect"], SCHEMAS["damage"]


def effect_sources(traits: DataFrame, extractions: DataFrame) -> DataFrame:
    """Tagged rows of both inputs with a column tbl."""
    a = tagged_rows(traits.select("trait_id", F.to_json("effects", {"ignoreNullFields": "true"}).alias("v")), "trait_id", "v", visit_effects).withColumn("tbl", F.lit("race_traits"))
    b = tagged_rows(extractions.select("ext_id", "value_json"), "ext_id", "value_json", visit_effects).withColumn("tbl", F.lit("extractions"))
    return a.unionByName(b)


def stored_tables(tagged: DataFrame) -> dict[str, DataFrame]:
    """The tables by tag, each with its schema, read from a copy in the shared folder that is partitioned by tag."""
    path = shared_path(tagged.sparkSession, "tagged")
    write_tables(tagged, path)
    stored = tagged.sparkSession.read.schema(tagged.schema).parquet(path)
    return {tag: typed(stored, tag, schema) for tag, schema in SCHEMAS.items()}


def damage_rows(tagged: DataFrame) -> DataFrame:
    """p6_found: tbl, row_id, effect_path, kind, dmg_pos, damage_type; an effect without damage types has dmg_pos -1 and ''.

    The tagged rows are written once, by tag; the damage table gives its rows, the effect table those without damage.
    """
    tables = stored_tables(tagged)
    damage = tables["damage"].select("tbl", "row_id", F.col("parent").alias("effect_path"), "kind", "dmg_pos", "damage_type")
    none = tables["effect"].where("n_damage = 0").select("tbl", "row_id", F.col("pk").alias("effect_path"), "kind", F.lit(-1).alias("dmg_pos"), F.lit("").alias("damage_type"))
    return damage.unionByName(none)


def visit_leaves(record: Any, emit: Emit) -> None:
    """Emits ``leaf`` for each leaf (an object with ``value`` or ``quote``) of an object: pk its path such as a.b[0].c, ``<root>``
    where the record is one itself. Null members, members that are no objects, and entries of lists that are no objects
    are passed over, and so are leaves with a quote but no value, which contradict themselves."""
    todo = [("", record)]
    while todo:
        path, v = todo.pop()
        if not isinstance(v, dict):
            continue
        if "value" in v or "quote" in v:
            if v.get("value") is not None or v.get("quote") is None:
                emit("leaf", path or "<root>", None, {"value": None if v.get("value") is None else json.dumps(v["value"], ensure_ascii=False), "quote": v.get("quote"), "page": v.get("page"), "confidence": v.get("confidence", "high")})
            continue
        for k, x in reversed(list(v.items())):
            name = f"{path}.{k}" if path else k
            todo += [(f"{name}[{i}]", y) for i, y in reversed(list(enumerate(x)))] if isinstance(x, list) else [(name, x)]


LEAF = "value string, quote string, page int, confidence string"
STEP = re.compile(r"([^.\[\]]+)(?:\[(\d+)\])?")


def assembled(leaves: list[tuple[list[tuple[str, int | None]], Any]]) -> dict:
    """The nested object of leaves given as (steps, leaf); a step is (name, position in its list or None). Lists are as long as
    their last position asks; entries nothing is known of are empty objects. A leaf with members below it keeps both."""
    members: dict[str, dict[int | None, list]] = {}
    for steps, leaf in leaves:
        members.setdefault(steps[0][0], {}).setdefault(steps[0][1], []).append((steps[1:], leaf))

    def node(inner: list) -> Any:
        own = [leaf for steps, leaf in inner if not steps]
        below = assembled([x for x in inner if x[0]])
        return {**own[-1], **below} if own and isinstance(own[-1], dict) else own[-1] if own else below

    out: dict = {}
    for name, places in members.items():
        if set(places) == {None}:
            out[name] = node(places[None])
        else:
            out[name] = [node(places.get(i, [])) for i in range(1 + max(i for i in places if i is not None))]
    return out


@F.pandas_udf(T.StringType())
def _assemble(paths: pd.Series, leaves: pd.Series) -> pd.Series:
    """The object of one top-level field or list entry, from the paths below it ('' is the entry itself) and JSON leaves."""

    def one(ps: Any, ls: Any) -> str:
        inner = [([("x", None)] + [(n, int(i) if i else None) for n, i in STEP.findall(p)], json.loads(v)) for p, v in sorted(zip(ps, ls, strict=True))]
        return json.dumps(assembled(inner)["x"], ensure_ascii=False, sort_keys=True)

    return pd.Series([one(p, v) for p, v in zip(paths, leaves, strict=True)], dtype="string")


def nested_rows(rows: DataFrame, keys: list[str], path: str, leaf: str) -> DataFrame:
    """keys, field, idx, node: flat rows (keys, path such as a.b[0].c, leaf as JSON) put back into one JSON object for each
    top-level field or, for lists, each position; positions that no path names are empty objects.

    The entries of a list are rows, not one array: a file with any number of entries is spread over tasks. Paths with ``$``
    (inventories) and null paths or leaves are left out; of repeated paths the one with the largest leaf text counts.
    """
    part = lambda i: F.regexp_extract(path, r"^([^.\[\]]+)(?:\[(\d+)\])?(?:\.(.*))?$", i)
    flat = rows.where(~F.col(path).contains("$") & F.col(leaf).isNotNull()).groupBy(*keys, path).agg(F.max(leaf).alias("__leaf"))
    flat = flat.select(*keys, part(1).alias("field"), part(2).try_cast("int").alias("idx"), part(3).alias("__rest"), "__leaf").where("field <> ''")
    some = flat.groupBy(*keys, "field", "idx").agg(F.collect_list(F.struct("__rest", "__leaf")).alias("l"))
    nodes = shared_table(some.select(*keys, "field", "idx", _assemble(F.col("l.__rest"), F.col("l.__leaf")).alias("node")), "nodes")
    lengths = nodes.where("idx is not null").groupBy(*keys, "field").agg(F.max("idx").alias("n"))
    every = lengths.select(*keys, "field", F.explode(F.sequence(F.lit(0), "n")).alias("idx"))
    listed = every.join(nodes, [*keys, "field", "idx"], "left").na.fill("{}", ["node"])
    return listed.unionByName(nodes.where("idx is null"))


P6_SQL = """
with src as (select 'race_traits' as tbl, trait_id as row_id, to_json(effects)::varchar as v from race_traits where effects is not null union all select 'extractions', ext_id, value_json from extractions where value_json is not null and json_valid(value_json)),
t as (select tbl, row_id, j.fullkey as k, j.value as o, v from src, lateral json_tree(src.v::json) j where j.type = 'OBJECT'),
e as (select tbl, row_id, k, o, case when json_type(v) = 'ARRAY' then '$' when coalesce(json_type(v, '$.effects'), 'NULL') <> 'NULL' then case when json_type(v, '$.effects') = 'OBJECT' then '$.effects.value' else '$.effects' end when json_type(v, '$.value') = 'OBJECT' then '$.value.value' else '$.value' end as root from t),
f as (select tbl, row_id, trim(replace(substr(k, length(root) + 1), '].options[', '.'), '[]') as effect_path, coalesce(o->>'kind', '') as kind, case json_type(o, '$.damageTypes') when 'VARCHAR' then [o->>'damageTypes'] when 'ARRAY' then (o->>'$.damageTypes[*]')::varchar[] else [] end as types
  from e where starts_with(k, root) and regexp_full_match(substr(k, length(root) + 1), '\\[[0-9]+\\](\\.options\\[[0-9]+\\])*')),
d as (select tbl, row_id, effect_path, kind, unnest(types) as damage_type, (generate_subscripts(types, 1) - 1)::int as dmg_pos from f)
select tbl, row_id, effect_path, kind, dmg_pos, damage_type from d where damage_type is not null
union all select tbl, row_id, effect_path, kind, -1, '' from f where len(list_filter(types, lambda x: x is not null)) = 0
"""
