"""Queries on text, numbers, payloads and boxes, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import boxes, numbers, text
from quire.operators.skew import rank_within
from quire.sources import external, payloads, sinks
from quire.sources.tables import table
from quire.storage import shared_path

Q, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        Q[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


@query("content_hash", "select doc_id, sha256(text) as sha256, 'doc_' || substr(sha256(text), 1, 32) as key from documents where text is not null")
def _(s: SparkSession, d: str) -> DataFrame:
    sha = F.sha2("text", 256)
    return table(s, d, "documents").where("text is not null").select("doc_id", sha.alias("sha256"), payloads.content_key(sha).alias("key"))


@query("dedup_by_hash", "select first_id, copies from (select arg_min(doc_id, (added_at, doc_id)) as first_id, count(*) as copies from documents where text is not null group by sha256(text))")
def _(s: SparkSession, d: str) -> DataFrame:
    docs = table(s, d, "documents").where("text is not null")
    return docs.groupBy(F.sha2("text", 256).alias("h")).agg(F.min_by("doc_id", F.struct("added_at", "doc_id")).alias("first_id"), F.count("*").alias("copies")).drop("h")


@query("systematic_sample", """with r as (select page_id, doc_id, row_number() over (partition by doc_id order by page_no) - 1 as rn, count(*) over (partition by doc_id) as n from pages)
select page_id, doc_id from r where rn % greatest(1, n // 5) = 0 and rn // greatest(1, n // 5) < 5""")
def _(s: SparkSession, d: str) -> DataFrame:
    pages = table(s, d, "pages").select("page_id", "doc_id", "page_no")
    ranked = rank_within(pages, ["doc_id"], ["page_no"])
    size = pages.groupBy("doc_id").agg(F.count("*").alias("n"))
    step = F.greatest(F.lit(1), F.floor(F.col("n") / 5))
    return ranked.join(size, "doc_id").where((F.col("rank") % step == 0) & (F.floor(F.col("rank") / step) < 5)).select("page_id", "doc_id")


# fixed values: characters of compatibility forms and what they decompose to
_COMPAT = "replace(replace(replace(replace(replace(replace(replace(replace(replace(replace({c}, '²', '2'), '³', '3'), 'ª', 'a'), 'º', 'o'), '½', '1 2'), '¼', '1 4'), '™', 'tm'), '№', 'no'), 'ſ', 's'), '…', '...')"
_WIDE = "".join(chr(0xFEE0 + i) for i in range(0x21, 0x7F)), "".join(chr(i) for i in range(0x21, 0x7F)).replace("'", "''")
_NORMAL = "trim(regexp_replace(regexp_replace(lower(strip_accents(regexp_replace(translate(" + _COMPAT + ", '" + _WIDE[0] + "', '" + _WIDE[1] + "'), '[\\x{0300}-\\x{036F}]', '', 'g'))), '[^\\pL\\pN_\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"


def normal_sql(c: str) -> str:
    return _NORMAL.replace("{c}", f"coalesce({c}, '')")


@query("normalize_text", f"select region_id, {normal_sql('text')} as norm from regions")
def _(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "regions").select("region_id", text.normalize(F.col("text")).alias("norm"))


@query("pattern_count", "select page_id, coalesce(len(regexp_extract_all(full_text, 'level [0-9]+')), 0)::int as n from pages")
def _(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "pages").select("page_id", text.pattern_count(F.col("full_text"), "level [0-9]+").alias("n"))


@query("token_estimate", r"""select doc_id, round(coalesce(1.3 * (len(regexp_extract_all(text, '[0-9]')) + len(regexp_extract_all(text, '[^\pL\pN\s\pZ]')) + len(regexp_extract_all(text, '\pL')) / 3.0), 0), 3)::double as tokens from documents""")
def _(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").select("doc_id", F.round(text.estimate_tokens(F.col("text")), 3).alias("tokens"))


@query("slug_id", r"""with t as (select trait_id, list_concat(['race'], regexp_extract_all(lower(raceName), '[a-z0-9]+'), coalesce(regexp_extract_all(lower(subraceName), '[a-z0-9]+'), []), regexp_extract_all(lower(featureName), '[a-z0-9]+')) l from race_traits)
select trait_id, array_to_string(list_filter(l, lambda x, i: i = 1 or x <> l[i - 1]), '_') as slug from t""")
def _(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "race_traits").select("trait_id", text.slug("race", F.col("raceName"), F.col("subraceName"), F.col("featureName")).alias("slug"))


@query("format_duration", r"""with e as (select event_id, floor(value * 60)::int s from events)
select event_id, case when s < 60 then s || 's' when s < 3600 then (s // 60) || 'm ' || lpad((s % 60)::varchar, 2, '0') || 's' else (s // 3600) || 'h ' || lpad((s % 3600 // 60)::varchar, 2, '0') || 'm' end as shown from e""")
def _(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "events").select("event_id", text.duration(F.col("value") * 60).alias("shown"))


@query("progress_pct", """select doc_id, count(*) as total, count(*) filter (where full_text is not null) as done, floor(100.0 * count(*) filter (where full_text is not null) / count(*))::int as pct from pages group by doc_id""")
def _(s: SparkSession, d: str) -> DataFrame:
    done = F.count("full_text")
    return table(s, d, "pages").groupBy("doc_id").agg(F.count("*").alias("total"), done.alias("done"), F.floor(done * 100.0 / F.count("*")).cast("int").alias("pct"))


@query("prompt_text", """select item_id, 'Field: ' || coalesce(anchor, '') || chr(10) || coalesce('Section: ' || section || chr(10), '') || 'Regions: ' || coalesce(array_to_string(region_ids, ', '), '') as prompt from list_items""")
def _(s: SparkSession, d: str) -> DataFrame:
    lines = F.concat_ws("\n", F.concat(F.lit("Field: "), F.coalesce("anchor", F.lit(""))), F.concat(F.lit("Section: "), "section"), F.concat(F.lit("Regions: "), F.coalesce(F.array_join(F.col("region_ids").cast("array<string>"), ", "), F.lit(""))))
    return table(s, d, "list_items").select("item_id", lines.alias("prompt"))


_NUM = r"""case when t like '%,%' and t like '%.%' then (case when instr(reverse(t), ',') < instr(reverse(t), '.') then replace(replace(t, '.', ''), ',', '.') else replace(t, ',', '') end)
 when t like '%,%' then replace(t, ',', '.')
 when t like '%.%' and (len(string_split(t, '.')) > 2 or (len(string_split(t, '.')[2]) = 3 and len(string_split(t, '.')[1]) <= 3)) then replace(t, '.', '') else t end"""
_VALUE = f"case when regexp_full_match({_NUM}, '[-+]?[0-9]+[.]?[0-9]*') then cast({_NUM} as double) end"


@query("signed_numbers", rf"""with m as (select doc_id, replace(unnest(regexp_extract_all(translate(text, '−–—', '---'), '[-+]?\s*[0-9][0-9.,]*')), ' ', '') t from documents)
select doc_id, {_VALUE} as number, count(*) as n from m where {_VALUE} is not null group by all""")
def _(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").select("doc_id", F.explode(numbers.signed_numbers(F.col("text"))).alias("number")).groupBy("doc_id", "number").agg(F.count("*").alias("n"))


@query("normalize_number", rf"""with m as (select distinct replace(unnest(regexp_extract_all(translate(text, '−–—', '---'), '[-+]?\s*[0-9][0-9.,]*')), ' ', '') t from documents)
select t as token, {_VALUE} as number from m""")
def _(s: SparkSession, d: str) -> DataFrame:
    found = F.regexp_extract_all(numbers.one_minus(F.col("text")), F.lit(f"({numbers.NUMBER})"), F.lit(1))
    tokens = table(s, d, "documents").select(F.explode(found).alias("t")).select(F.replace("t", F.lit(" "), F.lit("")).alias("token")).distinct()
    return tokens.select("token", numbers.number_value(F.col("token")).alias("number"))


@query("identifier_tokens", r"""with m as (select ext_id, unnest(regexp_extract_all(translate(quote, '−–—', '---'), '[A-Za-z0-9][A-Za-z0-9.,/\\-]*[A-Za-z0-9]|[A-Za-z0-9]')) t from extractions)
select ext_id, t as token, count(*) as n from m where regexp_matches(t, '[0-9]') group by all""")
def _(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "extractions").select("ext_id", F.explode(numbers.identifier_tokens(F.col("quote"))).alias("token")).groupBy("ext_id", "token").agg(F.count("*").alias("n"))


@query("numbers_in_json", r"""with m as (select ext_id, unnest(regexp_extract_all(regexp_replace(value_json, '"(\\.|[^"\\])*"', '', 'g'), '-?[0-9]+(?:[.][0-9]+)?(?:[eE][-+]?[0-9]+)?'))::double v from extractions where json_valid(value_json))
select ext_id, count(*) as n, sum(v) as total from m group by ext_id""")
def _(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "extractions").where(F.try_parse_json("value_json").isNotNull())
    return rows.select("ext_id", F.explode(numbers.json_numbers(F.col("value_json"))).alias("v")).groupBy("ext_id").agg(F.count("*").alias("n"), F.sum("v").alias("total"))


@query("expected_numbers", """with e as (select trait_id, unnest(effects) x from race_traits)
select trait_id, x.kind as kind, x.amount as amount, case when x.kind = 'speed_bonus' then x.amount + 30 else x.amount end as other from e where x.amount is not null""")
def _(s: SparkSession, d: str) -> DataFrame:
    """The values that can witness an amount: itself, and for a speed bonus the sum with the base speed of 30."""
    rows = table(s, d, "race_traits").select("trait_id", F.explode("effects").alias("x")).where("x.amount is not null")
    return rows.select("trait_id", "x.kind", "x.amount", F.when(F.col("x.kind") == "speed_bonus", F.col("x.amount") + 30).otherwise(F.col("x.amount")).alias("other"))


@query("ocr_payload_explode", """select doc_id, page_no, (row_number() over (partition by doc_id, page_no order by order_idx, region_type) - 1)::int as pos, region_type, case when bbox is null then null else 4 end::int as n_box, coalesce(text, '') as text from regions where engine = 'a'""")
def _(s: SparkSession, d: str) -> DataFrame:
    built = payloads.block_payload(table(s, d, "regions").where("engine = 'a'"))
    return payloads.explode_blocks(built).drop("error")


@query("grounding_parse", r"""with p as (select doc_id, string_split(text, '<|ref|>') l from documents where contains(text, '<|ref|>')),
r as (select doc_id, unnest(l) part, generate_subscripts(l, 1) - 1 as pos from p),
g as (select doc_id, pos::int pos, trim(regexp_extract(part, '(?s)^(.*?)<\|/ref\|>\s*<\|det\|>(.*?)<\|/det\|>(.*)$', 1)) label, try_cast(regexp_extract(part, '(?s)^(.*?)<\|/ref\|>\s*<\|det\|>(.*?)<\|/det\|>(.*)$', 2) as double[][]) b,
  regexp_replace(regexp_extract(part, '(?s)^(.*?)<\|/ref\|>\s*<\|det\|>(.*?)<\|/det\|>(.*)$', 3), '^\s+|\s+$', '', 'g') text from r where pos > 0 and regexp_matches(part, '(?s)^(.*?)<\|/ref\|>\s*<\|det\|>(.*?)<\|/det\|>(.*)$'))
select doc_id, pos, label, case lower(label) when 'table' then 'table' when 'table_title' then 'table' when 'formula' then 'formula' when 'equation' then 'formula' when 'seal' then 'stamp' when 'stamp' then 'stamp' else 'text' end region_type,
  round(list_min([x[1] for x in b]) * 2480 / 999.0, 6)::double x0, round(list_min([x[2] for x in b]) * 3508 / 999.0, 6)::double y0, round(list_max([x[3] for x in b]) * 2480 / 999.0, 6)::double x1, round(list_max([x[4] for x in b]) * 3508 / 999.0, 6)::double y1, text
from g where label <> 'image' and len(b) > 0 and len(list_filter(b, lambda x: len(x) = 4 and len(list_filter(x, lambda v: v is not null)) = 4)) = len(b)""")
def _(s: SparkSession, d: str) -> DataFrame:
    return payloads.grounding_regions(table(s, d, "documents"), "doc_id", "text").withColumns({c: F.round(c, 6) for c in ("x0", "y0", "x1", "y1")})


@query("grounding_errors", r"""with p as (select doc_id, regexp_replace(text, '<[|｜]end▁of▁sentence[|｜]>', '', 'g') t from documents where source = 'engine_b_payloads'),
g as (select doc_id, t, regexp_extract_all(t, '(?s)<\|ref\|>(.*?)<\|/ref\|><\|det\|>(.*?)<\|/det\|>', 1) l, regexp_extract_all(t, '(?s)<\|ref\|>(.*?)<\|/ref\|><\|det\|>(.*?)<\|/det\|>', 2) b from p where regexp_matches(t, '\S')),
x as (select doc_id, unnest(l) lab, try_cast(unnest(b) as double[][]) bx from g), y as (select distinct doc_id from x where lower(trim(lab)) <> 'image' and not coalesce(len(bx) > 0 and len(list_filter(bx, lambda v: len(v) = 4 and len(list_filter(v, lambda w: w is not null)) = 4)) = len(bx), false))
select g.doc_id, case when len(l) = 0 then 'untagged' else 'box' end as error from g left join y on g.doc_id = y.doc_id where len(l) = 0 or y.doc_id is not null""")
def _(s: SparkSession, d: str) -> DataFrame:
    return payloads.grounding_errors(table(s, d, "documents").where("source = 'engine_b_payloads'"), "doc_id", "text")


@query("stub_answers", """select item_id, case when anchor is not null and not regexp_matches(anchor, '[0-9]') then '{"anchor_chars": ' || length(anchor) || '}' end as payload, case when regexp_matches(anchor, '[0-9]') then 'ValueError: digits in the anchor' end as error from list_items""")
def _(s: SparkSession, d: str) -> DataFrame:
    """The call slot with a stub for the model: an answer for each item, or the error that its call raised."""

    def stub(anchor: str) -> str:
        if any(c in "0123456789" for c in anchor):
            raise ValueError("digits in the anchor")
        return f'{{"anchor_chars": {len(anchor)}}}'

    return external.call(table(s, d, "list_items").select("item_id", "anchor"), "anchor", stub).drop("anchor")


@query("log_excerpt", "with l as (select trim(unnest(string_split(text, chr(10)))) line from documents) select line, count(*) as times from l where regexp_matches(line, '(?i)error|traceback|memory') group by line")
def _(s: SparkSession, d: str) -> DataFrame:
    """The lines of all texts that a log filter would keep."""
    lines = table(s, d, "documents").select(F.explode(F.split("text", "\n")).alias("value"))
    return external.excerpt(lines)


@query("written_definitions", """select trait_id, coalesce(json_valid(record_json), false) as valid from race_traits""")
def _(s: SparkSession, d: str) -> DataFrame:
    """Definitions written as JSON lines, the invalid ones apart, and read back."""
    path = shared_path(s, "definitions")
    rows = table(s, d, "race_traits").select("trait_id", "def_id", "record_json", F.when(F.try_parse_json("record_json").isNull(), "no valid JSON").alias("errors"))
    sinks.write_definitions(rows, path)
    return s.read.schema("trait_id long, invalid boolean").json(path).select("trait_id", (~F.col("invalid")).alias("valid"))


@query("written_corrections", "select doc_id, field_path, value_json as new_value from extractions where status = 'needs_review' and value_json is not null")
def _(s: SparkSession, d: str) -> DataFrame:
    """Corrections appended as JSON lines, in two parts, and read back."""
    path = shared_path(s, "corrections")
    rows = table(s, d, "extractions").where("status = 'needs_review' and value_json is not null").select("doc_id", "field_path", F.col("value_json").alias("new_value"), "schema_name")
    for part in (F.col("schema_name").eqNullSafe(F.lit("contract")), ~F.col("schema_name").eqNullSafe(F.lit("contract"))):
        sinks.write_corrections(rows.where(part), path)
    return s.read.schema("doc_id string, field_path string, new_value string").json(path)


@query("box_unions", f"""with r as (select doc_id, page_no, case when len(cast(bbox as json)::double[]) = 4 then cast(bbox as json)::double[] end b from regions where engine = 'a')
select doc_id, page_no, min(b[1]) as x0, min(b[2]) as y0, max(b[3]) as x1, max(b[4]) as y1 from r where b is not null group by doc_id, page_no""")
def _(s: SparkSession, d: str) -> DataFrame:
    """The box around all boxes of a page."""
    rows = table(s, d, "regions").where("engine = 'a'").select("doc_id", "page_no", boxes.box(F.col("bbox")).alias("b")).where("b is not null")
    every = rows.groupBy("doc_id", "page_no").agg(F.collect_list("b").alias("bs"))
    return every.select("doc_id", "page_no", F.aggregate("bs", F.get("bs", F.lit(0)), boxes.union).alias("u")).select("doc_id", "page_no", "u.*")


@query("label_map", """with p as (select string_split(text, '<|ref|>') l from documents where contains(text, '<|ref|>')), r as (select unnest(l[2:]) part from p), g as (select trim(string_split(part, '<|/ref|>')[1]) label from r where contains(part, '<|/ref|>'))
select label, case lower(label) when 'table' then 'table' when 'table_title' then 'table' when 'formula' then 'formula' when 'equation' then 'formula' when 'seal' then 'stamp' when 'stamp' then 'stamp' else 'text' end as region_type, count(*) as n from g group by all""")
def _(s: SparkSession, d: str) -> DataFrame:
    parts = table(s, d, "documents").where(F.col("text").contains(payloads.TAG)).select(F.explode(F.slice(F.split("text", r"<\|ref\|>"), 2, 1 << 30)).alias("p")).where(F.col("p").contains("<|/ref|>"))
    labels = parts.select(F.trim(F.substring_index("p", "<|/ref|>", 1)).alias("label"))
    return labels.groupBy("label").agg(F.count("*").alias("n")).withColumn("region_type", text.region_type(F.col("label"), second=True))


@query("json_object_guard", "select ext_id, case when value_json is null then 'missing' when not json_valid(value_json) then 'not json' when json_type(value_json) <> 'OBJECT' then 'not an object' end as error from extractions")
def _(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "extractions").select("ext_id", payloads.object_guard(F.col("value_json")).alias("error"))


_B = "(case when len(cast(bbox as json)::double[]) = 4 then cast(bbox as json)::double[] end)"


@query("bbox_ops", f"""with r as (select region_id, {_B} b from regions)
select region_id, greatest(0.0, b[1] - 12)::double x0, greatest(0.0, b[2] - 12)::double y0, least(2480.0, b[3] + 12)::double x1, least(3508.0, b[4] + 12)::double y1, (greatest(b[3] - b[1], 0) * greatest(b[4] - b[2], 0))::double area from r where b is not null""")
def _(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "regions").select("region_id", boxes.box(F.col("bbox")).alias("b")).where("b is not null")
    return rows.select("region_id", boxes.expand(F.col("b"), 12, 2480, 3508).alias("e"), boxes.area(F.col("b")).alias("area")).select("region_id", "e.*", "area")


@query("bbox_rotate", f"""with r as (select r.region_id, p.deskew_angle g, {_B.replace('bbox', 'r.bbox')} b from regions r join pages p on r.doc_id = p.doc_id and r.page_no = p.page_no),
c as (select region_id, g, b, [b[1], b[3], b[3], b[1]] xs, [b[2], b[2], b[4], b[4]] ys from r where b is not null),
t as (select region_id, g, b, [1240 + (xs[i] - 1240) * cos(radians(g)) - (ys[i] - 1754) * sin(radians(g)) for i in [1, 2, 3, 4]] tx, [1754 + (xs[i] - 1240) * sin(radians(g)) + (ys[i] - 1754) * cos(radians(g)) for i in [1, 2, 3, 4]] ty from c)
select region_id, round(case when coalesce(g, 0) = 0 then b[1] else list_min(tx) end, 6)::double x0, round(case when coalesce(g, 0) = 0 then b[2] else list_min(ty) end, 6)::double y0, round(case when coalesce(g, 0) = 0 then b[3] else list_max(tx) end, 6)::double x1, round(case when coalesce(g, 0) = 0 then b[4] else list_max(ty) end, 6)::double y1 from t""")
def _(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "regions").select("region_id", "doc_id", "page_no", boxes.box(F.col("bbox")).alias("b")).where("b is not null")
    turned = rows.join(table(s, d, "pages").select("doc_id", "page_no", "deskew_angle"), ["doc_id", "page_no"]).select("region_id", boxes.rotate(F.col("b"), F.col("deskew_angle"), 2480, 3508).alias("t"))
    return turned.select("region_id", *[F.round(f"t.{c}", 6).alias(c) for c in ("x0", "y0", "x1", "y1")])


@query("weighted_mean", f"""with r as (select r.doc_id, p.deskew_angle g, {_B.replace('bbox', 'r.bbox')} b from regions r join pages p on r.doc_id = p.doc_id and r.page_no = p.page_no where r.engine = 'a')
select doc_id, round(sum(g * greatest(b[3] - b[1], 0) * greatest(b[4] - b[2], 0)) / sum(case when g is not null then greatest(b[3] - b[1], 0) * greatest(b[4] - b[2], 0) end), 6) as angle from r where b is not null group by doc_id""")
def _(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "regions").where("engine = 'a'").select("doc_id", "page_no", boxes.area(boxes.box(F.col("bbox"))).alias("a")).where("a is not null")
    joined = rows.join(table(s, d, "pages").select("doc_id", "page_no", "deskew_angle"), ["doc_id", "page_no"])
    g = F.col("deskew_angle")
    return joined.groupBy("doc_id").agg(F.round(F.sum(g * F.col("a")) / F.sum(F.when(g.isNotNull(), F.col("a"))), 6).alias("angle"))


@query("folded_median", "select doc_id, round(coalesce(((median(deskew_angle * 100) + 45) % 90 + 90) % 90 - 45, 0), 6) as angle from pages group by doc_id")
def _(s: SparkSession, d: str) -> DataFrame:
    folded = F.pmod(F.median(F.col("deskew_angle") * 100) + 45, F.lit(90.0)) - 45
    return table(s, d, "pages").groupBy("doc_id").agg(F.round(F.coalesce(folded, F.lit(0.0)), 6).alias("angle"))
