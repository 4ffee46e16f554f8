"""Queries on packing, inventories, nesting, gates, review and evaluation, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.functions import boxes, text
from quire.operators import evaluate, gates, nested_tables, packing, states, versions
from quire.operators.skew import rank_within
from quire.plans.table_queries import KEY, ORDER
from quire.plans.text_queries import _VALUE, normal_sql
from quire.session import Settings
from quire.sources.tables import table

Q, SQL = {}, {}
PAGE = ["doc_id", "page_no"]
D = Settings()  # the defaults, for the SQL


def conf(s: SparkSession) -> Settings:
    """The session's settings."""
    return Settings.from_session(s)



def query(name: str, sql: str | None = None):
    def add(f):
        Q[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


# packing


@query("page_windows", f"""with recursive p as (select doc_id, page_no, length(coalesce(canonical_text, full_text, '')) + 2 sz, row_number() over (partition by doc_id order by page_no) rn from pages),
c as (select a.doc_id, a.rn s, max(b.rn) e from p a join (select doc_id, rn, sum(sz) over (partition by doc_id order by rn) cs from p) b on a.doc_id = b.doc_id and b.rn >= a.rn
  join (select doc_id, rn, sum(sz) over (partition by doc_id order by rn) - sz pre from p) f on f.doc_id = a.doc_id and f.rn = a.rn where b.rn = a.rn or b.cs - f.pre <= {D.window_chars} group by all),
m as (select doc_id, max(rn) n from p group by doc_id),
w as (select doc_id, 0 as win, 1::bigint as s from m union all select w.doc_id, win + 1, case when c.e > w.s then c.e else c.e + 1 end from w join c on w.doc_id = c.doc_id and w.s = c.s join m on m.doc_id = w.doc_id where c.e < m.n)
select w.doc_id, w.win as "window", a.page_no as first_page, b.page_no as last_page from w join c on w.doc_id = c.doc_id and w.s = c.s join p a on a.doc_id = w.doc_id and a.rn = c.s join p b on b.doc_id = w.doc_id and b.rn = c.e""")
def _(s: SparkSession, d: str) -> DataFrame:
    size = F.length(F.coalesce("canonical_text", "full_text", F.lit(""))) + 2
    return packing.page_windows(table(s, d, "pages").select(*PAGE, size.alias("size")), conf(s).window_chars)


_BLOCK_ROWS = """b as (select doc_id, page_no, region_id, length('[' || region_id || '] ' || region_type || ': ' || coalesce(text_canonical, text, 'None')) + 1 as size, 41 + length(page_no::varchar) as head, row_number() over (partition by doc_id, page_no order by order_idx, region_id) rn from regions where engine = 'a')"""


@query("page_blocks", f"""with recursive {_BLOCK_ROWS},
w as (select doc_id, page_no, region_id, rn, 0 as block, (head + size)::bigint as used from b where rn = 1
  union all select b.doc_id, b.page_no, b.region_id, b.rn, case when w.used + b.size > {D.block_chars} then w.block + 1 else w.block end, case when w.used + b.size > {D.block_chars} then b.head + b.size else w.used + b.size end from w join b on b.doc_id = w.doc_id and b.page_no = w.page_no and b.rn = w.rn + 1)
select doc_id, page_no, region_id, block from w""")
def _(s: SparkSession, d: str) -> DataFrame:
    """Pages cut to blocks of 2,000 characters; each has the two heading lines of its page, a region is a line with id and type."""
    line = F.format_string("[%d] %s: %s", "region_id", "region_type", F.coalesce("text_canonical", "text", F.lit("None")))
    head = F.length(F.col("page_no").cast("string")) + 41  # fixed value: characters of "=== PAGE n ===", the line of column names and the line end
    rows = table(s, d, "regions").where("engine = 'a'").select(*PAGE, "order_idx", "region_id", head.alias("head"), (F.length(line) + 1).alias("size"))
    return packing.page_blocks(rows, conf(s).block_chars)


@query("table_budget_fold", f"""with recursive b as (select doc_id, page_no, region_id, coalesce(length(text), 0) as size, row_number() over (partition by doc_id, page_no order by order_idx, region_id) rn from regions where engine = 'a' and region_type = 'table'),
w as (select doc_id, page_no, region_id, rn, size <= {D.page_table_chars} as taken, case when size <= {D.page_table_chars} then size else 0 end::bigint as used from b where rn = 1
  union all select b.doc_id, b.page_no, b.region_id, b.rn, w.used + b.size <= {D.page_table_chars}, case when w.used + b.size <= {D.page_table_chars} then w.used + b.size else w.used end from w join b on b.doc_id = w.doc_id and b.page_no = w.page_no and b.rn = w.rn + 1)
select doc_id, page_no, region_id from w where taken""")
def _(s: SparkSession, d: str) -> DataFrame:
    return packing.tables_in_budget(table(s, d, "regions").where("engine = 'a'"), conf(s).page_table_chars)


_SPANS = """i as (select item_id, doc_id, schema_name, page, unnest(region_ids) rid from list_items where page > 0 and len(region_ids) > 0),
l as (select i.item_id, i.doc_id, i.schema_name, i.page, case when r.region_id is not null then {'p': r.page_no, 'o': r.order_idx::bigint, 'r': r.region_id} end as place, r.page_no from i left join regions r on r.engine = 'a' and r.doc_id = i.doc_id and r.region_id = i.rid),
o as (select item_id, doc_id, schema_name, page, coalesce(min(place) filter (where page_no = page), {'p': page + 1, 'o': -1::bigint, 'r': -1::bigint}) as start, list(place) filter (where place is not null) as places from l group by item_id, doc_id, schema_name, page),
g as (select doc_id, schema_name, page, start, list_sort(list_distinct(flatten(list(coalesce(places, []))))) as places from o group by all),
n as (select *, coalesce(lead(page) over w, page) as last, lead(places) over w as following from g window w as (partition by doc_id, schema_name order by page, start)),
t as (select *, list_filter(following, lambda x: x >= start)[1] as stop from n),
j as (select t.doc_id, t.schema_name, t.page, t.start, r.region_id, sum(coalesce(length(coalesce(r.text_canonical, r.text)), 0)) over (partition by t.doc_id, t.schema_name, t.page, t.start order by r.page_no, r.order_idx, r.region_id) as run
  from t join regions r on r.engine = 'a' and r.doc_id = t.doc_id and r.page_no between t.page and t.last and {'p': r.page_no, 'o': r.order_idx::bigint, 'r': r.region_id} >= t.start and (t.stop is null or {'p': r.page_no, 'o': r.order_idx::bigint, 'r': r.region_id} < t.stop))"""


@query("item_span", f"with {_SPANS} select o.item_id, j.region_id from o join j on o.doc_id = j.doc_id and o.schema_name is not distinct from j.schema_name and o.page = j.page and o.start = j.start where j.run <= {D.span_chars}")
def _(s: SparkSession, d: str) -> DataFrame:
    """The regions of each item up to the next item of the file's list, across pages, over the canonical text."""
    regions = table(s, d, "regions").where("engine = 'a'").select(*PAGE, "order_idx", "region_id", F.coalesce(F.length(F.coalesce("text_canonical", "text")), F.lit(0)).alias("size"))
    return packing.file_spans(table(s, d, "list_items"), regions, conf(s).span_chars)


@query("item_context")
def _(s: SparkSession, d: str) -> DataFrame:
    """The regions that the task of an item sees: its span; without one the regions around its own, or its page; then the tables of
    its page and its section's page, as far as they fit the settings' table_chars."""
    items = table(s, d, "list_items").select("item_id", "doc_id", "schema_name", "page", "region_ids", "section_page")
    text_of = F.coalesce("text_canonical", "text")
    regions = table(s, d, "regions").where("engine = 'a'").select(*PAGE, "order_idx", "region_id", "region_type", F.coalesce(F.length(text_of), F.lit(0)).alias("size"))
    return packing.item_contexts(items, regions, conf(s).span_chars, conf(s).table_chars)


@query("margin_window", """with f as (select distinct unnest(region_ids) region_id from list_items), r as (select r.region_id, doc_id, page_no, order_idx, (f.region_id is not null)::int fl from regions r left join f on r.region_id = f.region_id where engine = 'a'),
w as (select *, max(fl) over (partition by doc_id, page_no order by order_idx rows between 1 preceding and 1 following) near, max(fl) over (partition by doc_id, page_no) anyhit from r) select region_id from w where near = 1 or anyhit = 0""")
def _(s: SparkSession, d: str) -> DataFrame:
    flagged = table(s, d, "list_items").select(F.explode("region_ids").alias("region_id")).distinct().withColumn("hit", F.lit(True))
    rows = table(s, d, "regions").where("engine = 'a'").select("region_id", *PAGE, "order_idx").join(flagged, "region_id", "left").na.fill(False, ["hit"])
    return packing.with_neighbours(rows, PAGE, "order_idx", "hit").select("region_id")


@query("label_window", f"""with r as (select region_id, doc_id, page_no, order_idx, case when contains({normal_sql('text')}, 'damage') then order_idx end hit from regions where engine = 'a'),
f as (select *, min(hit) over (partition by doc_id, page_no) first from r), g as (select *, (hit = first)::int fl from f),
w as (select *, max(coalesce(fl, 0)) over (partition by doc_id, page_no order by order_idx rows between 1 preceding and 1 following) near, max(coalesce(fl, 0)) over (partition by doc_id, page_no) anyhit from g) select region_id from w where near = 1 or anyhit = 0""")
def _(s: SparkSession, d: str) -> DataFrame:
    """The first region of a page that holds the label, with its neighbours; all regions where none does."""
    rows = table(s, d, "regions").where("engine = 'a'").select("region_id", *PAGE, "order_idx", F.contains(text.normalize(F.col("text")), F.lit("damage")).alias("has"))
    first = F.min(F.when(F.col("has"), F.col("order_idx"))).over(W.partitionBy(*PAGE))
    rows = rows.withColumn("hit", F.coalesce(F.col("order_idx") == first, F.lit(False)))
    return packing.with_neighbours(rows, PAGE, "order_idx", "hit").select("region_id")


_FIELD_LABELS = (("importo", "amount"), ("damage", "danni"))  # for each field its labels, the preferred one first
_LABELS_SQL = " union all ".join(f"select {i} as field, {j} as pr, '{lab}' as label" for i, labels in enumerate(_FIELD_LABELS) for j, lab in enumerate(labels))


@query("labels_window", f"""with l as ({_LABELS_SQL}), r as (select region_id, doc_id, page_no, order_idx, {normal_sql('text')} as norm from regions where engine = 'a'),
h as (select r.doc_id, r.page_no, l.field, l.pr, min(r.order_idx) as first from r join l on contains(r.norm, l.label) group by all), b as (select doc_id, page_no, field, arg_min(first, pr) as first from h group by all),
f as (select r.*, b.field, coalesce(b.first = r.order_idx, false)::int as fl, b.first is not null as known from r cross join (select distinct field from l) x left join b on b.doc_id = r.doc_id and b.page_no = r.page_no and b.field = x.field),
w as (select *, max(fl) over (partition by doc_id, page_no, coalesce(field, -1) order by order_idx rows between 1 preceding and 1 following) as near from f)
select distinct region_id from w where near = 1 or not known""")
def _(s: SparkSession, d: str) -> DataFrame:
    """For each field the first region of the page with its best label, with neighbours, or the whole page where no label stands; the
    union over the fields."""
    rows = table(s, d, "regions").where("engine = 'a'").select("region_id", *PAGE, "order_idx", text.normalize(F.col("text")).alias("norm"))
    page = W.partitionBy(*PAGE)
    out = None
    for labels in _FIELD_LABELS:
        firsts = [F.min(F.when(F.contains("norm", F.lit(lab)), F.col("order_idx"))).over(page) for lab in labels]
        flagged = rows.withColumn("hit", F.coalesce(F.col("order_idx") == F.coalesce(*firsts), F.lit(False)))
        part = packing.with_neighbours(flagged, PAGE, "order_idx", "hit").select("region_id")
        out = part if out is None else out.unionByName(part)
    return out.distinct()


@query("field_page", """with l(label, pr) as (values ('importo', 0), ('traits', 1), ('damage', 2)), h as (select r.doc_id, r.page_no, l.pr, r.order_idx from regions r join l on contains(lower(r.text), l.label) where engine = 'a')
select doc_id, arg_min(page_no, (pr, page_no, order_idx)) as page_no from h group by doc_id""")
def _(s: SparkSession, d: str) -> DataFrame:
    low = F.lower("text")
    priority = F.when(F.contains(low, F.lit("importo")), 0).when(F.contains(low, F.lit("traits")), 1).when(F.contains(low, F.lit("damage")), 2)
    rows = table(s, d, "regions").where("engine = 'a'").select(*PAGE, "order_idx", priority.alias("pr")).where("pr is not null")
    return rows.groupBy("doc_id").agg(F.min_by("page_no", F.struct("pr", "page_no", "order_idx")).alias("page_no"))


@query("task_chunks", f"""with f as (select distinct doc_id, page_no, field_path from extractions), r as (select *, (row_number() over (partition by doc_id, page_no order by field_path) - 1) // {D.fields_per_task} as chunk from f)
select doc_id, page_no, chunk, count(*) as fields from r where page_no is not null group by all""")
def _(s: SparkSession, d: str) -> DataFrame:
    fields = table(s, d, "extractions").where("page_no is not null").select(*PAGE, "field_path").distinct()
    from quire.storage import shared_table

    ranked = rank_within(shared_table(fields, "fields"), PAGE, ["field_path"])
    return ranked.groupBy(*PAGE, F.floor(F.col("rank") / conf(s).fields_per_task).alias("chunk")).agg(F.count("*").alias("fields"))


@query("asof_section", f"""with p as (select doc_id, page_no, {normal_sql('coalesce(canonical_text, full_text)')} norm from pages), i as (select item_id, doc_id, page, {normal_sql('section')} sec from list_items where section is not null)
select item_id, max(page_no) as found_page from i join p on p.doc_id = i.doc_id and p.page_no between i.page - 5 and i.page and contains(p.norm, i.sec) where i.sec <> '' group by item_id""")
def _(s: SparkSession, d: str) -> DataFrame:
    pages = table(s, d, "pages").select(*PAGE, text.normalize(F.coalesce("canonical_text", "full_text")).alias("norm"))
    items = table(s, d, "list_items").where("section is not null").select("item_id", "doc_id", "page", text.normalize(F.col("section")).alias("section")).where("section <> ''")
    return packing.asof_page(items, pages, 6)


@query("asof_section_fuzzy")
def _(s: SparkSession, d: str) -> DataFrame:
    """asof_section by partial ratio within the item's window of pages."""
    rows = table(s, d, "pages")
    line = F.format_string("[%d] %s: %s", "region_id", "region_type", F.coalesce("text_canonical", "text", F.lit("None")))
    regions = table(s, d, "regions").where("engine = 'a'").select(*PAGE, "order_idx", "region_id", text.estimate_tokens(line).alias("size"))
    windows = packing.enumeration_windows(rows, regions, conf(s).window_tokens)
    pages = rows.select(*PAGE, text.normalize(F.coalesce("canonical_text", "full_text")).alias("norm"))
    items = table(s, d, "list_items").where("section is not null").select("item_id", "doc_id", "page", text.normalize(F.col("section")).alias("section")).where("section <> ''")
    return packing.near_section(items, pages, windows, conf(s).anchor_min)


# inventories

_ANCHOR = f"""p as (select doc_id, page_no, {normal_sql('coalesce(canonical_text, full_text)')} norm from pages), v as (select i.item_id, count(r.region_id) n_valid from (select item_id, doc_id, page, unnest(region_ids) region_id from list_items) i join regions r on r.engine = 'a' and r.region_id = i.region_id and r.doc_id = i.doc_id and r.page_no = i.page group by 1),
a as (select i.item_id, i.doc_id, i.page, {normal_sql('i.anchor')} anchor from list_items i where i.anchor is not null), c as (select a.*, coalesce(v.n_valid, 0) n_valid from a join p on p.doc_id = a.doc_id and p.page_no = a.page left join v on v.item_id = a.item_id where a.anchor <> '' and contains(p.norm, a.anchor))"""


def _checked(s: SparkSession, d: str, near: bool = False) -> DataFrame:
    """Items whose anchor their page contains; with near, also those whose partial ratio with it is at least 90."""
    items = table(s, d, "list_items")
    pages = table(s, d, "pages").select("doc_id", F.col("page_no").alias("page"), text.normalize(F.coalesce("canonical_text", "full_text")).alias("norm"))
    real = table(s, d, "regions").where("engine = 'a'").select("region_id", "doc_id", F.col("page_no").alias("page"))
    valid = items.select("item_id", "doc_id", "page", F.explode("region_ids").alias("region_id")).join(real, ["region_id", "doc_id", "page"]).groupBy("item_id").agg(F.count("*").alias("n_valid"))
    rows = items.where("anchor is not null").select("item_id", "doc_id", "page", text.normalize(F.col("anchor")).alias("anchor")).where("anchor <> ''")
    rows = gates.anchored(rows, pages, conf(s).anchor_min) if near else rows.join(pages, ["doc_id", "page"]).where(F.contains("norm", "anchor")).drop("norm")
    return rows.join(valid, "item_id", "left").na.fill(0, ["n_valid"])


@query("anchor_check", f"with {_ANCHOR} select item_id, n_valid from c")
def _(s: SparkSession, d: str) -> DataFrame:
    return _checked(s, d).select("item_id", "n_valid")


@query("inventory_build", f"with {_ANCHOR}, k as (select doc_id, page, anchor, min(item_id) item_id, count(*) as times from c group by all) select item_id, times, row_number() over (partition by doc_id order by item_id) - 1 as idx from k")
def _(s: SparkSession, d: str) -> DataFrame:
    """Checked items, one for each anchor of a page, numbered within the file."""
    return _inventory(_checked(s, d))


@query("anchor_check_fuzzy")
def _(s: SparkSession, d: str) -> DataFrame:
    return _checked(s, d, near=True).select("item_id", "n_valid")


@query("inventory_build_fuzzy")
def _(s: SparkSession, d: str) -> DataFrame:
    return _inventory(_checked(s, d, near=True))


def _inventory(checked: DataFrame) -> DataFrame:
    from quire.storage import shared_table

    once = checked.groupBy("doc_id", "page", "anchor").agg(F.min("item_id").alias("item_id"), F.count("*").alias("times"))
    return rank_within(shared_table(once.select("doc_id", "item_id", "times"), "inventory"), ["doc_id"], ["item_id"], "idx").select("item_id", "times", "idx")


@query("prefix_join", f"""with g as (select item_id gid, doc_id, page, {normal_sql('anchor')} a from gold_traits), i as (select item_id, doc_id, page, {normal_sql('anchor')} b from list_items)
select gid as gold_id, min(item_id) as item_id from g join i on g.doc_id = i.doc_id and g.page = i.page and (starts_with(a, b) or starts_with(b, a)) group by gid""")
def _(s: SparkSession, d: str) -> DataFrame:
    g = table(s, d, "gold_traits").select(F.col("item_id").alias("gold_id"), "doc_id", "page", text.normalize(F.col("anchor")).alias("a"))
    i = table(s, d, "list_items").select("item_id", "doc_id", "page", text.normalize(F.col("anchor")).alias("b"))
    return g.join(i, ["doc_id", "page"]).where(F.startswith("a", "b") | F.startswith("b", "a")).groupBy("gold_id").agg(F.min("item_id").alias("item_id"))


_DEDUP = f"""i as (select item_id, doc_id, page, {normal_sql('anchor')} as a, list_sort(coalesce(region_ids, [])) as ids, row_number() over (partition by doc_id, page order by item_id) rn from list_items),
w as (select doc_id, page, rn, item_id, true as keep, [{{'a': a, 'ids': ids}}] as kept from i where rn = 1
  union all select i.doc_id, i.page, i.rn, i.item_id, x.clash = 0, case when x.clash = 0 then list_append(w.kept, {{'a': i.a, 'ids': i.ids}}) else w.kept end
  from w join i on i.doc_id = w.doc_id and i.page = w.page and i.rn = w.rn + 1, lateral (select len(list_filter(w.kept, lambda k: (starts_with(k.a, i.a) or starts_with(i.a, k.a)) and (k.ids = i.ids or len(k.ids) = 0 or len(i.ids) = 0))) as clash) x)"""


@query("prefix_dedup", f"with recursive {_DEDUP} select item_id from w where keep")
def _(s: SparkSession, d: str) -> DataFrame:
    items = table(s, d, "list_items").withColumn("anchor", text.normalize(F.col("anchor")))
    return packing.prefix_duplicates(items)


@query("inventory_coverage", f"""with recursive {_DEDUP}, k as (select l.doc_id, count(*) as found from w join list_items l on l.item_id = w.item_id where w.keep and l.schema_name = 'race_traits' group by l.doc_id), e as (select doc_id, count(distinct def_id) as expected from race_traits where doc_id is not null group by doc_id)
select coalesce(k.doc_id, e.doc_id) as doc_id, coalesce(found, 0) as found, coalesce(expected, 0) as expected, case when coalesce(found, 0) = coalesce(expected, 0) then 'enumerated' else 'needs_review' end as status from k full join e on k.doc_id = e.doc_id""")
def _(s: SparkSession, d: str) -> DataFrame:
    """The items found in each file against an independent count, that of its definitions; files where they differ need review."""
    items = table(s, d, "list_items")
    kept = Q["prefix_dedup"](s, d).join(items.where("schema_name = 'race_traits'").select("item_id", "doc_id"), "item_id")
    found = kept.groupBy("doc_id").agg(F.count("*").alias("found"))
    expected = table(s, d, "race_traits").where("doc_id is not null").groupBy("doc_id").agg(F.countDistinct("def_id").alias("expected"))
    both = found.join(expected, "doc_id", "full_outer").na.fill(0, ["found", "expected"])
    return both.withColumn("status", F.when(F.col("found") == F.col("expected"), "enumerated").otherwise("needs_review"))


@query("region_ids_elsewhere", """select i.item_id, count(*) as n from (select item_id, doc_id, page, unnest(region_ids) region_id from list_items) i left join regions r on r.region_id = i.region_id and r.engine = 'a' where r.region_id is null or r.doc_id <> i.doc_id or r.page_no <> i.page group by i.item_id""")
def _(s: SparkSession, d: str) -> DataFrame:
    ids = table(s, d, "list_items").select("item_id", "doc_id", "page", F.explode("region_ids").alias("region_id"))
    real = table(s, d, "regions").where("engine = 'a'").select("region_id", "doc_id", F.col("page_no").alias("page"))
    return ids.join(real, ["region_id", "doc_id", "page"], "left_anti").groupBy("item_id").agg(F.count("*").alias("n"))


# nesting


@query("flatten_json", """with j as (select ext_id, cast(value_json as json) v from extractions where json_valid(value_json) and json_type(value_json) = 'OBJECT'), l as (select j.ext_id, t.fullkey k, t.value leaf from j, lateral json_tree(j.v) t where t.type = 'OBJECT'),
x as (select *, json_keys(leaf) keys from l)
select ext_id, case when k = '$' then '<root>' else substr(k, 3) end as field, leaf->>'quote' as quote, (leaf->>'page')::int as page from x a where (list_contains(keys, 'value') or list_contains(keys, 'quote')) and (coalesce(json_type(leaf, '$.value'), 'NULL') <> 'NULL' or coalesce(json_type(leaf, '$.quote'), 'NULL') = 'NULL')
  and not exists (select 1 from x b where b.ext_id = a.ext_id and b.k <> a.k and (b.k = '$' or starts_with(a.k, b.k || '.') or starts_with(a.k, b.k || '[')) and (list_contains(b.keys, 'value') or list_contains(b.keys, 'quote')))""")
def _(s: SparkSession, d: str) -> DataFrame:
    """The leaves (objects with value or quote) of objects at any depth, one row each, by their paths."""
    found = nested_tables.tagged_rows(table(s, d, "extractions"), "ext_id", "value_json", nested_tables.visit_leaves)
    leaves = nested_tables.typed(found, "leaf", nested_tables.LEAF)
    return leaves.select(F.col("row_id").alias("ext_id"), F.col("pk").alias("field"), "quote", "page")


@query("nest_paths")
def _(s: SparkSession, d: str) -> DataFrame:
    """Validated rows of any path back to one JSON object for each top-level field or list entry of a file."""
    rows = table(s, d, "extractions").where("status = 'validated'").select(*KEY, *ORDER, "value_json", "quote", "page_no", "confidence")
    latest = versions.latest(rows, KEY, ORDER)
    value = F.when(F.try_parse_json("value_json").isNotNull(), F.col("value_json")).otherwise("null")
    rest = F.to_json(F.struct("quote", F.col("page_no").alias("page"), F.coalesce("confidence", F.lit("high")).alias("confidence")), {"ignoreNullFields": "false"})
    leaf = F.concat(F.lit('{"value":'), value, F.lit(","), F.substring(rest, 2, 1 << 30))
    return nested_tables.nested_rows(latest.select(*KEY, leaf.alias("leaf")), ["doc_id"], "field_path", "leaf")


@query("declared_absence", """select doc_id, count(*) filter (where quote is null) as declared, count(*) filter (where quote is not null) as broken from extractions where value_json is null or value_json = 'null' group by doc_id""")
def _(s: SparkSession, d: str) -> DataFrame:
    """Rows without a value: with no quote either the absence is declared, with a quote the row is void."""
    empty = table(s, d, "extractions").where("value_json is null or value_json = 'null'")
    return empty.groupBy("doc_id").agg(F.count_if(F.col("quote").isNull()).alias("declared"), F.count("quote").alias("broken"))


LEAVES = ("effects", "featureName", "grantedAtLevel", "notes", "raceName")
_LATEST = "l as (select * from (select *, row_number() over (partition by doc_id, field_path order by attempt desc nulls last, loaded_at desc nulls last, ext_id desc) rn from extractions where status = 'validated') where rn = 1)"
_PATH = r"regexp_extract(field_path, '^(traits\[[0-9]+\])\.([A-Za-z]+)$', {})"


def _latest_leaves(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "extractions").where("status = 'validated'").select(*KEY, *ORDER, "value_json", "confidence")
    latest = versions.latest(rows, KEY, ORDER)
    part = lambda i: F.regexp_extract("field_path", r"^(traits\[[0-9]+\])\.([A-Za-z]+)$", i)
    return latest.select("doc_id", part(1).alias("item"), part(2).alias("leaf"), "value_json").where("item <> ''")


@query("nest_document", f"""with {_LATEST}, x as (select doc_id, {_PATH.format(1)} item, {_PATH.format(2)} leaf, value_json from l)
select doc_id, item, {', '.join(f"max(case when leaf = '{c}' then value_json end) as {c}" for c in LEAVES)} from x where item <> '' group by doc_id, item""")
def _(s: SparkSession, d: str) -> DataFrame:
    """Rows by path back to one nested record for each item."""
    return _latest_leaves(s, d).groupBy("doc_id", "item").agg(*[F.max(F.when(F.col("leaf") == c, F.col("value_json"))).alias(c) for c in LEAVES])


_WANT = "unnest(['effects', 'featureName', 'grantedAtLevel', 'notes', 'raceName'])"


@query("fill_missing", f"""with {_LATEST}, x as (select doc_id, {_PATH.format(1)} item, {_PATH.format(2)} leaf, value_json from l), e as (select doc_id, item, {_WANT} leaf from (select distinct doc_id, item from x where item <> ''))
select e.doc_id, e.item, e.leaf, x.value_json, case when x.item is null then 'low' else 'kept' end as state from e left join x on e.doc_id = x.doc_id and e.item = x.item and e.leaf = x.leaf""")
def _(s: SparkSession, d: str) -> DataFrame:
    """Every leaf of every item, absent ones as null with low confidence."""
    have = _latest_leaves(s, d)
    want = have.select("doc_id", "item").distinct().withColumn("leaf", F.explode(F.array(*map(F.lit, LEAVES))))
    return want.join(have.withColumn("state", F.lit("kept")), ["doc_id", "item", "leaf"], "left").na.fill("low", ["state"])


@query("coverage_anti_join", rf"""with x as (select distinct doc_id, {_PATH.format(1)} item, {_PATH.format(2)} leaf from extractions where field_path not like '%$%'), e as (select doc_id, item, {_WANT} leaf from (select distinct doc_id, item from x where item <> ''))
select e.doc_id, e.item || '.' || e.leaf as field_path from e anti join x on e.doc_id = x.doc_id and e.item = x.item and e.leaf = x.leaf""")
def _(s: SparkSession, d: str) -> DataFrame:
    """Expected leaf paths that no row was ever produced for."""
    rows = table(s, d, "extractions").where(~F.col("field_path").contains("$")).select("doc_id", "field_path")
    items = rows.select("doc_id", F.regexp_extract("field_path", r"^(traits\[[0-9]+\])\.[A-Za-z]+$", 1).alias("item")).where("item <> ''").distinct()
    leaves = items.withColumn("leaf", F.explode(F.array(*map(F.lit, LEAVES))))
    want = leaves.select("doc_id", F.concat_ws(".", "item", "leaf").alias("field_path"))
    return versions.remaining(want, rows, ["doc_id", "field_path"])


@query("task_missing_fields", rf"""with x as (select distinct doc_id, {_PATH.format(1)} item, {_PATH.format(2)} leaf from extractions), g as (select doc_id, item, list(leaf) have from x where item <> '' group by all), m as (select doc_id, item, list_filter(['effects', 'featureName', 'grantedAtLevel', 'raceName'], lambda f: not list_contains(have, f)) miss from g)
select doc_id, item, array_to_string(miss, ',') as missing, case when len(miss) = 0 then 'ok' else 'failed' end as status from m""")
def _(s: SparkSession, d: str) -> DataFrame:
    """Required fields each item's task did not give, and where the task goes."""
    part = lambda i: F.regexp_extract("field_path", r"^(traits\[[0-9]+\])\.([A-Za-z]+)$", i)
    rows = table(s, d, "extractions").select("doc_id", part(1).alias("item"), part(2).alias("leaf")).where("item <> ''")
    have = rows.groupBy("doc_id", "item").agg(F.collect_set("leaf").alias("have"))
    missing = F.array_except(F.array(*map(F.lit, ("effects", "featureName", "grantedAtLevel", "raceName"))), F.col("have"))
    return have.select("doc_id", "item", F.array_join(missing, ",").alias("missing"), F.when(F.size(missing) == 0, "ok").otherwise("failed").alias("status"))


@query("json_path_get", "select trait_id, json_extract_string(record_json, '$.effects[0].kind') as kind, json_extract_string(record_json, '$.activeState.id') as state from race_traits")
def _(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "race_traits").select("trait_id", F.get_json_object("record_json", "$.effects[0].kind").alias("kind"), F.get_json_object("record_json", "$.activeState.id").alias("state"))


@query("flatten_gold", """select item_id, 'raceName' as field, raceName.value as value from gold_traits union all select item_id, 'featureName', featureName.value from gold_traits union all select item_id, 'grantedAtLevel', grantedAtLevel.value::varchar from gold_traits union all select item_id, 'effects', effects.value from gold_traits""")
def _(s: SparkSession, d: str) -> DataFrame:
    cell = lambda c: F.struct(F.lit(c).alias("field"), F.col(f"{c}.value").cast("string").alias("value"))
    return table(s, d, "gold_traits").select("item_id", F.explode(F.array(*map(cell, ("raceName", "featureName", "grantedAtLevel", "effects")))).alias("x")).select("item_id", "x.*")


_GOLD_PATHS = f"""inv as (select doc_id, page, {normal_sql('anchor')} a, row_number() over (partition by doc_id order by item_id) - 1 as idx from list_items where schema_name = 'race_traits'),
gi as (select g.item_id, g.doc_id, g.anchor, min(inv.idx) as idx from gold_traits g left join inv on inv.doc_id = g.doc_id and inv.page = g.page and (starts_with(inv.a, {normal_sql('g.anchor')}) or starts_with({normal_sql('g.anchor')}, inv.a)) group by all),
gv as (select item_id, unnest(['raceName', 'featureName', 'grantedAtLevel', 'effects']) as field, unnest([raceName.value, featureName.value, grantedAtLevel.value::varchar, effects.value]) as value from gold_traits),
gp as (select gi.doc_id, gv.field, 'traits[' || coalesce(gi.idx::varchar, 'missing:' || coalesce(gi.anchor, '')) || '].' || gv.field as field_path, gv.value from gi join gv on gi.item_id = gv.item_id where gv.value is distinct from 'DA COMPILARE')"""


def _gold_paths(s: SparkSession, d: str) -> DataFrame:
    """doc_id, field, field_path, value: gold values by the paths of this run. An item's place is that of the first inventory item of
    its page whose anchor begins with its own or the other way round; without one its path is one that no run produces."""
    from quire.storage import shared_table

    inv = table(s, d, "list_items").where("schema_name = 'race_traits'").select("doc_id", "page", "item_id", text.normalize(F.col("anchor")).alias("a"))
    inv = rank_within(shared_table(inv, "inventory"), ["doc_id"], ["item_id"], "idx").drop("item_id")
    gold = table(s, d, "gold_traits").select("item_id", "doc_id", "page", "anchor", text.normalize(F.col("anchor")).alias("g"))
    place = gold.join(inv, ["doc_id", "page"]).where(F.startswith("a", "g") | F.startswith("g", "a")).groupBy("item_id").agg(F.min("idx").alias("idx"))
    own = gold.join(place, "item_id", "left").select("item_id", "doc_id", F.coalesce(F.col("idx").cast("string"), F.concat(F.lit("missing:"), F.coalesce("anchor", F.lit("")))).alias("at"))
    cell = lambda c: F.struct(F.lit(c).alias("field"), F.col(f"{c}.value").cast("string").alias("value"))
    values = table(s, d, "gold_traits").select("item_id", F.explode(F.array(*map(cell, ("raceName", "featureName", "grantedAtLevel", "effects")))).alias("x")).select("item_id", "x.*")
    values = values.where(~F.col("value").eqNullSafe(F.lit("DA COMPILARE")))
    return own.join(values, "item_id").select("doc_id", "field", F.concat(F.lit("traits["), "at", F.lit("]."), "field").alias("field_path"), "value")


@query("gold_paths", f"with {_GOLD_PATHS} select doc_id, field_path, value from gp")
def _(s: SparkSession, d: str) -> DataFrame:
    return _gold_paths(s, d).drop("field")


@query("strip_defaults", """with e as (select trait_id, unnest(effects) x, generate_subscripts(effects, 1) - 1 as pos from race_traits) select trait_id, pos::int as pos, x.kind as kind, nullif(x.condition, 'always') as condition from e""")
def _(s: SparkSession, d: str) -> DataFrame:
    """Effects without properties that stand at their default."""
    bare = F.transform("effects", lambda e: e.withField("condition", F.nullif(e["condition"], F.lit("always"))))
    return table(s, d, "race_traits").select("trait_id", F.posexplode(bare).alias("pos", "e")).select("trait_id", "pos", "e.kind", "e.condition")


# gates


@query("quote_iff_value", "select ext_id, (value_json is null or value_json = 'null') = (quote is null) as ok from extractions")
def _(s: SparkSession, d: str) -> DataFrame:
    empty = F.col("value_json").isNull() | (F.col("value_json") == "null")
    return table(s, d, "extractions").select("ext_id", (empty == F.col("quote").isNull()).alias("ok"))


_SCALAR = "value_json is not null and not regexp_matches(value_json, '^\\s*[\\[{]') and json_valid(value_json)"


@query("value_quote_gate", rf"""with e as (select ext_id, quote, value_json, json_type(value_json) jt, json_extract_string(value_json, '$') v from extractions where {_SCALAR}),
m as (select ext_id, replace(unnest(regexp_extract_all(translate(quote, '−–—', '---'), '[-+]?\s*[0-9][0-9.,]*')), ' ', '') t from e), n as (select ext_id, {_VALUE} x from m)
select e.ext_id, case when e.quote is null then false when jt = 'VARCHAR' then {normal_sql('v')} <> '' and contains({normal_sql('e.quote')}, {normal_sql('v')}) else coalesce((select bool_or(abs(n.x - try_cast(e.v as double)) < 1e-6) from n where n.ext_id = e.ext_id), false) end as ok from e""")
def _(s: SparkSession, d: str) -> DataFrame:
    """Scalar values against their quotes."""
    rows = table(s, d, "extractions").where("value_json is not null").where(~F.col("value_json").rlike(r"^\s*[\[{]") & F.try_parse_json("value_json").isNotNull())
    return rows.select("ext_id", gates.value_in_quote(F.col("value_json"), F.col("quote")).alias("ok"))


@query("value_quote_nested", rf"""with e as (select ext_id, quote, value_json v from extractions where regexp_matches(value_json, '^\s*[\[{{]') and json_valid(value_json)),
m as (select ext_id, replace(unnest(regexp_extract_all(translate(quote, '−–—', '---'), '[-+]?\s*[0-9][0-9.,]*')), ' ', '') t from e), n as (select ext_id, {_VALUE} x from m),
w as (select e.ext_id, j.fullkey k, j.atom::varchar::double a, j.key = 'amount' and json_extract_string(e.v, j.path || '.kind') = 'speed_bonus' as derived from e, lateral json_tree(e.v::json) j where j.type in ('UBIGINT', 'BIGINT', 'DOUBLE', 'HUGEINT')),
k as (select w.ext_id, w.k, coalesce(bool_or(abs(n.x - w.a) < 1e-6 or (w.derived and abs(n.x - w.a - 30) < 1e-6)), false) as said from w left join n on n.ext_id = w.ext_id group by all)
select e.ext_id, e.quote is not null and coalesce((select bool_and(k.said) from k where k.ext_id = e.ext_id), true) as ok from e""")
def _(s: SparkSession, d: str) -> DataFrame:
    """Arrays and objects against their quotes, by their numbers."""
    rows = table(s, d, "extractions").where(F.col("value_json").rlike(r"^\s*[\[{]") & F.try_parse_json("value_json").isNotNull())
    return rows.select("ext_id", gates.value_in_quote(F.col("value_json"), F.col("quote")).alias("ok"))


@query("schema_gate", """select trait_id, array_to_string(list_filter([case when raceName is null then 'raceName' end, case when featureName is null then 'featureName' end, case when grantedAtLevel is null or grantedAtLevel < 1 then 'grantedAtLevel' end, case when coalesce(len(effects), 0) = 0 then 'effects' end, case when coalesce(len(sources), 0) = 0 then 'sources' end], lambda x: x is not null), ',') as errors from race_traits""")
def _(s: SparkSession, d: str) -> DataFrame:
    bad = [F.when(F.col(c).isNull(), c) for c in ("raceName", "featureName")] + [F.when(F.col("grantedAtLevel").isNull() | (F.col("grantedAtLevel") < 1), "grantedAtLevel")]
    bad += [F.when(F.coalesce(F.size(c), F.lit(-1)) <= 0, c) for c in ("effects", "sources")]
    return table(s, d, "race_traits").select("trait_id", F.array_join(F.array_compact(F.array(*bad)), ",").alias("errors"))


@query("cross_field_rule", """with a as (select distinct doc_id from extractions where field_path = 'amount_eur' and try_cast(value_json as double) > 0), p as (select distinct doc_id from extractions where field_path like 'parties[%'  and value_json is not null)
select a.doc_id, p.doc_id is not null as ok from a left join p on a.doc_id = p.doc_id""")
def _(s: SparkSession, d: str) -> DataFrame:
    """A contract with an amount needs a party."""
    e = table(s, d, "extractions")
    a = e.where("field_path = 'amount_eur' and try_cast(value_json as double) > 0").select("doc_id").distinct()
    p = e.where("field_path like 'parties[%' and value_json is not null").select("doc_id").distinct().withColumn("ok", F.lit(True))
    return a.join(p, "doc_id", "left").na.fill(False, ["ok"])


_ONE_OF = " or ".join(f"(x.kind = '{k}' and (json_extract(x.o, '$.{a}') is null or json_type(x.o, '$.{a}') = 'NULL') = (json_extract(x.o, '$.{b}') is null or json_type(x.o, '$.{b}') = 'NULL'))" for k, (a, b) in gates.ONE_OF.items())
_NOOP = ", ".join(f"'{k}'" for k in gates.NO_OP_AT_ZERO)
_TYPES = ", ".join(f"'{k}'" for k in gates.DAMAGE_TYPES)


def _taxonomy_sql(source: str, row_id: str) -> str:
    return f"""with s as ({source}), t as (select row_id, j.fullkey as path, j.value as o from s, lateral json_tree(s.v::json) j where j.type = 'OBJECT'),
g as (select *, case json_type(o, '$.damageTypes') when 'ARRAY' then (o->>'$.damageTypes[*]')::varchar[] when 'VARCHAR' then [o->>'damageTypes'] else [] end || case json_type(o, '$.damageType') when 'ARRAY' then (o->>'$.damageType[*]')::varchar[] when 'VARCHAR' then [o->>'damageType'] else [] end as types, case when json_type(o, '$.kind') = 'VARCHAR' then o->>'kind' end as kind from t),
x as (select * from g where kind is not null or len(types) > 0)
select row_id as {row_id}, path, kind, concat_ws(',', case when len(list_filter(types, lambda t: t is not null and lower(t) not in ({_TYPES}))) > 0 then 'damage_type' end,
  case when kind in ({_NOOP}) and try_cast(o->>'amount' as double) = 0 and len(list_filter(json_keys(o), lambda k: k not in ('kind', 'condition', 'amount'))) = 0 then 'no_effect' end, case when {_ONE_OF} then 'one_of' end) as errors from x"""


@query("taxonomy_rules", _taxonomy_sql("select trait_id as row_id, record_json as v from race_traits where json_valid(record_json)", "trait_id"))
def _(s: SparkSession, d: str) -> DataFrame:
    """What the loader's rules find in each effect of the definitions as delivered, options included; '' where nothing is wrong."""
    return gates.taxonomy_errors(table(s, d, "race_traits"), "trait_id", "record_json").withColumnRenamed("row_id", "trait_id")


@query("taxonomy_gate", _taxonomy_sql("select ext_id as row_id, value_json as v from extractions where json_valid(value_json)", "ext_id"))
def _(s: SparkSession, d: str) -> DataFrame:
    """The same for extracted values."""
    return gates.taxonomy_errors(table(s, d, "extractions"), "ext_id", "value_json").withColumnRenamed("row_id", "ext_id")


# fixed values: the fields whose values are definitions of the taxonomy, and the properties that an envelope's definition needs
DEFINED = {"effects": "featureEffect"}
ENVELOPE = ("id", "raceName", "featureName", "grantedAtLevel", "sources", "effects")


@query("field_definition", r"""select ext_id, case when regexp_extract(field_path, '([A-Za-z_]+)(\[[0-9]+\])?$', 1) = 'effects' then 'featureEffect' end as definition from extractions where field_path not like '%$%'""")
def _(s: SparkSession, d: str) -> DataFrame:
    """The definition of the taxonomy that a field is bound to, by the last name of its path."""
    name = F.regexp_extract("field_path", r"([A-Za-z_]+)(\[[0-9]+\])?$", 1)
    definition = F.try_element_at(F.create_map(*[F.lit(x) for kv in DEFINED.items() for x in kv]), name)
    return table(s, d, "extractions").where(~F.col("field_path").contains("$")).select("ext_id", definition.alias("definition"))


@query("envelope_errors", f"""select trait_id, array_to_string(list_filter([{', '.join(f"case when coalesce(json_type(record_json, '$.{c}'), 'NULL') = 'NULL' then '{c}' end" for c in ENVELOPE)}, case when try_cast(record_json->>'$.grantedAtLevel' as int) not between 1 and 20 then 'grantedAtLevel: range' end], lambda x: x is not null), ',') as errors from race_traits where json_valid(record_json)""")
def _(s: SparkSession, d: str) -> DataFrame:
    """Required properties that a definition as delivered lacks, and levels outside 1 to 20."""
    v = lambda c: F.get_json_object("record_json", f"$.{c}")
    bad = [F.when(v(c).isNull(), c) for c in ENVELOPE] + [F.when(~v("grantedAtLevel").try_cast("int").between(1, 20), "grantedAtLevel: range")]
    return table(s, d, "race_traits").where(F.try_parse_json("record_json").isNotNull()).select("trait_id", F.array_join(F.array_compact(F.array(*bad)), ",").alias("errors"))


_LIST = r"regexp_extract(field_path, '^(traits|parties)\[([0-9]+)\]', 2)"


@query("retry_pages", f"""with i as (select doc_id, page, section_page, row_number() over (partition by doc_id, schema_name order by item_id) - 1 as idx, schema_name from list_items),
e as (select ext_id, doc_id, schema_name, page_no, try_cast({_LIST} as bigint) as idx from extractions where field_path not like '%$%'), f as (select doc_id, list(page_no) as pages from pages group by doc_id having count(*) <= 3),
x as (select e.ext_id, e.doc_id, list_sort(list_distinct(list_filter([e.page_no, i.page, i.section_page], lambda x: x is not null))) as pages from e left join i on i.doc_id = e.doc_id and i.schema_name = e.schema_name and i.idx = e.idx)
select ext_id, array_to_string(case when len(x.pages) > 0 then x.pages else coalesce(list_sort(f.pages), []) end, ',') as pages from x left join f on f.doc_id = x.doc_id""")
def _(s: SparkSession, d: str) -> DataFrame:
    """The pages to read again for a field: its own, its item's and that of the item's section; where none is known, all pages of a
    file of at most three."""
    from quire.storage import shared_table

    items = table(s, d, "list_items").select("doc_id", "schema_name", "item_id", "page", "section_page")
    items = rank_within(shared_table(items, "items"), ["doc_id", "schema_name"], ["item_id"], "idx").drop("item_id")
    idx = F.regexp_extract("field_path", r"^(traits|parties)\[([0-9]+)\]", 2).try_cast("long")
    rows = table(s, d, "extractions").where(~F.col("field_path").contains("$")).select("ext_id", "doc_id", "schema_name", "page_no", idx.alias("idx"))
    small = table(s, d, "pages").groupBy("doc_id").agg(F.array_sort(F.collect_list("page_no")).alias("all"), F.count("*").alias("n")).where("n <= 3").drop("n")
    near = F.array_sort(F.array_distinct(F.array_compact(F.array("page_no", "page", "section_page"))))
    both = rows.join(items, ["doc_id", "schema_name", "idx"], "left").join(small, "doc_id", "left")
    pages = F.when(F.size(near) > 0, near).otherwise(F.coalesce("all", F.array().cast("array<int>")))
    return both.select("ext_id", F.array_join(pages.cast("array<string>"), ",").alias("pages"))


@query("validation_summary", "with l as (select * from (select *, row_number() over (partition by doc_id, field_path order by attempt desc nulls last, loaded_at desc nulls last, ext_id desc) rn from extractions) where rn = 1) select schema_name, status, count(*) as n, count(distinct doc_id) as files from l group by all")
def _(s: SparkSession, d: str) -> DataFrame:
    latest = versions.latest(table(s, d, "extractions").select(*KEY, *ORDER, "schema_name", "status"), KEY, ORDER)
    return latest.groupBy("schema_name", "status").agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("files"))


def _grounded(s: SparkSession, d: str) -> DataFrame:
    pages = table(s, d, "pages").select(*PAGE, F.coalesce("canonical_text", "full_text", F.lit("")).alias("page"))
    rows = table(s, d, "extractions").select("ext_id", *PAGE, "quote", "value_json")
    return gates.grounded(gates.by_page(rows), pages, PAGE, conf(s).grounding_min)


@query("grounding_gate")
def _(s: SparkSession, d: str) -> DataFrame:
    return _grounded(s, d).where("quote is not null").select("ext_id", "ok")


@query("gate_cascade")
def _(s: SparkSession, d: str) -> DataFrame:
    """Outcome of the gates in order: absence, grounding (retry), value against quote (rejected), validated."""
    rows = _grounded(s, d)
    empty = F.col("value_json").isNull() | (F.col("value_json") == "null")
    fits = gates.value_in_quote(F.col("value_json"), F.col("quote"))
    return rows.select("ext_id", F.when(empty & F.col("quote").isNull(), "validated").when(~F.col("ok"), "retry").when(~fits, "rejected").otherwise("validated").alias("outcome"))


@query("localize_quote")
def _(s: SparkSession, d: str) -> DataFrame:
    quotes = table(s, d, "extractions").where("quote is not null and quote <> ''").select(F.col("ext_id").alias("id"), *PAGE, text.normalize(F.col("quote")).alias("q")).where("q <> ''")
    regions = table(s, d, "regions").where("engine = 'a'").select(*PAGE, "region_id", "order_idx", "bbox", text.normalize(F.coalesce("text_canonical", "text")).alias("r")).where("r <> ''")
    return gates.located(quotes, regions, conf(s).localise_min)


_BOX = "case when len(cast({0} as json)::double[]) = 4 then cast({0} as json)::double[] end"


@query("invalidate_dependents", f"""with c as (select r.doc_id, r.page_no, {_BOX.format('r.bbox')} b from region_conflicts k join regions r on k.region_id = r.region_id), e as (select ext_id, doc_id, page_no, {_BOX.format('bbox')} b from extractions where bbox is not null)
select distinct ext_id from e join c on e.doc_id = c.doc_id and e.page_no = c.page_no where greatest(0, least(e.b[3], c.b[3]) - greatest(e.b[1], c.b[1])) * greatest(0, least(e.b[4], c.b[4]) - greatest(e.b[2], c.b[2])) > 0
  and greatest(e.b[3] - e.b[1], 0) * greatest(e.b[4] - e.b[2], 0) + greatest(c.b[3] - c.b[1], 0) * greatest(c.b[4] - c.b[2], 0) > greatest(0, least(e.b[3], c.b[3]) - greatest(e.b[1], c.b[1])) * greatest(0, least(e.b[4], c.b[4]) - greatest(e.b[2], c.b[2]))""")
def _(s: SparkSession, d: str) -> DataFrame:
    """Extractions whose box overlaps a region in conflict."""
    changed = table(s, d, "region_conflicts").select("region_id").join(table(s, d, "regions").select("region_id", *PAGE, boxes.box(F.col("bbox")).alias("box")), "region_id").where("box is not null").drop("region_id")
    e = table(s, d, "extractions").select("ext_id", *PAGE, boxes.box(F.col("bbox")).alias("box")).where("box is not null")
    return gates.dependents(changed, e)


@query("invalidate_by_quote")
def _(s: SparkSession, d: str) -> DataFrame:
    """Extractions whose quote stands in a region in conflict."""
    changed = table(s, d, "region_conflicts").select("region_id").join(table(s, d, "regions").select("region_id", *PAGE, text.normalize(F.col("text")).alias("r")), "region_id").drop("region_id")
    e = table(s, d, "extractions").where("quote is not null").select("ext_id", *PAGE, text.normalize(F.col("quote")).alias("q")).where("q <> ''")
    return gates.dependents_by_quote(changed, e, conf(s).grounding_min)


@query("retry_rounds", f"""with p as (select doc_id, page_no, {normal_sql('coalesce(canonical_text, full_text)')} p from pages), e as (select ext_id, doc_id, page_no, {normal_sql('quote')} q from extractions where quote is not null),
j as (select e.ext_id, q, p, length(q) n from e join p on e.doc_id = p.doc_id and e.page_no = p.page_no where q <> ''), k as (select *, left(q, n // 2) q2 from j), l as (select *, left(q2, length(q2) // 2) q3 from k)
select ext_id, case when contains(p, q) then 1 when contains(p, q2) then 2 else 3 end as attempt, case when contains(p, q) or contains(p, q2) or contains(p, q3) then 'validated' else 'needs_review' end as state from l""")
def _(s: SparkSession, d: str) -> DataFrame:
    """Quotes asked again until they stand on their page; the stub for the extractor answers with the first half."""
    pages = table(s, d, "pages").select(*PAGE, text.normalize(F.coalesce("canonical_text", "full_text")).alias("p"))
    rows = table(s, d, "extractions").where("quote is not null").select("ext_id", *PAGE, text.normalize(F.col("quote")).alias("q")).where("q <> ''").join(pages, PAGE)
    half = lambda df: df.withColumn("q", F.left("q", F.floor(F.length("q") / 2).cast("int")))
    return gates.retried(rows.drop(*PAGE), lambda df: F.contains("p", "q"), half, conf(s).max_retries + 1).select("ext_id", "attempt", "state")


# review, export, evaluation


@query("review_order", """with l as (select * from (select *, row_number() over (partition by doc_id, field_path order by attempt desc nulls last, loaded_at desc nulls last, ext_id desc) rn from extractions where field_path not like '%$%') where rn = 1 and status in ('needs_review', 'rejected')),
q as (select doc_id, field_path as what, case when confidence = 'low' then 0 when attempt > 1 then 1 when value_json is null then 2 else 3 end risk, attempt from l union all select doc_id, 'region ' || region_id, 0, 1 from region_conflicts where resolver = 'divergent_low')
select doc_id, what, risk, row_number() over (partition by doc_id order by risk, attempt, what) - 1 as pos from q""")
def _(s: SparkSession, d: str) -> DataFrame:
    """What a person should look at, riskiest first."""
    from quire.storage import shared_table

    rows = table(s, d, "extractions").where(~F.col("field_path").contains("$")).select(*KEY, *ORDER, "status", "confidence", "value_json")
    latest = versions.latest(rows, KEY, ORDER).where("status in ('needs_review', 'rejected')")
    risk = F.when(F.col("confidence") == "low", 0).when(F.col("attempt") > 1, 1).when(F.col("value_json").isNull(), 2).otherwise(3)
    fields = latest.select("doc_id", F.col("field_path").alias("what"), risk.alias("risk"), "attempt")
    conflicts = table(s, d, "region_conflicts").where("resolver = 'divergent_low'").select("doc_id", F.concat(F.lit("region "), "region_id").alias("what"), F.lit(0).alias("risk"), F.lit(1).alias("attempt"))
    queue = shared_table(fields.unionByName(conflicts), "queue")
    return rank_within(queue, ["doc_id"], ["risk", "attempt", "what"], "pos").select("doc_id", "what", "risk", "pos")


def _tokens_sql(c: str) -> str:
    return f"coalesce(array_to_string(regexp_extract_all(lower({c}), '[a-z0-9]+'), ' '), '')"


@query("seed_match_join", f"""with t as (select min(trait_id) trait_id, doc_id, {_tokens_sql('raceName')} r, {_tokens_sql('featureName')} f from race_traits group by all), g as (select item_id, doc_id, {_tokens_sql('raceName.value')} r, {_tokens_sql('featureName.value')} f from gold_traits)
select g.item_id, t.trait_id from g left join t on g.doc_id = t.doc_id and g.r = t.r and g.f = t.f""")
def _(s: SparkSession, d: str) -> DataFrame:
    words = lambda c: F.array_join(text.tokens(F.col(c)), " ")
    t = table(s, d, "race_traits").groupBy("doc_id", words("raceName").alias("r"), words("featureName").alias("f")).agg(F.min("trait_id").alias("trait_id"))
    g = table(s, d, "gold_traits").select("item_id", "doc_id", words("raceName.value").alias("r"), words("featureName.value").alias("f"))
    return g.join(t, ["doc_id", "r", "f"], "left").select("item_id", "trait_id")


@query("export_dedup", r"""with t as (select trait_id, list_concat(['race'], coalesce(regexp_extract_all(lower(raceName), '[a-z0-9]+'), []), coalesce(regexp_extract_all(lower(subraceName), '[a-z0-9]+'), []), coalesce(regexp_extract_all(lower(featureName), '[a-z0-9]+'), [])) l, coalesce(grantedAtLevel, 1) lv, sources from race_traits where len(effects) > 0),
i as (select *, array_to_string(list_filter(l, lambda x, i: i = 1 or x <> l[i - 1]), '_') id from t), f as (select id, min(trait_id) trait_id, count(*) as definitions from i group by id)
select f.id, f.trait_id, f.definitions, i.lv as level, array_to_string(list_sort(list_distinct(i.sources)), ',') as sources from f join i on i.trait_id = f.trait_id""")
def _(s: SparkSession, d: str) -> DataFrame:
    """Definitions with effects, the first of each id, sources as a sorted set."""
    rows = table(s, d, "race_traits").where("size(effects) > 0")
    own = text.slug("race", F.col("raceName"), F.col("subraceName"), F.col("featureName"))
    first = rows.groupBy(own.alias("id")).agg(F.min_by(F.struct("trait_id", "grantedAtLevel", "sources"), "trait_id").alias("t"), F.count("*").alias("definitions"))
    return first.select("id", "t.trait_id", "definitions", F.coalesce("t.grantedAtLevel", F.lit(1)).alias("level"), F.coalesce(F.array_join(F.array_sort(F.array_distinct("t.sources")), ","), F.lit("")).alias("sources"))


_EXPORT = f"""{_LATEST}, x as (select doc_id, try_cast(regexp_extract(field_path, '^traits\\[([0-9]+)\\]\\.([A-Za-z]+)$', 1) as bigint) as idx, regexp_extract(field_path, '^traits\\[([0-9]+)\\]\\.([A-Za-z]+)$', 2) as leaf, value_json from l),
v as (select doc_id, idx, max(case when leaf = 'raceName' and json_valid(value_json) then value_json::json->>'$' end) r, max(case when leaf = 'featureName' and json_valid(value_json) then value_json::json->>'$' end) f, max(case when leaf = 'effects' then value_json end) e from x where idx is not null group by doc_id, idx),
s as (select {_tokens_sql('raceName')} r, {_tokens_sql('subraceName')} b, {_tokens_sql('featureName')} f, arg_max(def_id, trait_id) as def_id from race_traits where def_id is not null group by 1, 2, 3),
t as (select v.*, coalesce(s.def_id, array_to_string(list_filter(list_concat(['race'], coalesce(regexp_extract_all(lower(v.r), '[a-z0-9]+'), []), coalesce(regexp_extract_all(lower(v.f), '[a-z0-9]+'), [])), lambda x, i: i = 1 or x <> list_concat(['race'], coalesce(regexp_extract_all(lower(v.r), '[a-z0-9]+'), []), coalesce(regexp_extract_all(lower(v.f), '[a-z0-9]+'), []))[i - 1]), '_')) as id,
  e is null or not json_valid(e) or e in ('null', '[]', '{{}}', '""', '0', 'false') as none from v left join s on s.r = {_tokens_sql('v.r')} and s.b = '' and s.f = {_tokens_sql('v.f')}),
n as (select *, row_number() over (partition by doc_id, id, none order by idx) rn from t)"""


@query("export_notes", f"with {_EXPORT} select doc_id, idx, case when not none then id end as id, case when none then 'no effect' when rn > 1 then 'duplicate' end as note from n")
def _(s: SparkSession, d: str) -> DataFrame:
    """Each validated trait of a file with the id it is exported under (that of the definition with the same names, else its slug),
    or the note that says why it is left out: no effect, or an earlier trait of the file has its id."""
    from quire.storage import shared_table

    leaves = _latest_leaves(s, d).withColumn("idx", F.regexp_extract("item", r"([0-9]+)", 1).cast("long"))
    plain = F.when(F.try_parse_json("value_json").isNotNull(), F.get_json_object(F.concat(F.lit('{"v":'), "value_json", F.lit("}")), "$.v"))
    pick = lambda c, v: F.max(F.when(F.col("leaf") == c, v))
    rows = leaves.groupBy("doc_id", "idx").agg(pick("raceName", plain).alias("race"), pick("featureName", plain).alias("feature"), pick("effects", F.col("value_json")).alias("effects"))
    words = lambda c: F.array_join(text.tokens(F.col(c)), " ")
    seed = table(s, d, "race_traits").where("def_id is not null").groupBy(words("raceName").alias("r"), words("subraceName").alias("b"), words("featureName").alias("f")).agg(F.max_by("def_id", "trait_id").alias("def_id"))
    named = rows.withColumns({"r": words("race"), "f": words("feature")}).join(seed.where("b = ''").drop("b"), ["r", "f"], "left")
    none = F.col("effects").isNull() | F.try_parse_json("effects").isNull() | F.col("effects").isin("null", "[]", "{}", '""', "0", "false")
    named = shared_table(named.select("doc_id", "idx", F.coalesce("def_id", text.slug("race", F.col("race"), F.col("feature"))).alias("id"), none.alias("none")), "named")
    ranked = rank_within(named, ["doc_id", "id", "none"], ["idx"])
    return ranked.select("doc_id", "idx", F.when(~F.col("none"), F.col("id")).alias("id"), F.when(F.col("none"), "no effect").when(F.col("rank") > 0, "duplicate").alias("note"))


def _answers(s: SparkSession, d: str) -> DataFrame:
    """run (annotator), field, item, value: each annotator's latest answers."""
    sheet = table(s, d, "worksheet").select("item_id", "annotator_id", "labelled_at", "label_id", F.col("featureName.value").alias("f"), F.col("effects.value").alias("e"))
    latest = versions.latest(sheet, ["item_id", "annotator_id"], ["labelled_at", "label_id"])
    cells = F.array(F.struct(F.lit("featureName").alias("field"), F.col("f").alias("value")), F.struct(F.lit("effects").alias("field"), F.col("e").alias("value")))
    return latest.select(F.col("annotator_id").alias("run"), F.col("item_id").alias("item"), F.explode(cells).alias("x")).select("run", "item", "x.*")


def _gold(s: SparkSession, d: str) -> DataFrame:
    cells = F.array(F.struct(F.lit("featureName").alias("field"), F.col("featureName.value").alias("value")), F.struct(F.lit("effects").alias("field"), F.col("effects.value").alias("value")))
    return table(s, d, "gold_traits").select(F.col("item_id").alias("item"), F.explode(cells).alias("x")).select("item", "x.*").where("value is null or value <> 'DA COMPILARE'")


_EVAL = """w as (select item_id, annotator_id, featureName.value f, effects.value e, row_number() over (partition by item_id, annotator_id order by labelled_at desc, label_id desc) rn from worksheet),
a as (select annotator_id run, item_id item, 'featureName' field, f as value from w where rn = 1 union all select annotator_id, item_id, 'effects', e from w where rn = 1),
g as (select item_id item, 'featureName' field, featureName.value as value from gold_traits union all select item_id, 'effects', effects.value from gold_traits),
gg as (select * from g where value is null or value <> 'DA COMPILARE')"""
_TREE = "(select string_agg(t.fullkey || ' ' || t.type || ' ' || coalesce(t.atom::varchar, ''), chr(10) order by t.fullkey) from json_tree(case when json_valid({0}) then {0} else 'null' end::json) t where not (t.fullkey like '%.condition' and t.atom::varchar = '\"always\"'))"
_P = "coalesce(case when regexp_matches({0}, '^\\s*[\\[{{]') then case when json_valid({0}) then " + _TREE + " else {0} end else lower(regexp_replace({0}, '^\\s+|\\s+$', '', 'g')) end, '')"
_CMP = f"select coalesce(p.field, gg.field) field, gg.item is not null expected, gg.item is not null and {_P.format('p.value')} = {_P.format('gg.value')} hit, p.value pv, gg.value gv from p full join gg on p.field = gg.field and p.item = gg.item"
_MET = "count(*) filter (where expected) as n, count(*) filter (where hit) as tp, count(*) filter (where not hit and pv is not null) as fp, count(*) filter (where not hit and gv is not null) as fn"
_SHARES = "case when tp + fp > 0 then round(tp / (tp + fp), 6) else 1 end::double as precision, case when tp + fn > 0 then round(tp / (tp + fn), 6) else 1 end::double as recall, case when n > 0 then round(tp / n, 6) else 0 end::double as exact"
_LAST = "p as (select field, item, arg_max(value, run) filter (where value is not null) as value from a group by all)"


def _pred(s: SparkSession, d: str) -> DataFrame:
    """The prediction of an item and field: the non-null answer of the annotator with the largest id."""
    return _answers(s, d).groupBy("field", "item").agg(F.expr("max_by(value, run) filter (where value is not null)").alias("value"))


@query("eval_metrics", f"with {_EVAL}, {_LAST}, c as ({_CMP}), m as (select field, {_MET} from c group by field) select *, {_SHARES} from m")
def _(s: SparkSession, d: str) -> DataFrame:
    return evaluate.metrics(evaluate.compared(_pred(s, d), _gold(s, d)), ["field"])


_PATH_EVAL = f"""{_GOLD_PATHS}, lx as (select * from (select *, row_number() over (partition by doc_id, field_path order by attempt desc nulls last, loaded_at desc nulls last, ext_id desc) rn from extractions) where rn = 1 and field_path not like '%$%' and status = 'validated'),
pp as (select doc_id, field_path, confidence, regexp_extract(field_path, '([A-Za-z_]+)(\\[[0-9]+\\])?$', 1) as field, case when not json_valid(value_json) then value_json when json_type(value_json) = 'VARCHAR' then value_json::json->>'$' when json_type(value_json) <> 'NULL' then value_json end as value from lx),
kk as (select coalesce(gp.field, pp.field) field, gp.doc_id is not null expected, gp.doc_id is not null and {_P.format('pp.value')} = {_P.format('gp.value')} hit, pp.value pv, gp.value gv, pp.confidence from pp full join gp on pp.doc_id = gp.doc_id and pp.field_path = gp.field_path where gp.doc_id is not null or pp.value is not null)"""


@query("eval_paths", f"with {_PATH_EVAL}, m as (select field, {_MET}, count(*) filter (where not hit and pv is not null and confidence = 'high') as silent from kk group by field) select *, {_SHARES} from m")
def _(s: SparkSession, d: str) -> DataFrame:
    """Metrics of each field: the latest validated values against the gold values of their paths; values at other paths are invented."""
    rows = versions.latest(table(s, d, "extractions").where(~F.col("field_path").contains("$")).select(*KEY, *ORDER, "status", "value_json", "confidence"), KEY, ORDER).where("status = 'validated'")
    v = F.col("value_json")
    bare = F.when(F.try_parse_json("value_json").isNull(), v).when(v.rlike(r'^\s*"'), F.get_json_object(F.concat(F.lit('{"v":'), v, F.lit("}")), "$.v")).when(F.trim(v) != "null", v)
    pred = rows.select(F.regexp_extract("field_path", r"([A-Za-z_]+)(\[[0-9]+\])?$", 1).alias("field"), "doc_id", "field_path", bare.alias("value"), "confidence")
    gold = _gold_paths(s, d).withColumnRenamed("field", "gold_field")
    return evaluate.path_metrics(pred, gold)


@query("silent_error_rate", f"with {_EVAL}, {_LAST}, c as ({_CMP}) select round(count(*) filter (where not hit and pv is not null) / count(*), 6)::double as rate from c where expected or pv is not null")
def _(s: SparkSession, d: str) -> DataFrame:
    """Wrong values among all expected and invented ones."""
    rows = evaluate.compared(_pred(s, d), _gold(s, d)).where("expected or wrong")
    return rows.agg(F.round(F.count_if(F.col("wrong")) / F.count("*"), 6).alias("rate"))


@query("eval_summary", f"with {_EVAL}, {_LAST}, c as ({_CMP}) select count(*) filter (where expected) as evaluated, count(*) filter (where hit) as exact, count(*) filter (where expected and not hit) as wrong, count(*) filter (where not expected and pv is not null) as invented from c")
def _(s: SparkSession, d: str) -> DataFrame:
    rows = evaluate.compared(_pred(s, d), _gold(s, d))
    n = lambda c: F.count_if(F.expr(c))
    return rows.agg(n("expected").alias("evaluated"), n("hit").alias("exact"), n("expected and not hit").alias("wrong"), n("not expected and wrong").alias("invented"))


@query("compare_runs", f"""with {_EVAL}, ru as (select run, lag(run) over (order by run) as before from (select distinct run from a)),
gr as (select ru.run, gg.* from gg cross join ru), c as (select coalesce(p.run, gr.run) run, coalesce(p.field, gr.field) field, gr.item is not null expected, gr.item is not null and {_P.format('p.value')} = {_P.format('gr.value')} hit, p.value pv, gr.value gv from a p full join gr on p.run = gr.run and p.field = gr.field and p.item = gr.item),
m as (select run, field, {_MET} from c group by run, field), x as (select *, {_SHARES} from m),
z as (select y.run, y.field, round(y.precision - x.precision, 6) d_precision, round(y.recall - x.recall, 6) d_recall, round(y.exact - x.exact, 6) d_exact from x y join ru on ru.run = y.run join x on x.run = ru.before and x.field = y.field)
select * from z where d_precision <> 0 or d_recall <> 0 or d_exact <> 0""")
def _(s: SparkSession, d: str) -> DataFrame:
    """Every annotator as a run, each held against the one before (by id)."""
    from quire.storage import shared_table

    found = shared_table(evaluate.metrics_of_runs(_answers(s, d), _gold(s, d)), "runs")
    ranked = rank_within(shared_table(found.select("run").distinct().withColumn("g", F.lit(0)), "run-ids"), ["g"], ["run"], "pos").drop("g")
    earlier = found.join(ranked, "run").withColumn("pos", F.col("pos") + 1).drop("run").join(ranked, "pos").drop("pos")
    later = found.join(earlier.select("run", "field"), ["run", "field"], "left_semi")
    return evaluate.run_delta(earlier, later, ["run", "field"], ["precision", "recall", "exact"])


@query("annotation_diff", f"""with {_EVAL}, o as (select *, lag(value) over w as b, lag(run) over w as prior from a window w as (partition by field, item order by run)),
j as (select field, item, run, coalesce(b, '') as a, coalesce(value, '') as b from o where prior is not null)
select * from j where a <> 'DA COMPILARE' and b <> 'DA COMPILARE' and {_P.format('a')} <> {_P.format('b')}""")
def _(s: SparkSession, d: str) -> DataFrame:
    """Every annotation of an item against that of the annotator before (by id)."""
    from quire.storage import shared_table

    ranked = rank_within(shared_table(_answers(s, d), "answers"), ["field", "item"], ["run"], "pos")
    own = ranked.where("pos > 0").select("field", "item", "pos", "run")
    earlier = ranked.select("field", "item", (F.col("pos") + 1).alias("pos"), "value").join(own, ["field", "item", "pos"])
    return evaluate.annotation_diff(earlier, ranked.where("pos > 0"), "DA COMPILARE", key=["field", "item", "run"])


@query("last_run", f"""with {_EVAL}, ru as (select annotator_id as run, max(labelled_at) as finished from worksheet where annotator_id is not null group by annotator_id having max(labelled_at) is not null), la as (select max(run) as run from ru),
gr as (select la.run, gg.* from gg cross join la), aa as (select a.* from a join la on a.run = la.run), c as (select coalesce(p.field, gr.field) field, gr.item is not null expected, gr.item is not null and {_P.format('p.value')} = {_P.format('gr.value')} hit, p.value pv, gr.value gv from aa p full join gr on p.field = gr.field and p.item = gr.item),
m as (select field, {_MET} from c group by field) select la.run, field, n, tp, fp, fn, {_SHARES} from m cross join la""")
def _(s: SparkSession, d: str) -> DataFrame:
    """The stored metrics of the last run that finished: metrics of every run are written as JSON lines and read back."""
    from quire.sources import sinks
    from quire.storage import shared_path

    path = shared_path(s, "runs")
    found = evaluate.metrics_of_runs(_answers(s, d), _gold(s, d))
    finished = table(s, d, "worksheet").where("annotator_id is not null").groupBy(F.col("annotator_id").alias("run")).agg(F.max("labelled_at").alias("finished_at"))
    sinks.write_runs(found, finished, path)
    return sinks.last_run(s, path).select("run", F.inline("metrics"))
