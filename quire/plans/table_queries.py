"""Queries on versions, resumption, reading order and reconciliation, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import boxes, fuzzy, text
from quire.operators import ordering, reconcile, states, versions
from quire.operators.skew import rank_within
from quire.plans.text_queries import normal_sql
from quire.session import Settings
from quire.sources.tables import table

Q, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        Q[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


KEY = ["doc_id", "field_path"]
ORDER = ["attempt", "loaded_at", "ext_id"]


@query("latest_attempt", "select ext_id, doc_id, field_path, attempt, status from (select *, row_number() over (partition by doc_id, field_path order by attempt desc nulls last, loaded_at desc nulls last, ext_id desc) rn from extractions) where rn = 1")
def _(s: SparkSession, d: str) -> DataFrame:
    return versions.latest(table(s, d, "extractions").select("ext_id", *KEY, "attempt", "loaded_at", "status"), KEY, ORDER).drop("loaded_at")


@query("latest_validated", "select ext_id, doc_id, field_path from (select *, row_number() over (partition by doc_id, field_path order by attempt desc nulls last, loaded_at desc nulls last, ext_id desc) rn from extractions where status = 'validated') where rn = 1")
def _(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "extractions").where("status = 'validated'")
    return versions.latest(rows.select("ext_id", *KEY, "attempt", "loaded_at"), KEY, ORDER).select("ext_id", *KEY)


@query("upsert_keep_first", """select doc_id, field_path, attempt, arg_min(ext_id, (loaded_at, ext_id)) as ext_id, arg_max(status, (loaded_at, ext_id)) as status from extractions where status is not null group by all""")
def _(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "extractions").where("status is not null").select(*KEY, "attempt", "ext_id", "loaded_at", "status")
    return versions.keep_first(rows, [*KEY, "attempt"], ["loaded_at", "ext_id"], ["status"]).drop("loaded_at")


@query("upsert_last_wins", "select doc_id, field_path, attempt, ext_id, quote from (select *, row_number() over (partition by doc_id, field_path, attempt order by loaded_at desc nulls last, ext_id desc) rn from extractions) where rn = 1")
def _(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "extractions").select(*KEY, "attempt", "ext_id", "loaded_at", "quote")
    return versions.latest(rows, [*KEY, "attempt"], ["loaded_at", "ext_id"]).drop("loaded_at")


@query("upsert_coalesce", """select doc_id, field_path, attempt, arg_max(value_json, (loaded_at, ext_id)) filter (where value_json is not null) as value_json, arg_max(quote, (loaded_at, ext_id)) filter (where quote is not null) as quote,
  arg_max(page_no, (loaded_at, ext_id)) filter (where page_no is not null) as page_no, arg_max(schema_name, (loaded_at, ext_id)) filter (where schema_name is not null) as schema_name from extractions group by doc_id, field_path, attempt""")
def _(s: SparkSession, d: str) -> DataFrame:
    return versions.coalesced(table(s, d, "extractions"), [*KEY, "attempt"], ["loaded_at", "ext_id"], ["value_json", "quote", "page_no", "schema_name"])


@query("replace_partition", """select region_id, doc_id, page_no, engine from regions r where engine in ('a', 'b') and not exists (select 1 from regions n where n.engine = 'resolver' and n.doc_id = r.doc_id and n.page_no = r.page_no and r.engine = 'b')
union all select region_id, doc_id, page_no, 'b' from regions where engine = 'resolver'""")
def _(s: SparkSession, d: str) -> DataFrame:
    """Engine b's pages replaced by the resolver's regions where it has read the page."""
    rows = table(s, d, "regions").select("region_id", "doc_id", "page_no", "engine")
    return versions.replace_partition(rows.where("engine in ('a', 'b')"), rows.where("engine = 'resolver'").withColumn("engine", F.lit("b")), ["doc_id", "page_no", "engine"])


@query("scoped_delete", "select ext_id from extractions where not (coalesce(schema_name = 'race_traits', false) and field_path not like '%$%')")
def _(s: SparkSession, d: str) -> DataFrame:
    """A schema's rows deleted, its inventories kept."""
    gone = F.coalesce(F.col("schema_name") == "race_traits", F.lit(False)) & ~versions.metadata_path(F.col("field_path"))
    return table(s, d, "extractions").where(~gone).select("ext_id")


@query("apply_correction", """with c as (select doc_id, field_path, value_json from (select *, row_number() over (partition by doc_id, field_path order by attempt desc nulls last, loaded_at desc nulls last, ext_id desc) rn from extractions) where rn = 1 and status = 'needs_review')
select e.doc_id, e.field_path, (max(e.attempt) + 1)::int as attempt, any_value(c.value_json) as value_json, 'validated' as status, 'high' as confidence from extractions e join c on e.doc_id = c.doc_id and e.field_path = c.field_path group by e.doc_id, e.field_path""")
def _(s: SparkSession, d: str) -> DataFrame:
    """The values under review confirmed as they are, each as a new version."""
    rows = table(s, d, "extractions").select(*KEY, "attempt", "loaded_at", "ext_id", "status", "value_json")
    review = versions.latest(rows, KEY, ORDER).where("status = 'needs_review'").select(*KEY, F.col("value_json").alias("new_value"))
    return versions.corrected(rows, KEY, review)


@query("ordered_extractions", "select ext_id, row_number() over (partition by doc_id order by field_path, attempt, ext_id) - 1 as pos from extractions")
def _(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "extractions").select("ext_id", "doc_id", "field_path", "attempt")
    return rank_within(rows, ["doc_id"], ["field_path", "attempt", "ext_id"], "pos").select("ext_id", "pos")


@query("last_finished_file", "select arg_max(doc_id, (created_at, doc_id)) as doc_id from doc_files where status = 'done'")
def _(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "doc_files").where("status = 'done'").agg(F.max_by("doc_id", F.struct("created_at", "doc_id")).alias("doc_id"))


@query("resume_antijoin", "select page_id from pages p where not exists (select 1 from regions r where r.engine = 'b' and r.doc_id = p.doc_id and r.page_no = p.page_no) or full_text is null")
def _(s: SparkSession, d: str) -> DataFrame:
    pages = table(s, d, "pages")
    full = pages.where("full_text is not null").select("page_id", "doc_id", "page_no")
    unread = versions.remaining(full, table(s, d, "regions").where("engine = 'b'"), ["doc_id", "page_no"])
    return unread.select("page_id").unionByName(pages.where("full_text is null").select("page_id"))


@query("failed_rows", "select doc_id, status, count(*) as n from extractions where status <> 'validated' group by all")
def _(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "extractions").where("status <> 'validated'").groupBy("doc_id", "status").agg(F.count("*").alias("n"))


_RB = "case when len(cast(bbox as json)::double[]) = 4 then cast(bbox as json)::double[] end"
_ORDER_SQL = f"""with r as (select region_id, doc_id, page_no, order_idx idx, {_RB} b, coalesce(regexp_matches(text, '\\S'), false) flow from regions where engine = 'a'),
w as (select *, max(case when flow then b[3] end) over p - min(case when flow then b[1] end) over p as wd, bool_or(b is null) over p or count(*) filter (where flow) over p < 2 as keep0 from r window p as (partition by doc_id, page_no)),
k as (select *, keep0 or wd <= 0 or wd is null as keep from w),
g as (select *, case when keep0 then 1 when not flow then 3 when keep then 1 when b[4] <= 0.05 * 3508 then 0 when b[2] >= 0.95 * 3508 then 2 else 1 end band from k),
s as (select *, coalesce(band = 1 and not keep, false) body, coalesce(band = 1 and not keep and b[3] - b[1] >= 0.6 * wd, false) span from g),
t as (select *, case when span then row_number() over (partition by doc_id, page_no, span order by b[2], b[1], idx) - 1 end rk from s),
u as (select *, list(case when span then b[4] end) over (partition by doc_id, page_no) ends from t),
v as (select *, case when not body then 0 when span then 2 * rk + 1 else 2 * len(list_filter(ends, lambda y: y <= (b[2] + b[4]) / 2)) end sec from u),
c as (select *, coalesce((body and not span and b[1] > max(b[3]) over (partition by doc_id, page_no, band, sec order by b[1], idx rows between unbounded preceding and 1 preceding) + 0.02 * wd)::int, 0) nw from v),
e as (select *, sum(nw) over (partition by doc_id, page_no, band, sec order by b[1], idx rows between unbounded preceding and current row) col from c),
f as (select *, min(idx) over (partition by doc_id, page_no, band, sec, col) first from e),
o as (select region_id, doc_id, page_no, idx, (row_number() over (partition by doc_id, page_no order by band, sec, case when body then first end nulls first, case when body then b[2] end nulls first, case when body then b[1] end nulls first, idx) - 1)::int new_idx from f)"""


def _ordered(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "regions").where("engine = 'a'").select("region_id", "doc_id", "page_no", "order_idx", boxes.box(F.col("bbox")).alias("box"), F.coalesce(F.col("text").rlike(r"\S"), F.lit(False)).alias("flow"))
    return ordering.reading_order(rows, ["doc_id", "page_no"], "order_idx", "box", "flow", 3508.0)


@query("reading_order", _ORDER_SQL + " select region_id, new_idx from o")
def _(s: SparkSession, d: str) -> DataFrame:
    return _ordered(s, d).select("region_id", "new_idx")


@query("reorder_changed_pages", _ORDER_SQL + ", q as (select *, row_number() over (partition by doc_id, page_no order by idx) - 1 old_idx from o) select doc_id, page_no, count(*) as moved from q where new_idx <> old_idx group by all")
def _(s: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window as W

    old = F.row_number().over(W.partitionBy("doc_id", "page_no").orderBy("order_idx")) - 1
    return _ordered(s, d).withColumn("old_idx", old).where("new_idx <> old_idx").groupBy("doc_id", "page_no").agg(F.count("*").alias("moved"))


@query("ordered_pages", "select page_id, row_number() over (partition by doc_id order by page_no) - 1 as pos from pages")
def _(s: SparkSession, d: str) -> DataFrame:
    return rank_within(table(s, d, "pages").select("page_id", "doc_id", "page_no"), ["doc_id"], ["page_no"], "pos").select("page_id", "pos")


@query("ordered_regions", "select region_id, (row_number() over (partition by doc_id, page_no order by engine nulls first, order_idx, region_id) - 1)::int as pos from regions")
def _(s: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window as W

    return table(s, d, "regions").select("region_id", (F.row_number().over(W.partitionBy("doc_id", "page_no").orderBy("engine", "order_idx", "region_id")) - 1).alias("pos"))


@query("page_text_agg", "select doc_id, page_no, coalesce(string_agg(text, chr(10) order by order_idx), '') as text from regions where engine = 'a' group by all")
def _(s: SparkSession, d: str) -> DataFrame:
    return ordering.page_text(table(s, d, "regions").where("engine = 'a'"), ["doc_id", "page_no"], "order_idx", "text")


@query("canonical_text", "select doc_id, page_no, coalesce(string_agg(coalesce(text_canonical, text), chr(10) order by order_idx), '') as text from regions where engine = 'a' group by all")
def _(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "regions").where("engine = 'a'").withColumn("best", F.coalesce("text_canonical", "text"))
    return ordering.page_text(rows, ["doc_id", "page_no"], "order_idx", "best")


@query("page_best_text", "select page_id, coalesce(canonical_text, full_text, '') as text from pages")
def _(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "pages").select("page_id", F.coalesce("canonical_text", "full_text", F.lit("")).alias("text"))


@query("conflicts_left_join", "select c.region_id, c.resolver, r.page_no, r.engine, r.order_idx from region_conflicts c left join regions r on c.region_id = r.region_id where c.resolver in ('divergent_low', 'majority')")
def _(s: SparkSession, d: str) -> DataFrame:
    c = table(s, d, "region_conflicts").where("resolver in ('divergent_low', 'majority')").select("region_id", "resolver")
    return c.join(table(s, d, "regions").select("region_id", "page_no", "engine", "order_idx"), "region_id", "left")


@query("conflict_rate", """with a as (select doc_id, count(*) n from regions where engine = 'a' group by doc_id), c as (select doc_id, count(*) k from region_conflicts group by doc_id)
select a.doc_id, n as regions, coalesce(k, 0) as conflicts, round(coalesce(k, 0) / n, 6) as rate, coalesce(k, 0) / n > 0.05 as warn from a left join c on a.doc_id = c.doc_id""")
def _(s: SparkSession, d: str) -> DataFrame:
    a = table(s, d, "regions").where("engine = 'a'").groupBy("doc_id").agg(F.count("*").alias("regions"))
    c = table(s, d, "region_conflicts").groupBy("doc_id").agg(F.count("*").alias("k"))
    rate = F.coalesce("k", F.lit(0)) / F.col("regions")
    return a.join(c, "doc_id", "left").select("doc_id", "regions", F.coalesce("k", F.lit(0)).alias("conflicts"), F.round(rate, 6).alias("rate"), (rate > Settings.from_session(s).conflict_rate_warn).alias("warn"))


_ABC = """with j as (select a.region_id, a.text a, b.text b, c.resolved_text c from regions a join regions b on b.engine = 'b' and a.doc_id = b.doc_id and a.page_no = b.page_no and a.order_idx = b.order_idx join region_conflicts c on c.region_id = a.region_id where a.engine = 'a')"""


@query("majority_vote", _ABC + " select region_id, case when a is not distinct from b or a is not distinct from c then a when b is not distinct from c then b else a end as text, case when a is not distinct from b or a is not distinct from c or b is not distinct from c then 'majority' else 'divergent_low' end as kind from j")
def _(s: SparkSession, d: str) -> DataFrame:
    r = table(s, d, "regions")
    at = ["doc_id", "page_no", "order_idx"]
    both = r.where("engine = 'a'").select("region_id", *at, F.col("text").alias("a")).join(r.where("engine = 'b'").select(*at, F.col("text").alias("b")), at)
    j = both.join(table(s, d, "region_conflicts").select("region_id", F.col("resolved_text").alias("c")), "region_id")
    abc = F.col("a"), F.col("b"), F.col("c")
    return j.select("region_id", reconcile.vote(*abc).alias("text"), reconcile.vote_kind(*abc).alias("kind"))


@query("iou_align", f"""with r as (select region_id, doc_id, page_no, order_idx, engine, {_RB} b from regions where bbox is not null),
p as (select a.region_id id_a, b.region_id id_b, b.order_idx ib, greatest(0, least(a.b[3], b.b[3]) - greatest(a.b[1], b.b[1])) * greatest(0, least(a.b[4], b.b[4]) - greatest(a.b[2], b.b[2])) i,
  greatest(a.b[3] - a.b[1], 0) * greatest(a.b[4] - a.b[2], 0) + greatest(b.b[3] - b.b[1], 0) * greatest(b.b[4] - b.b[2], 0) t from r a join r b on a.engine = 'a' and b.engine = 'b' and a.doc_id = b.doc_id and a.page_no = b.page_no),
q as (select id_a, id_b, ib, case when t - i > 0 then i / (t - i) else 0 end iou from p)
select id_a, id_b, round(iou, 6) as iou from (select *, row_number() over (partition by id_a order by iou desc, ib, id_b) rn from q where iou >= 0.5) where rn = 1""")
def _(s: SparkSession, d: str) -> DataFrame:
    r = table(s, d, "regions").select("doc_id", "page_no", "engine", F.col("region_id").alias("id"), F.col("order_idx").alias("idx"), boxes.box(F.col("bbox")).alias("box")).where("box is not null")
    return reconcile.best_overlap(r.where("engine = 'a'"), r.where("engine = 'b'"), ["doc_id", "page_no"], Settings.from_session(s).iou_min).withColumn("iou", F.round("iou", 6))


@query("reconcile_pages")
def _(s: SparkSession, d: str) -> DataFrame:
    return reconcile.reconcile_pages(table(s, d, "regions"), Settings.from_session(s).iou_min, Settings.from_session(s).text_accept)


@query("similarity_pairs")
def _(s: SparkSession, d: str) -> DataFrame:
    """Similarity of every aligned pair of readings."""
    r = table(s, d, "regions")
    at = ["doc_id", "page_no", "order_idx"]
    both = r.where("engine = 'a'").select("region_id", *at, text.normalize(F.col("text")).alias("a")).join(r.where("engine = 'b'").select(*at, text.normalize(F.col("text")).alias("b")), at)
    return both.select("region_id", F.round(fuzzy.similarity(F.col("a"), F.col("b")), 4).alias("score"))


@query("coverage_of_pages", "select f.doc_id, f.n_pages, count(p.page_id) as have from doc_files f left join pages p on f.doc_id = p.doc_id group by f.doc_id, f.n_pages")
def _(s: SparkSession, d: str) -> DataFrame:
    have = table(s, d, "pages").groupBy("doc_id").agg(F.count("*").alias("have"))
    return table(s, d, "doc_files").select("doc_id", "n_pages").join(have, "doc_id", "left").na.fill(0, ["have"])


@query("resolved_regions", "select r.region_id, coalesce(c.resolved_text, r.text_canonical) as text_canonical, c.resolver from regions r left join (select region_id, arg_max(resolved_text, resolver) filter (where resolved_text is not null) as resolved_text, max(resolver) filter (where resolved_text is not null) as resolver from region_conflicts group by region_id) c on c.region_id = r.region_id where r.engine = 'a'")
def _(s: SparkSession, d: str) -> DataFrame:
    """Engine a's regions after the resolutions: a resolved text becomes the canonical one, with its resolver; others stay."""
    some = table(s, d, "region_conflicts").where("resolved_text is not null").groupBy("region_id").agg(F.max_by("resolved_text", "resolver").alias("resolved"), F.max("resolver").alias("resolver"))
    rows = table(s, d, "regions").where("engine = 'a'").select("region_id", "text_canonical").join(some, "region_id", "left")
    return rows.select("region_id", F.coalesce("resolved", "text_canonical").alias("text_canonical"), "resolver")


# states, tasks and lookups

_KNOWN = """n as (select doc_id, schema_name, case when bool_or(status = 'pending') then 'extracted' when bool_or(status in ('needs_review', 'rejected')) then 'needs_review' else 'validated' end as status from (select *, row_number() over (partition by doc_id, field_path order by attempt desc nulls last, loaded_at desc nulls last, ext_id desc) rn from extractions) where rn = 1 and field_path not like '%$%' and schema_name is not null group by all)"""
_EFFECTIVE = _KNOWN + """, f as (select f.doc_id, x.schema_name, coalesce(n.status, case when f.status in ('reconciled', 'enumerated', 'extracted', 'validated', 'done', 'needs_review') then 'reconciled' else f.status end) as status from doc_files f cross join (values ('contract'), ('race_traits')) x(schema_name) left join n on n.doc_id = f.doc_id and n.schema_name = x.schema_name)"""
SCHEMA_NAMES = ["contract", "race_traits"]


def latest_rows(s: SparkSession, d: str) -> DataFrame:
    """The latest row of each path."""
    return versions.latest(table(s, d, "extractions").select(*KEY, *ORDER, "schema_name", "status", "value_json", "page_no", "confidence"), KEY, ORDER)


def effective(s: SparkSession, d: str) -> DataFrame:
    """The state of each file and schema; what its latest rows say stands for the recorded one."""
    rows = latest_rows(s, d).where(~F.col("field_path").contains("$") & F.col("schema_name").isNotNull())
    has = lambda *x: F.max(F.coalesce(F.col("status").isin(*x), F.lit(False)))
    known = rows.groupBy("doc_id", "schema_name").agg(F.when(has("pending"), "extracted").when(has("needs_review", "rejected"), "needs_review").otherwise("validated").alias("status"))
    return states.effective_status(table(s, d, "doc_files"), SCHEMA_NAMES, known)


@query("effective_status", f"with {_EFFECTIVE} select doc_id, schema_name, status from f")
def _(s: SparkSession, d: str) -> DataFrame:
    return effective(s, d)


@query("validation_step", f"""with {_EFFECTIVE}, r as (select distinct doc_id, schema_name from extractions where field_path not like '%$%')
select f.doc_id, f.schema_name, case when f.status in ('validated', 'done') then 'skip' when f.status = 'needs_review' then 'resume' when f.status is distinct from 'extracted' then 'error' when r.doc_id is null then 'needs_review' else 'validate' end as step from f left join r on r.doc_id = f.doc_id and r.schema_name = f.schema_name""")
def _(s: SparkSession, d: str) -> DataFrame:
    """What validation does with each file and schema: skip what is past it, resume what is under review, refuse what is not extracted,
    and send to review what has no row."""
    rows = table(s, d, "extractions").where(~F.col("field_path").contains("$")).select("doc_id", "schema_name").distinct().withColumn("has", F.lit(True))
    step = F.when(F.col("status").isin("validated", "done"), "skip").when(F.col("status") == "needs_review", "resume").when(~F.col("status").eqNullSafe(F.lit("extracted")), "error").when(F.col("has").isNull(), "needs_review").otherwise("validate")
    return effective(s, d).join(rows, ["doc_id", "schema_name"], "left").select("doc_id", "schema_name", step.alias("step"))


_STEPS = ", ".join(f"('{a}', '{b}')" for a, to in states.STEPS.items() for b in (*to, "failed"))


@query("illegal_transitions", f"""with s(src, dst) as (values {_STEPS}), a as (select doc_id, x.src, x.dst from doc_files cross join (values ('extracted', 'validated'), ('validated', 'done'), ('done', 'extracted'), ('needs_review', 'failed'), ('ingested', 'done')) x(src, dst))
select a.doc_id, a.src, a.dst, case when s.src is null then 'not allowed' else 'stale' end as reason from a left join s on s.src = a.src and s.dst = a.dst left join doc_files f on f.doc_id = a.doc_id where s.src is null or f.status is distinct from a.src""")
def _(s: SparkSession, d: str) -> DataFrame:
    """Five steps asked for every file: which may not be made, and why."""
    files = table(s, d, "doc_files").select("doc_id", "status")
    steps = (("extracted", "validated"), ("validated", "done"), ("done", "extracted"), ("needs_review", "failed"), ("ingested", "done"))
    asked = files.select("doc_id", F.explode(F.array(*[F.struct(F.lit(a).alias("src"), F.lit(b).alias("dst")) for a, b in steps])).alias("x")).select("doc_id", "x.*")
    return states.illegal_transitions(asked, files, ["doc_id"])


@query("skip_if_done", """with d as (select distinct doc_id from pages union select distinct doc_id from doc_files), p as (select ['ingested', 'rasterized', 'ocr_a', 'ocr_b', 'reconciled', 'enumerated', 'extracted', 'validated', 'done'] l)
select d.doc_id, case when f.status is null then 'error' when f.status = 'needs_review' or coalesce(list_position(l, f.status), 0) >= list_position(l, 'validated') then 'skip' when f.status = 'extracted' then 'run' else 'error' end as decision from d cross join p left join doc_files f on d.doc_id = f.doc_id""")
def _(s: SparkSession, d: str) -> DataFrame:
    """What the phase from extracted to validated does with each file, those only pages know of included."""
    files = table(s, d, "doc_files").select("doc_id", "status")
    every = table(s, d, "pages").select("doc_id").union(files.select("doc_id")).distinct()
    return every.join(files, "doc_id", "left").select("doc_id", states.skip_decision(F.col("status"), "extracted", "validated").alias("decision"))


@query("pending_by_status", "select doc_id, path, n_pages from doc_files where status = 'extracted'")
def _(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "doc_files").where("status = 'extracted'").select("doc_id", "path", "n_pages")


@query("file_lookup", "select i.item_id, f.path, f.status, p.page_id, p.image_path, p.dpi from list_items i left join doc_files f on f.doc_id = i.doc_id left join pages p on p.doc_id = i.doc_id and p.page_no = i.page")
def _(s: SparkSession, d: str) -> DataFrame:
    """The file, its status and the page of each item."""
    items = table(s, d, "list_items").select("item_id", "doc_id", F.col("page").alias("page_no"))
    rows = items.join(table(s, d, "doc_files").select("doc_id", "path", "status"), "doc_id", "left")
    return rows.join(table(s, d, "pages").select("doc_id", "page_no", "page_id", "image_path", "dpi"), ["doc_id", "page_no"], "left").select("item_id", "path", "status", "page_id", "image_path", "dpi")


REQUIRED = ["effects", "featureName", "grantedAtLevel", "raceName"]
_ITEM = r"regexp_extract(field_path, '^(traits\[[0-9]+\])\.([A-Za-z]+)$', {})"
_ROUTED = f"""l as (select * from (select *, row_number() over (partition by doc_id, field_path order by attempt desc nulls last, loaded_at desc nulls last, ext_id desc) rn from extractions) where rn = 1 and {_ITEM.format(1)} <> ''),
a as (select doc_id, {_ITEM.format(1)} as task, min(page_no) as task_page, bool_or(coalesce(status = 'rejected', false)) as bad, list({{'field': {_ITEM.format(2)}, 'page': page_no}}) as fields from l group by doc_id, {_ITEM.format(1)}),
e as (select *, list_sort(list_filter(['effects', 'featureName', 'grantedAtLevel', 'raceName'], lambda x: not list_contains(list_transform(fields, lambda y: y.field), x))) as gone from a),
r as (select *, case when bad then 'a value was rejected' when len(gone) > 0 then 'left out: ' || array_to_string(gone, ',') end as error from e)"""


def answers(s: SparkSession, d: str) -> DataFrame:
    """doc_id, task, status, error, field, page: the latest rows of each item as the answer to its task; a rejected one fails it."""
    part = lambda i: F.regexp_extract("field_path", r"^(traits\[[0-9]+\])\.([A-Za-z]+)$", i)
    rows = latest_rows(s, d).select("doc_id", part(1).alias("task"), part(2).alias("field"), "page_no", "status").where("task <> ''")
    bad = F.when(F.max(F.coalesce(F.col("status") == "rejected", F.lit(False))), "a value was rejected")
    asked = rows.groupBy("doc_id", "task").agg(F.min("page_no").alias("task_page"), bad.alias("error"), F.collect_list(F.struct("field", F.col("page_no").alias("page"))).alias("fields"))
    return states.routed(asked, REQUIRED, table(s, d, "pages").select("doc_id", "page_no"))


@query("task_routing", f"""with {_ROUTED}, o as (select doc_id, count(*) n, min(page_no) only_page from pages group by doc_id), x as (select doc_id, task, unnest(fields) f from r where error is null)
select r.doc_id, r.task, 'failed' as status, r.error, null as field, null::int as page from r where error is not null
union all select x.doc_id, x.task, 'ok', null, x.f.field, coalesce(p.page_no, r.task_page, case when o.n = 1 then o.only_page end) from x join r on r.doc_id = x.doc_id and r.task = x.task left join o on o.doc_id = x.doc_id left join (select distinct doc_id, page_no from pages) p on p.doc_id = x.doc_id and p.page_no = x.f.page""")
def _(s: SparkSession, d: str) -> DataFrame:
    return answers(s, d)


@query("failed_tasks", f"with {_ROUTED} select doc_id, task, left(error, 500) as error from r where error is not null")
def _(s: SparkSession, d: str) -> DataFrame:
    return answers(s, d).where("status = 'failed'").select("doc_id", "task", "error")


@query("task_status", f"with {_ROUTED} select doc_id, task, case when error is null then 'ok' else 'failed' end as status from r")
def _(s: SparkSession, d: str) -> DataFrame:
    return answers(s, d).select("doc_id", "task", "status").distinct()


_FINAL = f"""{_EFFECTIVE}, {_ROUTED}, lt as (select * from (select *, row_number() over (partition by doc_id, field_path order by attempt desc nulls last, loaded_at desc nulls last, ext_id desc) rn from extractions) where rn = 1),
fa as (select doc_id, schema_name, count(*) filter (where field_path not like '%$%') re, count(*) filter (where status = 'pending') pe from lt group by all),
qu as (select distinct doc_id, schema_name from lt where status in ('needs_review', 'rejected') and field_path not like '%$%' union select distinct c.doc_id, x.schema_name from region_conflicts c cross join (values ('contract'), ('race_traits')) x(schema_name) where c.resolver = 'divergent_low'),
ft as (select distinct doc_id, 'race_traits' as schema_name from r where error is not null),
ex as (select distinct doc_id, {_ITEM.format(1)} item, {_ITEM.format(2)} leaf from extractions where field_path not like '%$%'),
mi as (select distinct w.doc_id, 'race_traits' as schema_name from (select doc_id, item, unnest(['effects', 'featureName', 'grantedAtLevel', 'notes', 'raceName']) leaf from (select distinct doc_id, item from ex where item <> '')) w anti join ex on ex.doc_id = w.doc_id and ex.item = w.item and ex.leaf = w.leaf),
iv as (select distinct a.doc_id, 'contract' as schema_name from extractions a where a.field_path = 'amount_eur' and try_cast(a.value_json as double) > 0 and not exists (select 1 from extractions p where p.doc_id = a.doc_id and p.field_path like 'parties[%' and p.value_json is not null))"""


@query("finalize_check", f"""with {_FINAL}
select f.doc_id, f.schema_name, case when f.status not in ('needs_review', 'validated') or f.status is null then 'state' when coalesce(fa.re, 0) = 0 then 'empty' when fa.pe > 0 then 'pending' when qu.doc_id is not null then 'queue' when ft.doc_id is not null then 'failed' when mi.doc_id is not null then 'missing' when iv.doc_id is not null then 'schema' end as reason
from f left join fa using (doc_id, schema_name) left join qu using (doc_id, schema_name) left join ft using (doc_id, schema_name) left join mi using (doc_id, schema_name) left join iv using (doc_id, schema_name)""")
def _(s: SparkSession, d: str) -> DataFrame:
    """Which file and schema may become done, and what keeps the others from it."""
    from quire.plans import item_queries

    rows = latest_rows(s, d)
    review = rows.where("status in ('needs_review', 'rejected')").where(~F.col("field_path").contains("$")).select("doc_id", "schema_name")
    conflicts = table(s, d, "region_conflicts").where("resolver = 'divergent_low'").select("doc_id", F.explode(F.array(*map(F.lit, SCHEMA_NAMES))).alias("schema_name"))
    failed = answers(s, d).where("status = 'failed'").select("doc_id", F.lit("race_traits").alias("schema_name"))
    missing = item_queries.Q["coverage_anti_join"](s, d).select("doc_id", F.lit("race_traits").alias("schema_name"))
    invalid = item_queries.Q["cross_field_rule"](s, d).where("not ok").select("doc_id", F.lit("contract").alias("schema_name"))
    return states.finalised(effective(s, d), rows, review.unionByName(conflicts), failed, missing, invalid)


NORMAL = normal_sql
