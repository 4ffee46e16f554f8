"""Windows, spans and budgets over the regions of pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.functions import fuzzy
from quire.operators.gates import by_page
from quire.operators.skew import running_within
from quire.storage import shared_table

PAGE = ["doc_id", "page_no"]


def ordered_blocks(blocks: DataFrame, order: list[str]) -> DataFrame:
    """A file's blocks (doc_id, order, size) with ``pos`` (0, 1, 2 ...) and ``until``, the sizes of all up to it."""
    size = F.greatest(F.coalesce(F.col("size").cast("double"), F.lit(0.0)), F.lit(0.0))
    return shared_table(running_within(blocks.withColumn("size", size), ["doc_id"], order, "size", "until", "pos"), "blocks")


def greedy_windows(blocks: DataFrame, budget: int) -> DataFrame:
    """doc_id, window, first, last: the positions of a file's blocks (``ordered_blocks``) packed in order into windows whose sizes
    stay within budget. The last block of a window is the first of the next one; a block too large for a window stands alone.

    No file lies in one task. The end of the window that would begin at a block is found by running sums, among the blocks
    of the same or the next stretch of ``budget``; which blocks do begin one follows by doubling the jumps from block to next
    beginning, so that the number of passes grows with the logarithm of the windows of a file.
    """
    before = F.col("until") - F.col("size")
    begin = blocks.select("doc_id", F.floor(before / budget).alias("stretch"), before.alias("key"), "pos", F.lit(True).alias("begins"))
    e = F.floor(F.col("until") / budget)
    end = blocks.select("doc_id", F.explode(F.array(e, e - 1)).alias("stretch"), F.col("until").alias("key"), "pos", F.lit(False).alias("begins"))
    reach = W.partitionBy("doc_id", "stretch").orderBy("key").rangeBetween(0, budget)
    ends = begin.unionByName(end).withColumn("last", F.max(F.when(~F.col("begins"), F.col("pos"))).over(reach)).where("begins")
    size = blocks.groupBy("doc_id").agg(F.max("pos").alias("final"))
    ends = shared_table(ends.select("doc_id", "pos", F.greatest("pos", F.coalesce("last", "pos")).alias("last")).join(size, "doc_id"), "window-ends")
    jump = ends.where("last < final").select("doc_id", "pos", F.greatest("last", F.col("pos") + 1).alias("to"))
    found, hops = ends.where("pos = 0").select("doc_id", "pos", F.lit(0).alias("window")), 1
    while True:
        more = found.join(jump, ["doc_id", "pos"]).select("doc_id", F.col("to").alias("pos"), (F.col("window") + hops).alias("window"), F.lit(None).cast("long").alias("to"))
        twice = jump.withColumnsRenamed({"pos": "__from", "to": "pos"}).join(jump, ["doc_id", "pos"]).select("doc_id", F.col("__from").alias("pos"), F.lit(None).cast("int").alias("window"), "to")
        step = shared_table(more.unionByName(twice), "windows")
        more = step.where("window is not null").drop("to")
        if more.isEmpty():
            break
        found, jump, hops = found.unionByName(more), step.where("window is null").select("doc_id", "pos", "to"), hops * 2
    return found.join(ends, ["doc_id", "pos"]).select("doc_id", "window", F.col("pos").alias("first"), "last")


def page_windows(pages: DataFrame, budget: int) -> DataFrame:
    """doc_id, window, first_page, last_page: a file's pages (doc_id, page_no, size) packed in order, overlapping by a page."""
    blocks = ordered_blocks(pages.select("doc_id", "page_no", "size"), ["page_no"])
    return _with_pages(greedy_windows(blocks, budget), blocks)


def _with_pages(windows: DataFrame, blocks: DataFrame) -> DataFrame:
    at = lambda c, page: blocks.select("doc_id", F.col("pos").alias(c), F.col("page_no").alias(page))
    named = windows.join(at("first", "first_page"), ["doc_id", "first"]).join(at("last", "last_page"), ["doc_id", "last"])
    return named.select("doc_id", "window", "first_page", "last_page")


def spend(rows: Column, budget: int) -> Column:
    """The ids of an array of (o, id, size) structs that fit, in order; one too large is skipped and the next one tried."""
    start = F.struct(F.lit(0).cast("long").alias("used"), F.array().cast("array<bigint>").alias("ids"))
    fits = lambda acc, r: acc["used"] + r["size"] <= budget
    return F.aggregate(rows, start, lambda acc, r: F.struct(F.when(fits(acc, r), acc["used"] + r["size"]).otherwise(acc["used"]).alias("used"), F.when(fits(acc, r), F.array_append(acc["ids"], r["id"])).otherwise(acc["ids"]).alias("ids")), lambda acc: acc["ids"])


def tables_in_budget(regions: DataFrame, budget: int) -> DataFrame:
    """doc_id, page_no, region_id of the table regions of each page that fit the budget."""
    t = regions.where("region_type = 'table'").select(*PAGE, F.struct(F.col("order_idx").alias("o"), F.col("region_id").alias("id"), F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("size")).alias("r"))
    return t.groupBy(*PAGE).agg(spend(F.array_sort(F.collect_list("r")), budget).alias("ids")).select(*PAGE, F.explode("ids").alias("region_id"))


def page_blocks(regions: DataFrame, budget: float) -> DataFrame:
    """doc_id, page_no, region_id, block: a page's regions in order (order_idx, region_id), a new block where the budget would be
    exceeded. regions: doc_id, page_no, order_idx, region_id, head (size of the heading that each block repeats), size (of the
    region's row, its line end included). A region that exceeds the budget with the heading alone is a block of its own. A page
    is one array of numbers.
    """
    number = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c)
    row = F.struct("order_idx", "region_id", number("head"), number("size"))
    rows = regions.select(*PAGE, row.alias("r")).groupBy(*PAGE).agg(F.array_sort(F.collect_list("r")).alias("rs"))
    none = F.array().cast("array<struct<id:bigint,block:int>>")

    def place(done: Column, r: Column) -> Column:
        fits = (F.size(done["out"]) == 0) | (done["used"] + r["size"] <= budget)
        block = done["block"] + F.when(fits, 0).otherwise(1)
        used = F.when(fits & (F.size(done["out"]) > 0), done["used"]).otherwise(r["head"]) + r["size"]
        return F.struct(used.alias("used"), block.alias("block"), F.array_append(done["out"], F.struct(r["region_id"].cast("bigint").alias("id"), block.alias("block"))).alias("out"))

    start = F.struct(F.lit(0.0).alias("used"), F.lit(0).alias("block"), none.alias("out"))
    placed = rows.select(*PAGE, F.explode(F.aggregate("rs", start, place, lambda done: done["out"])).alias("x"))
    return placed.select(*PAGE, F.col("x.id").alias("region_id"), "x.block")


def file_spans(items: DataFrame, regions: DataFrame, budget: int) -> DataFrame:
    """item_id, region_id: the regions from an item's first region up to the next item of its list, across pages, as far as
    their running length stays within budget. items: item_id, doc_id, schema_name, page, region_ids; regions: doc_id, page_no,
    order_idx, region_id, size.

    Items of a list are in order of page and first region; those with the same first region have one span. An item without a
    region on its own page starts with the page after it; the span ends before the first region of the next item, on the next item's page at
    the latest, and that of the last item with its page. Only the pages in between are joined, by equality.
    """
    LIST = ["doc_id", "schema_name"]  # noqa: N806
    at = F.struct(F.col("page_no").alias("p"), F.col("order_idx").cast("long").alias("o"), F.col("region_id").alias("r"))
    ids = items.where("page > 0 and size(region_ids) > 0").select("item_id", *LIST, "page", F.explode("region_ids").alias("region_id"))
    places = ids.join(regions.select("doc_id", "page_no", "order_idx", "region_id"), ["doc_id", "region_id"], "left").withColumn("at", F.when(F.col("page_no").isNotNull(), at))
    none = F.struct((F.col("page") + 1).alias("p"), F.lit(-1).cast("long").alias("o"), F.lit(-1).cast("long").alias("r"))
    own = places.groupBy("item_id", *LIST, "page").agg(F.min(F.when(F.col("page_no") == F.col("page"), F.col("at"))).alias("start"), F.collect_set("at").alias("ats"))
    own = own.withColumn("start", F.coalesce("start", none))
    starts = own.groupBy(*LIST, "page", "start").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ats")))).alias("ats"))
    w = W.partitionBy(*LIST).orderBy("page", "start")
    starts = starts.withColumns({"last": F.coalesce(F.lead("page").over(w), F.col("page")), "following": F.lead("ats").over(w)}).drop("ats")
    starts = starts.withColumn("stop", F.get(F.filter("following", lambda x: x >= F.col("start")), F.lit(0))).drop("following")
    wide = starts.withColumn("page_no", F.explode(F.sequence("page", "last"))).join(regions, ["doc_id", "page_no"])
    inside = wide.withColumn("at", at).where("at >= start and (stop is null or at < stop)")
    running = F.sum("size").over(W.partitionBy(*LIST, "page", "start").orderBy("at"))
    kept = inside.withColumn("running", running).where(F.col("running") <= budget).select(*LIST, "page", "start", "region_id")
    return own.select("item_id", *LIST, "page", "start").join(kept, [*LIST, "page", "start"]).select("item_id", "region_id")


def item_contexts(items: DataFrame, regions: DataFrame, span_budget: int, table_budget: int) -> DataFrame:
    """item_id, region_id, role of the regions an item's task sees. items: item_id, doc_id, schema_name, page, region_ids,
    section_page; regions: doc_id, page_no, order_idx, region_id, region_type, size.

    role ``span``: the item's span (``file_spans``). ``near``: where it has none, its regions on its page and those beside them,
    or the whole page where it names none of it. ``table``: the tables of its page, then of its section's page, that are not
    among these, as far as their sizes fit the budget (``spend``); a page's tables are one array of numbers.
    """
    spans = shared_table(file_spans(items, regions, span_budget).withColumn("role", F.lit("span")), "spans")
    bare = items.join(spans.select("item_id").distinct(), "item_id", "left_anti").select("item_id", "doc_id", F.col("page").alias("page_no"), "region_ids")
    places = bare.join(regions.select(*PAGE, "order_idx", "region_id"), PAGE)
    flagged = places.withColumn("__own", F.coalesce(F.array_contains("region_ids", F.col("region_id")), F.lit(False)))
    near = with_neighbours(flagged, ["item_id"], "order_idx", "__own").select("item_id", "region_id", F.lit("near").alias("role"))
    chosen = shared_table(spans.unionByName(near), "chosen")
    tables = regions.where("region_type = 'table'").groupBy(*PAGE).agg(F.array_sort(F.collect_list(F.struct(F.col("order_idx").alias("o"), F.col("region_id").alias("id"), F.col("size").cast("long").alias("size")))).alias("ts"))
    asked = items.select("item_id", "doc_id", F.posexplode(F.array_distinct(F.array_compact(F.array("page", "section_page")))).alias("at", "page_no"))
    offered = asked.join(tables, PAGE).select("item_id", "at", F.explode("ts").alias("t"))
    offered = offered.join(chosen.select("item_id", F.col("region_id").alias("__r")), (offered["item_id"] == chosen["item_id"]) & (F.col("t.id") == F.col("__r")), "left_anti")
    taken = offered.groupBy("item_id").agg(F.array_sort(F.collect_list(F.struct("at", F.col("t.o").alias("o"), F.col("t.id").alias("id"), F.col("t.size").alias("size")))).alias("ts"))
    return chosen.unionByName(taken.select("item_id", F.explode(spend(F.col("ts"), table_budget)).alias("region_id"), F.lit("table").alias("role")))


def with_neighbours(rows: DataFrame, page: list[str], order: str, flag: str, margin: int = 1) -> DataFrame:
    """The rows within ``margin`` positions of a flagged one on the page; a page without a flag is kept whole."""
    w = W.partitionBy(*page)
    near = F.max(F.col(flag).cast("int")).over(w.orderBy(order).rowsBetween(-margin, margin))
    some = F.max(F.col(flag).cast("int")).over(w)
    return rows.withColumns({"__near": near, "__some": some}).where("__near = 1 or __some = 0").drop("__near", "__some")


def asof_page(items: DataFrame, pages: DataFrame, reach: int) -> DataFrame:
    """item_id, found_page: the nearest page at or before the item's whose text contains the item's section.

    items: item_id, doc_id, page, section (normalised); pages: doc_id, page_no, norm. An item meets ``reach`` pages by
    equality, so no range join is needed.
    """
    wide = items.withColumn("page_no", F.explode(F.sequence(F.greatest(F.col("page") - reach + 1, F.lit(0)), F.col("page"))))
    return wide.join(pages, ["doc_id", "page_no"]).where(F.contains("norm", "section")).groupBy("item_id").agg(F.max("page_no").alias("found_page"))


def enumeration_windows(pages: DataFrame, regions: DataFrame, budget: int) -> DataFrame:
    """doc_id, first_page, last_page: the windows in which items are looked for. pages: doc_id, page_no; regions: doc_id, page_no,
    order_idx, region_id, size (tokens of its row). A page is one block of its heading and regions, more where it exceeds the
    budget (``page_blocks``); blocks are packed by ``greedy_windows``.
    """
    head = 1.3 * (F.length(F.col("page_no").cast("string")) + 11 + 22 / 3)  # fixed value: digits, signs and letters of a block's two heading lines
    sized = shared_table(regions.select(*PAGE, "order_idx", "region_id", head.alias("head"), F.coalesce("size", F.lit(0.0)).alias("size")), "rows")
    placed = page_blocks(sized.withColumn("size", F.col("size") + 1), budget).join(sized.select("region_id", "size"), "region_id")
    filled = placed.groupBy(*PAGE, "block").agg(F.sum("size").alias("size"))
    blocks = pages.select(*PAGE).distinct().join(filled, PAGE, "left").select(*PAGE, F.coalesce("block", F.lit(0)).alias("block"), (head + F.coalesce("size", F.lit(0.0))).alias("size"))
    blocks = ordered_blocks(shared_table(blocks, "page-blocks"), ["page_no", "block"])
    return _with_pages(greedy_windows(blocks, budget), blocks).drop("window")


def near_section(items: DataFrame, pages: DataFrame, windows: DataFrame, threshold: float = 90.0) -> DataFrame:
    """item_id, found_page: the nearest page at or before the item's, within the item's window, whose text has the item's section
    with a partial ratio of at least the threshold.

    items: item_id, doc_id, page, section (normalised); pages: doc_id, page_no, norm; windows: doc_id, first_page, last_page. A page in two
    windows counts to the first. Containment is tested first; only pages after the last one that contains the section are scored,
    each (page, section) once.
    """
    reach = windows.withColumn("page", F.explode(F.sequence("first_page", "last_page"))).groupBy("doc_id", "page").agg(F.min("first_page").alias("first_page"))
    wide = items.join(reach, ["doc_id", "page"]).withColumn("page_no", F.explode(F.sequence("first_page", "page"))).select("item_id", "doc_id", "page_no", "section")
    asked = wide.select("doc_id", "page_no", "section").distinct().join(pages, ["doc_id", "page_no"])
    asked = shared_table(asked.withColumn("inside", F.contains("norm", "section")).withColumn("norm", F.when(~F.col("inside"), F.col("norm"))), "sections")
    pairs = shared_table(wide.join(asked.drop("norm"), ["doc_id", "page_no", "section"]), "section-pages")
    sure = pairs.groupBy("item_id").agg(F.max(F.when(F.col("inside"), F.col("page_no"))).alias("sure"))
    open_ = shared_table(pairs.join(sure, "item_id").where("page_no > coalesce(sure, -1)").select("item_id", "doc_id", "page_no", "section"), "section-open")
    todo = by_page(open_.select("doc_id", "page_no", "section").distinct()).join(asked.drop("inside"), ["doc_id", "page_no", "section"])
    near = todo.where(fuzzy.partial_similarity(F.col("section"), F.col("norm"), threshold) >= threshold).select("doc_id", "page_no", "section")
    more = open_.join(near, ["doc_id", "page_no", "section"]).select("item_id", "page_no")
    return sure.where("sure is not null").select("item_id", F.col("sure").alias("page_no")).unionByName(more).groupBy("item_id").agg(F.max("page_no").alias("found_page"))


def prefix_duplicates(items: DataFrame) -> DataFrame:
    """item_id of the items kept: in order of item_id, an item is dropped if a kept one of its page has an anchor that begins
    with its own, or the other way round, and region ids that are equal or missing on a side. A null anchor counts as ''.

    Items of a page with equal anchor and ids stand or fall together after the first, so one of each takes part. Conflicts are
    found by joining anchors with the beginnings of others, by equality. Items in no conflict are kept at once; of the others
    each pass decides those that all earlier opponents are decided for, so there are as many passes as the longest chain.
    """
    ids = F.array_sort(F.coalesce("region_ids", F.array().cast("array<bigint>")))
    anchor = F.coalesce("anchor", F.lit(""))
    distinct = items.groupBy("doc_id", "page", anchor.alias("anchor"), ids.alias("ids")).agg(F.min("item_id").alias("item_id"))
    distinct = shared_table(distinct, "distinct-items")
    begins = distinct.withColumn("anchor", F.explode(F.transform(F.sequence(F.lit(0), F.length("anchor")), lambda n: F.left(F.col("anchor"), n))))
    other = distinct.select("doc_id", "page", "anchor", F.col("ids").alias("other_ids"), F.col("item_id").alias("other"))
    pairs = begins.alias("b").join(other.alias("o"), F.col("b.doc_id").eqNullSafe(F.col("o.doc_id")) & F.col("b.page").eqNullSafe(F.col("o.page")) & (F.col("b.anchor") == F.col("o.anchor")))
    pairs = pairs.where((F.col("item_id") != F.col("other")) & ((F.col("ids") == F.col("other_ids")) | (F.size("ids") == 0) | (F.size("other_ids") == 0)))
    open_ = shared_table(pairs.select(F.least("item_id", "other").alias("first"), F.greatest("item_id", "other").alias("item_id")).distinct(), "conflicts")
    dropped = None
    while not open_.isEmpty():
        waiting = open_.select("item_id").distinct()
        settled = open_.select(F.col("first").alias("item_id")).distinct().join(waiting, "item_id", "left_anti")  # kept: nothing earlier is left
        out = shared_table(open_.join(settled.withColumnRenamed("item_id", "first"), "first", "left_semi").select("item_id").distinct(), "dropped")
        dropped = out if dropped is None else dropped.unionByName(out)
        rest = open_.join(out, "item_id", "left_anti").join(out.withColumnRenamed("item_id", "first"), "first", "left_anti")
        open_ = shared_table(rest, "conflicts")
    kept = distinct.select("item_id")
    return kept if dropped is None else kept.join(dropped, "item_id", "left_anti")
