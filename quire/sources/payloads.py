"""Adapters of engine payloads, and files by content."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import text


def files_by_content(spark: SparkSession, path: str, known: DataFrame | None = None) -> DataFrame:
    """Binary files with sha256 and key; a content already in ``known`` (sha256) or seen under a smaller path is left out."""
    files = spark.read.format("binaryFile").load(path).select("path", "length", F.sha2("content", 256).alias("sha256"))
    first = files.groupBy("sha256").agg(F.min_by(F.struct("path", "length"), "path").alias("f"))
    out = first.select(content_key(F.col("sha256")).alias("doc_id"), "sha256", "f.path", "f.length")
    return out if known is None else out.join(known.select("sha256"), "sha256", "left_anti")


def content_key(sha: Column) -> Column:
    return F.concat(F.lit("doc_"), F.substring(sha, 1, 32))


def block_payload(regions: DataFrame) -> DataFrame:
    """doc_id, page_no, payload: a page's regions as the first engine's JSON, bare or under ``res`` (odd pages)."""
    block = F.struct(F.col("order_idx").alias("index"), F.col("region_type").alias("block_label"), F.from_json("bbox", "array<double>").alias("block_bbox"), F.col("text").alias("block_content"))
    pages = regions.groupBy("doc_id", "page_no").agg(F.to_json(F.struct(F.array_sort(F.collect_list(block)).alias("parsing_res_list"))).alias("p"))
    return pages.select("doc_id", "page_no", F.when(F.col("page_no") % 2 == 1, F.concat(F.lit('{"res":'), "p", F.lit("}"))).otherwise(F.col("p")).alias("payload"))


def explode_blocks(payloads: DataFrame) -> DataFrame:
    """doc_id, page_no, pos, region_type, n_box, text, error of every block of the first engine's payloads.

    A payload is an object with ``parsing_res_list``, bare or under ``res``; a JSON string of one; a list of such objects, whose
    blocks follow each other; or a list of plain regions (bbox, type, text). An empty list gives no row, anything else one
    row with the error ``unrecognised``. A block with a box that is no list of four, or without any known member, has an error
    of its own (``box``, ``block``). A table given as an object is kept as JSON. A missing text is ''.
    """
    get = F.get_json_object
    quoted = F.col("payload").rlike(r'^\s*"')
    rows = payloads.select("doc_id", "page_no", F.when(quoted, get(F.concat(F.lit('{"v":'), "payload", F.lit("}")), "$.v")).otherwise(F.col("payload")).alias("p"))
    listed = lambda c: F.coalesce(get(c, "$.parsing_res_list"), get(c, "$.res.parsing_res_list"))
    parts = F.from_json("p", "array<string>")
    known = F.forall(parts, lambda e: e.rlike(r"^\s*\{"))
    whole = F.forall(parts, lambda e: listed(e).isNotNull())
    plain = F.forall(parts, lambda e: listed(e).isNull())
    many = F.when(known & whole, F.flatten(F.transform(parts, lambda e: F.from_json(listed(e), "array<string>")))).when(known & plain, parts)
    blocks = F.when(F.col("p").rlike(r"^\s*\["), many).otherwise(F.from_json(listed(F.col("p")), "array<string>"))
    rows = rows.withColumn("l", blocks)
    b = F.col("b")
    has = lambda *names: F.coalesce(F.exists(F.json_object_keys(b), lambda k: k.isin(*names)), F.lit(False))
    own, legacy = has("block_bbox", "block_label", "block_content"), has("bbox", "type", "text")
    box = F.when(own, get(b, "$.block_bbox")).otherwise(get(b, "$.bbox"))
    n_box = F.size(F.from_json(box, "array<double>"))
    kind = F.when(own, text.region_type(get(b, "$.block_label"))).otherwise(F.coalesce(F.nullif(get(b, "$.type"), F.lit("")), F.lit("text")))
    content = F.coalesce(F.when((kind == "table") & get(b, "$.table").isNotNull(), get(b, "$.table")), F.when(own, get(b, "$.block_content")).otherwise(get(b, "$.text")), F.lit(""))
    error = F.when(~own & ~legacy, "block").when(own & box.isNotNull() & ~F.coalesce(n_box == 4, F.lit(False)), "box")
    good = rows.select("doc_id", "page_no", F.posexplode("l").alias("pos", "b"))
    good = good.select("doc_id", "page_no", "pos", kind.alias("region_type"), F.when(box.isNotNull(), n_box).alias("n_box"), content.alias("text"), error.alias("error"))
    none = lambda c, t: F.lit(None).cast(t).alias(c)
    bad = rows.where("l is null").select("doc_id", "page_no", none("pos", "int"), none("region_type", "string"), none("n_box", "int"), none("text", "string"), F.lit("unrecognised").alias("error"))
    return good.unionByName(bad)


END = r"<[|｜]end▁of▁sentence[|｜]>"  # fixed value: the mark that ends the second engine's answer


TAG = "<|ref|>"


def grounding_regions(df: DataFrame, row_id: str, content: str, width: float = 2480.0, height: float = 3508.0) -> DataFrame:
    """Regions of tagged text <|ref|>label<|/ref|><|det|>[[x1,y1,x2,y2],...]<|/det|>body: row_id, pos, label, region_type, x0, y0,
    x1, y1, text.

    A region's box is the union of its boxes, scaled from 0-999 to the page; text runs to the next tag; the label image is
    dropped; marks of the answer's end are none of the text. Text before the first tag and tags whose box list is no list of
    four numbers each give no region; ``grounding_errors`` names the answers that have such faults.
    """
    df = df.withColumn(content, F.regexp_replace(content, END, ""))
    parts = F.split(F.col(content), r"<\|ref\|>", -1)
    rows = df.where(F.col(content).contains(TAG)).select(F.col(row_id), F.posexplode(parts).alias("pos", "part")).where("pos > 0")
    pattern = r"(?s)^(.*?)<\|/ref\|>\s*<\|det\|>(.*?)<\|/det\|>(.*)$"
    g = lambda i: F.regexp_extract("part", pattern, i)
    rows = rows.where(F.col("part").rlike(pattern)).select(row_id, "pos", F.trim(g(1)).alias("label"), F.from_json(g(2), "array<array<double>>").alias("boxes"), F.regexp_replace(g(3), r"^\s+|\s+$", "").alias("text"))
    rows = rows.where("label <> 'image' and size(boxes) > 0 and forall(boxes, b -> size(b) = 4 and forall(b, x -> x is not null))")
    edge = lambda i, f, size: (f(F.transform("boxes", lambda b: b[i])) * size / 999.0)
    return rows.select(row_id, "pos", "label", text.region_type(F.col("label"), second=True).alias("region_type"), edge(0, F.array_min, width).alias("x0"), edge(1, F.array_min, height).alias("y0"), edge(2, F.array_max, width).alias("x1"), edge(3, F.array_max, height).alias("y1"), "text")


def grounding_errors(df: DataFrame, row_id: str, content: str) -> DataFrame:
    """row_id, error of every answer of the second engine that cannot be taken as it is: ``untagged`` (text without any region)
    or ``box`` (a region but an image whose boxes are no list of lists of four numbers). Null and blank answers are empty pages.
    """
    rows = df.select(row_id, F.regexp_replace(content, END, "").alias("__t")).where(F.col("__t").rlike(r"\S"))
    tag = r"(?s)<\|ref\|>(.*?)<\|/ref\|><\|det\|>(.*?)<\|/det\|>"
    labels, boxes = F.regexp_extract_all("__t", F.lit(tag), F.lit(1)), F.regexp_extract_all("__t", F.lit(tag), F.lit(2))
    fits = lambda b: F.coalesce((F.size(b) > 0) & F.forall(b, lambda x: (F.size(x) == 4) & F.forall(x, lambda v: v.isNotNull())), F.lit(False))
    bad = F.exists(F.zip_with(labels, boxes, lambda l, b: (F.lower(F.trim(l)) != "image") & ~fits(F.from_json(b, "array<array<double>>"))), lambda x: x)
    error = F.when(F.size(labels) == 0, "untagged").when(bad, "box")
    return rows.select(row_id, error.alias("error")).where("error is not null")


def object_guard(json_text: Column) -> Column:
    """Null where the text is a JSON object, else what is wrong with it."""
    v = F.try_parse_json(json_text)
    return F.when(json_text.isNull(), "missing").when(v.isNull(), "not json").when(~F.schema_of_variant(v).startswith("OBJECT"), "not an object")
