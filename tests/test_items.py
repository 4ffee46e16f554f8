"""Spans of items over whole files."""

from __future__ import annotations

from quire.operators.gates import anchored
from quire.operators.packing import enumeration_windows, file_spans, item_contexts, near_section


def test_spans_cross_pages(spark):
    # region_id: page * 10 + order; two regions a page, each 10 long
    regions = spark.createDataFrame([("d", p, o, p * 10 + o, 10) for p in range(1, 8) for o in (0, 1)], "doc_id string, page_no int, order_idx int, region_id long, size int")
    items = [
        (1, "d", "a", 1, [11]), (2, "d", "a", 3, [31]), (3, "d", "a", 3, [31]),  # copies have one span, up to the next item
        (4, "d", "a", 4, [41]), (5, "d", "a", 6, [51]),  # its region is on the page before
        (6, "d", "b", 2, [20]), (7, "d", "a", 7, []), (8, "d", "b", 7, [71]),
    ]
    items = spark.createDataFrame(items, "item_id long, doc_id string, schema_name string, page int, region_ids array<long>")

    def spans(budget):
        out = {}
        for i, r in sorted(tuple(x) for x in file_spans(items, regions, budget).collect()):
            out.setdefault(i, []).append(r)
        return out

    got = spans(1000)
    assert got == {1: [11, 20, 21, 30], 2: [31, 40], 3: [31, 40], 4: [41, 50], 6: [20, 21, 30, 31, 40, 41, 50, 51, 60, 61, 70], 8: [71]}
    assert spans(35) == {1: [11, 20, 21], 2: [31, 40], 3: [31, 40], 4: [41, 50], 6: [20, 21, 30], 8: [71]}


def test_anchors_survive_scan_noise(spark, rows):
    pages = spark.createDataFrame([("d", 1, "the deep wlzard of the tower"), ("d", 2, "nothing here")], "doc_id string, page int, norm string")
    items = spark.createDataFrame([(1, "d", 1, "deep wizard"), (2, "d", 1, "the tower"), (3, "d", 2, "deep wizard"), (4, "d", 3, "x")], "item_id long, doc_id string, page int, anchor string")
    assert rows(anchored(items, pages).select("item_id")) == [(1,), (2,)]


def test_sections_within_the_window(spark, rows):
    texts = {1: "elf traits", 3: "dwarf tra1ts and more", 4: "", 12: "elf traits", 14: "elf trait5 again"}
    pages = spark.createDataFrame([("d", p, texts.get(p, "other words")) for p in range(1, 16)], "doc_id string, page_no int, norm string")
    windows = spark.createDataFrame([("d", 1, 10), ("d", 10, 15)], "doc_id string, first_page int, last_page int")
    items = [(1, 9, "elf traits"), (2, 10, "elf traits"), (3, 11, "elf traits"), (4, 15, "elf traits"), (5, 13, "elf traits"), (6, 4, "dwarf traits"), (7, 10, "dwarf traits"), (8, 15, "dwarf traits")]
    items = spark.createDataFrame([(i, "d", p, x) for i, p, x in items], "item_id long, doc_id string, page int, section string")
    # the first is 8 pages back; page 10 counts to the first window; page 12 is after item 3; page 14 has it by score, nearer than page 12
    assert rows(near_section(items, pages, windows)) == [(1, 1), (2, 1), (4, 14), (5, 12), (6, 3), (7, 3)]


def test_windows_split_large_pages(spark, rows):
    pages = spark.createDataFrame([("d", p) for p in range(1, 6)], "doc_id string, page_no int")
    sizes = {1: [40.0], 2: [150.0, 150.0], 3: [20.0], 4: [300.0]}  # page 2 makes two blocks, page 4 one too large, page 5 has no region
    regions = spark.createDataFrame([("d", p, i, p * 10 + i, x) for p, xs in sizes.items() for i, x in enumerate(xs)], "doc_id string, page_no int, order_idx int, region_id long, size double")
    # blocks: 1, 2, 2, 3, 4, 5 of about 65, 175, 175, 45, 325, 25; page 3 sees page 2 by its second block
    assert rows(enumeration_windows(pages, regions, 250)) == [("d", 1, 2), ("d", 2, 2), ("d", 2, 3), ("d", 3, 3), ("d", 4, 4), ("d", 5, 5)]


def test_contexts_have_tables(spark, rows):
    """Item 1 has a span with one table of its page inside and one outside; item 2 names no region; item 3 has one of another page."""
    regions = [("d", 1, 0, 10, "text", 5), ("d", 1, 1, 11, "table", 5), ("d", 1, 2, 12, "text", 5), ("d", 1, 3, 13, "table", 30), ("d", 2, 0, 20, "table", 90), ("d", 2, 1, 21, "table", 9), ("d", 3, 0, 30, "text", 1), ("d", 3, 1, 31, "text", 1)]
    regions = spark.createDataFrame(regions, "doc_id string, page_no int, order_idx int, region_id long, region_type string, size int")
    items = [(1, "d", "a", 1, [11], 2), (2, "d", "a", 1, [13], None), (3, "d", "b", 3, [], 2)]
    items = spark.createDataFrame(items, "item_id long, doc_id string, schema_name string, page int, region_ids array<long>, section_page int")
    want = [(1, 11, "span"), (1, 12, "span"), (1, 13, "table"), (1, 21, "table"), (2, 13, "span"), (2, 11, "table"), (3, 30, "near"), (3, 31, "near"), (3, 21, "table")]
    assert rows(item_contexts(items, regions, 1000, 50)) == sorted(want, key=repr)
