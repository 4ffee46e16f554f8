"""Scan noise: line rules, and a small corpus with known noise."""

from __future__ import annotations

import pytest

from quire.llm.scan_noise import FIELDS, find_noise, noise_rows, repair, repaired
from quire.llm.scan_text import joined, misread_of, numbered_title, odd_letters, odd_number, page_number_alone, skeleton, split_pairs, title_key, title_like, words

PAGES = "page_id long, doc_id string, page_no int, full_text string, canonical_text string, f int, line_no string"
REGIONS = "region_id long, doc_id string, page_no int, order_idx int, engine string, text string, kind string"
COMMON = "The heavily armed captain moves towards another window while the silent lantern remembers every winter morning\nand the self-made hunter heavily follows the river captain within modern gardens of silver copper\n"


@pytest.mark.parametrize(("line", "n"), [("17", 17), ("- 17 -", 17), ("Pagina 13", 13), ("pag. 3 / 20", 3), ("pag. l6 / 2O4", 16), ("- lO2 -", 102), ("Page 5", 5), ("12.", None), ("40).", None), ("level 5", None), ("", None), ("XII", None), ("27 hours", None)])
def test_page_numbers(line, n):
    assert page_number_alone(line) == n


def test_titles():
    assert title_key("S T O U T  QUIVER") == title_key("Stout Qu1ver") == title_key("STOUT QUIVER")
    assert numbered_title("2 CONTRATTO N. 497/C KAIRUS") == (2, "CONTRATTO N. 497/C KAIRUS")
    assert numbered_title("Melothis Harbor   13") == (13, "Melothis Harbor")
    assert title_like("Melothis Forgotten Harbor") and not title_like("sees the river.") and not title_like("the river bends")


def test_misread():
    for bad, good in (("drovvsy", "drowsy"), ("witliin", "within"), ("c0pper", "copper"), ("arnong", "among"), ("week1y", "weekly"), ("eng!ne", "engine"), ("liftſ", "lifts"), ("neeclle", "needle"), ("miriutes", "minutes"), ("planef", "planet")):
        assert misread_of(bad, good) and skeleton(bad) == skeleton(good)
    assert not misread_of("river", "river") and not misread_of("cold", "gold")
    assert odd_number("l81") and odd_number("2S7") and not odd_number("12") and not odd_number("SOS") and not odd_number("3d6")
    assert odd_letters("dela6or") and not odd_letters("ABC5") and not odd_letters("E9QUGLH0YVJ44MREPK")
    assert words("giorn! (fine!)") == ["giorn", "fine"] or words("giorn! (fine!)") == ["giorn!", "fine"]
    assert joined("hea", "vily.") == ("hea", "vily", "heavily", "hea-vily")
    assert split_pairs("a hea-\nvily b\n- 1 -\nx¬ \n2 end-") == [(2, 5, 7, 11)]


def corpus(spark):
    pages, regions = [], []
    n = 0
    for p in range(1, 9):
        body = COMMON * 6
        if p == 3:
            body += "The captain hea-\nvily armed a self-\nmade hunter, witliin l81 gardens c0pper\n"
        head = "" if p == 1 else ("Silver River Codex\n" if p % 2 else "The Winter Captain\n" if p != 4 else "THE  W1NTER CAPTAIN\n")
        text = f"{head}{body}- {p + 10} -"
        pages.append((p, "d", p, text, None if p == 5 else text, 1, "x"))
        for i, line in enumerate([head.strip(), body.strip("\n"), f"- {p + 10} -"]):
            n += 1
            regions.append((n, "d", p, i, "a", line or None, "k"))
    pages.append((90, "d", 9, None, None, 1, "x"))
    pages.append((91, None, None, "", "   \n ", 1, "x"))
    return spark.createDataFrame(pages, PAGES), spark.createDataFrame(regions, REGIONS)


def test_corpus(spark):
    pages, regions = corpus(spark)
    got = {(r["field"], r["row_id"], r["line_no"], r["noise"]) for r in noise_rows(pages, regions).collect()}
    full = {x[1:] for x in got if x[0] == FIELDS[0]}
    assert {(p, n) for p, i, n in full if n == "header"} == {(p, "header") for p in range(2, 9)}
    assert {(p, n) for p, i, n in full if n == "page_number"} == {(p, "page_number") for p in range(1, 9)}
    assert (3, 13, "hyphen") in full and not any(n == "hyphen" and i == 14 for _, i, n in full)
    assert (3, 15, "char") in full
    assert {x[1:] for x in got if x[0] == FIELDS[1]} == {x for x in full if x[0] != 5}
    assert sum(x[3] == "header" for x in got if x[0] == FIELDS[2]) == 7
    assert sum(x[3] == "page_number" for x in got if x[0] == FIELDS[2]) == 8


def test_repair_and_empty(spark):
    pages, regions = corpus(spark)
    text = {r["row_id"]: r["text"] for r in repaired(pages, regions).where("field = 'pages.full_text'").collect()}[3]
    assert "captain heavily armed a self-made hunter, within 181 gardens" in text and "Codex" not in text and "- 13 -" not in text
    assert find_noise(pages.where("false"), regions.where("false")).lines.count() == 0
    assert noise_rows(pages.where("false"), regions).count() > 0
    assert repair("", []) == "" and repair("a\n\nb", []) == "a\nb"


def test_titles_with_lost_letters(spark):
    """A running title with letters lost, which no folding of misread characters brings back, is one by its edit distance; a heading
    of other words at the same place is none."""
    pages = []
    for p in range(1, 11):
        head = {6: "Th Book of Ancent Traits\n", 7: "The Works of Ancient Giants\n"}.get(p, "The Book of Ancient Traits\n" if p % 2 == 0 else "")
        pages.append((p, "d", p, head + COMMON * 3, None, 1, "x"))
    regions = spark.createDataFrame([], REGIONS)
    got = noise_rows(spark.createDataFrame(pages, PAGES), regions).where("noise = 'header'").collect()
    assert {(r["row_id"], r["line_no"]) for r in got} == {(p, 0) for p in (2, 4, 6, 8, 10)}
