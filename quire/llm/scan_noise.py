"""Noise in text from scanned pages (problem 5), over all texts of a corpus.

Headers and footers are found by the fuzzy repetition of lines at page edges: by edit distance between near pages, under a
form that common misreadings leave alone. Page numbers are found by their sequence; lines are joined, and misread words put right, by the vocabulary of the whole corpus.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.lookalikes import FORMS, SUSPECT, unify
from quire.llm.scan_text import (
    compound,
    joined,
    like_case,
    misread_of,
    numbered_title,
    odd_letters,
    odd_number,
    outer,
    page_number_alone,
    plain_letters,
    plain_number,
    skeleton,
    split_pairs,
    title_key,
    title_like,
    words,
)
from quire.operators.skew import salted_lookup
from quire.storage import shared_table

TRUSTED, TRUSTED_CHARS = 200_000, 40  # bound of the broadcast set of frequent tokens; all others are looked up by a join
FLUSH = 400_000
NEAR, EDITS = 6, 8  # a line is a misread title if one within 6 pages differs in one of 8 characters at most
RATIO = 20  # a word of letters alone is misread if the word it stands for is that much more frequent
_SUSPECT = re.compile(SUSPECT)


def _survey(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of tokens (kind t) and of word halves at line ends (p), the lines at page edges (e), and pages (s) with the first
    and last place (order_idx, line_no) of their regions that are not blank."""
    memo: dict = {}
    tokens: Counter = Counter()
    pairs: Counter = Counter()
    edges: list[tuple] = []
    spots: dict[tuple, list] = {}
    columns = ["kind", "a", "b", "n", "f", "row_id", "doc_id", "page_no", "order_idx", "line_no", "edge", "alone", "num", "rest", "full"]

    def edge(row: tuple, where: str, line_no: int, line: str) -> None:
        alone = page_number_alone(line)
        title = alone is None and title_like(line)
        found = numbered_title(line) if title else None
        if alone is None and not title:
            return
        f, row_id, doc_id, page_no, order_idx = row
        num, rest = (found[0], title_key(found[1])) if found and len(title_key(found[1])) > 3 else (None, None)
        edges.append(("e", None, None, None, f, row_id, doc_id, page_no, order_idx, line_no, where, alone, num, rest, title_key(line) if title else None))

    def flush() -> pd.DataFrame:
        blank = (None,) * 11
        out = [("t", t, None, n, *blank) for t, n in tokens.items() if n > 0] + [("p", l, r, n, *blank) for (l, r), n in pairs.items()] + edges
        out += [("s", None, None, None, None, None, doc_id, page_no, lo, hi, None, None, None, None, None) for (doc_id, page_no), (lo, hi) in spots.items()]
        spots.clear()
        tokens.clear()
        pairs.clear()
        edges.clear()
        frame = pd.DataFrame(out, columns=columns)
        return frame.astype({c: "Int64" for c in ("n", "f", "row_id", "page_no", "order_idx", "line_no", "alone", "num")})

    for pdf in batches:
        for f, row_id, doc_id, page_no, order_idx, text in zip(*(pdf[c].tolist() for c in ("f", "row_id", "doc_id", "page_no", "order_idx", "text")), strict=True):
            if _SUSPECT.search(text):
                text = unify(text, FORMS, memo)[0]
            tokens.update(text.split())
            for a, i, j, k in split_pairs(text):
                left, right = text[a:i], text[j:k]
                pairs[left, right] += 1
                end = i
                while end < j and not text[end].isspace():
                    end += 1
                tokens[text[a:end]] -= 1
                tokens[right] -= 1
            row = (f, row_id, doc_id, page_no, order_idx)
            body = text.strip()
            if f != 1:
                spot = spots.setdefault((doc_id, page_no), [None, None])
                if f == 2 and body:
                    spot[:] = [order_idx if spot[0] is None else min(spot[0], order_idx), order_idx if spot[1] is None else max(spot[1], order_idx)]
            if f < 2:
                if body:
                    before = text[: text.index(body[0])].count("\n")
                    edge(row, "first", before, body.partition("\n")[0])
                    if "\n" in body:
                        edge(row, "last", before + body.count("\n"), body.rpartition("\n")[2])
            else:
                if body and "\n" not in body:
                    edge(row, "region", text[: text.index(body[0])].count("\n"), body)
        if len(tokens) + len(pairs) + len(edges) + len(spots) > FLUSH:
            yield flush()
    yield flush()


_SURVEY = "kind string, a string, b string, n long, f int, row_id long, doc_id string, page_no int, order_idx int, line_no int, edge string, alone long, num long, rest string, full string"


def _token_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for raw, n in zip(pdf["a"].tolist(), pdf["n"].tolist(), strict=True):
            for w in words(raw):
                if not w.isdigit():
                    out.append((raw, "w", w.lower(), n, odd_number(w) or odd_letters(w)))
            c = compound(raw)
            if c:
                out.append((raw, "c", c, n, False))
        yield pd.DataFrame(out, columns=["raw", "kind", "word", "n", "odd"])


def _pair_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        done = [joined(a, b) for a, b in zip(pdf["a"].tolist(), pdf["b"].tolist(), strict=True)]
        yield pd.DataFrame({"l": pdf["a"], "r": pdf["b"], "n": pdf["n"], "lw": [d[0] for d in done], "rw": [d[1] for d in done], "word": [d[2] for d in done], "comp": [d[3] for d in done], "odd": [odd_letters(d[0] + d[1]) for d in done]})


def _folded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        w = pdf["word"].tolist()
        yield pdf.assign(sk=[skeleton(x) for x in w], clean=[x.isalpha() and "ſ" not in x for x in w])


def _confirmed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        keep = []
        for word, n, clean, right, best in zip(*(pdf[c].tolist() for c in ("word", "n", "clean", "right", "best")), strict=True):
            often = not clean or best >= RATIO * n or (("vv" in word or "ii" in word) and best >= 3 * n)
            keep.append(often and misread_of(word, right))
        yield pdf.loc[keep, ["word", "right"]]


def _bad_tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """raw, fixed: the token with its misread words put right."""
    for pdf in batches:
        out = []
        for raw, bad, rights in zip(pdf["raw"].tolist(), pdf["words"].tolist(), pdf["rights"].tolist(), strict=True):
            known = dict(zip(bad, rights, strict=True))
            fixed = raw
            for w in words(raw):
                right = known.get(w.lower())
                if right:
                    fixed = fixed.replace(w, like_case(right, w), 1)
                elif w.lower() in known:
                    fixed = fixed.replace(w, plain_number(w) if odd_number(w) else plain_letters(w), 1)
            out.append(fixed)
        yield pd.DataFrame({"raw": pdf["raw"], "n": pdf["n"], "fixed": out})


def _bad_pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Which halves of a split word are misread, and what left and right parts become."""
    for pdf in batches:
        rows = []
        for l, r, lw, rw, right, odd, hyphen in zip(*(pdf[c].tolist() for c in ("l", "r", "lw", "rw", "right", "odd", "hyphen")), strict=True):
            in_left = in_right = False
            whole = l + r if hyphen else f"{l}-{r}"
            if right:
                in_right = right.startswith(lw.lower())
                in_left = not in_right
                if in_left and not right.endswith(rw.lower()) and not any(misread_of(lw, right[:i]) and right[i:] == rw.lower() for i in range(len(right))):
                    in_right = True
                if hyphen:
                    whole = l[: len(l) - len(lw)] + like_case(right, lw) + r[r.index(rw) + len(rw) :]
            elif odd:
                in_left, in_right = not lw.isalpha(), not rw.isalpha()
                if hyphen:
                    whole = l[: len(l) - len(lw)] + plain_letters(lw + rw) + r[r.index(rw) + len(rw) :]
            rows.append((in_left, in_right, whole))
        yield pdf[["l", "r", "n", "hyphen"]].assign(in_left=[x[0] for x in rows], in_right=[x[1] for x in rows], whole=[x[2] for x in rows])


def _suspects(trusted) -> object:
    """Tokens outside the trusted set and split words, each with its line."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = trusted.value
        memo: dict = {}
        for pdf in batches:
            out = []
            for f, row_id, text in zip(pdf["f"].tolist(), pdf["row_id"].tolist(), pdf["text"].tolist(), strict=True):
                if _SUSPECT.search(text):
                    text = unify(text, FORMS, memo)[0]
                halves = split_pairs(text)
                odd = set(text.split()) - known
                if not odd and not halves:
                    continue
                edges: dict[int, int] = {}
                line, at = 0, 0
                for a, i, j, k in halves:
                    line += text.count("\n", at, i)
                    at = i
                    out.append((f, row_id, line, "p", text[a:i], text[j:k]))
                    edges[line] = edges.get(line, 0) | 1  # the last token of this line and the first of the next are halves
                    edges[line + 1] = edges.get(line + 1, 0) | 2
                if odd:
                    for number, content in enumerate(text.split("\n")):
                        here = content.split()
                        if not here or odd.isdisjoint(here):
                            continue
                        side = edges.get(number, 0)
                        here = here[1 if side & 2 else 0 : -1 if side & 1 else None]
                        out += [(f, row_id, number, "t", t, None) for t in dict.fromkeys(here) if t in odd]
            yield pd.DataFrame(out, columns=["f", "row_id", "line_no", "kind", "a", "b"]).astype({"f": "int32", "line_no": "int32"})

    return run


@dataclass
class Noise:
    """lines: f, row_id, line_no, noise (hyphen, char, header, page_number), one row each. fixes: f, row_id, line_no, kind (t, p,
    drop), old, new for the repair."""

    lines: DataFrame
    fixes: DataFrame


def corpus_texts(pages: DataFrame, regions: DataFrame) -> DataFrame:
    """f (0 full_text, 1 canonical_text, 2 regions.text), row_id, doc_id, page_no, order_idx, text of all texts but null ones.
    A null doc_id is a file of its own for each row."""
    cols = lambda df, f, row, text, order: df.select(F.lit(f).alias("f"), F.col(row).cast("long").alias("row_id"), F.coalesce(F.col("doc_id"), F.concat(F.lit("?"), F.col(row).cast("string"))).alias("doc_id"), F.coalesce(F.col("page_no"), F.lit(0)).cast("int").alias("page_no"), order.cast("int").alias("order_idx"), F.col(text).alias("text"))
    order = F.coalesce(F.col("order_idx"), F.lit(-1))
    every = cols(pages, 0, "page_id", "full_text", F.lit(-1)).unionByName(cols(pages, 1, "page_id", "canonical_text", F.lit(-1))).unionByName(cols(regions, 2, "region_id", "text", order))
    return every.where("text is not null and row_id is not null")


def _like_titles(known: DataFrame) -> DataFrame:
    """doc_id, edge, key, page_no, title: what a line's key counts as, its own or that of a more frequent line at the same edge of
    a page at most NEAR pages away that differs in one of every EDITS characters at most.

    Lines meet by equality of file, edge and page, so a line meets those of 2 * NEAR + 1 pages.
    """
    lines = known.where("key is not null and key <> ''").select("doc_id", "edge", "key", "page_no").distinct()
    often = lines.groupBy("doc_id", "edge", "key").agg(F.count("*").alias("times"))
    lines = shared_table(salted_lookup(lines, often.withColumn("c", F.col("times")), ["doc_id", "edge", "key"], "c", F.col("page_no")), "title-lines")
    titles = lines.where("times > 1").select("doc_id", "edge", F.explode(F.sequence(F.col("page_no") - NEAR, F.col("page_no") + NEAR)).alias("page_no"), F.col("key").alias("title"), F.col("times").alias("more")).distinct()
    allowed = F.floor(F.length("key") / EDITS).cast("int")
    alike = lines.join(titles, ["doc_id", "edge", "page_no"]).where((F.col("key") != F.col("title")) & (F.col("more") > F.col("times")) & (F.abs(F.length("key") - F.length("title")) <= allowed))
    alike = alike.where((F.levenshtein("key", "title") <= allowed) & (F.regexp_replace("key", r"[^\d]", "") == F.regexp_replace("title", r"[^\d]", "")))
    best = alike.groupBy("doc_id", "edge", "key").agg(F.max_by("title", F.struct("more", "title")).alias("title"), F.count("*").alias("c"))
    return best.select("doc_id", "edge", "key", "title")


def _edge_noise(survey: DataFrame) -> DataFrame:
    """f, row_id, line_no, header, page_number of the running lines."""
    edges = survey.where("kind = 'e'").select("f", "row_id", "doc_id", "page_no", "order_idx", "line_no", "edge", "alone", "num", "rest", "full")
    spots = survey.where("kind = 's'").groupBy("doc_id", "page_no").agg(F.min("order_idx").alias("lo"), F.max("line_no").alias("hi"))
    spots = shared_table(spots, "spots")
    span = spots.where("lo is not null")
    region = edges.where("edge = 'region'").drop("edge").join(span, ["doc_id", "page_no"]).withColumn("edge", F.expr("case when order_idx = lo then 'first' when order_idx = hi then 'last' end")).drop("lo", "hi")
    edges = shared_table(edges.where("edge <> 'region'").unionByName(region.where("edge is not null")), "edges")
    sizes = edges.groupBy("doc_id").agg(F.count("*").alias("c"))
    value = F.coalesce("alone", "num")
    shifts = edges.where(value.isNotNull()).select("doc_id", "page_no", (value - F.col("page_no")).alias("shift")).distinct()
    shifts = shifts.groupBy("doc_id", "shift").agg(F.count("*").alias("k")).groupBy("doc_id").agg(F.max_by("shift", F.struct("k", -F.abs("shift"), "shift")).alias("shift"))
    files = spots.groupBy("doc_id").agg(F.count("*").alias("pages"), F.min("page_no").alias("opening"))
    about = shared_table(sizes.join(shifts, "doc_id", "left").join(files, "doc_id"), "files")
    numbered = (value - F.col("page_no")).eqNullSafe(F.col("shift")) & value.isNotNull()
    known = salted_lookup(edges, about, ["doc_id"], "c", F.col("row_id")).withColumn("is_num", numbered)
    known = known.withColumn("key", F.when(F.col("num").isNotNull() & F.col("is_num"), F.col("rest")).otherwise(F.col("full")))
    known = shared_table(known, "edges-known")
    alike = shared_table(_like_titles(known), "title-forms")
    forms = known.where("key is not null").groupBy("doc_id", "edge", "key").agg(F.count("*").alias("n")).join(alike, ["doc_id", "edge", "key"])
    changed = salted_lookup(known.where("key is not null"), forms, ["doc_id", "edge", "key"], "n", F.col("row_id")).withColumn("key", F.col("title")).drop("title")
    same = known.join(alike.select("doc_id", "edge", "key"), ["doc_id", "edge", "key"], "left_anti")
    known = shared_table(same.unionByName(changed), "edges-titles")
    on = known.where("key is not null and key <> ''").select("doc_id", "edge", "key", "page_no", "pages", "opening").distinct()
    later = F.col("page_no") > F.col("opening")
    odd = F.col("page_no") % 2 != 0
    side = lambda cond, n: [F.count_if(cond).alias(f"n{n}"), F.min(F.when(cond, F.col("page_no"))).alias(f"a{n}"), F.max(F.when(cond, F.col("page_no"))).alias(f"b{n}")]
    stats = on.groupBy("doc_id", "edge", "key").agg(*side(later & ~odd, "e"), *side(later & odd, "o"), *side(F.lit(True), "x"), F.first("pages").alias("pages"))
    need = "case when pages <= 12 then 2 else 3 end"
    one = lambda n, m: f"(n{n} >= {need} and n{n} >= 0.9 * (n{n} + n{m}) and n{n} >= 0.5 * ((b{n} - a{n}) / 2 + 1))"
    every = "((nx >= 3 or (nx = 2 and pages <= 3)) and nx >= 0.6 * (bx - ax + 1) and nx >= 0.5 * pages)"
    titles = stats.where(f"{one('e', 'o')} or {one('o', 'e')} or {every}").select("doc_id", "edge", "key", F.lit(True).alias("running"))
    counts = known.where("key is not null").groupBy("doc_id", "edge", "key").agg(F.count("*").alias("c"))
    titles = shared_table(titles.join(counts, ["doc_id", "edge", "key"]), "titles")
    running = salted_lookup(known, titles, ["doc_id", "edge", "key"], "c", F.col("row_id")).where("page_no > opening").select("f", "row_id", "line_no", F.lit(True).alias("header"), F.col("is_num").alias("page_number"))
    counted = known.where("is_num").select("f", "row_id", "line_no", F.col("num").isNotNull().alias("header"), F.lit(True).alias("page_number"))
    return running.unionByName(counted).groupBy("f", "row_id", "line_no").agg(F.bool_or("header").alias("header"), F.bool_or("page_number").alias("page_number"))


def find_noise(pages: DataFrame, regions: DataFrame) -> Noise:
    """The noise of all texts of pages (full_text, canonical_text) and regions (text, all engines).

    hyphen: the line ends in a hyphen (- ‐ ¬) inside a word that goes on in the next line; not where the compound with this
    hyphen is more frequent in the corpus than the joined word. char: the line has a word that can come by misreading from
    a much more frequent one with the same skeleton, a word of letters with a digit or sign read for a letter, or a number
    with letters read for digits. header: a line at a page's edge whose skeleton recurs in the file as running titles do: on
    one side of the opening (pages of one parity) or on most pages; never on the file's first page; or a title with
    the page's number. page_number: the line gives the number that the file's numbering (the most frequent difference of
    printed and physical numbers) gives the page. Null and blank texts have no noise; repeated rows count once; an empty
    corpus gives no rows.

    Python passes twice over the text in Arrow batches: once to count tokens within the task, once to emit tokens outside
    a broadcast set of at most 200,000 frequent ones. All else is joins and aggregations of vocabulary entries, line-end
    halves and edge lines; rows of a hot token or file are split over tasks.
    """
    spark = pages.sparkSession
    texts = corpus_texts(pages, regions)
    survey = shared_table(texts.mapInPandas(_survey, _SURVEY), "survey")
    edge = shared_table(_edge_noise(survey), "running")
    counts = survey.where("kind in ('t', 'p')").groupBy("kind", "a", "b").agg(F.sum("n").alias("n"))
    counts = shared_table(counts, "tokens")
    tokens = counts.where("kind = 't'")
    parts = shared_table(tokens.select("a", "n").mapInPandas(_token_words, "raw string, kind string, word string, n long, odd boolean"), "token-words")
    vocabulary = shared_table(parts.groupBy("kind", "word").agg(F.sum("n").alias("n")), "vocabulary")
    of = lambda k, key, name: vocabulary.where(F.col("kind") == k).select(F.col("word").alias(key), F.col("n").alias(name))
    pairs = counts.where("kind = 'p'").select("a", "b", "n").mapInPandas(_pair_words, "l string, r string, n long, lw string, rw string, word string, comp string, odd boolean")
    pairs = pairs.join(of("w", "word", "n_word"), "word", "left").join(of("c", "comp", "n_comp"), "comp", "left")
    pairs = shared_table(pairs.withColumn("hyphen", F.coalesce("n_comp", F.lit(0)) <= F.coalesce("n_word", F.lit(0))), "pairs")
    entries = vocabulary.where("kind = 'w'").select("word", "n").unionByName(pairs.where("hyphen").select("word", "n")).groupBy("word").agg(F.sum("n").alias("n"))
    folded = shared_table(entries.mapInPandas(_folded, "word string, n long, sk string, clean boolean"), "folded")
    best = folded.where("clean").groupBy("sk").agg(F.max_by(F.struct(F.col("word").alias("right"), F.col("n").alias("best")), F.struct("n", "word")).alias("b")).select("sk", "b.right", "b.best")
    wrong = folded.join(best, "sk").where("word <> right").select("word", "n", "clean", "right", "best").mapInPandas(_confirmed, "word string, right string")
    wrong = shared_table(wrong, "misread")
    bad = parts.where("kind = 'w'").join(wrong, "word", "left").where("odd or right is not null")
    bad = bad.groupBy("raw").agg(F.max("n").alias("n"), F.collect_list("word").alias("words"), F.collect_list(F.coalesce("right", F.lit(""))).alias("rights"))
    bad = shared_table(bad.mapInPandas(_bad_tokens, "raw string, n long, fixed string"), "bad-tokens")
    judged = pairs.join(wrong, "word", "left").mapInPandas(_bad_pairs, "l string, r string, n long, hyphen boolean, in_left boolean, in_right boolean, whole string")
    judged = shared_table(judged, "bad-pairs")
    frequent = tokens.where(F.length("a") <= TRUSTED_CHARS).join(bad, tokens["a"] == bad["raw"], "left_anti").orderBy(F.desc("n"), "a").limit(TRUSTED)
    trusted = spark.sparkContext.broadcast({r["a"] for r in frequent.select("a").collect()})
    seen = shared_table(texts.select("f", "row_id", "text").mapInPandas(_suspects(trusted), "f int, row_id long, line_no int, kind string, a string, b string"), "suspects")
    odd = salted_lookup(seen.where("kind = 't'").withColumnRenamed("a", "raw"), bad, ["raw"], "n", F.col("row_id")).select("f", "row_id", "line_no", F.lit("t").alias("kind"), F.col("raw").alias("old"), F.lit(None).cast("string").alias("next"), F.col("fixed").alias("new"), F.array(F.struct(F.lit("char").alias("noise"), F.lit(0).alias("d"))).alias("x"))
    marks = F.array_compact(F.array(F.when(F.col("hyphen"), F.struct(F.lit("hyphen").alias("noise"), F.lit(0).alias("d"))), F.when(F.col("in_left"), F.struct(F.lit("char").alias("noise"), F.lit(0).alias("d"))), F.when(F.col("in_right"), F.struct(F.lit("char").alias("noise"), F.lit(1).alias("d")))))
    split = salted_lookup(seen.where("kind = 'p'").withColumnsRenamed({"a": "l", "b": "r"}), judged, ["l", "r"], "n", F.col("row_id")).select("f", "row_id", "line_no", F.lit("p").alias("kind"), F.col("l").alias("old"), F.col("r").alias("next"), F.col("whole").alias("new"), marks.alias("x"))
    found = shared_table(odd.unionByName(split), "noise")
    lines = found.select("f", "row_id", "line_no", F.explode("x").alias("x")).select("f", "row_id", (F.col("line_no") + F.col("x.d")).alias("line_no"), "x.noise")
    running = edge.select("f", "row_id", "line_no", F.explode(F.array_compact(F.array(F.when(F.col("header"), F.lit("header")), F.when(F.col("page_number"), F.lit("page_number"))))).alias("noise"))
    kinds = lines.unionByName(running).groupBy("f", "row_id", "line_no").agg(F.collect_set("noise").alias("k"))
    title = F.array_contains("k", "header") | F.array_contains("k", "page_number")
    lines = kinds.select("f", "row_id", "line_no", F.explode(F.when(title, F.array_remove("k", "char")).otherwise(F.col("k"))).alias("noise"))
    drops = edge.select("f", "row_id", "line_no", F.lit("drop").alias("kind"), F.lit(None).cast("string").alias("old"), F.lit(None).cast("string").alias("next"), F.lit(None).cast("string").alias("new"))
    return Noise(lines, found.select("f", "row_id", "line_no", "kind", "old", "next", "new").unionByName(drops))


FIELDS = ("pages.full_text", "pages.canonical_text", "regions.text")


def noise_rows(pages: DataFrame, regions: DataFrame) -> DataFrame:
    """p5_found: field, row_id, line_no, noise."""
    field = F.element_at(F.array(*map(F.lit, FIELDS)), F.col("f") + 1)
    return find_noise(pages, regions).lines.select(field.alias("field"), "row_id", "line_no", "noise")


def repair(text: str, fixes: list[tuple]) -> str:
    """Paragraphs of a text: running lines dropped, misread tokens replaced, split words and lines joined. A paragraph ends at
    an empty line, after a line that ends a sentence and is clearly shorter than the longest, and around table rows,
    headings and formulas."""
    lines = text.split("\n")
    drop = {f[0] for f in fixes if f[1] == "drop"}
    pairs = {f[0]: (f[2], f[3], f[4]) for f in fixes if f[1] == "p"}
    tokens: dict[int, dict[str, str]] = {}
    for f in fixes:
        if f[1] == "t":
            tokens.setdefault(f[0], {})[f[2]] = f[4]
    width = max((len(x) for x in lines), default=0)
    out: list[str] = []
    current: list[str] = []
    carried: str | None = None

    def close() -> None:
        if current:
            out.append(" ".join(current))
            current.clear()

    for i, line in enumerate(lines):
        if i in drop:
            continue
        if "\t" in line or " | " in line:
            close()
            out.append(line)
            continue
        here = line.split()
        if not here:
            close()
            continue
        swap = tokens.get(i, {})
        here = [swap.get(t, t) for t in here]
        if carried is not None:
            here[0] = carried
            carried = None
        if i in pairs and i + 1 < len(lines) and i + 1 not in drop:
            carried = pairs[i][2]
            current += here[:-1]
            continue
        heading = title_like(line) and len(line) < 60 and not (current and current[-1][-1:] not in ".!?…:»”")
        if heading:
            close()
            out.append(" ".join(here))
            continue
        current += here
        if here[-1][-1:] in ".!?…" and len(line) < 0.75 * width:
            close()
    if carried is not None:
        current.append(carried)
    close()
    return "\n".join(out)


def _repaired(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    memo: dict = {}
    for pdf in batches:
        out = []
        for text, fixes in zip(pdf["text"].tolist(), pdf["fixes"].tolist(), strict=True):
            if _SUSPECT.search(text):
                text = unify(text, FORMS, memo)[0]
            out.append(repair(text, [] if fixes is None else [tuple(x[k] for k in ("line_no", "kind", "old", "next", "new")) for x in fixes]))
        yield pd.DataFrame({"f": pdf["f"], "row_id": pdf["row_id"], "text": out})


def repaired(pages: DataFrame, regions: DataFrame) -> DataFrame:
    """field, row_id, text: every text in continuous paragraphs; null texts have no row."""
    noise = find_noise(pages, regions)
    fixes = noise.fixes.groupBy("f", "row_id").agg(F.collect_list(F.struct("line_no", "kind", "old", "next", "new")).alias("fixes"))
    texts = corpus_texts(pages, regions).select("f", "row_id", "text").join(fixes, ["f", "row_id"], "left")
    field = F.element_at(F.array(*map(F.lit, FIELDS)), F.col("f") + 1)
    return texts.mapInPandas(_repaired, "f int, row_id long, text string").select(field.alias("field"), "row_id", "text")
