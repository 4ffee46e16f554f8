"""Text that looks the same but is written with other characters (problem 3).

The script set of every letter of a token is intersected over the token; an empty intersection marks a mixed-script token,
which is respelt in the one script that all of its foreign letters have look-alikes in. A token wholly of another script's
look-alikes is respelt where the tokens around it are Latin. Full-width forms, combining accents,
zero-width characters and special spaces are then brought to the ordinary form.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: letters of Greek and Cyrillic that look like a Latin letter, in the order of the Latin letters
GREEK = "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧ" "ανοικρυϲϳ"
GREEK_LATIN = "ABEZHIKMNOPTYX" "avoikpucj"
CYRILLIC = "АВЕЅІЈКМНОРСТУХҮԚԜЗӀ" "аеорсухѕіјԛԝһԁӏүвкмнтг"
CYRILLIC_LATIN = "ABESIJKMHOPCTYXYQW3I" "aeopcyxsijqwhdlybkmhtr"
TO_LATIN = {**dict(zip(GREEK, GREEK_LATIN, strict=True)), **dict(zip(CYRILLIC, CYRILLIC_LATIN, strict=True))}
FROM_LATIN = {"Grek": {}, "Cyrl": {}}
for _s, _a, _b in (("Grek", GREEK, GREEK_LATIN), ("Cyrl", CYRILLIC, CYRILLIC_LATIN)):
    for _x, _y in zip(_a, _b, strict=True):
        FROM_LATIN[_s].setdefault(_y, _x)

# fixed values: letters of Armenian and Cherokee that look like a Latin letter, in the order of the Latin letters
ARMENIAN, ARMENIAN_LATIN = "ցհոօզսՏԼՕՍ", "ghnoquSLOU"
CHEROKEE = "ᎪᏴᏟᎬᎻᎫᏦᏞᎷᏢᏒᏚᎢᏙᎳᏃ"
CHEROKEE_LATIN = "ABCEHJKLMPRSTVWZ"
for _s, _a, _b in (("Armn", ARMENIAN, ARMENIAN_LATIN), ("Cher", CHEROKEE, CHEROKEE_LATIN)):
    TO_LATIN.update(zip(_a, _b, strict=True))
    FROM_LATIN[_s] = dict(zip(_b, _a, strict=True))

# fixed values: code point ranges
ZERO_WIDTH = "\u200b-\u200f\u202a-\u202e\u2060-\u2064\ufeff"
COMBINING = "\u0300-\u036f\u1ab0-\u1aff\u1dc0-\u1dff\u20d0-\u20ff\ufe20-\ufe2f"
FULL_WIDTH = "\uff01-\uff60\uffe0-\uffe6"
SPACES = "\xa0\u1680\u2000-\u200a\u202f\u205f\u3000"
OTHER_LETTERS = "\u0370-\u03ff\u1f00-\u1fff\u0400-\u052f\u1c80-\u1c8f\u2de0-\u2dff\ua640-\ua69f\u0530-\u058f\u13a0-\u13ff"
SUSPECT = f"[{ZERO_WIDTH}{COMBINING}{FULL_WIDTH}{SPACES}{OTHER_LETTERS}]"


def _forms() -> dict[str, object]:
    return {
        "zero": re.compile(f"[{ZERO_WIDTH}]"),
        "space": re.compile(f"[{SPACES}]"),
        "mark": re.compile(f"[{COMBINING}]"),
        "wide": re.compile(f"[{FULL_WIDTH}]"),
        "token": re.compile(r"[^\W\d_]+"),
        "other": re.compile(f"[{OTHER_LETTERS}]"),
        "alike": re.compile(rf"(?<![^\W\d_])[{GREEK}{CYRILLIC}{ARMENIAN}{CHEROKEE}]+(?![^\W\d_])"),
    }


FORMS = _forms()
EVERY = frozenset({"Latn", "Grek", "Cyrl", "Armn", "Cher", "other"})
LATIN = frozenset({"Latn"})
NAMES = {"LATIN": "Latn", "FULLWIDTH": "Latn", "GREEK": "Grek", "CYRILLIC": "Cyrl", "ARMENIAN": "Armn", "CHEROKEE": "Cher"}


def scripts_of(c: str, memo: dict[str, frozenset[str]]) -> frozenset[str]:
    """The scripts a letter can belong to; signs that count as letters but belong to no script belong to all."""
    found = memo.get(c)
    if found is None:
        name = unicodedata.name(c, "")
        first = name.split(" ", 1)[0]
        none = unicodedata.category(c) in ("Lm", "Mn", "Mc") or first in ("MICRO", "OHM", "FEMININE", "MASCULINE")
        found = memo[c] = frozenset({NAMES[first]}) if first in NAMES else EVERY if none else frozenset({"other"})
    return found


def resolve(token: str, memo: dict[str, frozenset[str]]) -> tuple[str, str]:
    """(the token in one script, the kind of mixture: ``mixed`` for Greek or Cyrillic beside Latin, ``foreign`` for Armenian or
    Cherokee beside Latin, '' for none).

    A token whose script sets intersect is of one script and stays as it is. A mixed token is respelt in the script all its
    letters have a look-alike in: Latin if possible, else the most frequent script that works, else only the letters that
    have a Latin look-alike change.
    """
    sets = [scripts_of(c, memo) for c in token]
    if frozenset.intersection(EVERY, *sets):
        return token, ""
    used = [next(iter(s)) for s in sets if len(s) == 1]
    if "Latn" not in used or not set(used) & set(FROM_LATIN):
        return token, ""
    kind = "mixed" if "Grek" in used or "Cyrl" in used else "foreign"
    away = [len(s) == 1 and next(iter(s)) in FROM_LATIN for s in sets]
    if not all(c in TO_LATIN for c, x in zip(token, away, strict=True) if x):
        for script in sorted({u for u in used if u in FROM_LATIN}, key=lambda u: (-used.count(u), u)):
            back = FROM_LATIN[script]
            if all(script in s or c in back for c, s in zip(token, sets, strict=True)):
                return "".join(c if script in s else back[c] for c, s in zip(token, sets, strict=True)), kind
    return "".join(TO_LATIN.get(c, c) if x else c for c, x in zip(token, away, strict=True)), kind


def whole_script(words: list[str], memo: dict[str, frozenset[str]]) -> list[int]:
    """The places of words that are wholly of another script's look-alikes of Latin letters and stand among Latin words: the
    nearest words of two letters or more before and after, such words themselves aside, are of Latin script, at least one of them is there, and
    no other word of the text is of the look-alikes' script."""
    script: list[str | None] = []
    alike = []
    for w in words:
        common = LATIN if w.isascii() else frozenset.intersection(EVERY, *(scripts_of(c, memo) for c in w))
        script.append(next(iter(common)) if len(common) == 1 else None)
        alike.append(script[-1] in FROM_LATIN and all(c in TO_LATIN for c in w))
    sure = {s for s, x in zip(script, alike, strict=True) if not x}
    out = []
    before: str | None = None
    after: list[str | None] = [None] * len(words)
    following: str | None = None
    for i in range(len(words) - 1, -1, -1):
        after[i] = following
        following = following if alike[i] or script[i] is None or len(words[i]) < 2 else script[i]
    for i in range(len(words)):
        if alike[i] and script[i] not in sure and {x for x in (before, after[i]) if x} == {"Latn"}:
            out.append(i)
        if not alike[i] and script[i] is not None and len(words[i]) > 1:
            before = script[i]
    return out


def unify(text: str, forms: dict, memo: dict[str, frozenset[str]]) -> tuple[str, str]:
    """(text in the consistent form, the kinds of forms found, separated by commas)."""
    kinds = [k for k in ("zero", "space", "mark", "wide") if forms[k].search(text)]
    if "zero" in kinds:
        text = forms["zero"].sub("", text)
    if "space" in kinds:
        text = forms["space"].sub(" ", text)
    if "wide" in kinds:
        text = forms["wide"].sub(lambda m: unicodedata.normalize("NFKC", m[0]), text)
    if "mark" in kinds:
        text = unicodedata.normalize("NFC", text)
    if forms["other"].search(text):
        found = set()

        def one(m: re.Match) -> str:
            if not forms["other"].search(m[0]):
                return m[0]
            word, kind = resolve(m[0], memo)
            found.add(kind)
            return word

        text = forms["token"].sub(one, text)
        if forms["alike"].search(text):
            places = list(forms["token"].finditer(text))
            for i in reversed(whole_script([m[0] for m in places], memo)):
                m = places[i]
                text = text[: m.start()] + "".join(TO_LATIN[c] for c in m[0]) + text[m.end() :]
                found.add("whole")
        kinds += [k for k in ("mixed", "foreign", "whole") if k in found]
    return text, ",".join(kinds)


@F.pandas_udf(T.StructType().add("text", T.StringType()).add("kinds", T.StringType()))
def _unify_udf(s: pd.Series) -> pd.DataFrame:
    memo: dict[str, frozenset[str]] = {}
    out = [(None, None) if t is None else unify(t, FORMS, memo) for t in s.tolist()]
    return pd.DataFrame(out, columns=["text", "kinds"])


def suspect(c: Column) -> Column:
    """Whether a text has a character that may have to be unified; ASCII texts, known by their size, are not searched."""
    return F.coalesce((F.octet_length(c) > F.length(c)) & c.rlike(SUSPECT), F.lit(False))


def consistent_text(df: DataFrame, text: str) -> DataFrame:
    """df with ``text_norm`` and ``kinds`` (array of zero, space, mark, wide, mixed, foreign, whole that were found).

    Spaces other than the ordinary one become it (line ends and tabs stay), zero-width characters go, full-width forms
    become ordinary ones, letters with combining accents are composed, letters of another script in a Latin word become
    the Latin look-alike (mixed; foreign where the script is Armenian or Cherokee). A word wholly of look-alikes of Latin
    letters becomes Latin where the words around it say so (whole; ``whole_script``), and is ordinary elsewhere. Composed accents, quotation marks, hyphens, ſ and signs such as ½ stay. Null gives null and no
    kinds; empty text stays empty. One scan: texts without any such character (one regular expression in the JVM) do not go to Python.
    """
    rows = df.withColumn("__odd", suspect(F.col(text))).withColumn("__u", _unify_udf(F.when(F.col("__odd"), F.col(text))))
    kinds = F.when(F.col("__odd"), F.filter(F.split("__u.kinds", ","), lambda k: k != "")).otherwise(F.array().cast("array<string>"))
    return rows.withColumns({"text_norm": F.when(F.col("__odd"), F.col("__u.text")).otherwise(F.col(text)), "kinds": kinds}).drop("__odd", "__u")


def consistent_rows(df: DataFrame, tbl: str, row_id: str, text: str) -> DataFrame:
    """tbl, row_id, text_norm, kinds of every row of one table."""
    out = consistent_text(df.select(F.col(row_id).alias("row_id"), F.col(text).alias("text")), "text")
    return out.select(F.lit(tbl).alias("tbl"), "row_id", "text_norm", "kinds")


ORDINARY = ("foreign", "whole")  # kinds that p3_found takes for ordinary


def odd_rows(df: DataFrame, tbl: str, row_id: str, text: str) -> DataFrame:
    """p3_found of one table: tbl, row_id of the rows whose text holds a form to be unified."""
    odd = df.select(F.col(row_id).alias("row_id"), F.col(text).alias("text")).where(suspect(F.col("text")))
    return consistent_text(odd, "text").where(F.size(F.array_except("kinds", F.array(*map(F.lit, ORDINARY)))) > 0).select(F.lit(tbl).alias("tbl"), "row_id")


# Java and RE2 both know these classes
FOUND = r"[\x{200B}-\x{200F}\x{202A}-\x{202E}\x{2060}-\x{2064}\x{FEFF}\x{0300}-\x{036F}\x{1AB0}-\x{1AFF}\x{1DC0}-\x{1DFF}\x{20D0}-\x{20FF}\x{FE20}-\x{FE2F}\x{FF01}-\x{FF60}\x{FFE0}-\x{FFE6}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{202F}\x{205F}\x{3000}]|\p{Latin}\pL*[\p{Greek}\p{Cyrillic}]|[\p{Greek}\p{Cyrillic}]\pL*\p{Latin}"
P3_SQL = f"""
select 'regions' as tbl, region_id as row_id from regions where regexp_matches(text, '{FOUND}')
union all select 'extractions', ext_id from extractions where regexp_matches(quote, '{FOUND}')
"""
