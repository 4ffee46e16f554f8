"""Text functions as column expressions; only non-ASCII text goes through Arrow."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def normalize_py(s: str | None) -> str:
    """Reference form of ``normalize``: NFKD, no combining marks, lower case, signs to blanks, blanks collapsed."""
    plain = "".join(c for c in unicodedata.normalize("NFKD", s or "") if not unicodedata.combining(c))
    return " ".join(re.sub(r"[^\w\s]", " ", plain.lower()).split())


@F.pandas_udf(T.StringType())
def _normalize_udf(s: pd.Series) -> pd.Series:
    return s.map(lambda v: None if v is None else normalize_py(v))


def normalize(c: Column) -> Column:
    """Text without accents, signs and letter case; null becomes ''. ASCII text stays in the JVM."""
    plain = F.trim(F.regexp_replace(F.regexp_replace(F.lower(c), r"[^a-z0-9_\s\x1c-\x1f]", " "), r"[\s\x1c-\x1f]+", " "))
    odd = c.rlike(r"[^\x00-\x7f]")
    return F.coalesce(F.when(odd, _normalize_udf(F.when(odd, c))).otherwise(plain), F.lit(""))


def tokens(c: Column) -> Column:
    """The [a-z0-9]+ tokens of the lower-case text."""
    return F.coalesce(F.regexp_extract_all(F.lower(c), F.lit("([a-z0-9]+)"), F.lit(1)), F.array().cast("array<string>"))


def slug(prefix: str, *parts: Column) -> Column:
    """prefix and the tokens of all parts joined by _, a token equal to the one before it left out."""
    every = F.concat(F.array(F.lit(prefix)), *[tokens(p) for p in parts])
    kept = F.filter(every, lambda x, i: (i == 0) | (x != F.get(every, i - 1)))
    return F.array_join(kept, "_")


def pattern_count(c: Column, pattern: str) -> Column:
    return F.coalesce(F.regexp_count(c, F.lit(pattern)), F.lit(0))


def estimate_tokens(c: Column) -> Column:
    """1.3 * (digits + signs + letters / 3) without a tokenizer."""
    n = lambda p: F.regexp_count(c, F.lit(p))
    return F.coalesce(1.3 * (n(r"[0-9]") + n(r"[^\p{L}\p{N}\s\p{Z}]") + n(r"\p{L}") / 3.0), F.lit(0.0))


def duration(seconds: Column) -> Column:
    """Seconds as ``12s``, ``3m 04s`` or ``2h 05m``."""
    s = F.floor(seconds).cast("int")
    return F.when(s < 60, F.format_string("%ds", s)).when(s < 3600, F.format_string("%dm %02ds", F.floor(s / 60).cast("int"), s % 60)).otherwise(F.format_string("%dh %02dm", F.floor(s / 3600).cast("int"), F.floor(s % 3600 / 60).cast("int")))


# fixed values: region labels of both engines and the types they stand for, and those that the second engine has besides
LABELS = {"text": "text", "title": "text", "header": "text", "footer": "text", "line": "text", "paragraph": "text", "reference": "text", "algorithm": "text", "table": "table", "table_title": "table", "formula": "formula", "stamp": "stamp", "seal": "stamp"}
SECOND_LABELS = {"sub_title": "text", "table_caption": "text", "table_footnote": "text", "image_caption": "text", "equation": "formula"}


def region_type(label: Column, second: bool = False) -> Column:
    """A label's region type; unknown labels and null are text. second: labels of the second engine count too."""
    pairs = [F.lit(x) for kv in {**LABELS, **(SECOND_LABELS if second else {})}.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.lower(F.trim(label))), F.lit("text"))
