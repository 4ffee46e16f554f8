"""Numbers and identifiers in text."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: the patterns of numbers and identifiers ([0-9], as Java and RE2 must agree), and the base of speeds
NUMBER = r"[-+]?\s*[0-9][0-9.,]*"
IDENTIFIER = r"[A-Za-z0-9][A-Za-z0-9.,/\\-]*[A-Za-z0-9]|[A-Za-z0-9]"
BASE_SPEED = 30


def one_minus(c: Column) -> Column:
    """The minus signs of print as the ASCII one."""
    return F.translate(c, "−–—", "---")


def number_value(c: Column) -> Column:
    """The double a number token stands for: of two kinds of separators the last is the decimal one; a lone comma is decimal; lone
    dots are thousands if there are two or more, or one with three digits behind and at most three before. Null if no number."""
    comma, dot = c.contains(","), c.contains(".")
    last_comma = F.instr(F.reverse(c), ",") < F.instr(F.reverse(c), ".")
    parts = F.split(c, r"\.")
    thousands = (F.size(parts) > 2) | ((F.size(parts) == 2) & (F.length(parts[1]) == 3) & (F.length(parts[0]) <= 3))
    plain = F.when(comma & dot & last_comma, F.replace(F.replace(c, F.lit("."), F.lit("")), F.lit(","), F.lit("."))).when(comma & dot, F.replace(c, F.lit(","), F.lit(""))).when(comma, F.replace(c, F.lit(","), F.lit("."))).when(dot & thousands, F.replace(c, F.lit("."), F.lit(""))).otherwise(c)
    return F.when(plain.rlike(r"^[-+]?[0-9]+\.?[0-9]*$"), plain.cast("double"))


def signed_numbers(c: Column) -> Column:
    """All numbers of a text with their signs, in order; unreadable ones dropped; null gives an empty array."""
    found = F.regexp_extract_all(one_minus(c), F.lit(f"({NUMBER})"), F.lit(1))
    return F.coalesce(F.array_compact(F.transform(found, lambda t: number_value(F.replace(t, F.lit(" "), F.lit(""))))), F.array().cast("array<double>"))


def identifier_tokens(c: Column) -> Column:
    """Tokens with at least one digit: numbers, dates, identifiers."""
    found = F.regexp_extract_all(one_minus(c), F.lit(f"({IDENTIFIER})"), F.lit(1))
    return F.coalesce(F.filter(found, lambda t: t.rlike("[0-9]")), F.array().cast("array<string>"))


def json_numbers(c: Column) -> Column:
    """All numbers that are values of a JSON text, at any depth, in order; keys and strings do not count."""
    bare = F.regexp_replace(c, r'"(\\.|[^"\\])*"', "")
    found = F.regexp_extract_all(bare, F.lit(r"(-?[0-9]+(?:\.[0-9]+)?(?:[eE][-+]?[0-9]+)?)"), F.lit(1))
    return F.transform(F.coalesce(found, F.array().cast("array<string>")), lambda t: t.cast("double"))


def witnesses_py(value: object, base: int = BASE_SPEED) -> list[list[float]]:
    """For each number in a JSON value, at any depth, the numbers of a quote that can witness it: itself, and for the amount of
    a speed bonus also its sum with the base. Booleans are no numbers."""
    out, todo = [], [(value, False)]
    while todo:
        v, derived = todo.pop()
        if isinstance(v, dict):
            todo += [(x, v.get("kind") == "speed_bonus" and k == "amount") for k, x in v.items()]
        elif isinstance(v, list):
            todo += [(x, False) for x in v]
        elif isinstance(v, (int, float)) and not isinstance(v, bool):
            out.append([float(v), float(v) + base] if derived else [float(v)])
    return out


@F.pandas_udf(T.ArrayType(T.ArrayType(T.DoubleType())))
def witnesses(s: pd.Series) -> pd.Series:
    """``witnesses_py`` of JSON texts; null for null and for text that is no JSON."""

    def one(v: str | None) -> list | None:
        try:
            return None if v is None else witnesses_py(json.loads(v))
        except (ValueError, RecursionError, OverflowError):
            return None

    return s.map(one)
