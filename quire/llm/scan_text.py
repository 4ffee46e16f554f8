"""Line-level rules for text from scanned pages: running titles, page numbers, misread characters, hyphens (problem 5).

Plain functions without Spark; ``scan_noise`` applies them over a cluster.
"""

from __future__ import annotations

import re

# fixed values: what scanners read for a letter, a digit or a group of letters
READ_FOR_LETTER = {"0": "o", "1": "li", "5": "s", "9": "g", "6": "b", "8": "b", "!": "il", "@": "a", "$": "s", "|": "il", "ſ": "s"}
READ_FOR_GROUP = {"vv": "w", "rn": "m", "ri": "n", "ii": "u", "li": "h", "cl": "d", "c": "e", "l": "i", "f": "t"}
DIGIT_OF_LETTER = {"o": "0", "O": "0", "l": "1", "I": "1", "S": "5", "B": "8", "Z": "2", "s": "5", "g": "9", "i": "1"}
PAGE_WORDS = {"page", "pagina", "pag", "pg", "p", "seite", "s", "blatt", "folio", "f"}
HYPHENS = "-‐¬"

HYPHEN_END = re.compile(rf"[{HYPHENS}][^\S\n]*\n")
WORD = re.compile(r"[!@$|]?[^\W_](?:[^\W_]|[!@$|̀-ͯ])*")
_FOLD = str.maketrans({"0": "o", "1": "i", "l": "i", "!": "i", "|": "i", "5": "s", "$": "s", "9": "g", "6": "b", "8": "b", "@": "a", "ſ": "s", "f": "t", "c": "e"})
_EXPAND = (("w", "vv"), ("m", "rn"), ("n", "ri"), ("u", "ii"), ("h", "li"), ("d", "cl"))


def skeleton(word: str) -> str:
    """A form that a word and its misread spellings have in common."""
    word = word.lower()
    for a, b in _EXPAND:
        word = word.replace(a, b)
    return word.translate(_FOLD)


def misread_of(word: str, right: str) -> bool:
    """Whether word can come from right by misread characters, at least one (case aside)."""
    word, right = word.lower(), right.lower()
    if word == right:
        return False
    states = {0}  # positions in right reached after a prefix of word
    n = len(word)
    reach: list[set[int]] = [set() for _ in range(n + 1)]
    reach[0] = states
    for i in range(n):
        one, two = word[i], word[i : i + 2]
        for j in reach[i]:
            c = right[j : j + 1]
            if not c:
                continue
            if one == c or c in READ_FOR_LETTER.get(one, "") or READ_FOR_GROUP.get(one) == c:
                reach[i + 1].add(j + 1)
            if len(two) == 2 and READ_FOR_GROUP.get(two) == c:
                reach[i + 2].add(j + 1)
    return len(right) in reach[n]


def words(token: str) -> list[str]:
    """The words and numbers in a token (a stretch without white space); punctuation at the end is none of it."""
    out = []
    for m in WORD.finditer(token):
        w = m[0]
        rest = token[m.end() :]
        while w and w[-1] in "!|$@" and not (w[-1] == "@" or rest[:1].isalnum()):
            w = w[:-1]
        if w[:1] in "!@$|" and m.start() and token[m.start() - 1].isalnum():
            w = w[1:]
        if w:
            out.append(w)
    return out


def odd_number(w: str) -> bool:
    """Digits with letters that are read for digits among them, and no other: l81, 2S7, 28O, lO2."""
    digits = sum(c.isdigit() for c in w)
    return 0 < digits < len(w) <= 9 and all(c.isdigit() or c in "lIOSB" for c in w)


def odd_letters(w: str) -> bool:
    """A word of letters with one or two signs or digits that are read for letters inside: eng!ne, dela6or, c0pper."""
    odd = [c for c in w if not c.isalpha()]
    if not odd or len(w) < 4 or len(odd) > 2 or len(odd) * 3 > len(w) or len(w) > 30:
        return False
    if not all(c in READ_FOR_LETTER for c in odd):
        return False
    letters = "".join(c for c in w if c.isalpha())
    plain = letters.islower() or letters.isupper() or letters[0].isupper() and letters[1:].islower()
    return plain and not (w[-1].isdigit() and letters.isalpha() and w[: len(letters)] == letters and letters.isupper())


def number_value(token: str) -> int | None:
    """The number a token stands for, misread digits included; None if it is none."""
    if not token or len(token) > 9 or not any(c.isdigit() or c in "lIO" for c in token):
        return None
    out = "".join(c if c.isdigit() else DIGIT_OF_LETTER.get(c, "?") for c in token)
    return int(out) if out.isascii() and out.isdigit() else None


_ALONE = re.compile(r"^\W*(?:([^\W\d_]+)(?:\.\s*|\s+))?([0-9lIOoSsBZg]{1,9})(?:\s*(?:/|of|di|von)\s*[0-9lIOoSsBZg]{1,9})?[^\w.,;:)]*$")
_LEAD = re.compile(r"^\W*([0-9lIOoSsBZg]{1,9})\s+(\D.*)$")
_TRAIL = re.compile(r"^(.*\D)\s+([0-9lIOoSsBZg]{1,9})\W*$")


def page_number_alone(line: str) -> int | None:
    """The number of a line that holds nothing but a page number, a page word and signs."""
    spaced = re.sub(r"(?<=\d) (?=\d)", "", line.strip())
    m = _ALONE.match(spaced)
    if not m or (m[1] and m[1].lower() not in PAGE_WORDS and not any(misread_of(m[1], p) for p in ("page", "pagina", "pag", "seite"))):
        return None
    if not any(c.isdigit() for c in m[2]) and not (len(m[2]) < 4 and set(m[2]) <= set("lIO") and "l" in m[2]):
        return None
    return number_value(m[2])


def numbered_title(line: str) -> tuple[int, str] | None:
    """(number, rest) of a line that begins or ends with a number and has letters besides."""
    line = line.strip()
    m = _LEAD.match(line)
    if m and any(c.isdigit() for c in m[1]) and (v := number_value(m[1])) is not None:
        return v, m[2].strip()
    m = _TRAIL.match(line)
    if m and any(c.isdigit() for c in m[2]) and (v := number_value(m[2])) is not None:
        return v, m[1].strip()
    return None


def title_like(line: str) -> bool:
    """A short line without a sentence's end whose longer words begin with capitals."""
    line = line.strip()
    if not line or len(line) > 200 or line[-1] in ".,;:!?-‐¬…" or "\t" in line or "|" in line:
        return False
    long = [w for w in re.findall(r"[^\W_]+", line) if len(w) > 2 and not w.isdigit()]
    letters = [w for w in re.findall(r"[^\W_]+", line) if not w.isdigit()]
    return bool(letters) and len(letters) <= 40 and all(w[0].isupper() or w[0] in "0158" for w in (long or letters))


def title_key(line: str) -> str:
    """What a running title keeps under misreading, spacing, case and punctuation."""
    return skeleton("".join(c for c in line if c.isalnum() or c in "!@$|"))


def split_pairs(text: str) -> list[tuple[int, int, int, int]]:
    """(start and end of the part before the hyphen, start and end of the token after the line end) of every line that ends in
    a hyphen behind a letter and is followed by a line that begins with one."""
    out = []
    for m in HYPHEN_END.finditer(text):
        i, j = m.start(), m.end()
        if i == 0 or not (text[i - 1].isalpha() or text[i - 1] in "!@$|01568"):
            continue
        while j < len(text) and text[j] in " \t":
            j += 1
        if j >= len(text) or not (text[j].isalpha() or text[j] in "!@$|01568"):
            continue
        a = i
        while a and not text[a - 1].isspace():
            a -= 1
        k = j
        while k < len(text) and not text[k].isspace():
            k += 1
        out.append((a, i, j, k))
    return out


def outer(token: str) -> tuple[str, str, str]:
    """(signs before, core, signs after) of a token."""
    core = token.strip(".,;:!?()[]«»“”\"'’…")
    if not core:
        return token, "", ""
    i = token.index(core)
    return token[:i], core, token[i + len(core) :]


def compound(token: str) -> str | None:
    """The token as a compound with hyphens in one form, None if it is none."""
    core = outer(token)[1].lower()
    parts = re.split(f"[{HYPHENS}]", core)
    return "-".join(parts) if len(parts) > 1 and all(p[:1].isalpha() for p in parts) else None


def joined(left: str, right: str) -> tuple[str, str, str, str]:
    """(last word of left, first word of right, the word they form, the compound they form), in lower case."""
    a = re.split(r"[^\w!@$|]+", left)[-1]
    found = words(right)
    b = found[0] if found else ""
    return a, b, (a + b).lower(), f"{outer(left)[1]}-{outer(right)[1]}".lower()


def like_case(right: str, pattern: str) -> str:
    """right in the letter case of pattern."""
    letters = [c for c in pattern if c.isalpha()]
    if len(letters) > 1 and all(c.isupper() for c in letters):
        return right.upper()
    return right[:1].upper() + right[1:] if pattern[:1].isupper() or letters and letters[0].isupper() and not pattern[:1].isalpha() else right


def plain_number(w: str) -> str:
    return "".join(c if c.isdigit() else DIGIT_OF_LETTER.get(c, c) for c in w)


def plain_letters(w: str) -> str:
    return "".join(READ_FOR_LETTER[c][0] if c in READ_FOR_LETTER else c for c in w)
