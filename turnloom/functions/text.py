"""Text normalisation as native columns (no Python UDF)."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's str.strip has it: as a pattern, and its characters.
_WS = r"[\s\x1c-\x1f\x85\xa0]"
_SPACES = "".join(chr(i) for i in range(0x10000) if chr(i).isspace())


def strip(c: Column) -> Column:
    """Without white space at both ends (Unicode white space, unlike trim)."""
    return F.btrim(c.cast("string"), F.lit(_SPACES))


def ident(c: Column) -> Column:
    """A scalar as stripped text; null as ''."""
    return strip(F.coalesce(c.cast("string"), F.lit("")))


def integer(c: Column) -> Column:
    """A whole number or null; text is stripped first."""
    return strip(c.cast("string")).try_cast("bigint")


def _residue() -> tuple[list[tuple[str, str]], list[tuple[str, str]]]:
    """Case folding beyond lower-casing, from Unicode itself: (one to one, one to many)."""
    one, many = [], []
    for point in range(0x80, 0x110000):
        if 0xD800 <= point < 0xE000:
            continue
        low = chr(point).lower()
        if len(low) == 1 and low == chr(point) and low.casefold() != low:
            (one if len(low.casefold()) == 1 else many).append((low, low.casefold()))
    return one, many


_ONE, _MANY = _residue()
_PAIRS = json.dumps([{"a": a, "b": b} for a, b in _MANY])


def _any_of(points: list[int]) -> str:
    """A pattern of one of the code points, neighbours as ranges.

    Those beyond Latin-1 stand behind a test of one range: a class of many ranges is slow,
    and most letters never come to it.
    """

    def ranges(some: list[int]) -> str:
        out: list[list[int]] = []
        for p in sorted(some):
            if out and p == out[-1][1] + 1:
                out[-1][1] = p
            else:
                out.append([p, p])
        return "[" + "".join(f"\\x{{{a:x}}}" + (f"-\\x{{{b:x}}}" if b > a else "") for a, b in out) + "]"

    near, far = [p for p in points if p < 0x100], [p for p in points if p >= 0x100]
    return "|".join(([ranges(near)] if near else []) + ([rf"(?![\x00-\xff]){ranges(far)}"] if far else []))


_SPECIAL = _any_of([ord(a) for a, _ in _ONE + _MANY])
#: The one of them that is common in texts, and the others.
_COMMON = "ß"
_RARE = _any_of([ord(a) for a, _ in _ONE + _MANY if a != _COMMON])


def casefold(c: Column) -> Column:
    """Full Unicode case folding; the long chain of replacements is for texts with rare letters alone."""
    low = F.lower(c)
    single = F.translate(low, "".join(a for a, _ in _ONE), "".join(b for _, b in _ONE))
    pairs = F.from_json(F.lit(_PAIRS), "array<struct<a:string,b:string>>")
    full = F.aggregate(pairs, single, lambda s, p: F.replace(s, p["a"], p["b"]))
    return F.when(~low.rlike(_SPECIAL), low).when(~low.rlike(_RARE), F.replace(low, F.lit(_COMMON), F.lit(_COMMON.casefold()))).otherwise(full)


def semantic(c: Column) -> Column:
    """Comparison form: stripped, white space runs as one space, case folded."""
    # a run that is one space already is no match
    return casefold(F.regexp_replace(ident(c), rf"(?U){_WS}(?:(?<! )|(?={_WS})){_WS}*", " "))


def filled(c: Column) -> Column:
    """The text, or null where it is empty."""
    return F.nullif(c, F.lit(""))
