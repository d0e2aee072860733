"""Cleaning of ids and short text values as native column expressions.

Every function maps null to null and never raises on any string.
"""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that stand for "no value".
PLACEHOLDERS = ("none", "null", "nan", "n/a", "na", "-", "--", "unknown", "unknown date", "undefined")

#: Characters that print nothing: format characters, variation selectors, joiners, fillers, NUL.
INVISIBLE = r"[\p{Cf}\x{FE00}-\x{FE0F}\x{34F}\x{115F}\x{1160}\x{17B4}\x{17B5}\x{3164}\x{FFA0}\x{0}]+"
_EDGES = r"^[\s\p{Z}\p{Cc}]+|[\s\p{Z}\p{Cc}]+$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_id(c: Column | str) -> Column:
    """Id without invisible characters and surrounding white space; empty becomes null."""
    c = _col(c)
    cleaned = F.regexp_replace(F.regexp_replace(c, INVISIBLE, ""), _EDGES, "")
    return F.when(c.rlike(r"^[!-~]+$"), c).otherwise(F.nullif(cleaned, F.lit("")))


def clean_line(c: Column | str) -> Column:
    """One line of text: no invisible characters, white space runs become one blank."""
    stripped = F.regexp_replace(_col(c), INVISIBLE, "")
    return F.trim(F.regexp_replace(stripped, r"[\s\p{Z}\p{Cc}]+", " "))


def clean_text(c: Column | str, multiline: bool = False) -> Column:
    """Text or null: invisible characters go, placeholders and blanks become null.

    With ``multiline`` line breaks stay and at most one blank line is kept.
    """
    return stated(clean_lines(c) if multiline else clean_line(c))


def clean_lines(c: Column | str) -> Column:
    """Lines of text: no invisible characters, single blanks, at most one blank line."""
    t = F.regexp_replace(_col(c), INVISIBLE, "")
    t = F.regexp_replace(t, r"\r\n?", "\n")
    t = F.regexp_replace(t, r"[^\S\n]|[\p{Z}&&[^\n]]", " ")
    t = F.regexp_replace(F.regexp_replace(t, r" {2,}", " "), r" ?\n ?", "\n")
    return F.regexp_replace(F.regexp_replace(t, r"\n{3,}", "\n\n"), r"^\s+|\s+$", "")


def stated(t: Column) -> Column:
    """A cleaned text, or null where it is empty or a placeholder."""
    return F.when((t != "") & ~F.lower(t).isin(*PLACEHOLDERS), t)


_UNUSABLE = r"(?i)^[\s\p{Z}\p{C}]*(?:" + "|".join(w.replace(" ", r"\s+") for w in sorted(PLACEHOLDERS, key=len, reverse=True)) + r")?[\s\p{Z}\p{C}]*$"


def usable(c: Column | str) -> Column:
    """True unless the text is null, blank or a placeholder word. Never null."""
    return F.coalesce(~_col(c).rlike(_UNUSABLE), F.lit(False))


def usable_year(c: Column | str) -> Column:
    """True unless the year is null or 0. Never null."""
    return F.coalesce(_col(c) != 0, F.lit(False))


@cache
def fold_table() -> tuple[str, str]:
    """Single characters and the ASCII letter they fold to, by Unicode decomposition."""
    special = {"ł": "l", "Ł": "L", "ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ı": "i", "ħ": "h", "ð": "d", "’": "'"}
    src, dst = [], []
    for cp in [*range(0xA0, 0x250), *range(0x1E00, 0x1F00), *range(0xFF01, 0xFF5F), 0x2010, 0x2011, 0x212B, 0x2019]:
        ch = chr(cp)
        base = special.get(ch) or "".join(x for x in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(x))
        if len(base) == 1 and base != ch and " " <= base <= "~":
            src.append(ch)
            dst.append(base)
    return "".join(src), "".join(dst)


def fold(c: Column | str) -> Column:
    """Comparison key: clean line, lower case, without accents, widths and extra blanks."""
    t = F.translate(_col(c), *fold_table())
    for a, b in (("ß", "ss"), ("æ", "ae"), ("Æ", "ae"), ("œ", "oe"), ("Œ", "oe")):
        t = F.replace(t, F.lit(a), F.lit(b))
    return clean_line(F.lower(F.regexp_replace(t, r"\p{M}+", "")))
