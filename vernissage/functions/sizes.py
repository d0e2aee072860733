"""Sizes written in text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vernissage.functions.scalars import let
from vernissage.functions.text import INVISIBLE, _col

#: Vulgar fractions and the fraction each stands for.
FRACTIONS = {"½": "1/2", "¼": "1/4", "¾": "3/4", "⅓": "1/3", "⅔": "2/3", "⅛": "1/8", "⅜": "3/8", "⅝": "5/8", "⅞": "7/8"}

NUM = r"(?:\d+(?:\.\d+)?(?: \d+/\d+)?|\d+/\d+)"
UNIT = r"(?:millimet(?:re|er)s?|centimet(?:re|er)s?|zentimeter|met(?:re|er)s?|inch(?:es)?|feet|foot|mm|cm|dm|ft|in|m|\"|'')"
ONE = rf"(?:{NUM} ?(?:'(?!')|ft|feet|foot)(?: ?{NUM} ?(?:\"|''|in(?:ch(?:es)?)?)?)?|{NUM} ?{UNIT}?)"


def size_text(c: Column, brackets: bool = False) -> Column:
    """Size text in plain characters: fractions written out, decimal points, no second size in brackets."""
    t = F.lower(F.regexp_replace(c, INVISIBLE, ""))
    for ch, frac in FRACTIONS.items():
        t = F.replace(t, F.lit(ch), F.lit(f" {frac}"))
    t = F.translate(t, "″”“′’", "\"\"\"''")
    t = F.regexp_replace(t, r"[\s\p{Z}]+", " ")
    t = F.regexp_replace(t, r"(?<=\d),(?=\d{1,2}(?!\d))", ".")
    t = F.regexp_replace(t, r"(?<=\d),(?=\d{3}(?!\d))", "")
    if brackets:
        return F.trim(t)
    return F.trim(F.regexp_replace(t, r"(?<=[\w\".] ?)\(.*$", ""))


def written_number(text: Column) -> Column:
    """Whole, decimal and fractional parts of ``12``, ``12.5``, ``12 1/2`` or ``1/2``."""
    whole = F.regexp_extract(text, r"^(\d+(?:\.\d+)?)(?![\d/.])", 1)
    num = F.regexp_extract(text, r"(\d+)/(\d+)", 1).try_cast("decimal(6,0)")
    den = F.regexp_extract(text, r"(\d+)/(\d+)", 2).try_cast("decimal(6,0)")
    part = F.when(den != 0, (num / den).cast("decimal(14,6)"))
    w = whole.try_cast("decimal(14,6)")
    return F.when(w.isNotNull() | part.isNotNull(), F.coalesce(w, F.lit(0)) + F.coalesce(part, F.lit(0)))


#: Units in millimetres; only these are read in running text.
MILLIMETRES = {"mm": "1", "cm": "10", "dm": "100", "m": "1000", "in": "25.4", "ft": "304.8"}
_METRIC = ("mm", "cm", "dm", "m")
_UNIT_NAMES = {"millimetre": "mm", "millimeter": "mm", "centimetre": "cm", "centimeter": "cm", "zentimeter": "cm", "metre": "m", "meter": "m", "inch": "in", "inche": "in", "feet": "ft", "foot": "ft", '"': "in", "''": "in"}
#: Words that say which side a number is.
SIDES = {"h": "h height high hauteur haut hohe hoch altezza alto altura ht".split(), "w": "w width wide l length largeur large larg breite breit b larghezza anchura ancho largura".split(), "d": "d depth deep profondeur prof tiefe profondita profundidad".split()}
#: Centimetres outside these bounds are no side of an object.
LEAST_CM, MOST_CM = 0.3, 2000.0

_TOKEN = rf"{NUM}|[a-z]+|[×\"]|''"
_LENGTH = r"n\S+(?: [hwd])?(?: u\w+)?"


def size_tokens(t: Column) -> Column:
    """A size text as words with a mark: ``n`` and a number, ``u`` and a unit, ``x``, ``h``, ``w`` or ``d``; others are ``o``."""

    def read(w: Column, one: Column) -> Column:
        out = F.when(w.rlike(r"^\d"), F.concat(F.lit("n"), F.replace(w, F.lit(" "), F.lit("_")))).when(w.isin("x", "×", "by", "per", "mal"), "x")
        for side, words in SIDES.items():
            out = out.when(w.isin(*words), side)
        out = out.when(w.isin(*MILLIMETRES), F.concat(F.lit("u"), w))
        for name, unit in _UNIT_NAMES.items():
            out = out.when((one == name) | (w == name), f"u{unit}")
        return out.otherwise("o")

    def marked(w: Column) -> Column:
        return let(F.regexp_replace(w, "s$", ""), lambda one: read(w, one))

    plain = F.translate(t, "äöüéèà", "aoueea")
    return F.array_join(F.transform(F.regexp_extract_all(plain, F.lit(_TOKEN), 0), marked), " ")


def _centimetres(number: Column, unit: Column) -> Column:
    def in_millimetres(u: Column) -> Column:
        factor = F.lit(None).cast("decimal(8,2)")
        for name, mm in MILLIMETRES.items():
            factor = F.when(u == name, F.lit(mm).cast("decimal(8,2)")).otherwise(factor)
        return factor

    written = let(F.replace(number, F.lit("_"), F.lit(" ")), written_number)
    return let(F.round(written * let(unit, in_millimetres) / 10, 1).cast("double"), lambda cm: F.when(cm.between(LEAST_CM, MOST_CM), cm))


def size_cm(c: Column | str) -> Column:
    """``struct(height, width, depth)`` in centimetres, rounded half up to 0.1.

    Of the sizes written ``a x b`` or ``a x b x c`` the first in a metric unit
    counts, else the first, among those whose sides are all possible. Without
    one the numbers beside the words for height, width and depth count, each
    in its own unit or the next one in the text.
    """
    none = F.struct(*[F.lit(None).cast("double").alias(side) for side in ("height", "width", "depth")])

    def box(words: Column) -> Column:
        lengths = F.split(words, " x ")
        last = F.try_element_at(F.regexp_extract_all(words, F.lit(r"u(\w+)"), 1), F.lit(-1))

        def sides(b: Column) -> Column:
            def side(i: int) -> Column:
                own = F.regexp_extract(F.get(b["lengths"], i), r"u(\w+)", 1)
                return _centimetres(F.regexp_extract(F.get(b["lengths"], i), r"n(\S+)", 1), let(own, lambda u: F.when(u != "", u).otherwise(b["last"])))

            return F.struct(side(0).alias("height"), side(1).alias("width"), side(2).alias("depth"), b["last"].isin(*_METRIC).alias("metric"), F.size(b["lengths"]).alias("n"))

        return let(F.struct(lengths.alias("lengths"), last.alias("last")), sides)

    def of_words(words: Column) -> Column:
        # A unit must close the size, or each side has its own.
        boxes = F.transform(F.regexp_extract_all(words, F.lit(rf"{_LENGTH} x {_LENGTH}(?: x {_LENGTH})?"), 0), box)
        return let(boxes, lambda found: of_boxes(words, found))

    def of_boxes(words: Column, found: Column) -> Column:
        possible = F.filter(found, lambda b: b["height"].isNotNull() & b["width"].isNotNull() & (b["depth"].isNotNull() | (b["n"] < 3)))
        chosen = let(possible, lambda p: F.coalesce(F.get(F.filter(p, lambda b: b["metric"]), 0), F.get(p, 0)))

        def labelled(side: str) -> Column:
            near = rf"\b{side}(?: o)? n(\S+)(?: [^u]\S*){{0,6}}? u(\w+)"
            return _centimetres(F.regexp_extract(words, near, 1), F.regexp_extract(words, near, 2))

        sides = F.struct(labelled("h").alias("height"), labelled("w").alias("width"), labelled("d").alias("depth"))
        boxed = let(chosen, lambda b: F.when(b.isNotNull(), F.struct(b["height"].alias("height"), b["width"].alias("width"), b["depth"].alias("depth"))))
        return F.coalesce(boxed, F.when(F.size(found) == 0, sides), none)

    return let(size_tokens(size_text(_col(c), brackets=True)), of_words)
