"""Quantities in different units, brought to one canonical unit per kind.

Conversions are edges of a graph with affine functions ``y = a·x + b`` in exact
fractions. The shortest composition from every unit to its canonical target is
computed once on the driver (the graph has as many nodes as there are units and
notations, whatever the size of the data), every remaining edge closes a cycle
and is checked to agree, and the result is a small table with which recorded
values are equi-joined on their source unit.

Defined cases: an unknown unit, a value without a number and a null give no
row; a text that names its unit is right against a number field; a text
without one has the unit of its column, in ``dimensions`` it says nothing.
"""

from __future__ import annotations

from collections import defaultdict, deque
from collections.abc import Iterable
from dataclasses import dataclass, field
from decimal import Decimal
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vernissage.functions.sizes import NUM, ONE, UNIT, size_text, written_number
from vernissage.functions.text import clean_id, clean_line
from vernissage.operators.history import price_observations
from vernissage.session import small_rows, spread

#: A reference table of currencies with more rows than this is refused.
MAX_RATES = 10_000

#: Lengths, as (unit, other unit, factor).
LENGTHS = (("cm", "mm", "10"), ("m", "cm", "100"), ("in", "mm", "25.4"), ("ft", "in", "12"), ("in", "cm", "2.54"), ("ft", "cm", "30.48"), ("m", "mm", "1000"), ("dm", "cm", "10"), ("yd", "ft", "3"))

#: Ways in which length units are written.
LENGTH_NAMES = {
    "mm": ("millimetre", "millimetres", "millimeter", "millimeters"),
    "cm": ("centimetre", "centimetres", "centimeter", "centimeters", "zentimeter"),
    "m": ("metre", "metres", "meter", "meters"),
    "in": ("inch", "inches", '"', "''"),
    "ft": ("foot", "feet", "'"),
    "yd": ("yard", "yards"),
}

#: Subunits, as (notation, currency, parts of one).
SUBUNITS = (("EUR cents", "EUR", 100), ("euro ct", "EUR", 100), ("euro cents", "EUR", 100), ("US¢", "USD", 100), ("USD cents", "USD", 100), ("GBp", "GBP", 100), ("GBX", "GBP", 100), ("pence", "GBP", 100))

#: Other names of currencies.
CURRENCY_NAMES = {
    "EUR": ("€", "Euro", "Euros"),
    "USD": ("$", "US$", "U.S. Dollar", "US Dollar"),
    "GBP": ("£", "Pound sterling", "Pounds sterling", "GB£"),
    "SEK": ("Swedish krona", "Swedish kronor"),
    "CHF": ("SFr.", "SFr", "Swiss franc"),
    "CAD": ("CA$", "C$", "Can$", "Canadian Dollar"),
    "AUD": ("AU$", "A$", "Australian Dollar"),
    "JPY": ("¥", "円", "JP¥", "Yen"),
    "PLN": ("zł", "zl", "Polish zloty"),
}


@dataclass(frozen=True)
class Affine:
    a: Fraction = Fraction(1)
    b: Fraction = Fraction(0)

    def then(self, other: Affine) -> Affine:
        return Affine(other.a * self.a, other.a * self.b + other.b)

    def inverse(self) -> Affine:
        return Affine(1 / self.a, -self.b / self.a)


@dataclass
class UnitGraph:
    """Units as nodes, conversions as edges; ``tolerance`` is relative, for measured rates."""

    tolerance: Fraction = Fraction(0)
    edges: dict[str, list[tuple[str, Affine]]] = field(default_factory=lambda: defaultdict(list))

    def add(self, unit: str, other: str, a: str | int | Fraction, b: str | int | Fraction = 0) -> None:
        f = Affine(Fraction(a), Fraction(b))
        if f.a == 0:
            raise ValueError(f"{unit} → {other} cannot be inverted")
        self.edges[unit].append((other, f))
        self.edges[other].append((unit, f.inverse()))

    def compositions(self, target: str) -> dict[str, tuple[Affine, int]]:
        """Shortest composition of each unit that reaches ``target``, and its length.

        Raises ValueError where two ways from a unit to the target disagree.
        """
        known: dict[str, tuple[Affine, int]] = {target: (Affine(), 0)}
        todo = deque([target])
        while todo:
            node = todo.popleft()
            to_target, hops = known[node]
            for other, f in self.edges[node]:
                way = f.inverse().then(to_target)
                if other not in known:
                    known[other] = (way, hops + 1)
                    todo.append(other)
                    continue
                have = known[other][0]
                if abs(way.a - have.a) > self.tolerance * abs(have.a) or abs(way.b - have.b) > self.tolerance * max(1, abs(have.b)):
                    raise ValueError(f"conversions of {other!r} to {target!r} disagree: {float(way.a)} and {float(have.a)}")
        return known


def length_graph() -> UnitGraph:
    g = UnitGraph()
    for unit, other, a in LENGTHS:
        g.add(unit, other, a)
    for unit, names in LENGTH_NAMES.items():
        for name in names:
            g.add(name, unit, 1)
    return g


def currency_key(text: str) -> str:
    """Notation as compared: only ``GBp`` keeps its capitals, since it is not ``GBP``."""
    return text if text == "GBp" else text.lower()


def currency_graph(rates: Iterable[tuple[str, float]], canonical: str = "EUR") -> UnitGraph:
    """Graph of currencies, their subunits and notations; the target is the canonical's cent."""
    g = UnitGraph(tolerance=Fraction(1, 10**6))
    known = set()
    for code, rate in rates:
        if code is None or rate is None or not rate > 0:
            continue
        code = code.strip().upper()
        known.add(code)
        if code != canonical:
            g.add(currency_key(code), currency_key(canonical), Fraction(Decimal(repr(rate))))
    known.add(canonical)
    g.add(currency_key(canonical), "cent", 100)
    for notation, code, parts in SUBUNITS:
        if code in known:
            g.add(currency_key(notation), currency_key(code), Fraction(1, parts))
    for code, names in CURRENCY_NAMES.items():
        if code in known:
            for name in names:
                g.add(currency_key(name), currency_key(code), 1)
    return g


def conversion_table(spark: SparkSession, graph: UnitGraph, target: str, scale: int = 14) -> DataFrame:
    """``source_unit, target_unit, factor, shift, hops`` for the equi-join."""

    def dec(x: Fraction) -> Decimal:
        return (Decimal(x.numerator) / Decimal(x.denominator)).quantize(Decimal(1).scaleb(-scale))

    rows = [(u, target, dec(f.a), dec(f.b), hops) for u, (f, hops) in sorted(graph.compositions(target).items())]
    return spark.createDataFrame(rows, f"source_unit string, target_unit string, factor decimal(24,{scale}), shift decimal(24,{scale}), hops int")


def convert(df: DataFrame, value: str, unit: str, table: DataFrame, out: str = "common_value") -> DataFrame:
    """Adds ``out``: the value in the target unit, rounded half up to whole numbers.

    Rows whose unit is unknown are dropped. The table has one row per unit, so
    the broadcast does not grow with the data.
    """
    t = F.broadcast(table.select(F.col("source_unit").alias(unit), "factor", "shift"))
    exact = F.col(value).cast("decimal(14,4)") * F.col("factor") + F.col("shift")
    return df.join(t, unit).withColumn(out, F.round(exact, 0).cast("bigint")).drop("factor", "shift")


# ── sizes in text ───────────────────────────────────────────────────────────────

_SEP = r" ?(?:x|×|by|\*) ?"
_WIDTH_AFTER = rf"(?:^|[^a-zß-ÿ])(?:width|wide|breite|breedte|larghezza|largeur|anchura|ancho|largura|larg|[wbl])[. :]* ?({ONE})"
_WIDTH_BEFORE = rf"({ONE}) ?(?:width|wide|breit|w)(?![a-z])"
_SECOND = rf"^\D*?{ONE}{_SEP}({ONE})"
_LAST_UNIT = rf"{NUM} ?[wh]? ?({UNIT})[ .;,wh]*$"


def parse_widths(df: DataFrame, text: str = "text", default_unit: str = "default_unit") -> DataFrame:
    """Adds ``value, unit, named`` of the width the size text states; all null if it states none.

    Labels (W, wide, Breite, L. …) win; without them height comes first, then
    width. Feet and inches are added up to inches. ``named`` tells that the
    text itself names the unit. The steps are separate projections, so that no
    pattern is matched twice on one row.
    """
    keep = df.columns
    t = _staged(df, keep, _t=size_text(F.col(text)))
    t = _staged(t, [*keep, "_t"], _before=F.regexp_extract("_t", _WIDTH_BEFORE, 1), _after=F.regexp_extract("_t", _WIDTH_AFTER, 1), _second=F.regexp_extract("_t", _SECOND, 1), _trailing=F.regexp_extract("_t", _LAST_UNIT, 1))
    piece = F.when(F.col("_before") != "", F.col("_before")).when(F.col("_after") != "", F.col("_after")).otherwise(F.col("_second"))
    t = _staged(t, [*keep, "_trailing"], _piece=piece, _feet=F.regexp_extract(piece, rf"^({NUM}) ?(?:'(?!')|ft|feet|foot)", 1))
    rest = F.when(F.col("_feet") != "", F.regexp_replace("_piece", rf"^{NUM} ?(?:'(?!')|ft|feet|foot) ?", "")).otherwise(F.col("_piece"))
    t = _staged(t, [*keep, "_trailing", "_piece", "_feet"], _rest=rest)
    said = F.when(F.col("_feet") != "", F.lit("in")).when(F.regexp_extract("_rest", rf"({UNIT})$", 1) != "", F.regexp_extract("_rest", rf"({UNIT})$", 1)).when(F.col("_trailing") != "", F.col("_trailing"))
    number = F.when(F.col("_piece") != "", (12 * F.coalesce(written_number(F.col("_feet")), F.lit(0)) + F.coalesce(written_number(F.col("_rest")), F.lit(0))).cast("decimal(14,4)"))
    t = _staged(t, keep, value=number, _said=said)
    return t.select(*keep, "value", F.coalesce(F.col("_said"), F.col(default_unit)).alias("unit"), F.col("_said").isNotNull().alias("named"))


def _staged(df: DataFrame, keep: list[str], **new: Column) -> DataFrame:
    """A projection that later filters cannot be pushed through.

    Catalyst would repeat the patterns in every filter and projection above;
    generating the one element of an array evaluates them once per row.
    """
    return df.select(*keep, F.inline(F.array(F.struct(*[c.alias(n) for n, c in new.items()]))))


def recorded_widths(artworks: DataFrame) -> DataFrame:
    """One row per recorded width: ``platform_name, platform_artwork_id, width, unit, strength, prefer, width_cm``.

    ``strength`` orders the evidence: 3 a text naming its unit, 2 a number
    field in inches or a text in its column's unit, 1 ``width_cm``; ``prefer``
    orders equal evidence by its column.
    """
    cols = ["platform_name", "platform_artwork_id", "width_cm", "width_in", "dimensions_cm", "dimensions_in", "dimensions"]
    a = artworks.select(*cols).filter("width_cm is not null or width_in is not null or dimensions_cm is not null or dimensions_in is not null or dimensions is not null")
    a = spread(a).select("platform_name", clean_id("platform_artwork_id").alias("platform_artwork_id"), *cols[2:]).filter("platform_artwork_id is not null")
    width_cm = F.col("width_cm").try_cast("decimal(14,4)")
    none = F.lit(None)

    def said(prefer: int, text: Column, number: Column, unit: str | None) -> Column:
        return F.struct(F.lit(prefer).alias("prefer"), text.cast("string").alias("text"), number.try_cast("decimal(14,4)").alias("number"), F.lit(unit).cast("string").alias("default_unit"))

    records = F.array(said(5, F.col("dimensions_cm"), none, "cm"), said(4, F.col("dimensions_in"), none, "in"), said(3, F.col("dimensions"), none, None), said(2, none, F.col("width_in"), "in"), said(1, none, width_cm, "cm"))
    a = a.select("platform_name", "platform_artwork_id", width_cm.alias("width_cm"), F.inline(F.filter(records, lambda r: r["text"].isNotNull() | r["number"].isNotNull())))
    w = parse_widths(a)
    w = w.select(
        "platform_name", "platform_artwork_id", "width_cm", "prefer", F.coalesce("number", "value").alias("width"), "unit",
        F.when(F.col("number").isNotNull(), F.when(F.col("prefer") == 1, 1).otherwise(2)).when(F.col("named"), 3).otherwise(2).alias("strength"),
    )
    return w.filter("width > 0 and unit is not null")


#: Widths are compared on a logarithmic scale with steps of one percent, and agree within
#: two steps: the units confused here differ by a factor of 2.5 or more, rounding by far
#: less. The steps also bound what is kept of an artwork to a few thousand small numbers.
STEP, SAME_STEPS = 0.01, 2


def _step(mm: Column) -> Column:
    return F.when(mm > 0, F.round(F.ln(mm.cast("double")) / STEP).cast("int"))


def widths_to_convert(artworks: DataFrame) -> DataFrame:
    """``platform_name, platform_artwork_id, common_value`` (mm) of widths not in ``width_cm``."""
    spark = artworks.sparkSession
    mm = convert(recorded_widths(artworks), "width", "unit", conversion_table(spark, length_graph(), "mm"))
    best = F.max(F.struct("strength", "prefer", "common_value")).alias("best")
    one = mm.groupBy("platform_name", "platform_artwork_id").agg(best, F.collect_set(_step(F.col("width_cm") * 10)).alias("cm"))
    value = F.col("best.common_value")
    in_cm = F.exists("cm", lambda s: F.abs(s - F.coalesce(_step(value), F.lit(0))) <= SAME_STEPS)
    return one.filter(~in_cm).select("platform_name", "platform_artwork_id", value.alias("common_value"))


def currency_unit(c: Column | str) -> Column:
    """Key of a written currency for the join with the conversion table."""
    t = clean_line(c)
    return F.when(t == "GBp", t).otherwise(F.lower(t))


def prices_to_convert(artworks: DataFrame, ledger: DataFrame, rates: DataFrame, canonical: str = "EUR") -> DataFrame:
    """``platform_name, platform_artwork_id, common_value`` (cents) of latest prices not in the canonical currency."""
    spark = artworks.sparkSession
    graph = currency_graph([(r[0], r[1]) for r in small_rows(rates.select("currency", "eur_per_unit"), MAX_RATES, "fx_rates")], canonical)
    table = conversion_table(spark, graph, "cent")
    obs = price_observations(artworks, ledger)
    last = obs.groupBy("platform_name", "platform_id").agg(F.max(F.struct("crawl_date", "price", "currency")).alias("last"))
    own = [currency_key(x) for x in (canonical, *CURRENCY_NAMES.get(canonical, ()))]
    found = last.select("platform_name", F.col("platform_id").alias("platform_artwork_id"), "last.price", currency_unit("last.currency").alias("unit"))
    return convert(found.filter(~F.col("unit").isin(*own)), "price", "unit", table).select("platform_name", "platform_artwork_id", "common_value")
