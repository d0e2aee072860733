import datetime as dt
from decimal import Decimal
from fractions import Fraction

import pytest

from vernissage.operators import units

from .conftest import rows, utc

ART = (
    "platform_name string, platform_artwork_id string, width_cm double, width_in double, dimensions_cm string, dimensions_in string, dimensions string, "
    "crawl_date date, price decimal(14,2), currency string, has_detail boolean, crawled_at timestamp, source_file string, unit string, value string, text string"
)


def art(key, **x):
    base = dict.fromkeys(["width_cm", "width_in", "dimensions_cm", "dimensions_in", "dimensions", "price", "currency"]) | x
    return ("p", key, base["width_cm"], base["width_in"], base["dimensions_cm"], base["dimensions_in"], base["dimensions"], dt.date(2025, 1, 1), base["price"], base["currency"], True, utc(2025, 1, 1), "f", "u", "v", "t")


@pytest.mark.parametrize(
    "column, text, mm",
    [
        ("dimensions_in", "33 3/8 x 12½ in.", 318), ("dimensions_in", "9' x 9'9\"", 2972), ("dimensions_in", "3 ft by 2 ft 11 in", 889), ("dimensions_in", '8.9" H x 20.7" W', 526),
        ("dimensions_in", "34.7 W x 49.8 H in", 881), ("dimensions_in", "34.7 W x 49.8 Hin", 881), ("dimensions_in", "W 40 3/4 in; H 28⅝ in", 1035), ("dimensions_in", "28 3/8 X 33⅛ in. (72.1 X 84.1 cm.)", 841),
        ("dimensions_in", "41.9 X 17.1", 434), ("dimensions_in", "9.9 x 10 x 1.5", 254), ("dimensions_cm", "88,4 by 52,9cm", 529), ("dimensions_cm", "1280 by 1290 mm", 1290), ("dimensions_cm", "178 X 130", 1300),
        ("dimensions", "1.24 × 0.85 m", 850), ("dimensions", "139 cm wide, 140 cm high", 1390), ("dimensions", "H. : 119 cm ; L. : 85,5 cm", 855), ("dimensions", "Höhe 65 cm, Breite 135 cm", 1350),
        ("dimensions", "43 × 57", None), ("dimensions", "A3", None), ("dimensions", "variable", None), ("dimensions", "", None), ("dimensions_cm", "0 x 0 cm", None), ("dimensions_cm", "10 x 1,200 mm", 1200), ("dimensions", "x" * 5000, None),
    ],
)
def test_width_of_text(spark, column, text, mm):
    got = [r.common_value for r in units.widths_to_convert(spark.createDataFrame([art("a", **{column: text})], ART)).collect()]
    assert got == ([] if mm is None else [mm])


def test_a_named_unit_is_right_against_a_number(spark):
    a = spark.createDataFrame(
        [art("in", width_cm=20.6, dimensions_in="34.6 by 20.6 in"), art("mm", width_cm=1280.0, dimensions_cm="1 x 1280 mm"), art("m", width_cm=0.72, dimensions="64 by 72 cm"), art("ok", width_cm=152.0, dimensions_cm="126 X 152 cm"), art("both", width_cm=76.0, width_in=29.92), art("alone", width_in=29.92), art("cm", width_cm=10.0), art("none")],
        ART,
    )
    assert rows(units.widths_to_convert(a), "platform_artwork_id", "common_value") == [("alone", 760), ("in", 523), ("m", 720), ("mm", 1280)]


def test_evidence_of_several_rows(spark):
    a = spark.createDataFrame([art("a", width_in=10.0), art("a", width_cm=25.4), art("b", width_cm=100.0), art("b", dimensions_cm="5 x 100 mm")], ART)
    assert rows(units.widths_to_convert(a), "platform_artwork_id", "common_value") == [("b", 100)]


def test_prices(spark):
    led = spark.createDataFrame([("artworks", "p", dt.date(2025, 1, 1), "completed", "full")], "dataset string, source string, crawl_date date, status string, crawl_mode string")
    fx = spark.createDataFrame([("EUR", 1.0), ("GBP", 1.17), ("USD", 0.92), ("JPY", 0.0062), (None, 2.0), ("BAD", None)], "currency string, eur_per_unit double")
    given = {"EUR": None, " eur ": None, "€": None, "Euro": None, "EUR cents": 1000, "GBp": 1170, "gbp": 117000, "£": 117000, "US¢": 920, "円": 620, "XXX": None, None: None, "SEK": None}
    a = spark.createDataFrame([art(str(c), price=Decimal(1000), currency=c) for c in given], ART)
    got = dict(rows(units.prices_to_convert(a, led, fx), "platform_artwork_id", "common_value"))
    assert got == {str(c): v for c, v in given.items() if v is not None}


def test_half_cents_round_up(spark):
    led = spark.createDataFrame([("artworks", "p", dt.date(2025, 1, 1), "completed", "full")], "dataset string, source string, crawl_date date, status string, crawl_mode string")
    fx = spark.createDataFrame([("USD", 0.5)], "currency string, eur_per_unit double")
    a = spark.createDataFrame([art("a", price=Decimal("0.01"), currency="$"), art("b", price=Decimal("0.03"), currency="$")], ART)
    assert rows(units.prices_to_convert(a, led, fx), "platform_artwork_id", "common_value") == [("a", 1), ("b", 2)]


def test_graph_composes_and_checks_cycles():
    g = units.UnitGraph()
    g.add("C", "K", 1, "273.15")
    g.add("F", "C", Fraction(5, 9), Fraction(-160, 9))
    f, hops = g.compositions("K")["F"]
    assert f.a * 212 + f.b == Fraction("373.15") and hops == 2
    g.add("F", "K", Fraction(5, 9), 255)
    with pytest.raises(ValueError, match="disagree"):
        g.compositions("K")
    with pytest.raises(ValueError, match="inverted"):
        g.add("a", "b", 0)


def test_lengths_are_consistent():
    known = units.length_graph().compositions("mm")
    assert known["ft"][0].a == Fraction("304.8") and known["inches"][0].a == Fraction("25.4")
