import pytest
from pyspark.sql import functions as F

from vernissage.functions import text


@pytest.mark.parametrize("given, expected", [(" 12 ", "12"), ("﻿12⁠", "12"), ("\t", None), ("", None), (None, None), ("a​b", "ab"), ("A-1", "A-1"), ("12᠎", "12"), ("a b", "a b")])
def test_clean_id(one, given, expected):
    assert one(text.clean_id("s"), "s string", given) == expected


@pytest.mark.parametrize("given, expected", [("None", None), ("unknown date", None), ("  ", None), ("--", None), ("a ​ b", "a b"), ("a\x00b", "ab"), (" x\n y ", "x y"), (None, None), ("N/A", None), ("null and void", "null and void")])
def test_clean_text(one, given, expected):
    assert one(text.clean_text("s"), "s string", given) == expected


def test_clean_text_multiline(one):
    assert one(text.clean_text("s", multiline=True), "s string", " a  b \r\n\n\n\n c ") == "a b\n\nc"


@pytest.mark.parametrize("given, expected", [(None, False), ("", False), ("  ", False), ("N/A", False), ("Unknown", False), (" - ", False), ("Lyon", True), ("nano", True), ("unknown artist", True)])
def test_usable(one, given, expected):
    assert one(text.usable("s"), "s string", given) is expected


@pytest.mark.parametrize("given, expected", [(0, False), (None, False), (1950, True)])
def test_usable_year(one, given, expected):
    assert one(text.usable_year("y"), "y int", given) is expected


@pytest.mark.parametrize("a, b", [("Łódź", "lodz"), ("MÜNSTER ", "munster"), ("Köln", "koln"), (" Évora", "evora"), ("Ｌｙｏｎ", "lyon"), ("Straße", "strasse"), ("Santa  Fe", "santa fe")])
def test_fold(one, a, b):
    assert one(text.fold("s"), "s string", a) == b


def test_null_folds_to_null(one):
    assert one(text.fold("s"), "s string", None) is None
    assert one(text.clean_line(F.col("s")), "s string", None) is None
