import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vernissage.llm.canonical import LOOKS, Transducer, canonical, disguised, phonetic, transducer


@pytest.mark.parametrize(
    "text, expected",
    [
        ("Ｆｉｓｓｕｒｅ", "Fissure"), ("Orchard of Ferries　", "Orchard of Ferries "), ("Th­e T​ide﻿", "The Tide"), ("Café", "Café"), ("Åsa", "Åsa"), ("Reﬆless ﬁre Ⅷ", "Restless fire VIII"),
        ("Ηоllоw Field", "Hollow Field"), ("Cинeе окно", "Синее окно"), ("Τихая гавань", "Тихая гавань"), ("Λευκό νηсί", "Λευκό νηсί"), ("Άσπρо", "Άσπρο"), ("Vіlla ІΙ", "Villa II"), ("Inѐs", "Inès"), ("S️ilent", "Silent"), ("𝐁old", "Bold"), ("la а la", "la a la"), ("l'і̂le", "l'île"), ("ｶﾅ", "カナ"),
    ],
)
def test_disguises(text, expected):
    assert canonical(text) == expected


@pytest.mark.parametrize(
    "text",
    ["", None, "Plain – “quoted” … text", "Ночной рынок", "Άσπρο φως", "冬の窓。「青い港」", "Café Łódź ß œ", "Он живёт в Omaha с 1990, а она — в Porto.", "🖼️ 👩‍💻 ok", "10 × 20 cm ½ № 5", "a  b\tc\n", "価格！（税込）", "می‌خواهم", "О весе облаков"],
)
def test_left_alone(text):
    assert canonical(text) == text


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(codec="utf-8"), max_size=40))
def test_one_pass_is_enough_and_nothing_crashes(text):
    once = canonical(text)
    twice = canonical(once)
    assert canonical(twice) == twice


def test_conflicts_are_refused():
    with pytest.raises(ValueError, match="again"):
        Transducer({"ａ": "ｂ", "ｂ": "b"}, LOOKS, {})
    with pytest.raises(ValueError, match="two outputs"):
        Transducer({"а": "x"}, LOOKS, {})
    with pytest.raises(ValueError, match="two outputs"):
        Transducer({}, LOOKS, {"Ꭺ": "a"})
    with pytest.raises(ValueError, match="again"):
        Transducer({}, {**LOOKS, "A": {"ո": "а"}}, {})
    # All tables that are in use take part.
    assert set(transducer().to_latin) == {c for table in (*LOOKS.values(), phonetic()) for c in table}


@pytest.mark.parametrize(
    "text, expected",
    [
        ("Ꭺrt", "Art"), ("ᎪᎡᎢ", "ART"), ("ꓮrt ꓮꓣꓔ", "Art ART"), ("ᴀrt ᴀʀᴛ", "art art"), ("Ԍallery", "Gallery"), ("pɑint in a ɡallery", "paint in a gallery"), ("սnder", "under"),
        ("[ˈɡɑːlə]", "[ˈɡɑːlə]"), ("Ժողովուրդ ոսո", "Ժողովուրդ ոսո"), ("ᏣᎳᎩ ᎦᏬᏂᎯᏍᏗ", "ᏣᎳᎩ ᎦᏬᏂᎯᏍᏗ"), ("👩🏽‍💻 ​x", "👩🏽‍💻 x"), ("🖼️Word аnd", "🖼️Word and"),
    ],
)
def test_scripts_of_few_texts(text, expected):
    assert canonical(text) == expected


def test_the_longest_match_wins():
    # A base, what is invisible and its marks are one match; so is a whole emoji sequence.
    assert canonical("e\u200b\u0301\u200bt") == "ét"
    assert canonical("o\u0302\u0301") == unicodedata.normalize("NFC", "o\u0302\u0301")
    assert canonical("❤\ufe0f\u200d🔥\u200b") == "❤\ufe0f\u200d🔥"


def test_very_long_text_is_linear():
    import time

    took = []
    for n in (20_000, 200_000):
        text = "Ηоllоw Field\u200b Ночной рынок café " * (n // 36)
        began = time.perf_counter()
        assert len(canonical(text)) == len(text) - n // 36
        took.append(time.perf_counter() - began)
    assert took[1] < 40 * took[0]


def test_composition_agrees_with_unicode():
    for base in "aeiouncs":
        for mark in "̧̀́̈":
            assert canonical(base + mark) == unicodedata.normalize("NFC", base + mark)


def test_filter_inside_the_jvm_is_exact(spark):
    texts = ["plain", "Café", "Café", "a b", "Ночной рынок", "Vіlla", "– “x” …", "冬の窓", "x" * 20000 + "​", None, "", "№ 5", "\u0000"]
    df = spark.createDataFrame([(i, t, "y") for i, t in enumerate(texts)], "i int, t string, canonical string").drop("canonical")
    got = {r.i for r in disguised(df, "t").collect()}
    assert got == {i for i, t in enumerate(texts) if t is not None and canonical(t) != t}
