import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vernissage.llm import encoding

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def reference():
    t = tokenizers.Tokenizer.from_file(f"{encoding.TOKENIZERS}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return lambda s: t.encode(s, add_special_tokens=False).ids


VOCABULARY = encoding.load_vocabulary()
PIECES = ["'", "l", "ll", " ", "  ", "\n", "ve", "a", "é", "1", "!", "'re", "日", "👩‍💻", " ", "<|endoftext|>", "s", "word", "\t"]


@pytest.mark.parametrize("leaf, window", [(1, 4), (2, 5), (3, 4), (7, 8), (64, 16)])
def test_any_split_gives_the_same_ids(reference, leaf, window):
    enc = encoding.TreeEncoder(VOCABULARY, leaf, window)
    rnd = random.Random(leaf)
    for _ in range(150):
        text = "".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 80)))
        ids = enc.encode(text)
        assert ids == reference(text)
        assert enc.decode(ids) == text


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet=st.characters(codec="utf-8"), max_size=60))
def test_round_trip(text):
    enc = encoding.TreeEncoder(VOCABULARY, 4, 4)
    assert enc.decode(enc.encode(text)) == text


def test_one_long_word_and_long_blanks(reference):
    enc = encoding.TreeEncoder(VOCABULARY, 16, 8)
    for text in ("a" * 500, " " * 500, "a" + " " * 300 + "b", "1" * 100 + "x" * 300):
        assert enc.encode(text) == reference(text)


def test_column(spark):
    df = spark.createDataFrame([(1, "Hello, world"), (2, ""), (3, None), (4, "<|endoftext|>")], "doc_id bigint, text string")
    got = {r.doc_id: r.ids for r in encoding.encode_corpus(df, leaf=4).collect()}
    assert got[2] == [] and got[3] == [] and len(got[4]) > 1 and got[1][0] == 15496


def test_leaves_are_encoded_and_only_the_window_is_encoded_again(reference):
    enc = encoding.TreeEncoder(VOCABULARY, 32, 4)
    text = "Johannes painted seven harbours and did not sell any of them while he lived in Lyon."
    seen, make = [], enc.piece_ids
    enc.piece_ids = lambda part: seen.append(part) or make(part)
    assert enc.encode(text) == reference(text)
    quarter = len(text) // 4
    assert text[:quarter] in seen and text[quarter : 2 * quarter] in seen
    # Four leaves, and for each of three seams its two sides and the window.
    assert len(seen) == 4 + 3 * 3 and max(map(len, seen)) <= 32


def test_cuts_split_any_text(reference):
    rnd = random.Random(5)
    pieces = [*PIECES, ", ", "é", "x'", "'s", "12", "。", "々", "(", "\u00a0", "½", "ก"]
    for _ in range(300):
        text = "".join(rnd.choice(pieces) for _ in range(rnd.randint(1, 40)))
        whole = reference(text)
        for m in encoding.CUT.finditer(text):
            assert reference(text[: m.start()]) + reference(text[m.start() :]) == whole


def test_very_long_texts_are_trees(reference):
    enc = encoding.TreeEncoder(VOCABULARY)
    text = "Sold in Lyon for 1,200 €; it wasn't signed.\n" * 3000
    assert enc.encode(text) == reference(text) and enc.decode(enc.encode(text)) == text
    for text in ("日本の画家。" * 5000, "ก" * 3000, "x" * 20000):
        assert enc.encode(text) == reference(text)
