import random

import numpy as np
import pytest

from vernissage.llm import leakage

from ..conftest import rows


def slow(a, b):
    best, h = 0, np.zeros((len(a) + 1, len(b) + 1))
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (1 if a[i - 1] == b[j - 1] else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
            best = max(best, h[i, j])
    return best


def coded(*texts):
    codes = {}
    return [np.array([codes.setdefault(w, len(codes)) for w in t], np.int32) for t in texts]


def test_alignment_against_the_textbook():
    rnd = random.Random(0)
    for _ in range(60):
        a = [rnd.choice("abcd") for _ in range(rnd.randint(1, 20))]
        b = [rnd.choice("abcde") for _ in range(rnd.randint(0, 30))]
        found = leakage.align(*coded(a, b))
        assert found.score == slow(a, b) == found.ops.count("=") * 2 - len(found.ops)


def test_passages_across_parts_of_long_items_and_documents(monkeypatch):
    rnd = random.Random(1)
    item = [f"w{i}" for i in range(900)]
    monkeypatch.setattr(leakage, "PIECE", 64)
    monkeypatch.setattr(leakage, "STRETCH", 128)
    for _ in range(40):
        a, at = rnd.randrange(880), rnd.randrange(1000)
        passage = item[a : a + 20]
        passage[rnd.randrange(20)] = "zzz"
        doc = [f"x{i}" for i in range(at)] + passage + [f"y{i}" for i in range(500)]
        items = leakage.Items.of([(1, item)])
        codes = items.encode(doc)
        places, numbers = items.hits(codes)
        used = items.uses(np.unique(numbers))
        found = leakage.find_leak(items.codes[0], codes, items.place[used], places)
        assert found and a <= found.first and found.end <= a + 20


ITEM = "suppose the sculptor hides painted panels in a shared studio which of thirty witnesses loyal to the weight of clouds would name old linen first and then leave".split()
FILL = "please note that the colours may look different on your screen".split()


def doc(words):
    return " ".join(FILL + words + FILL)


def changed(words, *at):
    return [("zzz" if i in at else w) for i, w in enumerate(words)]


@pytest.mark.parametrize(
    "text, found",
    [
        (doc(ITEM), True), (doc(ITEM[5:20]), True), (doc(ITEM[5:15]), False), (doc(changed(ITEM, 4, 13, 22)), True), (doc([w for i, w in enumerate(ITEM) if i not in (6, 15)]), True), (doc(changed(ITEM[3:18], 7)), True),
        (doc(ITEM).upper(), True), ("<p>" + " ".join(f"<em>{w}</em>" for w in ITEM[2:20]) + "</p>", True), (doc(ITEM).replace("o", "о"), True), (" ".join(f"{w}\n> " for w in ITEM), True), (doc(ITEM[:7]) + " " + doc(ITEM[12:20]), False), (doc(changed(ITEM[3:18], 4, 10)), True), (doc(changed(ITEM[3:18], 0, 14)), True),
        (doc([w for i, w in enumerate(ITEM[3:18]) if i not in (5, 9)]), True), (doc(changed(ITEM[3:18], 3, 7, 11)), False), (doc(ITEM[5:17]), False), (doc(changed(ITEM, 5, 11, 17, 23)), True), ("", False), (None, False), ("— 🎨", False),
    ],
)
def test_cases(spark, text, found):
    docs = spark.createDataFrame([(1, text, "x"), (2, doc([]), "x")], "doc_id bigint, text string, words string")
    items = spark.createDataFrame([(7, " ".join(ITEM).capitalize() + "?"), (8, None), (9, "")], "item_id bigint, text string")
    assert rows(leakage.leaks(docs, items), "doc_id", "item_id") == ([(1, 7)] if found else [])


@pytest.mark.parametrize("n", range(1, 15))
def test_short_items(spark, n):
    words = "grey linen hides seven tall doors while nobody counts those quiet northern harbour lights".split()[:n]
    mid = n // 2
    cases = {1: doc(words), 2: " ".join(words), 3: doc(changed(words, mid)), 4: doc(words[:mid] + words[mid + 1 :]), 5: doc([]), 6: doc(words[: n // 2])}
    docs = spark.createDataFrame(list(cases.items()), "doc_id bigint, text string")
    items = spark.createDataFrame([(7, " ".join(words)), (8, " ".join(words))], "item_id bigint, text string")
    right = [1, 2, 3, 4] if n >= 7 else [1, 2]
    assert rows(leakage.leaks(docs, items), "doc_id", "item_id") == [(d, i) for d in right for i in (7, 8)]


def test_every_passage_that_counts_shares_the_seeds_it_needs():
    rnd = random.Random(3)
    for n in [*range(1, 15)] * 6 + [40] * 60:
        item = [f"w{i}" for i in range(n)]
        items = leakage.Items.of([(1, item)])
        a = rnd.randrange(max(1, n - leakage.PASSAGE + 1))
        passage = changed(item[a : a + leakage.PASSAGE], *rnd.sample(range(min(n, leakage.PASSAGE)), leakage.allowed(n)))
        if rnd.random() < 0.5:
            passage = [w for w in passage if w != "zzz"]
        codes = items.encode(["x", *passage, "y"])
        _, numbers = items.hits(codes)
        doc, item = items.candidates(np.zeros(len(numbers), np.int64), numbers, np.zeros(len(items.seeds), bool))
        assert doc.tolist() == item.tolist() == [0]
        assert items.may_leak([codes], doc, item).all()


def test_pairs_of_words_tell_phrases_apart_from_passages():
    rnd = random.Random(4)
    rows = [(k, [rnd.choice("abcdefgh") for _ in range(n)]) for k, n in enumerate([1, 2, 8, 14, 15, 16, 40, 300])]
    items = leakage.Items.of(rows)
    docs = [[rnd.choice("abcdefghxyz") for _ in range(n)] for n in (0, 1, 30, 200)] + [w for _, w in rows]
    codes = [items.encode(d) for d in docs]
    pairs = [(d, i) for d in range(len(docs)) for i in range(len(rows))]
    got = items.may_leak(codes, np.array([d for d, _ in pairs]), np.array([i for _, i in pairs]))
    for (d, i), likely in zip(pairs, got):
        has = set(zip(docs[d], docs[d][1:]))
        flags = [p in has for p in zip(rows[i][1], rows[i][1][1:])]
        n, e = min(len(rows[i][1]), leakage.PASSAGE), leakage.allowed(len(rows[i][1]))
        most = max(sum(flags[k : k + n - 1]) for k in range(len(rows[i][1]) - n + 1))
        assert likely == (most >= n - 1 - 2 * e or sum(flags) >= leakage.COPY - 1)


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    docs = spark.createDataFrame([(i, doc(ITEM[i : i + 15])) for i in range(14)], "doc_id bigint, text string")
    items = spark.createDataFrame([(k, " ".join(ITEM[k:])) for k in range(9)], "item_id bigint, text string")
    whole = rows(leakage.leaks(docs, items))
    monkeypatch.setattr(leakage, "BLOCK_WORDS", 50)
    assert rows(leakage.leaks(docs, items)) == whole and len(whole) > 20


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, doc(ITEM))], "doc_id bigint, text string")
    items = spark.createDataFrame([(7, " ".join(ITEM))], "item_id bigint, text string")
    assert leakage.leaks(docs.filter("false"), items).count() == leakage.leaks(docs, items.filter("false")).count() == 0


def test_frequent_passages_are_not_lost(spark, monkeypatch):
    monkeypatch.setattr(leakage, "RARE_LEAST", 2)
    docs = spark.createDataFrame([(i, doc(ITEM[3:19])) for i in range(40)], "doc_id bigint, text string")
    items = spark.createDataFrame([(7, " ".join(ITEM)), (8, " ".join(ITEM))], "item_id bigint, text string")
    assert leakage.leaks(docs, items).count() == 80


def test_very_long_text(spark):
    docs = spark.createDataFrame([(1, "lorem ipsum " * 60000 + " ".join(ITEM) + " dolor" * 60000)], "doc_id bigint, text string")
    items = spark.createDataFrame([(7, " ".join(ITEM))], "item_id bigint, text string")
    assert rows(leakage.leaks(docs, items), "doc_id", "item_id") == [(1, 7)]
