import datetime as dt
import random

from vernissage.operators import history

from .conftest import rows, utc

ART = "platform_name string, platform_artwork_id string, crawl_date date, price decimal(14,2), currency string, has_detail boolean, crawled_at timestamp, source_file string"
LED = "dataset string, source string, crawl_date date, status string, crawl_mode string"
D = [dt.date(2025, m, 1) for m in range(1, 8)]


def ledger(spark, dataset="artworks", failed=()):
    return spark.createDataFrame([(dataset, "p", d, "failed" if d in failed else "completed", "full") for d in D], LED)


def art(d, price, detail=True, at=1, src="f", key="a"):
    from decimal import Decimal

    return ("p", key, D[d], None if price is None else Decimal(price), "EUR", detail, utc(2025, 1, at) if at else None, src)


def test_versions_return_and_gaps(spark):
    a = spark.createDataFrame([art(0, 1), art(1, 1), art(2, 2), art(3, None), art(4, 1), art(5, 1)], ART)
    got = rows(history.price_history(a, ledger(spark)), "version", "value", "valid_from", "valid_to")
    assert [(v, int(p), f, t) for v, p, f, t in got] == [(1, 1, D[0], D[2]), (2, 2, D[2], D[4]), (3, 1, D[4], None)]


def test_best_row_of_a_crawl(spark):
    a = spark.createDataFrame([art(0, 1, None, 9), art(0, 2, False, 9), art(0, 3, True, None, "z"), art(0, 4, True, 2, "a"), art(0, 5, True, 2, "b"), art(0, None, True, 30)], ART)
    got = history.price_observations(a, ledger(spark)).collect()
    assert [int(r.price) for r in got] == [5]


def test_failed_and_unknown_crawls_say_nothing(spark):
    a = spark.createDataFrame([art(0, 1), art(1, 9), art(2, 1)], ART)
    assert history.price_history(a, ledger(spark, failed=[D[1]])).count() == 1
    assert history.price_history(a, ledger(spark).filter("false")).count() == 0


def test_ids_are_cleaned_and_null_keys_ignored(spark):
    a = spark.createDataFrame([art(0, 1, key=" a"), art(1, 1, key="﻿a"), art(2, 2, key=None), art(3, 2, key="  ")], ART)
    assert rows(history.price_history(a, ledger(spark)), "platform_id", "version") == [("a", 1)]


def test_city_by_place_not_spelling(spark):
    cols = "platform_name string, platform_artist_id string, crawl_date date, city string, crawled_at timestamp, source_file string, at string, value string, v string"
    c = ["Łódź", "LODZ ", "N/A", " Lodz", "Lyon", "LYON"]
    a = spark.createDataFrame([("p", "1", D[i], x, utc(2025, 1, 1), "f", "x", "y", "z") for i, x in enumerate(c)], cols)
    got = rows(history.city_history(a, ledger(spark, "artists")), "version", "valid_from")
    assert got == [(1, D[0]), (2, D[4])]


def test_random_histories_against_a_loop(spark):
    rnd = random.Random(3)
    data = [(f"e{rnd.randrange(20)}", D[rnd.randrange(7)], rnd.choice([None, 1, 2, 3])) for _ in range(400)]
    obs = spark.createDataFrame(data, "e string, d date, x int")
    got = rows(history.attribute_history(obs, ["e"], "d", "x"), "e", "value", "valid_from", "valid_to")
    want = []
    for e in {r[0] for r in data}:
        best = {}
        for k, d, x in data:
            if k == e and x is not None:
                best[d] = max(best.get(d, 0), x)
        runs = []
        for d in sorted(best):
            if not runs or runs[-1][0] != best[d]:
                runs.append((best[d], d))
        want += [(e, x, d, runs[i + 1][1] if i + 1 < len(runs) else None) for i, (x, d) in enumerate(runs)]
    assert got == sorted(want, key=repr)
