import datetime as dt

import pytest
from pyspark.sql import functions as F

from vernissage.functions import payload, sizes
from vernissage.operators import audit, partitioning
from vernissage.operators.dedup import SortField
from vernissage.operators.merge import Store
from vernissage.plans import pages, sync

from .conftest import rows
from .test_payload_plans import MAPPING


@pytest.mark.parametrize(
    "text, expected",
    [
        ("50 × 70 cm (19 5/8 x 27 1/2 in.)", (50.0, 70.0, None)), ("19¾ by 27½ inches", (50.2, 69.9, None)), ("18 in. x 2 ft", (45.7, 61.0, None)), ("Höhe 33 cm, Breite: 21,5 cm", (33.0, 21.5, None)), ("120 x 80 x 4 mm", (12.0, 8.0, 0.4)), ("height 14, depth 6 in", (35.6, None, 15.2)),
        ("1,200 x 800 mm", (120.0, 80.0, None)), ("0 x 5 cm, or 5 x 9 cm", (5.0, 9.0, None)), ("9000 x 3 cm", (None, None, None)), ("sheet", (None, None, None)), ("8 x 10", (None, None, None)), ("h 40", (None, None, None)), ("", (None, None, None)),
    ],
)
def test_size_cm(one, text, expected):
    assert tuple(one(sizes.size_cm("s"), "s string", text)) == expected


def test_size_of_null(one):
    got = one(sizes.size_cm("s"), "s string", None)
    assert got is None or tuple(got) == (None, None, None)


def test_blocked(spark):
    df = spark.createDataFrame([(200, None, "fine"), (429, None, "x"), (200, "cf-Challenge", None), (200, None, "Please solve the CAPTCHA"), (200, None, " " * 20000 + "captcha"), (None, None, None)], "s int, h string, b string")
    assert [r.v for r in df.select(payload.blocked(F.col("s"), F.col("h"), F.col("b")).alias("v")).collect()] == [None, "status:429", "header", "keyword:captcha", None, None]


def test_requeue_and_fill(spark):
    c = spark.createDataFrame([("a", True, 10), ("b", True, 10), ("c", False, None)], "k string, done boolean, found int")
    few, many = (spark.range(n).withColumnRenamed("id", "u") for n in (9, 15))
    assert rows(audit.requeue(c, few, ["u"]), "k") == [("a",), ("b",), ("c",)]
    assert rows(audit.requeue(c, many, ["u"]), "k") == [("c",)]
    s = spark.createDataFrame([("x", 1, 3), ("x", 3, 3), ("y", 1, 9), ("y", 4, 9)], "g string, n int, size int")
    assert rows(partitioning.fill_ranges(s, ["g"], "n", "size"), "g", "n") == [("x", 1), ("x", 2), ("x", 3), ("y", 1), ("y", 4)]


def test_fingerprint_tells_mappings_apart():
    from dataclasses import replace

    assert pages.fingerprint(MAPPING) == pages.fingerprint(MAPPING) != pages.fingerprint(replace(MAPPING, rows="$.other"))


def test_sync_isolates_failures(spark, tmp_path):
    s = "platform_name string, crawl_date string, status string, started_at string, finished_at string"
    man = spark.createDataFrame([("p", d, "completed", None, "5") for d in ("2025-01-01", "2025-02-01", "2025-03-01")], s)
    led = spark.createDataFrame([("p", "2025-01-01", "completed", "9", None)], s)

    def rows_of(platform, day):
        if day == "2025-02-01":
            raise RuntimeError("page is broken")
        return spark.createDataFrame([(platform, dt.date.fromisoformat(day), "a", day)], "platform_name string, crawl_date date, id string, source_file string")

    store = Store(spark, str(tmp_path), "artworks", "id", [SortField("source_file")])
    report = sync.sync(man, led, rows_of, store)
    assert report.done == [("p", "2025-03-01")] and not report.ok and report.failed[0][2] == "page is broken"
    assert rows(store.read("current"), "id", "source_file") == [("a", "2025-03-01")]
    assert rows(sync.ledger_rows(spark, report, "artworks"), "crawl_date", "status") == [("2025-02-01", "failed"), ("2025-03-01", "completed")]
