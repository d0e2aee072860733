import random

import pytest
from pyspark.sql import functions as F

from vernissage.functions import urls
from vernissage.operators import audit, entries, ordering, partitioning, search
from vernissage.plans import disappearances

from .conftest import SF, rows


def hot(n=3000):
    rnd = random.Random(2)
    return [("hot" if rnd.random() < 0.6 else None if rnd.random() < 0.1 else f"k{rnd.randrange(9)}", rnd.randrange(10**6), i, rnd.random() < 0.2) for i in range(n)]


S = "k string, at int, id int, bad boolean"


def test_positions_are_those_of_a_sorted_group(spark):
    data = hot()
    df = spark.createDataFrame(data, S).repartition(7)
    got = {r.id: r.position for r in ordering.positions(df, ["k"], [F.col("at"), F.col("id")]).collect()}
    by = {}
    for k, at, i, _ in data:
        by.setdefault(k, []).append((at, i))
    assert got == {i: p for group in by.values() for p, (_, i) in enumerate(sorted(group), 1)}
    assert ordering.positions(df.filter("false"), ["k"], [F.col("at")]).count() == 0


@pytest.mark.parametrize("block", [5, 37, 100_000])
def test_sliding_windows_do_not_depend_on_blocks(spark, block):
    data = hot(900)
    df = spark.createDataFrame(data, S)
    got = {r.id: (r.n, r.s) for r in ordering.sliding(df, ["k"], [F.col("at"), F.col("id")], 5, block, n=F.count("*"), s=F.sum("at")).collect()}
    by, want = {}, {}
    for k, at, i, _ in sorted(data, key=lambda x: x[1:3]):
        last = by.setdefault(k, [])
        last.append(at)
        want[i] = (min(5, len(last)), sum(last[-5:]))
    assert got == want


def test_rate_alarm_within_a_hot_group(spark):
    data = [("a", i, i, 10 <= i < 14) for i in range(40)] + [("b", i, 100 + i, True) for i in range(4)]
    got = audit.rate_alarm(spark.createDataFrame(data, S), ["k"], [F.col("at")], F.col("bad"), rows=5, share=0.8)
    assert rows(got, "id") == [(13,), (14,)]


def test_range_parts_fit_and_cover(spark):
    rnd = random.Random(1)
    data = [("g", rnd.choice([1, 2, 3, 50, 51, 900, 900, 900, 900])) for _ in range(400)] + [("h", 7), ("h", None)]
    got = search.range_parts(spark.createDataFrame(data, "g string, v int"), ["g"], "v", 40).collect()
    for g in ("g", "h"):
        mine = sorted((r.lo, r.hi, r.n, r.fits) for r in got if r.g == g)
        assert all(a[1] <= b[0] for a, b in zip(mine, mine[1:])) and all(r[3] == (r[2] <= 40) and (r[3] or r[1] - r[0] == 1) for r in mine)
        assert {v: sum(r[2] for r in mine if r[0] <= v < r[1]) > 0 for _, v in data if _ == g and v is not None}.values()
        assert sum(r[2] for r in mine) == sum(1 for x, v in data if x == g and v is not None)


def test_facet_parts(spark):
    data = [("x", "a", i) for i in range(6)] + [("x", "b", i) for i in range(3)] + [("x", None, i) for i in range(2)] + [("y", 'q"', 0)] * 2 + [("z", "one", 0)] * 9
    got = {r.part: (r.n, r.fits) for r in search.facet_parts(spark.createDataFrame(data, "p string, q string, i int"), ["p", "q"], 4, most=2).collect()}
    assert got == {'p:"x" AND q:"a"': (6, False), 'p:"x" AND q:"b"': (3, True), 'p:"x" AND NOT q:common': (2, True), 'p:"z"': (9, False), "NOT p:common": (2, True)}
    assert search.facet_parts(spark.createDataFrame([("x", 1)] * 3, "p string, i int"), ["p"], 1).collect()[0].part == ""


def test_collected_and_filters(spark):
    parts = spark.createDataFrame([("a", 2), ("b", 9), ("c", 1)], "part string, n int")
    hits = spark.createDataFrame([("a", 1), ("a", 2), ("a", 2), ("b", 1)], "part string, id int")
    assert rows(search.collected(parts, hits, "part", ["id"], 5), "part", "seen", "status") == [("a", 2, "ok"), ("b", 1, "unsplittable"), ("c", 0, "count_mismatch")]
    assert search.any_of("id", ["7", "x", "7", "12"]) == "id:7 OR id:12"
    df = spark.createDataFrame([('a\\"b', 3, 9)], "s string, lo int, hi int")
    assert df.select(search.facet_clause("f", F.col("s")), search.range_clause("y", F.col("lo"), F.col("hi"))).first()[:] == ('f:"a\\\\\\"b"', "y:3 TO 8")


def test_entries(spark):
    sales = spark.createDataFrame([("s1", None, "art"), ("s2", "2025-02-01", "cars"), ("s3", "2025-03-01", None)], "sale string, begin string, kind string")
    items = spark.createDataFrame([("s1", 1, None, "2025-01-05"), ("s1", 2, False, None), ("s2", 1, True, None), ("s3", 1, True, None), ("s4", 1, True, None)], "sale string, n int, published boolean, sold string")
    got = entries.items_of_sales(sales, items, "sale", F.col("kind") == "cars", F.col("published"), [F.col("sold"), F.col("begin")])
    assert rows(got, "sale", "n", "lastmod") == [("s1", 1, "2025-01-05"), ("s3", 1, "2025-03-01")]
    e = spark.createDataFrame([("u", None, 1), ("u", "2025-01-01", 2), ("v", None, 3)], "url string, lastmod string, x int")
    assert rows(entries.newest_entries(e, ["url"]), "url", "x") == [("u", 2), ("v", 3)]
    assert rows(entries.with_twins(e.filter("x = 3"), "url", F.lit(None).cast("string")), "url", "kind") == [("v", "live")]
    u = spark.createDataFrame([("https://h/sales-upcoming-12.xml.gz",), ("https://h/lots-3.xml",), ("https://h/x.xml",), (None,)], "u string")
    assert [tuple(r.k) if r.k else None for r in u.select(entries.numbered_list("u").alias("k")).collect()] == [("sale", "upcoming", 12), ("lot", None, 3), None, None]


def test_walk_ends(spark):
    data = [("short", i, n) for i, n in enumerate([20, 20, 3, 20], 1)] + [("empty", i, n) for i, n in enumerate([20, 0, 20, 0, 0, 20], 1)] + [("ceiling", i, 20) for i in range(1, 9)] + [("open", 1, 20)]
    got = partitioning.walked_pages(spark.createDataFrame(data, "k string, page int, n int"), ["k"], "page", "n", 20, ceiling=7)
    assert rows(got.groupBy("k").agg(F.max("page").alias("last"), F.max("stop").alias("stop"))) == [("ceiling", 7, "ceiling"), ("empty", 5, "empty"), ("open", 1, None), ("short", 3, "short")]


@pytest.mark.parametrize(
    "site, url, expected",
    [
        ("artsper", "https://www.artsper.com/contemporary-artists/ann-bell/12/works", ("artist", "12")), ("saatchi", "https://www.saatchiart.com/account/profile/Ann_B", ("artist", "ann_b")), ("saatchi", "https://www.saatchiart.com/collections", None), ("artsy", "https://artsy.net.example.com/artist/x", None),
        ("singulart", "https://www.singulart.com/artist/ann-12?x", None), ("artfinder", "https://www.artfinder.com/en-US/product/a/", None), ("mutualart", "https://www.mutualart.com/Artist/Ann/0A1b2C3d4E", ("artist", "0A1B2C3D4E")), ("artsy", None, None), ("artsy", "no address", None),
    ],
)
def test_entities_of_sites(one, site, url, expected):
    got = one(urls.entity_of("s", urls.ENTITIES[site]), "s string", url)
    assert (tuple(got) if got else None) == expected


def test_disappearances_once_per_pair(spark, tmp_path):
    led = spark.createDataFrame([(x, "p", day, "completed", "full") for x in ("artists", "artworks") for day in ("2025-01-01", "2025-02-01", "2025-03-01") if (x, day) != ("artists", "2025-03-01")], "dataset string, source string, crawl_date string, status string, crawl_mode string").withColumn("crawl_date", F.col("crawl_date").cast("date"))
    v = "platform_name string, crawl_date string, id string, sold boolean, artist string, extra int"
    versions = spark.createDataFrame([("p", "2025-01-01", i, False, "x", 1) for i in "abcde"] + [("p", "2025-02-01", i, i == "b", "x", 1) for i in "abcd"] + [("p", "2025-03-01", "a", False, "x", 1)], v).withColumn("crawl_date", F.col("crawl_date").cast("date"))
    folder = str(tmp_path / "out")
    want = [("b", "flagged"), ("e", "disappeared")]
    assert rows(disappearances.run(spark, versions, led, folder, "id", "sold", "artist"), "id", "reason") == want  # March waits for its artists
    assert disappearances.pending_pairs(led, spark.read.parquet(folder)).count() == 0
    more = led.unionByName(spark.createDataFrame([("artists", "p", "completed", "full")], "dataset string, source string, status string, crawl_mode string").withColumn("crawl_date", F.lit("2025-03-01").cast("date")))
    assert rows(disappearances.run(spark, versions, more, folder, "id", "sold", "artist"), "id", "reason") == want  # too few rows: taken for incomplete
    assert disappearances.pending_pairs(more, spark.read.parquet(folder)).count() == 0


def test_host_and_path_are_read_once_for_all_sites(spark):
    import __spark_entry__

    plan = __spark_entry__.queries()["u_sites"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("(?:[^/?#@]*@)?([^/?#:]+)") == 1


def test_an_address_of_two_sites_is_given_for_both(spark):
    two = {"a": urls.ENTITIES["artsy"], "b": urls.Entities("shop.artsy.net", (urls.template("item", "/artist/{s}"),))}
    given = [("https://shop.artsy.net/artist/Ann",), ("https://artsy.net/artist/Ann",), ("https://artsy.org/artist/Ann",), ("",), (None,)]
    found = spark.createDataFrame(given, "u string").select("u", F.inline(urls.entities_of("u", two)))
    assert rows(found, "u", "site", "k.entity_type", "k.entity_id") == [
        ("https://artsy.net/artist/Ann", "a", "artist", "ann"), ("https://shop.artsy.net/artist/Ann", "a", "artist", "ann"), ("https://shop.artsy.net/artist/Ann", "b", "item", "Ann"),
    ]
