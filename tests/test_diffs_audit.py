import pytest
from pyspark.sql import functions as F

from vernissage.operators import audit, diffs, partitioning

from .conftest import rows, utc

S = "k string, flag boolean, o string"


def side(spark, *x):
    return spark.createDataFrame([(k, f, o) for k, f, o in x], S)


def test_vanished_truth_table(spark):
    before = side(spark, *[(k, False, "x") for k in "abcde"])
    after = side(spark, *[(k, False, "x") for k in "abdef"])
    assert rows(diffs.vanished(before, after, "k", "flag", "o")) == [("c", "disappeared")]
    flips = side(spark, ("a", True, "x"), ("c", True, "x"), ("d", True, "x"))
    assert rows(diffs.flipped(side(spark, ("a", False, "x"), ("c", True, "x"), ("d", None, "x")), flips, ["k"], "flag"), "k") == [("a",)]


def test_vanished_guard(spark):
    before = side(spark, *[(k, False, "x") for k in "abcd"])
    after = side(spark, ("a", True, "x"), ("b", False, "x"))
    assert rows(diffs.vanished(before, after, "k", "flag", "o")) == [("a", "flagged")]
    assert rows(diffs.vanished(before, after, "k", "flag", "o", 0.5)) == [("a", "flagged"), ("c", "disappeared"), ("d", "disappeared")]


def test_vanished_owner_gone_but_null_owner_kept(spark):
    rest = [(f"r{i}", False, None) for i in range(20)]
    before = side(spark, ("a", False, "x"), ("b", False, "x"), ("c", False, "y"), ("n", False, None), *rest)
    after = side(spark, ("a", False, "x"), *rest)
    assert rows(diffs.vanished(before, after, "k", "flag", "o"), "k") == [("b",), ("n",)]


def test_vanished_judges_each_source_and_crawl_on_its_own(spark):
    s = "p string, d string, k string, flag boolean, o string"
    keep = [("q", "2", f"r{i}", False, "x") for i in range(9)] + [("q", "3", f"r{i}", False, "x") for i in range(9)]
    before = spark.createDataFrame([("p", "2", k, False, "x") for k in "abc"] + keep + [("q", "2", "g", False, "x"), ("q", "2", "h", False, "y"), ("q", "3", "f", False, "y"), ("r", "2", "z", False, None)], s)
    # Source p is incomplete; owner y is gone from q's pair 2 and not from pair 3; r has no rows later.
    after = spark.createDataFrame([("p", "2", "a", True, "x")] + keep + [("q", "3", "f", True, "y")], s)
    assert rows(diffs.vanished(before, after, "k", "flag", "o", by=["p", "d"])) == [("p", "2", "a", "flagged"), ("q", "2", "g", "disappeared"), ("q", "3", "f", "flagged")]


def test_every_pair_of_full_crawls_is_compared(spark):
    from vernissage.survey_queries import QUERIES

    from .conftest import SF

    pairs = QUERIES["w_consecutive"](spark, SF).filter("dataset = 'artworks' and previous is not null").count()
    assert 1 < QUERIES["j_vanished_pairs"](spark, SF).select("platform_name", "crawl_date").distinct().count() <= pairs


def test_url_changes(spark):
    s = "t string, id string, url string, lastmod timestamp"
    e = spark.createDataFrame([("l", "1", "u1", utc(2025, 1, 2)), ("l", "1", "u0", None), ("l", "2", "u2", utc(2025, 1, 1)), ("l", "3", "u3", None), ("l", "4", "u4", utc(2025, 1, 1)), (None, "9", "u9", None)], s)
    known = spark.createDataFrame([("l", "1", utc(2025, 1, 1)), ("l", "2", utc(2025, 1, 1)), ("l", "4", None)], "t string, id string, lastmod timestamp")
    assert rows(diffs.url_changes(e, known, ["t", "id"]), "id", "url", "status") == [("1", "u1", "updated"), ("2", "u2", "unchanged"), ("3", "u3", "new"), ("4", "u4", "updated")]


def test_overlaps_sets_and_division(spark):
    s = lambda *x: spark.createDataFrame([(v,) for v in x], "k int")
    got = dict(rows(diffs.overlaps({"a": s(1, 2, 2, 3), "b": s(2, 3, 4), "c": s(3)}, ["k"])))
    assert got == {"a": 1, "a+b": 1, "a+b+c": 1, "b": 1}
    assert rows(diffs.same_set(s(1, 1, 2), s(2, 1), ["k"])) == [(0, 0, True)]
    led = spark.createDataFrame([("p", "x", "completed"), ("p", "y", "completed"), ("q", "x", "completed"), ("q", "y", "failed")], "g string, dataset string, status string")
    assert rows(diffs.completed_for_all(led, ["g"], ["x", "y"])) == [("p",)]
    assert diffs.overlaps({"a": s(), "b": s()}, ["k"]).count() == 0


def test_counts(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 4), ("b", 7), ("b", 7)], "g string, n int")
    assert rows(audit.gaps(df, ["g"], "n"), "g", "n_missing", "contiguous") == [("a", 1, False), ("b", 0, True)]
    assert rows(audit.duplicates(df, ["g", "n"])) == [(5, 4, 1)]
    assert rows(audit.duplicates(df.filter("false"), ["g"])) == [(0, 0, 0)]
    exp = spark.createDataFrame([("a", 5), ("c", 1)], "g string, expected int")
    assert rows(audit.shortfall(exp, df, ["g"]), "g", "found", "missing") == [("a", 3, 2), ("c", 0, 1)]
    assert rows(audit.histogram(df, ["g"], "n", 4), "g", "bucket", "n") == [("a", 0, 2), ("a", 1, 1), ("b", 1, 2)]


def test_rate_alarm_needs_a_full_window(spark):
    df = spark.createDataFrame([("a", i, i < 3) for i in range(10)], "g string, i int, bad boolean")
    got = audit.rate_alarm(df, ["g"], [F.col("i")], F.col("bad"), rows=4, share=0.5)
    assert rows(got, "i") == [(3,), (4,)]


def test_samples(spark):
    df = spark.createDataFrame([(i, i % 7, utc(2025, 1, 1 + i % 28)) for i in range(200)], "k int, w int, at timestamp")
    a, b = (rows(audit.hash_sample(df.repartition(n), "k", 10), "k") for n in (2, 5))
    assert a == b and len(a) == 10
    s = audit.spread_sample(df, 16, "w", "at", "k")
    assert s.filter("chosen_by = 'weight'").count() == 4 and 6 <= s.filter("chosen_by = 'time'").count() <= 12
    assert s.select("k").distinct().count() == s.count()


@pytest.mark.parametrize("budget", [1, 5, 12, 1000])
def test_plan_ranges_against_a_loop(spark, budget):
    counts = {1: 3, 2: 4, 3: 20, 5: 1, 8: 2, 9: 9, 10: 1}
    df = spark.createDataFrame([("g", v, n) for v, n in counts.items()], "g string, v int, n int")
    got = rows(partitioning.plan_ranges(df, ["g"], "v", "n", budget), "lo", "hi", "n")
    covered = [v for lo, hi, _ in got for v in counts if lo <= v < hi]
    assert sorted(covered) == sorted(counts) and sum(n for *_, n in got) == sum(counts.values())
    for lo, hi, n in got:
        inside = [v for v in counts if lo <= v < hi]
        assert n == sum(counts[v] for v in inside) and (n <= budget or len(inside) == 1)
        assert all(counts[v] < budget or len(inside) == 1 for v in inside)


def test_split_facets(spark):
    df = spark.createDataFrame([("a", "x")] * 6 + [("a", None)] * 2 + [("b", "x")] * 3 + [(None, "z")] * 9, "p string, q string")
    got = rows(partitioning.split_facets(df, ["p", "q"], 5), "p", "q", "n", "fits")
    assert sum(n for _, _, n, _ in got) == 20
    assert ("b", None, 3, True) in got and ("a", "x", 6, False) in got and ("a", "", 2, True) in got and ("", "z", 9, False) in got


def test_months(spark):
    w = partitioning.month_windows("2025-01-15", "2025-03-01", spark, "2025-03-01")
    assert [(str(r.lo), r.settled) for r in w.collect()] == [("2025-01-01", True), ("2025-02-01", True), ("2025-03-01", False)]
    d = spark.createDataFrame([("2025-02-01",)], "m string").select(partitioning.monthly(F.lit(31), F.col("m").cast("date")).alias("d")).first().d
    assert str(d) == "2025-02-28"
