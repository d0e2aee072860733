import datetime as dt

import pytest
from pyspark.sql import functions as F

from vernissage.operators import dedup, merge
from vernissage.operators.dedup import SortField

from .conftest import rows, utc

S = "platform_name string, crawl_date date, id string, has_detail boolean, crawled_at timestamp, source_file string, x array<string>"
ORDER = [SortField("has_detail"), SortField("crawled_at"), SortField("source_file")]


def r(i, detail, at, src, d=1, x=None):
    return ("p", dt.date(2025, 1, d), i, detail, utc(2025, 1, at) if at else None, src, x)


def test_winner_order_and_rejects(spark):
    df = spark.createDataFrame([r("a", False, 9, "z"), r("a", True, None, "z"), r("a", True, 2, "a"), r("a", True, 2, "b"), r("a", None, 9, "z"), r("", True, 1, "f"), r(None, True, 1, "f")], S)
    got = dedup.winners(df, ["platform_name", "crawl_date", "id"], ORDER).collect()
    assert [(g.id, g.source_file) for g in got] == [("a", "b")]
    assert dedup.rejects(df, ["id"]).count() == 2
    assert dedup.winners(df.filter("false"), ["id"], ORDER).count() == 0


def test_winner_with_map_column(spark):
    df = spark.createDataFrame([("a", 1, {"k": "old"}), ("a", 2, {"k": "new"})], "id string, n int, m map<string,string>")
    assert dedup.winners(df, ["id"], [SortField("n")]).first().m == {"k": "new"}


@pytest.mark.parametrize("kind, values", [("int", [3, 1, None, 2]), ("string", ["b", "a", None, "ab"]), ("boolean", [True, False, None]), ("date", [dt.date(2025, 1, 2), dt.date(2024, 1, 2), None]), ("timestamp", [dt.datetime(2025, 1, 2), dt.datetime(2024, 1, 2), None])])
def test_ascending_order_puts_nulls_last(spark, kind, values):
    df = spark.createDataFrame([("k", v) for v in values], f"k string, v {kind}")
    best = dedup.winners(df, ["k"], [SortField("v", descending=False)]).first().v
    assert best == min(v for v in values if v is not None)


def test_top_k_and_priority_union(spark):
    df = spark.createDataFrame([("a", i) for i in range(5)] + [("b", 1)], "k string, n int")
    assert rows(dedup.top_k(df, ["k"], [F.desc("n")], 2), "k", "n", "rank") == [("a", 3, 2), ("a", 4, 1), ("b", 1, 1)]
    u = dedup.priority_union([spark.createDataFrame([("a", "first")], "k string, v string"), spark.createDataFrame([("a", "second"), ("b", "second")], "k string, v string")], ["k"])
    assert rows(u, "k", "v") == [("a", "first"), ("b", "second")]


def test_merge_columns(spark):
    s = "k string, a int, b int, own boolean"
    old = spark.createDataFrame([("x", 1, None, False), ("y", 1, 2, True), ("z", 9, 9, False)], s)
    new = spark.createDataFrame([("x", None, 5, False), ("y", 7, None, False), ("w", 3, 3, False)], s)
    assert rows(merge.merge_columns(old, new, ["k"], F.col("own")), "k", "a", "b") == [("w", 3, 3), ("x", 1, 5), ("y", 1, 2), ("z", 9, 9)]


def test_fold_columns_ignores_nulls_and_empty_lists(spark):
    df = spark.createDataFrame([("x", 1, "a", ["p"]), ("x", 2, None, []), ("x", 3, "c", None)], "k string, pos int, v string, l array<string>")
    assert rows(merge.fold_columns(df, ["k"], "pos"), "k", "v", "l") == [("x", "c", ["p"])]


def test_children_and_ids(spark):
    df = spark.createDataFrame([("x", ["a", "b"]), ("y", None)], "k string, l array<string>")
    assert rows(merge.children(df, ["k"], "l")) == [("x", 0, "a"), ("x", 1, "b")]
    known = spark.createDataFrame([(1, "a")], "id bigint, v string")
    got = merge.assign_ids(known, spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "v string"), "v")
    assert got.count() == 2 and got.filter("v = 'a'").first().id == 1
    assert rows(merge.replace_children(df, spark.createDataFrame([("x", ["c"])], "k string, l array<string>"), ["k"]), "k", "l") == [("x", ["c"]), ("y", None)]


def test_latest_epoch(spark):
    log = spark.createDataFrame([("w", "e1", 1), ("w", "e2", 2), ("w", "e1", 3), ("v", "e9", 1)], "w string, e string, pos int")
    assert rows(merge.latest_epoch(log, ["w"], "e", "pos"), "w", "e", "pos") == [("v", "e9", 1), ("w", "e1", 1), ("w", "e1", 3)]


def test_store_rerun_late_crawl_and_compaction(spark, tmp_path):
    st = merge.Store(spark, str(tmp_path), "artworks", "id", ORDER)
    with pytest.raises(ValueError):
        st.current()
    df = lambda *x: spark.createDataFrame(list(x), S)
    st.publish(df(r("a", True, 5, "new", d=5), r("b", True, 5, "b", d=5)))
    st.publish(df(r("a", True, 1, "old", d=1), r("c", True, 1, "c", d=1)))  # a late crawl
    st.compact()
    cur = {c.id: c for c in st.read("current").collect()}
    assert cur["a"].source_file == "new" and cur["a"].first_seen_at.day == 1 and cur["c"].latest_version == dt.date(2025, 1, 1)
    st.publish(df(r("a", True, 6, "again", d=5)))  # the crawl is run again: b is gone from it
    st.compact()
    assert rows(st.read("current"), "id", "source_file") == [("a", "again"), ("c", "c")]
    st.publish(df(r("d", True, 6, "d", d=5)), replace=False)
    assert rows(st.read("versions").filter("crawl_date = '2025-01-05'"), "id") == [("a",), ("d",)]
    st.delete_crawl("p", "2025-01-05")
    assert rows(st.read("current"), "id", "source_file") == [("a", "old"), ("c", "c")] == rows(st.read("versions"), "id", "source_file")
    st.delete_crawl("p", "2025-01-01")
    assert st.read("versions") is None and st.read("current") is None
    assert rows(st.ledger(), "crawl_date", "status") == [(dt.date(2025, 1, 1), "deleted"), (dt.date(2025, 1, 5), "deleted")]


def test_readers_keep_the_state_they_opened(spark, tmp_path):
    st = merge.Store(spark, str(tmp_path), "artworks", "id", ORDER)
    st.publish(spark.createDataFrame([r("a", True, 5, "one", d=1)], S))
    st.compact()
    opened = st.read("current")
    st.publish(spark.createDataFrame([r("a", True, 5, "two", d=2)], S))
    st.compact()
    assert rows(opened, "source_file") == [("one",)] and rows(st.read("current"), "source_file") == [("two",)]
    st.compact()
    folders = [p.name for p in (tmp_path / "current" / "dataset=artworks").iterdir() if p.name.startswith("state=")]
    assert len(folders) == 2  # the state and the one before


def test_finalize_counts_rejects_and_keeps_a_ledger(spark, tmp_path):
    st = merge.Store(spark, str(tmp_path), "artworks", "id", ORDER)
    df = spark.createDataFrame([r("a", True, 5, "x"), r("a", False, 5, "y"), r("b", True, 5, "x"), r("", True, 5, "x"), r(None, True, 5, "x")], S)
    bad = spark.createDataFrame([("broken.html", "no payload", 1)], "source_file string, error string, more int")
    counters = {"rows_in": 5, "no_key": 2, "published": 2, "rejected": 1, "duplicates": 1}
    assert st.finalize(df, "a b/c", "2025-02-01", bad) == counters
    assert st.finalize(df.filter("id = 'b'"), "a b/c", "2025-02-01") == {"rows_in": 1, "no_key": 0, "published": 1, "rejected": 0, "duplicates": 0}
    assert rows(st.read("versions"), "id") == [("b",)]
    assert rows(st.ledger(), "platform_name", "status", "published") == [("a b/c", "completed", 1)] and st.read("ledger").count() == 2
    st.delete_crawl("a b/c", "2025-02-01")
    assert st.read("versions") is None


def test_a_large_crawl_is_written_by_many_tasks(spark, tmp_path):
    st = merge.Store(spark, str(tmp_path), "artworks", "id", [SortField("source_file")])
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        wide = spark.range(200_000).select(F.lit("p").alias("platform_name"), F.lit("2025-01-01").cast("date").alias("crawl_date"), F.col("id").cast("string").alias("id"), F.sha2(F.col("id").cast("string"), 256).alias("source_file"))
        st.publish(wide)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = list((tmp_path / "versions").rglob("*.parquet"))
    assert len(files) >= 3 and st.read("versions").count() == 200_000
