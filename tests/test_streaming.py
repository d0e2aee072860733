import datetime as dt

from pyspark.sql import functions as F

from vernissage.operators.merge import Store
from vernissage.plans.datasets import ARTWORKS
from vernissage.streaming import ingest

from .conftest import rows, utc

S = "platform_name string, crawl_date date, platform_artwork_id string, has_detail boolean, crawled_at timestamp, source_file string"


def test_ingest_in_batches_resumes_and_late_crawls_do_not_win(spark, tmp_path):
    src, chk = str(tmp_path / "in"), str(tmp_path / "chk")
    store = Store(spark, str(tmp_path / "store"), "artworks", "platform_artwork_id", ARTWORKS.order)

    def drop(*data):
        spark.createDataFrame([("p", d, k, True, utc(2025, 1, 1), f) for d, k, f in data], S).coalesce(1).write.mode("append").parquet(src)

    late, early = dt.date(2025, 2, 1), dt.date(2025, 1, 1)
    drop((late, "a", "new"))
    drop((late, "b", "b"))
    ingest.ingest(spark, src, S, store, chk, max_files=1)
    drop((early, "a", "old"), (early, "c", "c"))
    ingest.ingest(spark, src, S, store, chk, max_files=1)
    ingest.ingest(spark, src, S, store, chk, max_files=1)
    assert rows(store.read("current"), "platform_artwork_id", "source_file") == [("a", "new"), ("b", "b"), ("c", "c")]
    assert store.read("versions").count() == 4


def test_windows_distinct_and_batches(spark, tmp_path):
    src = str(tmp_path / "e")
    spark.createDataFrame([(utc(2025, 1, 1, 0, i % 10), i % 3, "x") for i in range(30)], "ts timestamp, k int, t string").write.parquet(src)
    stream = lambda: spark.readStream.schema("ts timestamp, k int, t string").parquet(src)
    w = ingest.windowed_counts(stream(), "ts", ["t"], "5 minutes", "5 minutes", keys=F.approx_count_distinct("k"))
    ingest.run_to_table(w, str(tmp_path / "w1"), "complete")
    assert rows(spark.read.parquet(str(tmp_path / "w1")), "t", "n", "keys") == [("x", 15, 3), ("x", 15, 3)]
    ingest.run_to_table(ingest.distinct_stream(stream(), ["k"], "ts", "1 hour"), str(tmp_path / "d1"), "append")
    assert rows(spark.read.parquet(str(tmp_path / "d1")), "k") == [(0,), (1,), (2,)]


def test_sessions(spark):
    df = spark.createDataFrame([("a", utc(2025, 1, 1, h)) for h in (0, 1, 9)], "k string, ts timestamp")
    assert rows(ingest.sessions(df, "ts", ["k"], "2 hours"), "k", "n") == [("a", 1), ("a", 2)]
