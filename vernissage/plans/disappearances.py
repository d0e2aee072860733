"""What vanished between full crawls, once for each crawl and its predecessor."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from vernissage.operators.diffs import completed_for_all, vanished
from vernissage.operators.observations import crawls_of
from vernissage.operators.snapdiff import consecutive_crawls
from vernissage.session import checkpoint


def pending_pairs(ledger: DataFrame, done: DataFrame | None = None) -> DataFrame:
    """``platform_name, crawl_date, previous``: full crawls of artworks to be compared with the one before.

    A pair waits until the artists of both crawls are completed, too; ``done``
    (``platform_name, crawl_date``) are those compared before.
    """
    pairs = consecutive_crawls(crawls_of(ledger, "artworks", full_only=True)).filter("previous is not null").drop("seq")
    ready = completed_for_all(ledger.withColumnRenamed("source", "platform_name"), ["platform_name", "crawl_date"], ["artists", "artworks"])
    pairs = pairs.join(ready, ["platform_name", "crawl_date"], "left_semi").join(ready.withColumnRenamed("crawl_date", "previous"), ["platform_name", "previous"], "left_semi")
    return pairs if done is None else pairs.join(done, ["platform_name", "crawl_date"], "left_anti")


def detect(versions: DataFrame, pairs: DataFrame, key: str, flag: str, owner: str, least_share: float = 0.8) -> DataFrame:
    """``platform_name, crawl_date, key, reason`` for each pair; ``versions`` has one row per key and crawl."""
    cols = ["platform_name", "crawl_date", key, flag, owner]
    rows = versions.select(*cols)
    before = rows.withColumnRenamed("crawl_date", "previous").join(pairs, ["platform_name", "previous"]).drop("previous")
    after = rows.join(pairs.drop("previous"), ["platform_name", "crawl_date"])
    return vanished(before, after, key, flag, owner, least_share, by=["platform_name", "crawl_date"])


def run(spark: SparkSession, versions: DataFrame, ledger: DataFrame, folder: str, key: str, flag: str, owner: str) -> DataFrame:
    """Compares every pending pair and writes its result; a pair that is run again replaces its own result.

    Returns all results. A pair without changes leaves a row without a key, so
    that it counts as done.
    """
    pairs = checkpoint(pending_pairs(ledger, _read(spark, folder)))
    found = checkpoint(detect(versions, pairs, key, flag, owner))
    empty = pairs.drop("previous").join(found, ["platform_name", "crawl_date"], "left_anti").select("platform_name", "crawl_date", F.lit(None).cast("string").alias(key), F.lit("none").alias("reason"))
    rows = found.unionByName(empty)
    rows.hint("rebalance", "platform_name", "crawl_date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("platform_name", "crawl_date").parquet(folder)
    done = _read(spark, folder)
    return (rows if done is None else done).filter(F.col(key).isNotNull())


def _read(spark: SparkSession, folder: str) -> DataFrame | None:
    try:
        return spark.read.parquet(folder)
    except AnalysisException:
        return None
