"""Counts that tell whether a collection is whole: coverage, gaps, duplicates, samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vernissage.operators.ordering import sliding


def counters(df: DataFrame, by: Sequence[str], **conditions: Column) -> DataFrame:
    """Rows and rows that meet each condition, per group."""
    return df.groupBy(*by).agg(F.count("*").alias("n"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in conditions.items()])


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row ``n_rows, n_keys, n_duplicates``; two aggregations, both combined map-side."""
    per = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    return per.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"), F.count("*").alias("n_keys")).withColumn("n_duplicates", F.col("n_rows") - F.col("n_keys"))


def shortfall(expected: DataFrame, found: DataFrame, by: Sequence[str], n: str = "expected") -> DataFrame:
    """Per group the expected and found number and what is missing."""
    have = found.groupBy(*by).agg(F.count("*").alias("found"))
    j = expected.join(have, list(by), "left").withColumn("found", F.coalesce("found", F.lit(0)))
    return j.withColumn("missing", F.greatest(F.col(n) - F.col("found"), F.lit(0)))


def gaps(df: DataFrame, by: Sequence[str], number: str) -> DataFrame:
    """Per group whether its numbers run without a gap, and how many are missing."""
    per = df.groupBy(*by).agg(F.min(number).alias("first"), F.max(number).alias("last"), F.countDistinct(number).alias("n"))
    return per.withColumn("n_missing", F.col("last") - F.col("first") + 1 - F.col("n")).withColumn("contiguous", F.col("n_missing") == 0)


def histogram(df: DataFrame, by: Sequence[str], value: str, width: float) -> DataFrame:
    """Rows per bucket of a number."""
    return df.filter(F.col(value).isNotNull()).groupBy(*by, F.floor(F.col(value) / width).alias("bucket")).agg(F.count("*").alias("n"))


def rate_alarm(df: DataFrame, by: Sequence[str], order: Sequence[Column], flag: Column, rows: int = 100, share: float = 0.15) -> DataFrame:
    """Rows at which at least ``share`` of the last ``rows`` rows (a full window) are flagged; groups may be of any size."""
    seen = sliding(df, by, order, rows, rate=F.avg(F.when(flag, 1.0).otherwise(0.0)), n_window=F.count("*"))
    return seen.filter((F.col("n_window") == rows) & (F.col("rate") >= share))


def hash_sample(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """``n`` rows with the least salted hash of their key: the same rows on every run."""
    return df.orderBy(F.xxhash64(F.lit(seed), F.col(key)), F.col(key)).limit(n)


def spread_sample(df: DataFrame, size: int, weight: str, at: str, key: str) -> DataFrame:
    """A quarter of the sample by weight, the rest evenly over time.

    The even part takes the first row of each of equally long stretches of time;
    a stretch without rows gives none.
    """
    heavy = df.orderBy(F.desc(weight), F.col(key)).limit(max(1, size // 4))
    rest = df.join(heavy.select(key), key, "left_anti")
    count = max(1, size - max(1, size // 4))
    second = F.unix_seconds(F.col(at).cast("timestamp"))
    lo, hi = rest.agg(F.min(second)).scalar(), rest.agg(F.max(second)).scalar()
    placed = rest.withColumn("slot", F.floor((second - lo) * count / (hi - lo + 1)))
    even = placed.groupBy("slot").agg(F.min(F.struct(F.col(at), F.col(key))).alias("pick")).select(F.col(f"pick.{key}").alias(key))
    return heavy.select(key, F.lit("weight").alias("chosen_by")).unionByName(even.select(key, F.lit("time").alias("chosen_by")))


def feature_counts(pages: DataFrame, group: str, features: str, page: str, least_share: float = 0.05, limit: int = 50) -> DataFrame:
    """Features on at least a share of a group's pages, most frequent first, with a sample value.

    ``features`` is an array of structs ``path, sample``.
    """
    total = pages.groupBy(group).agg(F.countDistinct(page).alias("n_group"))
    each = pages.select(group, page, F.inline(features))
    counted = each.groupBy(group, "path").agg(F.countDistinct(page).alias("n_pages"), F.min("sample").alias("sample"))
    kept = counted.join(total, group).filter(F.col("n_pages") >= F.greatest(F.lit(1), F.round(F.col("n_group") * least_share)))
    w = Window.partitionBy(group).orderBy(F.desc("n_pages"), "path")
    return kept.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= limit)


def requeue(children: DataFrame, cached: DataFrame, keys: Sequence[str], found: str = "found", done: str = "done", least_share: float = 0.5) -> DataFrame:
    """Children to read: those not done, or all if the cache holds less than a share of what the done ones gave."""
    promised = children.agg(F.coalesce(F.sum(F.when(F.col(done), F.col(found))), F.lit(0))).scalar()
    have = cached.select(*keys).distinct().agg(F.count("*")).scalar()
    return children.filter((have < promised * least_share) | ~F.coalesce(F.col(done), F.lit(False)))


def window_summary(windows: DataFrame, rows: DataFrame, window: str, key: Sequence[str], expected: str = "expected", settled: str = "settled") -> DataFrame:
    """Per window its expected and found keys, duplicate rows, what is missing, and its status.

    ``done`` if nothing is missing and the window is settled, ``incomplete`` if
    something is missing of a settled one, else ``open``.
    """
    per = rows.groupBy(window, *key).agg(F.count("*").alias("_n")).groupBy(window).agg(F.count("*").alias("found"), (F.sum("_n") - F.count("*")).alias("n_duplicates"))
    j = windows.join(per, window, "left").withColumn("found", F.coalesce("found", F.lit(0))).withColumn("n_duplicates", F.coalesce("n_duplicates", F.lit(0)))
    j = j.withColumn("missing", F.greatest(F.col(expected) - F.col("found"), F.lit(0)))
    status = F.when(~F.coalesce(F.col(settled), F.lit(False)), "open").when(F.col("missing") > 0, "incomplete").otherwise("done")
    return j.withColumn("status", status)


def next_children(children: DataFrame, state: DataFrame, url: str, epoch: str, order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` children not done in their present epoch, in the given order."""
    done = state.filter("done").select(url, epoch).distinct()
    return children.join(done, [url, epoch], "left_anti").orderBy(*order, F.col(url)).limit(k)


def path_categories(df: DataFrame, url: str) -> DataFrame:
    """``category, n``: addresses by the first part of their path, empty for none."""
    path = F.regexp_extract(F.col(url), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*://)?[^/?#]*/?([^/?#]*)", 1)
    return df.filter(F.col(url).isNotNull()).groupBy(path.alias("category")).agg(F.count("*").alias("n"))
