"""What is new, updated, missing or flipped between two sets of keyed rows.

Keys are compared null-safe by anti joins: a null key on the left is kept, and
never matches. All functions read each side once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def missing(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    return before.join(after.select(*keys).distinct(), list(keys), "left_anti")


def flipped(before: DataFrame, after: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """Keys whose flag goes from false to true; null before is no flip."""
    b = before.filter(~F.col(flag)).select(*keys)
    return b.join(after.filter(F.col(flag)).select(*keys), list(keys))


def owners_gone(before: DataFrame, after: DataFrame, owner: str, by: Sequence[str] = ()) -> DataFrame:
    """Owners that have rows before and none after, in each pair of sides ``by`` tells apart."""
    keys = [*by, owner]
    return before.select(*keys).filter(F.col(owner).isNotNull()).distinct().join(after.select(*keys).distinct(), keys, "left_anti")


def vanished(before: DataFrame, after: DataFrame, key: str, flag: str, owner: str, least_share: float = 0.8, by: Sequence[str] = ()) -> DataFrame:
    """``by…, key, reason`` of rows that disappeared or whose flag turned true.

    ``by`` tells many pairs of sides apart, such as the source and the later
    crawl; each is judged on its own. Rows whose owner is gone are left out; a
    null owner is never gone. If the later side holds less than ``least_share``
    of the earlier one it is taken for incomplete, and only flips are reported.
    """
    keys = [*by, key]
    gone = missing(before, after, keys).join(owners_gone(before, after, owner, by), [*by, owner], "left_anti")
    if by:
        sizes = before.select(*by, F.lit(1).alias("b"), F.lit(0).alias("a")).unionByName(after.select(*by, F.lit(0).alias("b"), F.lit(1).alias("a"))).groupBy(*by).agg(F.sum("b").alias("b"), F.sum("a").alias("a"))
        disappeared = gone.join(sizes.filter(F.col("a") >= F.col("b") * least_share).select(*by), list(by), "left_semi")
    else:
        # The two counts are scalar subqueries.
        disappeared = gone.filter(after.agg(F.count("*")).scalar() >= before.agg(F.count("*")).scalar() * least_share)
    flips = flipped(before, after, keys, flag).select(*keys, F.lit("flagged").alias("reason"))
    return disappeared.select(*keys, F.lit("disappeared").alias("reason")).unionByName(flips)


def url_changes(entries: DataFrame, known: DataFrame, keys: Sequence[str], lastmod: str = "lastmod") -> DataFrame:
    """Best entry per key (newest, null never beats a date) with ``status`` new, updated or unchanged."""
    rest = [c for c in entries.columns if c not in (*keys, lastmod)]
    best = entries.filter(F.col(keys[0]).isNotNull()).groupBy(*keys).agg(F.max(F.struct(F.col(lastmod), *rest)).alias("e")).select(*keys, "e.*")
    old = known.groupBy(*keys).agg(F.max(lastmod).alias("stored"), F.lit(True).alias("known"))
    j = best.join(old, list(keys), "left")
    status = F.when(F.col("known").isNull(), "new").when(F.col(lastmod) > F.coalesce("stored", F.lit("0001-01-01").cast("timestamp")), "updated").otherwise("unchanged")
    return j.withColumn("status", status).drop("stored", "known")


def overlaps(sets: dict[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """``combination, n``: how many keys are in exactly each combination of sets.

    One aggregation over the union; sizes, intersections and the union follow.
    """
    rows = None
    for i, (_, s) in enumerate(sorted(sets.items())):
        part = s.select(*keys, F.lit(1 << i).alias("bit"))
        rows = part if rows is None else rows.unionByName(part)
    names = sorted(sets)
    per_key = rows.groupBy(*keys).agg(F.bit_or("bit").alias("bits"))
    label = F.concat_ws("+", *[F.when(F.col("bits").bitwiseAND(1 << i) != 0, n) for i, n in enumerate(names)])
    return per_key.groupBy(label.alias("combination")).agg(F.count("*").alias("n"))


def same_set(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row ``n_only_a, n_only_b, same``."""
    both = a.select(*keys, F.lit(1).alias("bit")).unionByName(b.select(*keys, F.lit(2).alias("bit"))).groupBy(*keys).agg(F.bit_or("bit").alias("bits"))
    counts = both.agg(F.count_if(F.col("bits") == 1).alias("n_only_a"), F.count_if(F.col("bits") == 2).alias("n_only_b"))
    return counts.withColumn("same", (F.col("n_only_a") + F.col("n_only_b")) == 0)


def completed_for_all(ledger: DataFrame, by: Sequence[str], required: Sequence[str], dataset: str = "dataset", ok: Column | None = None) -> DataFrame:
    """Groups of the ledger in which every required dataset is completed (relational division)."""
    done = ledger.filter((ok if ok is not None else F.col("status") == "completed") & F.col(dataset).isin(*required))
    return done.groupBy(*by).agg(F.countDistinct(dataset).alias("n")).filter(F.col("n") == len(set(required))).select(*by)
