"""What one crawl says about one entity: the best row of each crawl."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vernissage.session import broadcast_if_small

#: More ledger rows than this are joined by shuffle instead of by broadcast.
LEDGER_BROADCAST_ROWS = 100_000


def best_rank(*order: str | Column) -> Column:
    """Sort key whose maximum is the best row; nulls rank lowest in every part."""
    return F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])


def crawls_of(ledger: DataFrame, dataset: str, full_only: bool = False) -> DataFrame:
    """Completed crawls of a dataset: ``platform_name, crawl_date``, each once."""
    keep = (F.col("dataset") == dataset) & (F.col("status") == "completed")
    if full_only:
        keep &= F.col("crawl_mode") == "full"
    return ledger.filter(keep).select(F.col("source").alias("platform_name"), "crawl_date").distinct()


def only_crawls(rows: DataFrame, crawls: DataFrame) -> DataFrame:
    """Rows that belong to the given crawls. The ledger is broadcast only if counted small."""
    return rows.join(broadcast_if_small(crawls, LEDGER_BROADCAST_ROWS), ["platform_name", "crawl_date"], "left_semi")


def best_per_crawl(rows: DataFrame, keys: Sequence[str], rank: Column, values: Sequence[str]) -> DataFrame:
    """The values of the best row per key: one map-side combined ``max_by``.

    Ties in ``rank`` are broken by the values themselves, so the result does
    not depend on the order of rows. A hot key costs one partial row per task.
    """
    best = F.max(F.struct(rank.alias("_rank"), *values)).alias("best")
    return rows.groupBy(*keys).agg(best).select(*keys, *[F.col(f"best.{v}").alias(v) for v in values])

