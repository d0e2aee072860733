"""A whole incremental run: what is pending, crawl by crawl, then compaction and retention."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vernissage.operators.merge import Store
from vernissage.session import small_rows
from vernissage.sources.crawl import pending, retention

#: Crawls of one run at most; each is a job of its own.
MAX_CRAWLS = 100_000


@dataclass
class Report:
    done: list[tuple[str, str]] = field(default_factory=list)
    failed: list[tuple[str, str, str]] = field(default_factory=list)

    @property
    def ok(self) -> bool:
        return not self.failed


def sync(manifests: DataFrame, ledger: DataFrame, rows_of: Callable[[str, str], DataFrame], store: Store) -> Report:
    """Publishes every pending crawl in order of its date; one that fails does not stop the others.

    A crawl that died half-way is simply published again: its partition is
    replaced as a whole.
    """
    report = Report()
    todo = pending(manifests, ledger).filter("action <> 'done'").select("platform_name", F.col("crawl_date").cast("string").alias("crawl_date"))
    for platform, day in sorted(small_rows(todo, MAX_CRAWLS, "the list of pending crawls"), key=lambda r: (r[1], r[0])):
        try:
            store.publish(rows_of(platform, day))
            report.done.append((platform, day))
        except Exception as e:  # noqa: BLE001 - reported, and the run fails at its end
            report.failed.append((platform, day, str(e)[:500]))
    if report.done:
        store.compact()
    return report


def ledger_rows(spark: SparkSession, report: Report, dataset: str) -> DataFrame:
    """What a run adds to the ledger."""
    rows = [(dataset, p, d, "completed", None) for p, d in report.done] + [(dataset, p, d, "failed", e) for p, d, e in report.failed]
    return spark.createDataFrame(rows, "dataset string, platform_name string, crawl_date string, status string, error string")


def may_be_deleted(folders: DataFrame, ledger: DataFrame, datasets: Sequence[str], keep: int = 2) -> DataFrame:
    return retention(folders, ledger, datasets, keep)
