"""From pages to typed rows: extract a payload, map it by declared columns, reject the rest.

A ``Mapping`` declares for one source how rows are found in the payload and
where each column's value stands. It is data, not code: adding a source needs
no function. Everything runs on variants inside the JVM, except payloads that
are no JSON.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vernissage.functions.text import clean_text
from vernissage.operators.dedup import SortField, winners
from vernissage.operators.merge import Store


@dataclass(frozen=True)
class Mapping:
    """Rows of one source and dataset."""

    payload: Callable[[Column], Column]  # pages → variant
    rows: str  # path of the object or array of objects
    key: str
    columns: dict[str, tuple[str | tuple[str, ...], str]]  # column → (path, or paths in order of trust, type)
    convert: dict[str, Callable[[Column], Column]] = field(default_factory=dict)
    relevant: Callable[[Column], Column] | None = None
    derived: dict[str, Callable[[Column], Column]] = field(default_factory=dict)  # column → expression over the object


def fingerprint(m: Mapping) -> str:
    """Short digest of what a mapping declares; rows of different fingerprints were read differently."""
    said = repr((m.rows, m.key, sorted(m.columns.items()), sorted(m.convert), sorted(m.derived)))
    return hashlib.sha256(said.encode()).hexdigest()[:16]


def parsed(pages: DataFrame, m: Mapping, html: str = "html") -> DataFrame:
    """Pages with their payload in ``v``; null where none could be read."""
    return pages.withColumn("v", m.payload(F.col(html)))


def rejected(with_payload: DataFrame, reason: str = "no payload") -> DataFrame:
    return with_payload.filter("v is null").select("filename", F.lit(reason).alias("error"))


def mapped(with_payload: DataFrame, m: Mapping, keep: Sequence[str] = ("filename", "crawled_at")) -> DataFrame:
    """One row per object; rows without a key are dropped."""
    # Without a payload there is no array and so no row; a filter would read each payload once more.
    p = with_payload
    if m.relevant is not None:
        p = p.filter(F.col("v").isNotNull() & m.relevant(F.col("v")))
    found = F.try_variant_get("v", m.rows, "variant")
    # One object is handled as an array of one.
    items = F.coalesce(F.try_variant_get("v", m.rows, "array<variant>"), F.when(found.isNotNull(), F.array(found)))
    each = p.select(*keep, F.explode(items).alias("item"))

    def column(name: str, path: str | tuple[str, ...], kind: str) -> Column:
        c = F.coalesce(*[F.try_variant_get("item", p, kind) for p in ((path,) if isinstance(path, str) else path)])
        return m.convert[name](c).alias(name) if name in m.convert else c.alias(name)

    rows = each.select(*keep, *[column(n, path, kind) for n, (path, kind) in m.columns.items()], *[c(F.col("item")).alias(n) for n, c in m.derived.items()])
    return rows.withColumn(m.key, clean_text(F.col(m.key).cast("string"))).filter(F.col(m.key).isNotNull())


def filled_names(rows: DataFrame, page: str, key: str, name: str, position: str) -> DataFrame:
    """Rows without a name get the first one the same page gives for their id, in order of position."""
    there = rows.filter(F.col(name).isNotNull() & F.col(key).isNotNull())
    first = there.groupBy(page, key).agg(F.min(F.struct(position, name))[name].alias("_first"))
    return rows.join(first, [page, key], "left").withColumn(name, F.coalesce(name, "_first")).select(*rows.columns)


def run(pages: DataFrame, m: Mapping, order: Sequence[SortField], platform: str, crawl_date: str, store: Store | None = None) -> DataFrame:
    """Winners of one crawl, published if a store is given."""
    rows = mapped(parsed(pages, m), m).withColumnRenamed("filename", "source_file")
    rows = rows.withColumn("platform_name", F.lit(platform)).withColumn("crawl_date", F.lit(crawl_date).cast("date"))
    best = winners(rows, ["platform_name", "crawl_date", m.key], order)
    if store is not None:
        store.publish(best)
    return best


def run_stats(with_payload: DataFrame, rows: DataFrame) -> DataFrame:
    """One row of counters: pages, pages without payload, rows."""
    a = with_payload.agg(F.count("*").alias("files_total"), F.count_if(F.col("v").isNull()).alias("errors"))
    return a.withColumn("rows", rows.agg(F.count("*")).scalar())
