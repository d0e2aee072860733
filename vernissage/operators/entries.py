"""Entries of sales and lots: which of them count, their twins, and the kinds of their lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vernissage.functions.text import _col


def items_of_sales(sales: DataFrame, items: DataFrame, sale: str, denied: Column, published: Column, lastmod: Sequence[Column]) -> DataFrame:
    """Published items of the sales that are not denied, with the first time there is as ``lastmod``."""
    kept = sales.filter(~F.coalesce(denied, F.lit(False)))
    return items.filter(F.coalesce(published, F.lit(True))).join(kept, sale).withColumn("lastmod", F.coalesce(*lastmod))


def newest_entries(entries: DataFrame, keys: Sequence[str], lastmod: str = "lastmod") -> DataFrame:
    """The newest entry of each key; one without a time never beats one with a time."""
    rest = [c for c in entries.columns if c not in (*keys, lastmod)]
    best = entries.groupBy(*keys).agg(F.max(F.struct(lastmod, *rest)).alias("_e"))
    return best.select(*keys, "_e.*").select(*entries.columns)


def with_twins(entries: DataFrame, url: str, twin: Column, kind: str = "kind", kinds: tuple[str, str] = ("live", "twin")) -> DataFrame:
    """Each entry under its own address and under that of its twin."""
    both = F.array(F.struct(F.col(url).alias(url), F.lit(kinds[0]).alias(kind)), F.struct(twin.alias(url), F.lit(kinds[1]).alias(kind)))
    rest = [c for c in entries.columns if c not in (url, kind)]
    return entries.select(*rest, F.inline(both)).filter(F.col(url).isNotNull())


def numbered_list(url: Column | str) -> Column:
    """``struct(kind, phase, number)`` of a child list named ``…<kind>[-<phase>]-<number>.…``; null if it is none."""
    pattern = r"([a-z]+?)s?(?:-(upcoming|past))?-(\d+)\.[a-z.]+$"
    kind, phase, number = (F.regexp_extract(_col(url), pattern, i) for i in (1, 2, 3))
    return F.when(number != "", F.struct(kind.alias("kind"), F.nullif(phase, F.lit("")).alias("phase"), number.cast("int").alias("number")))
