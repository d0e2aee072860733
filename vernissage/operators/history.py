"""History of changing attributes: versions with the period in which each held.

Per entity the observations are folded, in order of time, by a higher-order
function that appends a version only where the value changes; the versions are
then exploded with their end times. There is at most one observation per
entity and crawl, so an entity's array is bounded by the number of crawls even
if one entity holds a third of all raw rows: those are combined map-side first.

Defined cases: observations without a time or a key value are ignored; several
observations at one time count as one (the greatest key, then value); an empty
input gives an empty history; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vernissage.functions.text import clean_id, fold, usable
from vernissage.operators.observations import best_per_crawl, best_rank, crawls_of, only_crawls


def fold_versions(observations: Column) -> Column:
    """Array of ``struct(at, value_key, value)`` → the same structs, of changes only."""
    ordered = F.array_sort(observations)

    def step(kept: Column, x: Column) -> Column:
        last = F.get(kept, F.size(kept) - 1)
        return F.when(last.getField("value_key") == x.getField("value_key"), kept).otherwise(F.concat(kept, F.array(x)))

    return F.aggregate(ordered, F.filter(ordered, lambda x: F.lit(False)), step)


def attribute_history(observations: DataFrame, entity: Sequence[str], at: str, value: str, key: str | None = None) -> DataFrame:
    """Versions ``entity…, version, value, valid_from, valid_to`` of an attribute.

    ``key`` names the column by which values are compared (the value itself by
    default). ``valid_to`` is exclusive and null for the version still valid.
    """
    key = key or value
    obs = observations.filter(F.col(at).isNotNull() & F.col(key).isNotNull())
    one = obs.groupBy(*entity, F.col(at).alias("at")).agg(F.max(F.struct(F.col(key).alias("value_key"), F.col(value).alias("value"))).alias("v"))
    packed = one.groupBy(*entity).agg(F.collect_list(F.struct("at", "v.value_key", "v.value")).alias("obs"))
    kept = packed.select(*entity, fold_versions(F.col("obs")).alias("kept"))
    ended = F.transform(
        "kept",
        lambda x, i: F.struct(
            (i + 1).alias("version"), x.getField("value").alias("value"), x.getField("at").alias("valid_from"), F.get("kept", i + 1).getField("at").alias("valid_to")
        ),
    )
    return kept.select(*entity, F.inline(ended))


def price_observations(artworks: DataFrame, ledger: DataFrame) -> DataFrame:
    """Price of each artwork in each completed crawl: the best row that has one."""
    rows = only_crawls(artworks.select("platform_name", "platform_artwork_id", "crawl_date", "price", "currency", "has_detail", "crawled_at", "source_file").filter("price is not null"), crawls_of(ledger, "artworks"))
    rows = rows.select("platform_name", clean_id("platform_artwork_id").alias("platform_id"), "crawl_date", "price", "currency", "has_detail", "crawled_at", "source_file").filter("platform_id is not null")
    return best_per_crawl(rows, ["platform_name", "platform_id", "crawl_date"], best_rank("has_detail", "crawled_at", "source_file"), ["price", "currency"])


def city_observations(artists: DataFrame, ledger: DataFrame) -> DataFrame:
    """City of each artist in each completed crawl: the newest row with a usable one."""
    rows = only_crawls(artists.select("platform_name", "platform_artist_id", "crawl_date", "city", "crawled_at", "source_file").filter(usable("city")), crawls_of(ledger, "artists"))
    rows = rows.select("platform_name", clean_id("platform_artist_id").alias("platform_id"), "crawl_date", "city", "crawled_at", "source_file").filter("platform_id is not null")
    best = best_per_crawl(rows, ["platform_name", "platform_id", "crawl_date"], best_rank("crawled_at", "source_file"), ["city"])
    return best.withColumn("place", fold("city"))


def price_history(artworks: DataFrame, ledger: DataFrame) -> DataFrame:
    return attribute_history(price_observations(artworks, ledger), ["platform_name", "platform_id"], "crawl_date", "price")


def city_history(artists: DataFrame, ledger: DataFrame) -> DataFrame:
    return attribute_history(city_observations(artists, ledger), ["platform_name", "platform_id"], "crawl_date", "city", key="place")
