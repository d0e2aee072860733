"""Sitemaps, address lists and typed caches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vernissage.functions.scalars import to_timestamp
from vernissage.functions.text import clean_line
from vernissage.functions.urls import Rule, classify, normalize_url


def sitemap_entries(spark: SparkSession, path: str) -> DataFrame:
    """``url, lastmod, source`` of sitemaps (also compressed); broken files give no rows."""
    x = spark.read.format("xml").option("rowTag", "url").option("mode", "DROPMALFORMED").schema("loc string, lastmod string").load(path)
    return x.filter("loc is not null").select(clean_line("loc").alias("url"), to_timestamp("lastmod").alias("lastmod"), F.col("_metadata.file_path").alias("source"))


def sitemap_children(spark: SparkSession, path: str, include: str | None = None, exclude: str | None = None) -> DataFrame:
    """Children an index names, filtered by patterns."""
    x = spark.read.format("xml").option("rowTag", "sitemap").option("mode", "DROPMALFORMED").schema("loc string, lastmod string").load(path)
    c = x.filter("loc is not null").select(clean_line("loc").alias("url"), to_timestamp("lastmod").alias("lastmod"))
    if include:
        c = c.filter(F.col("url").rlike(include))
    return c.filter(~F.col("url").rlike(exclude)) if exclude else c


def typed_entries(entries: DataFrame, rules: Sequence[Rule], plain_only: bool = False) -> DataFrame:
    """Entries with ``entity_type, entity_id``; addresses no rule knows are dropped."""
    e = entries.filter(~F.col("url").rlike("[?#]")) if plain_only else entries
    typed = e.withColumn("url", normalize_url("url")).withColumn("_k", classify("url", rules)).filter("_k is not null")
    return typed.select("*", "_k.entity_type", "_k.entity_id").drop("_k")


def url_lines(spark: SparkSession, path: str) -> DataFrame:
    """Addresses of a text list, one per line; blank lines and comments are skipped."""
    t = spark.read.text(path).select(F.trim("value").alias("url"))
    return t.filter("url <> '' and not startswith(url, '#')")


def url_json(spark: SparkSession, path: str) -> DataFrame:
    """First address of ``url, request, endpoint, input`` or ``request.endpoint`` of each JSON line."""
    v = spark.read.text(path).select(F.try_parse_json("value").alias("v"))
    names = ["$.url", "$.request", "$.endpoint", "$.input", "$.request.endpoint"]
    texts = [F.nullif(F.try_variant_get("v", n, "string"), F.lit("")) for n in names]
    urls = [F.when(t.rlike(r"^(?i)https?://"), t) for t in texts]
    return v.select(F.coalesce(*urls).alias("url")).filter("url is not null")


def typed_cache(spark: SparkSession, path: str, default_type: str) -> DataFrame:
    """``entity_type, entity_id, url, lastmod`` of a cache of JSON lines."""
    c = spark.read.schema("entity_type string, entity_id string, url string, lastmod string, _bad string").option("columnNameOfCorruptRecord", "_bad").json(path)
    ok = c.filter("_bad is null and trim(entity_id) <> '' and trim(url) <> ''")
    return ok.select(F.coalesce(F.nullif(F.trim("entity_type"), F.lit("")), F.lit(default_type)).alias("entity_type"), F.trim("entity_id").alias("entity_id"), F.trim("url").alias("url"), to_timestamp("lastmod").alias("lastmod"))


def append_cache(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def write_url_list(df: DataFrame, path: str, column: str = "url") -> None:
    df.select(F.col(column).alias("value")).filter("value is not null").write.mode("overwrite").text(path)
