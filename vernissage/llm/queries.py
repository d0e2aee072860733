"""Registry of the queries of this subpackage and of the SQL they must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vernissage.llm import canonical, encoding, language, leakage, linkage, survivor
from vernissage.queries import ID_ARTIST
from vernissage.session import table

Query = Callable[[SparkSession, str], DataFrame]
_GROUP = ["platform_name", "platform_artist_id", "crawl_date"]


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From which page each field of an artist's surviving record comes, per crawl."""
    rows = survivor.artist_rows(table(spark, sf_dir, "artists"))
    found = survivor.survivors(rows, _GROUP, survivor.ARTIST_FIELDS, ["crawled_at", "source_file"], with_values=False)
    return survivor.chosen_sources(found, _GROUP, survivor.ARTIST_FIELDS).withColumn("crawl_date", F.col("crawl_date").cast("string"))


def p2_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The surviving record itself."""
    fields = ["full_name", "birth_year", "nationality", "country", "city"]
    rows = survivor.artist_rows(table(spark, sf_dir, "artists"), fields)
    found = survivor.survivors(rows, _GROUP, fields, ["crawled_at", "source_file"])
    return found.select("platform_name", "platform_artist_id", F.col("crawl_date").cast("string").alias("crawl_date"), "n_rows", *[F.col(f"{f}.value").alias(f) for f in fields])


def p2_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The surviving record with all its fields; ``p2_survivors`` is the record without the biography."""
    fields = survivor.ARTIST_FIELDS
    found = survivor.survivors(survivor.artist_rows(table(spark, sf_dir, "artists")), _GROUP, fields, ["crawled_at", "source_file"])
    return found.select("platform_name", "platform_artist_id", F.col("crawl_date").cast("string").alias("crawl_date"), "n_rows", *[F.col(f"{f}.value").alias(f) for f in fields])


def _judged(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    rows = survivor.artist_rows(table(spark, sf_dir, "artists"))
    # The biography tells nothing about how full a page is.
    with_age, source = survivor.page_source(rows, _GROUP, [f for f in survivor.ARTIST_FIELDS if f != "biography"])
    return rows, *survivor.value_quality(with_age, _GROUP, survivor.ARTIST_FIELDS, source, F.struct("source_file", "crawled_at"))


def p2_value_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posterior truth of every value of a group; several values may be retained."""
    _, judged, _ = _judged(spark, sf_dir)
    return judged.withColumn("crawl_date", F.col("crawl_date").cast("string")).withColumn("posterior", F.round("posterior", 4))


def p2_source_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensitivity and specificity the model infers for every source and field."""
    _, _, quality = _judged(spark, sf_dir)
    return quality.withColumn("sensitivity", F.round("sensitivity", 4)).withColumn("specificity", F.round("specificity", 4))


def p2_rule_and_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often the newest usable value, which ``p2_found`` asks for, is the model's choice."""
    rows, judged, _ = _judged(spark, sf_dir)
    return survivor.rule_and_model(rows, _GROUP, survivor.ARTIST_FIELDS, judged, ["crawled_at", "source_file"])


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names, biographies and titles written with other characters than they show."""
    return canonical.disguised_fields(table(spark, sf_dir, "artists"), table(spark, sf_dir, "artworks"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Artists and house listings that are the same person."""
    return linkage.matches(table(spark, sf_dir, "artists"), table(spark, sf_dir, "house_artists")).drop("confidence")


def p5_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates between classes of equal profiles with their confidence; a class is named by its least id."""
    pairs, _, _ = linkage.artist_listing_links(table(spark, sf_dir, "artists"), table(spark, sf_dir, "house_artists"))
    return pairs.select("a_id.*", "b_id.*", F.round("confidence", 4).alias("confidence"))


def p5_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members of the classes of ``p5_confidence``: the class's name and each record's."""
    _, people, houses = linkage.artist_listing_links(table(spark, sf_dir, "artists"), table(spark, sf_dir, "house_artists"))
    named = [p.select(F.lit(side).alias("side"), F.to_json("id").alias("class"), F.to_json("member").alias("member")) for side, p in (("artist", people), ("listing", houses))]
    return named[0].unionByName(named[1])


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    return encoding.encode_corpus(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "ids")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that reproduce a held-out item or a passage of it, and the items."""
    return leakage.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items")).select("doc_id", "item_id").distinct()


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of documents whose label is missing, wrong or not their only language."""
    docs = table(spark, sf_dir, "documents")
    return language.mislabelled(docs, language.fit_model(table(spark, sf_dir, "lang_samples"), docs)).select("doc_id", "lang")


def p9_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language and confidence of every segment of every document."""
    docs = table(spark, sf_dir, "documents")
    model = language.fit_model(table(spark, sf_dir, "lang_samples"), docs)
    return language.document_segments(docs, model).withColumn("confidence", F.round("confidence", 4))


_UNUSABLE = "('none','null','nan','n/a','na','-','--','unknown','unknown date','undefined','')"
_P2_FIELDS = ["full_name", "birth_year", "nationality", "country", "city", "biography"]


def _usable_sql(f: str) -> str:
    return "coalesce(birth_year, 0) <> 0" if f == "birth_year" else f"{f} IS NOT NULL AND lower(regexp_replace({f}, '^[\\s\\p{{Z}}\\p{{C}}]+|[\\s\\p{{Z}}\\p{{C}}]+$', '', 'g')) NOT IN {_UNUSABLE}"


ORACLES: dict[str, str] = {
    "p2_found": "WITH a AS (SELECT *, "
    + ID_ARTIST
    + " AS id FROM artists), g AS (SELECT platform_name, id, crawl_date FROM a WHERE id IS NOT NULL GROUP BY ALL HAVING count(*) > 1), "
    + "c AS ("
    + " UNION ALL ".join(f"SELECT platform_name, id, crawl_date, '{f}' AS field_name, source_file, crawled_at FROM a WHERE {_usable_sql(f)}" for f in _P2_FIELDS)
    + "), r AS (SELECT *, row_number() OVER (PARTITION BY platform_name, id, crawl_date, field_name ORDER BY crawled_at DESC NULLS LAST, source_file DESC NULLS LAST) AS rn FROM c)"
    + " SELECT r.platform_name, r.id AS platform_artist_id, strftime(r.crawl_date, '%Y-%m-%d') AS crawl_date, field_name, source_file FROM r JOIN g USING (platform_name, id, crawl_date) WHERE rn = 1",
}

ORACLES["p2_survivors"] = (
    f"WITH a AS (SELECT *, {ID_ARTIST} AS id, coalesce(crawled_at, TIMESTAMPTZ '0001-01-01 00:00:00+00') AS seen, coalesce(source_file, '') AS src FROM artists) "
    "SELECT platform_name, id AS platform_artist_id, strftime(crawl_date, '%Y-%m-%d') AS crawl_date, count(*) AS n_rows, "
    + ", ".join(f"arg_max({f}, (seen, src, {f})) FILTER (WHERE {_usable_sql(f)}) AS {f}" for f in _P2_FIELDS[:-1])
    + " FROM a WHERE id IS NOT NULL GROUP BY platform_name, id, a.crawl_date"
)

ORACLES["p2_records"] = (
    f"WITH a AS (SELECT *, {ID_ARTIST} AS id, coalesce(crawled_at, TIMESTAMPTZ '0001-01-01 00:00:00+00') AS seen, coalesce(source_file, '') AS src FROM artists) "
    "SELECT platform_name, id AS platform_artist_id, strftime(crawl_date, '%Y-%m-%d') AS crawl_date, count(*) AS n_rows, "
    + ", ".join(f"arg_max({f}, (seen, src, {f})) FILTER (WHERE {_usable_sql(f)}) AS {f}" for f in _P2_FIELDS)
    + " FROM a WHERE id IS NOT NULL GROUP BY platform_name, id, a.crawl_date"
)

QUERIES: dict[str, Query] = {f.__name__: f for f in (p2_found, p2_survivors, p2_records, p2_value_quality, p2_source_quality, p2_rule_and_model, p4_found, p5_found, p5_confidence, p5_classes, p7_ids, p8_found, p9_found, p9_segments)}
