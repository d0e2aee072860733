"""Registry of the core's queries and of the SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vernissage import page_queries, source_queries, survey_queries  # noqa: F401 - they register their queries
from vernissage.operators import history, snapdiff, units
from vernissage.session import table

Query = Callable[[SparkSession, str], DataFrame]


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every version but the first of artworks' prices and artists' cities."""
    ledger = table(spark, sf_dir, "crawls")
    prices = history.price_history(table(spark, sf_dir, "artworks"), ledger)
    cities = history.city_history(table(spark, sf_dir, "artists"), ledger)
    cols = ["platform_name", "platform_id", "valid_from", "version"]
    both = prices.select(F.lit("artwork").alias("entity_type"), *cols).unionByName(cities.select(F.lit("artist").alias("entity_type"), *cols))
    return both.filter("version > 1").select("entity_type", "platform_name", "platform_id", F.col("valid_from").cast("string").alias("valid_from"))


def p1_price_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All price versions with the period in which each held."""
    h = history.price_history(table(spark, sf_dir, "artworks"), table(spark, sf_dir, "crawls"))
    return h.select("platform_name", "platform_id", "version", "value", F.col("valid_from").cast("string").alias("valid_from"), F.col("valid_to").cast("string").alias("valid_to"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Widths in millimetres and prices in euro cents that are recorded in other units."""
    artworks = table(spark, sf_dir, "artworks")
    widths = units.widths_to_convert(artworks)
    prices = units.prices_to_convert(artworks, table(spark, sf_dir, "crawls"), table(spark, sf_dir, "fx_rates"))
    both = widths.withColumn("quantity", F.lit("width")).unionByName(prices.withColumn("quantity", F.lit("price")))
    return both.select("platform_name", "platform_artwork_id", "quantity", "common_value")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Artworks added, removed or changed between consecutive full crawls."""
    return snapdiff.artwork_changes(table(spark, sf_dir, "artworks"), table(spark, sf_dir, "crawls"))


_CLEAN_ID = "nullif(regexp_replace(regexp_replace({c}, '[\\x{{200B}}-\\x{{200F}}\\x{{202A}}-\\x{{202E}}\\x{{2060}}-\\x{{2064}}\\x{{FEFF}}\\x{{00AD}}\\x{{180E}}\\x{{FE00}}-\\x{{FE0F}}\\x{{061C}}]', '', 'g'), '^[\\s\\p{{Z}}\\p{{Cc}}]+|[\\s\\p{{Z}}\\p{{Cc}}]+$', '', 'g'), '')"
_ID_ARTWORK = _CLEAN_ID.format(c="platform_artwork_id")
#: SQL of an artist's cleaned id, also for the queries of the subpackage.
ID_ARTIST = _ID_ARTIST = _CLEAN_ID.format(c="platform_artist_id")

_PRICE_OBS = f"""
price_obs AS (
  SELECT platform_name, id AS platform_id, crawl_date, price, currency FROM (
    SELECT a.*, {_ID_ARTWORK} AS id, row_number() OVER (PARTITION BY a.platform_name, {_ID_ARTWORK}, a.crawl_date
      ORDER BY has_detail DESC NULLS LAST, crawled_at DESC NULLS LAST, source_file DESC NULLS LAST, price DESC, currency DESC NULLS LAST) AS rn
    FROM artworks a JOIN (SELECT DISTINCT source, crawl_date FROM crawls WHERE dataset = 'artworks' AND status = 'completed') c
      ON a.platform_name = c.source AND a.crawl_date = c.crawl_date
    WHERE price IS NOT NULL AND {_ID_ARTWORK} IS NOT NULL) WHERE rn = 1)"""

_CITY_OBS = f"""
city_obs AS (
  SELECT platform_name, id AS platform_id, crawl_date, place FROM (
    SELECT a.platform_name, a.crawl_date, {_ID_ARTIST} AS id,
      trim(regexp_replace(replace(strip_accents(lower(nfc_normalize(city))), 'ł', 'l'), '[\\s\\p{{Z}}]+', ' ', 'g')) AS place,
      row_number() OVER (PARTITION BY a.platform_name, {_ID_ARTIST}, a.crawl_date
        ORDER BY crawled_at DESC NULLS LAST, source_file DESC NULLS LAST, city DESC) AS rn
    FROM artists a JOIN (SELECT DISTINCT source, crawl_date FROM crawls WHERE dataset = 'artists' AND status = 'completed') c
      ON a.platform_name = c.source AND a.crawl_date = c.crawl_date
    WHERE {_ID_ARTIST} IS NOT NULL AND trim(regexp_replace(city, '[\\s\\p{{Z}}]+', ' ', 'g')) <> ''
      AND lower(trim(city)) NOT IN ('none','null','nan','n/a','na','-','--','unknown','unknown date','undefined')) WHERE rn = 1)"""

_SIZE_NORM = """lower(replace(replace(replace(replace(replace(replace(replace(regexp_replace({c}, '([0-9]),([0-9]{{1,2}})([^0-9]|$)', '\\1.\\2\\3', 'g'),
  '½',' 1/2'),'¼',' 1/4'),'¾',' 3/4'),'⅛',' 1/8'),'⅜',' 3/8'),'⅝',' 5/8'),'⅞',' 7/8'))"""

_N = "[0-9]+(?:\\.[0-9]+)?(?: [0-9]+/[0-9]+)?"
_P3_WIDTH = f"""
said AS (
  SELECT platform_name, {_ID_ARTWORK} AS id, width_cm, width_in, {_SIZE_NORM.format(c="coalesce(dimensions_cm, dimensions_in, dimensions)")} AS t,
    CASE WHEN dimensions_cm IS NOT NULL THEN 'cm' WHEN dimensions_in IS NOT NULL THEN 'in' END AS col_unit
  FROM artworks),
piece AS (
  SELECT *, CASE
      WHEN regexp_matches(t, '[0-9]"? (w|cm wide)') THEN regexp_extract(t, '({_N})"? (?:cm )?w', 1)
      WHEN regexp_matches(t, '^w [0-9]') THEN regexp_extract(t, '^w ({_N})', 1)
      WHEN regexp_matches(t, 'l. : |breite ') THEN regexp_extract(t, '(?:l. : |breite )({_N})', 1)
      ELSE regexp_extract(t, '^{_N}(?:''| ft)? ?(?:x|×|by) ?({_N})', 1) END AS num,
    CASE WHEN regexp_matches(t, '(''| ft) ?(x|×|by)') THEN regexp_extract(t, '(?:x|×|by) ?[0-9]+(?:''| ft ?)([0-9]+)', 1) END AS inches,
    CASE WHEN regexp_matches(t, '(''| ft) ?(x|×|by)') THEN 'ft' WHEN regexp_matches(t, 'in|"') THEN 'in' WHEN regexp_matches(t, 'mm') THEN 'mm'
      WHEN regexp_matches(t, 'cm') THEN 'cm' WHEN regexp_matches(t, '[0-9] ?m') THEN 'm' END AS named
  FROM said),
num AS (
  SELECT *, try_cast(regexp_extract(num, '^[0-9.]+') AS DECIMAL(14,4)) + coalesce(try_cast(regexp_extract(num, ' ([0-9]+)/', 1) AS DECIMAL(14,4)) / try_cast(regexp_extract(num, '/([0-9]+)', 1) AS INT), 0) AS n,
    coalesce(named, col_unit) AS unit
  FROM piece),
mm AS (
  SELECT platform_name, id, width_cm, CASE
      WHEN n IS NOT NULL AND unit IS NOT NULL THEN CASE unit WHEN 'ft' THEN (n * 12 + coalesce(try_cast(inches AS INT), 0)) * 25.4 WHEN 'in' THEN n * 25.4 WHEN 'mm' THEN n WHEN 'cm' THEN n * 10 ELSE n * 1000 END
      WHEN width_in IS NOT NULL THEN CAST(width_in AS DECIMAL(14,4)) * 25.4 ELSE CAST(width_cm AS DECIMAL(14,4)) * 10 END AS mm
  FROM num),
widths AS (
  SELECT platform_name, id, CAST(floor(max(mm) + 0.5) AS BIGINT) AS common_value FROM mm WHERE mm > 0 AND id IS NOT NULL
  GROUP BY ALL HAVING NOT bool_or(coalesce(abs(width_cm * 10 - CAST(mm AS DOUBLE)) <= 0.02 * CAST(mm AS DOUBLE), false)))"""

ORACLES: dict[str, str] = {
    "p1_found": f"""WITH {_PRICE_OBS}, {_CITY_OBS},
    obs AS (SELECT 'artwork' AS entity_type, platform_name, platform_id, crawl_date, CAST(price AS VARCHAR) AS v FROM price_obs
            UNION ALL SELECT 'artist', platform_name, platform_id, crawl_date, place FROM city_obs),
    prev AS (SELECT *, lag(v) OVER (PARTITION BY entity_type, platform_name, platform_id ORDER BY crawl_date) AS before FROM obs)
    SELECT entity_type, platform_name, platform_id, strftime(crawl_date, '%Y-%m-%d') AS valid_from FROM prev WHERE before IS NOT NULL AND before <> v""",
    "p1_price_history": f"""WITH {_PRICE_OBS},
    prev AS (SELECT *, lag(price) OVER (PARTITION BY platform_name, platform_id ORDER BY crawl_date) AS before FROM price_obs),
    v AS (SELECT * FROM prev WHERE before IS NULL OR before <> price)
    SELECT platform_name, platform_id, CAST(row_number() OVER w AS INT) AS version, price AS value, strftime(crawl_date, '%Y-%m-%d') AS valid_from,
      strftime(lead(crawl_date) OVER w, '%Y-%m-%d') AS valid_to FROM v WINDOW w AS (PARTITION BY platform_name, platform_id ORDER BY crawl_date)""",
    "p3_found": f"""WITH {_PRICE_OBS}, {_P3_WIDTH},
    latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY platform_name, platform_id ORDER BY crawl_date DESC) AS rn FROM price_obs) WHERE rn = 1),
    named AS (SELECT *, trim(regexp_replace(currency, '[\\s\\p{{Z}}]+', ' ', 'g')) AS cur FROM latest),
    coded AS (SELECT *, CASE WHEN cur IN ('GBp','GBX','pence') THEN 'GBP' WHEN cur IN ('US¢','USD cents') THEN 'USD' WHEN cur IN ('EUR cents','euro ct') THEN 'EUR'
        WHEN cur IN ('$','US$','U.S. Dollar') THEN 'USD' WHEN cur IN ('€','Euro') THEN 'EUR' WHEN cur IN ('£','Pound sterling') THEN 'GBP' WHEN cur = 'Swedish krona' THEN 'SEK'
        WHEN cur = 'SFr.' THEN 'CHF' WHEN cur IN ('CA$','C$') THEN 'CAD' WHEN cur IN ('AU$','A$') THEN 'AUD' WHEN cur IN ('¥','円') THEN 'JPY' WHEN cur = 'zł' THEN 'PLN' ELSE upper(cur) END AS code,
        CASE WHEN cur IN ('GBp','GBX','pence','US¢','USD cents','EUR cents','euro ct') THEN 1 ELSE 100 END AS parts FROM named)
    SELECT platform_name, id AS platform_artwork_id, 'width' AS quantity, common_value FROM widths
    UNION ALL
    SELECT platform_name, platform_id, 'price', CAST(floor(price * parts * CAST(CAST(eur_per_unit AS VARCHAR) AS DECIMAL(12,6)) + 0.5) AS BIGINT)
    FROM coded JOIN fx_rates f ON f.currency = code WHERE NOT (code = 'EUR' AND parts = 100)""",
    "p6_found": f"""WITH full_crawls AS (SELECT source, crawl_date, row_number() OVER (PARTITION BY source ORDER BY crawl_date) AS seq
      FROM (SELECT DISTINCT source, crawl_date FROM crawls WHERE dataset = 'artworks' AND status = 'completed' AND crawl_mode = 'full')),
    snap AS (SELECT * FROM (SELECT a.platform_name, {_ID_ARTWORK} AS id, c.seq, price, is_available_for_sale AS av,
        row_number() OVER (PARTITION BY a.platform_name, {_ID_ARTWORK}, c.seq ORDER BY has_detail DESC NULLS LAST, crawled_at DESC NULLS LAST, source_file DESC NULLS LAST, price DESC NULLS LAST, is_available_for_sale DESC NULLS LAST) AS rn
      FROM artworks a JOIN full_crawls c ON a.platform_name = c.source AND a.crawl_date = c.crawl_date WHERE {_ID_ARTWORK} IS NOT NULL) WHERE rn = 1),
    pairs AS (SELECT source, seq, crawl_date FROM full_crawls WHERE seq > 1),
    a AS (SELECT p.source, p.crawl_date, s.id, s.price, s.av FROM pairs p JOIN snap s ON s.platform_name = p.source AND s.seq = p.seq),
    b AS (SELECT p.source, p.crawl_date, s.id, s.price, s.av FROM pairs p JOIN snap s ON s.platform_name = p.source AND s.seq = p.seq - 1)
    SELECT coalesce(a.source, b.source) AS platform_name, coalesce(a.id, b.id) AS platform_artwork_id, strftime(coalesce(a.crawl_date, b.crawl_date), '%Y-%m-%d') AS crawl_date,
      CASE WHEN b.id IS NULL THEN 'added' WHEN a.id IS NULL THEN 'removed' ELSE 'changed' END AS change_kind
    FROM a FULL OUTER JOIN b ON a.source = b.source AND a.crawl_date = b.crawl_date AND a.id = b.id
    WHERE a.id IS NULL OR b.id IS NULL OR a.price IS DISTINCT FROM b.price OR a.av IS DISTINCT FROM b.av""",
}

QUERIES: dict[str, Query] = {f.__name__: f for f in (p1_found, p1_price_history, p3_found, p6_found)}

QUERIES |= survey_queries.QUERIES
ORACLES |= survey_queries.ORACLES
