"""Queries of the general operators over whole tables, each with equivalent SQL.

The prefix of a query's name tells the kind of operator: f scalar functions, c
catalogue text, u addresses, g de-duplication, m merges, j joins and
differences, a aggregations, w windows, o order and samples, x sets, r ranges,
i incremental runs, k stores, p payloads.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vernissage.functions import catalogue, payload, scalars, text, urls
from vernissage.operators import audit, dedup, diffs, merge, partitioning
from vernissage.operators.dedup import SortField
from vernissage.operators.observations import best_per_crawl, best_rank, crawls_of, only_crawls
from vernissage.operators.snapdiff import consecutive_crawls
from vernissage.session import checkpoint, shared_folder, table
from vernissage.sources import crawl
from vernissage.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: The year beyond which no work or birth can lie, for the queries here.
AS_OF = 2026
CODES = {"FR": "France", "DE": "Germany", "IT": "Italy", "ES": "Spain", "PT": "Portugal", "NL": "Netherlands", "PL": "Poland", "SE": "Sweden", "GB": "United Kingdom", "US": "United States"}
NETWORKS = {"facebook": ("social-f.example",), "instagram": ("social-i.example",), "tiktok": ("social-t.example",), "twitter": ("social-x.example",)}
RULES = (urls.Rule("artist", r"^/artist/([^/]+)$"), urls.Rule("artwork", r"^/art/([^/]+)$"))
ARTWORK_ORDER = (SortField("has_detail"), SortField("crawled_at"), SortField("source_file"))
ARTIST_ORDER = (SortField("crawled_at"), SortField("source_file"))

_SPACE = r"[\s\p{Z}\p{Cc}]+"
_HIDDEN = r"[\x{200B}-\x{200F}\x{202A}-\x{202E}\x{2060}-\x{2064}\x{FEFF}\x{00AD}\x{180E}\x{FE00}-\x{FE0F}\x{061C}]"
_WORDS = "('none','null','nan','n/a','na','-','--','unknown','unknown date','undefined','')"


def _line(c: str) -> str:
    return rf"trim(regexp_replace(regexp_replace({c}, '{_HIDDEN}', '', 'g'), '{_SPACE}', ' ', 'g'))"


def _clean(c: str) -> str:
    return f"(CASE WHEN lower({_line(c)}) IN {_WORDS} THEN NULL ELSE {_line(c)} END)"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# ── scalar functions ────────────────────────────────────────────────────────────


@query(f"SELECT {_clean('nationality')} AS nationality, {_clean('country')} AS country, count(*) AS n FROM artists GROUP BY ALL")
def f_clean_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "artists").groupBy(text.clean_text("nationality").alias("nationality"), text.clean_text("country").alias("country")).agg(F.count("*").alias("n"))


@query("SELECT l_returnflag, count(*) AS n, sum(CAST(l_extendedprice AS DECIMAL(14,2))) AS total FROM lineitem GROUP BY 1")
def f_money(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select("l_returnflag", scalars.to_money(F.format_number("l_extendedprice", 2)).alias("m"))
    return rows.groupBy("l_returnflag").agg(F.count("m").alias("n"), F.sum("m").alias("total"))


@query(f"SELECT CASE WHEN regexp_full_match(upper({_clean('currency')}), '[A-Z]{{3}}') THEN upper({_clean('currency')}) END AS code, count(*) AS n FROM artworks GROUP BY 1")
def f_currency_code(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "artworks").groupBy(scalars.currency_code("currency").alias("code")).agg(F.count("*").alias("n"))


@query(f"SELECT y AS year, count(*) AS n FROM (SELECT CASE WHEN v BETWEEN 1000 AND {AS_OF} THEN v END AS y FROM (SELECT try_cast(regexp_extract(title, '\\b([0-9]{{4}})\\b', 1) AS INT) AS v FROM artworks)) GROUP BY 1")
def f_year(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "artworks").groupBy(scalars.year_of("title", AS_OF).alias("year")).agg(F.count("*").alias("n"))


@query(
    "SELECT CASE WHEN g IN ('m','man','male') THEN 'male' WHEN g IN ('f','woman','female') THEN 'female' ELSE g END AS gender, count(*) AS n "
    f"FROM (SELECT lower(regexp_extract({_clean('gender')}, '[^/]*$')) AS g FROM artists) GROUP BY 1"
)
def f_gender(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "artists").groupBy(scalars.gender("gender").alias("gender")).agg(F.count("*").alias("n"))


@query(f"SELECT CASE {' '.join(f'''WHEN upper(c) = '{k}' THEN '{v}' ''' for k, v in CODES.items())} ELSE c END AS country, count(*) AS n FROM (SELECT {_clean('country')} AS c FROM artists) GROUP BY 1")
def f_country(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "artists").groupBy(scalars.country_name("country", CODES).alias("country")).agg(F.count("*").alias("n"))


@query("SELECT regexp_extract(lower(profile_url), '^https?://(?:www\\.)?([^/:]+)', 1) AS host, count(*) AS n FROM artists WHERE profile_url IS NOT NULL GROUP BY 1")
def f_host(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "artists").filter("profile_url is not null").groupBy(scalars.host_of(scalars.to_url("profile_url")).alias("host")).agg(F.count("*").alias("n"))


@query("SELECT platform_name, count(website) AS website, count(facebook) AS facebook, count(instagram) AS instagram, count(tiktok) AS tiktok, count(twitter) AS twitter FROM artists GROUP BY 1")
def f_sort_links(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "artists")
    links = scalars.sort_links(F.array("twitter", "website", "tiktok", "instagram", "facebook"), (), NETWORKS)
    s = a.select("platform_name", links.alias("l")).select("platform_name", "l.*")
    return s.groupBy("platform_name").agg(*[F.count(c).alias(c) for c in ("website", *NETWORKS)])


@query("SELECT CAST(strftime(ts, '%Y-%m-%d') AS VARCHAR) AS day, count(*) AS n FROM events GROUP BY 1")
def f_to_date(spark: SparkSession, d: str) -> DataFrame:
    ms = F.unix_millis(F.col("ts").cast("timestamp")).cast("string")
    return table(spark, d, "events").groupBy(scalars.to_date(ms).cast("string").alias("day")).agg(F.count("*").alias("n"))


@query()
def f_plain_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", scalars.plain_text("text").alias("plain"))


@query("SELECT platform_name, count(*) AS n FROM artworks WHERE coalesce(len(styles), 0) + coalesce(len(mediums), 0) > 0 GROUP BY 1")
def f_text_list(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "artworks").filter(scalars.text_list("styles", "mediums").isNotNull()).groupBy("platform_name").agg(F.count("*").alias("n"))


@query("SELECT platform_name, count(*) AS n, min(strftime(coalesce(crawled_at, CAST(crawl_date AS TIMESTAMPTZ)), '%Y-%m-%d %H:%M:%S')) AS first_seen FROM artists GROUP BY 1")
def f_seen_at(spark: SparkSession, d: str) -> DataFrame:
    s = crawl.with_seen(table(spark, d, "artists"))
    return s.groupBy("platform_name").agg(F.count("seen_at").alias("n"), F.date_format(F.min("seen_at"), "yyyy-MM-dd HH:mm:ss").alias("first_seen"))


# ── catalogue text and addresses ────────────────────────────────────────────────


@query("SELECT CASE WHEN regexp_matches(signature, '(?i)\\bsigned\\b') THEN true END AS signed, count(*) AS n FROM artworks GROUP BY 1")
def c_signed(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "artworks").groupBy(catalogue.is_signed("signature").alias("signed")).agg(F.count("*").alias("n"))


@query()
def c_medium(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "artworks")
    line = F.concat_ws(", ", "technique", F.concat(F.lit("on "), F.lower("support")), "signature")
    return a.groupBy(catalogue.medium(line).alias("medium")).agg(F.count("*").alias("n"))


@query(
    "SELECT y AS year_made, count(*) AS n FROM (SELECT try_cast(nullif(regexp_extract(description, '(?i)\\b(?:painted|executed|drawn|cast|carved|printed|created|made|reali[sz]ed|peinte?|réalisée?|exécutée?|dipinto|gemalt)\\s+(?:in\\s+|en\\s+|nel\\s+)?(1[4-9][0-9]{2}|20[0-9]{2})', 1), '') AS INT) AS y FROM artworks) "
    f"WHERE y IS NULL OR y <= {AS_OF} GROUP BY 1"
)
def c_year_made(spark: SparkSession, d: str) -> DataFrame:
    y = catalogue.year_made("description", F.lit(None).cast("string"), F.lit(None).cast("int"), AS_OF)
    return table(spark, d, "artworks").groupBy(y.alias("year_made")).agg(F.count("*").alias("n"))


@query("SELECT platform_artwork_id, platform_name, crawl_date, regexp_replace(artwork_url, '[?#].*$', '') AS url, sha1(artwork_url) || '.html' AS filename FROM artworks WHERE artwork_url IS NOT NULL GROUP BY ALL")
def u_normalize(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "artworks").filter("artwork_url is not null")
    return a.select("platform_artwork_id", "platform_name", "crawl_date", urls.normalize_url("artwork_url").alias("url"), urls.page_filename("artwork_url").alias("filename")).distinct()


@query(
    "SELECT entity_type, count(*) AS n, count(DISTINCT id) AS n_ids FROM ("
    "SELECT 'artist' AS entity_type, regexp_extract(profile_url, '/artist/([^/?#]+)$', 1) AS id FROM artists UNION ALL SELECT 'artwork', regexp_extract(artwork_url, '/art/([^/?#]+)$', 1) FROM artworks) WHERE id <> '' GROUP BY 1"
)
def u_classify(spark: SparkSession, d: str) -> DataFrame:
    u = table(spark, d, "artists").select(F.col("profile_url").alias("url")).unionByName(table(spark, d, "artworks").select(F.col("artwork_url").alias("url")))
    k = u.select(urls.classify("url", RULES).alias("k")).filter("k is not null").select("k.*")
    return k.groupBy("entity_type").agg(F.count("*").alias("n"), F.countDistinct("entity_id").alias("n_ids"))


# ── de-duplication, merges and stores ───────────────────────────────────────────

_ARTWORK_WINNERS = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY platform_name, crawl_date, platform_artwork_id ORDER BY has_detail DESC NULLS LAST, crawled_at DESC NULLS LAST, source_file DESC NULLS LAST) AS rn FROM artworks WHERE platform_artwork_id <> '') WHERE rn = 1)"
_ARTIST_WINNERS = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY platform_name, crawl_date, platform_artist_id ORDER BY crawled_at DESC NULLS LAST, source_file DESC NULLS LAST) AS rn FROM artists WHERE platform_artist_id <> '') WHERE rn = 1)"
_SHORT = ["platform_name", "crawl_date", "platform_artwork_id", "price", "is_sold", "has_detail", "crawled_at", "source_file"]


def _artwork_winners(spark: SparkSession, d: str, cols: list[str] | None = None) -> DataFrame:
    return dedup.winners(table(spark, d, "artworks").select(*(cols or _SHORT)), ["platform_name", "crawl_date", "platform_artwork_id"], ARTWORK_ORDER)


@query(f"SELECT platform_name, crawl_date, platform_artwork_id, price, is_sold, has_detail, source_file FROM {_ARTWORK_WINNERS}")
def g_artwork_winners(spark: SparkSession, d: str) -> DataFrame:
    return _artwork_winners(spark, d).drop("crawled_at")


@query(f"SELECT platform_name, crawl_date, platform_artist_id, full_name, birth_year, city, source_file FROM {_ARTIST_WINNERS}")
def g_artist_winners(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "artists").select("platform_name", "crawl_date", "platform_artist_id", "full_name", "birth_year", "city", "source_file", "crawled_at")
    return dedup.winners(a, ["platform_name", "crawl_date", "platform_artist_id"], ARTIST_ORDER).drop("crawled_at")


@query(
    f"SELECT platform_name, platform_artwork_id, strftime(max(crawl_date), '%Y-%m-%d') AS latest_version, arg_max(price, crawl_date) FILTER (WHERE true) AS price, strftime(arg_min(coalesce(crawled_at, CAST(crawl_date AS TIMESTAMPTZ)), crawl_date), '%Y-%m-%d %H:%M:%S') AS first_seen_at FROM (SELECT platform_name, platform_artwork_id, crawl_date, crawled_at, coalesce(price, -1) AS price FROM {_ARTWORK_WINNERS}) GROUP BY 1, 2"
)
def g_current(spark: SparkSession, d: str) -> DataFrame:
    c = merge.current_state(_artwork_winners(spark, d), ["platform_name", "platform_artwork_id"])
    return c.select("platform_name", "platform_artwork_id", F.col("latest_version").cast("string").alias("latest_version"), F.coalesce("price", F.lit(-1)).cast("decimal(14,2)").alias("price"), F.date_format("first_seen_at", "yyyy-MM-dd HH:mm:ss").alias("first_seen_at"))


@query("SELECT event_type, user_id, min(event_id) AS event_id FROM events GROUP BY 1, 2")
def g_first_rows(spark: SparkSession, d: str) -> DataFrame:
    return dedup.first_rows(table(spark, d, "events").select("event_type", "user_id", "event_id"), ["event_type", "user_id"], "event_id")


@query("SELECT o_custkey, o_orderkey, rank FROM (SELECT o_custkey, o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS INT) AS rank FROM orders) WHERE rank <= 2")
def g_top_k(spark: SparkSession, d: str) -> DataFrame:
    return dedup.top_k(table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], [F.desc("o_totalprice"), F.col("o_orderkey")], 2).select("o_custkey", "o_orderkey", "rank")


@query("SELECT user_id, event_type, CAST(max(ts) AS VARCHAR)[:19] AS last_seen, CAST(min(ts) AS VARCHAR)[:19] AS first_seen, count(*) AS n_rows, arg_max(props, (length(props), props)) AS props FROM events GROUP BY 1, 2")
def g_latest_and_canonical(spark: SparkSession, d: str) -> DataFrame:
    r = dedup.latest_and_canonical(table(spark, d, "events"), ["user_id", "event_type"], "ts", "props", F.length("props"))
    return r.select("user_id", "event_type", F.date_format("last_seen", "yyyy-MM-dd HH:mm:ss").alias("last_seen"), F.date_format("first_seen", "yyyy-MM-dd HH:mm:ss").alias("first_seen"), "n_rows", "props")


@query("SELECT k, min(r) AS source_rank FROM (SELECT s_nationkey AS k, 0 AS r FROM supplier UNION ALL SELECT c_nationkey, 1 FROM customer UNION ALL SELECT n_nationkey, 2 FROM nation) GROUP BY 1")
def g_priority_union(spark: SparkSession, d: str) -> DataFrame:
    parts = [table(spark, d, t).select(F.col(c).alias("k")) for t, c in (("supplier", "s_nationkey"), ("customer", "c_nationkey"), ("nation", "n_nationkey"))]
    return dedup.priority_union(parts, ["k"])


@query(
    f"WITH o AS (SELECT platform_name, platform_artist_id, city, birth_year FROM (SELECT *, row_number() OVER (PARTITION BY platform_name, platform_artist_id ORDER BY crawl_date) AS k FROM {_ARTIST_WINNERS}) WHERE k = 1), "
    f"n AS (SELECT platform_name, platform_artist_id, city, birth_year FROM (SELECT *, row_number() OVER (PARTITION BY platform_name, platform_artist_id ORDER BY crawl_date DESC) AS k FROM {_ARTIST_WINNERS}) WHERE k = 1) "
    "SELECT platform_name, platform_artist_id, coalesce(n.city, o.city) AS city, coalesce(n.birth_year, o.birth_year) AS birth_year FROM o FULL JOIN n USING (platform_name, platform_artist_id)"
)
def m_merge_columns(spark: SparkSession, d: str) -> DataFrame:
    cols = ["platform_name", "crawl_date", "platform_artist_id", "city", "birth_year", "crawled_at", "source_file"]
    w = dedup.winners(table(spark, d, "artists").select(*cols), ["platform_name", "crawl_date", "platform_artist_id"], ARTIST_ORDER)
    key = ["platform_name", "platform_artist_id"]
    new = dedup.winners(w, key, [SortField("crawl_date")]).select(*key, "city", "birth_year")
    old = dedup.winners(w, key, [SortField("crawl_date", descending=False)]).select(*key, "city", "birth_year")
    return merge.merge_columns(old, new, key)


@query("SELECT o_custkey, arg_max(o_orderpriority, o_orderkey) AS o_orderpriority, arg_max(st, o_orderkey) FILTER (WHERE st IS NOT NULL) AS st FROM (SELECT *, nullif(o_orderstatus, 'O') AS st FROM orders) GROUP BY 1")
def m_fold_columns(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderpriority", F.nullif("o_orderstatus", F.lit("O")).alias("st"))
    return merge.fold_columns(o, ["o_custkey"], "o_orderkey")


@query("SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem WHERE l_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') UNION ALL SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem WHERE l_returnflag = 'R'")
def m_replace_children(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return merge.replace_children(li, li.filter("l_returnflag = 'R'"), ["l_orderkey"])


@query("SELECT platform_name, value, CAST(pos - 1 AS INT) AS position, count(*) AS n FROM (SELECT platform_name, unnest(styles) AS value, generate_subscripts(styles, 1) AS pos FROM artworks WHERE len(styles) > 0) GROUP BY ALL")
def m_children(spark: SparkSession, d: str) -> DataFrame:
    return merge.children(table(spark, d, "artworks"), ["platform_name"], "styles").groupBy("platform_name", "value", "position").agg(F.count("*").alias("n"))


@query("SELECT value, 1 AS n FROM (SELECT DISTINCT unnest(list_concat(coalesce(styles, []), coalesce(mediums, []))) AS value FROM artworks) WHERE value IS NOT NULL")
def m_assign_ids(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "artworks")
    known = merge.assign_ids(spark.createDataFrame([], "id bigint, value string"), a.select(F.explode("styles").alias("value")), "value")
    return merge.assign_ids(known, a.select(F.explode("mediums").alias("value")), "value").groupBy("value").agg(F.countDistinct("id").cast("int").alias("n"))


@query(f"SELECT platform_name, platform_artwork_id, strftime(max(crawl_date), '%Y-%m-%d') AS latest_version FROM {_ARTWORK_WINNERS} GROUP BY 1, 2")
def k_publish_and_compact(spark: SparkSession, d: str) -> DataFrame:
    """Versions of all crawls are written, published again for one source, compacted and read."""
    root = f"{_scratch(spark)}/{uuid.uuid4().hex}"
    store = merge.Store(spark, root, "artworks", "platform_artwork_id", ARTWORK_ORDER)
    rows = table(spark, d, "artworks").select(*_SHORT)
    store.publish(rows)
    store.publish(rows.filter("platform_name = 'murora'"))
    store.compact()
    return store.read("current").select("platform_name", "platform_artwork_id", F.col("latest_version").cast("string").alias("latest_version"))


def _scratch(spark: SparkSession) -> str:
    """Shared folder for written tables, beside the checkpoints."""
    return f"{shared_folder(spark)}/vernissage"


# ── joins and differences ───────────────────────────────────────────────────────

def _id(c: str) -> str:
    return f"nullif(regexp_replace(regexp_replace({c}, '{_HIDDEN}', '', 'g'), '^{_SPACE}|{_SPACE}$', '', 'g'), '')"


@query(
    f"WITH n AS (SELECT * REPLACE ({_id('platform_artwork_id')} AS platform_artwork_id, {_id('platform_artist_id')} AS platform_artist_id) FROM artworks), "
    "w AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY platform_name, crawl_date, platform_artwork_id ORDER BY has_detail DESC NULLS LAST, crawled_at DESC NULLS LAST, source_file DESC NULLS LAST, platform_artist_id DESC NULLS LAST, is_sold DESC NULLS LAST) AS rn FROM n WHERE platform_artwork_id IS NOT NULL) WHERE rn = 1), "
    "c AS (SELECT source, crawl_date, lag(crawl_date) OVER (PARTITION BY source ORDER BY crawl_date) AS previous FROM (SELECT DISTINCT source, crawl_date FROM crawls WHERE dataset = 'artworks' AND status = 'completed' AND crawl_mode = 'full')), "
    "b AS (SELECT w.platform_name, c.crawl_date AS d, platform_artwork_id AS k, platform_artist_id AS o, is_sold FROM w JOIN c ON w.platform_name = c.source AND w.crawl_date = c.previous), "
    "a AS (SELECT w.platform_name, c.crawl_date AS d, platform_artwork_id AS k, platform_artist_id AS o, is_sold FROM w JOIN c ON w.platform_name = c.source AND w.crawl_date = c.crawl_date WHERE c.previous IS NOT NULL), "
    "nb AS (SELECT platform_name, d, count(*) AS n FROM b GROUP BY ALL), na AS (SELECT platform_name, d, count(*) AS n FROM a GROUP BY ALL), whole AS (SELECT platform_name, d FROM nb JOIN na USING (platform_name, d) WHERE na.n >= 0.8 * nb.n), "
    "f AS (SELECT platform_name, d, k, 'disappeared' AS reason FROM b JOIN whole USING (platform_name, d) WHERE NOT EXISTS (SELECT 1 FROM a WHERE (a.platform_name, a.d, a.k) = (b.platform_name, b.d, b.k)) "
    "AND (b.o IS NULL OR EXISTS (SELECT 1 FROM a WHERE (a.platform_name, a.d, a.o) = (b.platform_name, b.d, b.o))) "
    "UNION ALL SELECT a.platform_name, a.d, a.k, 'flagged' FROM a JOIN b USING (platform_name, d, k) WHERE a.is_sold AND NOT b.is_sold) "
    "SELECT platform_name, strftime(d, '%Y-%m-%d') AS crawl_date, k AS platform_artwork_id, reason FROM f"
)
def j_vanished_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Each full crawl of every source against the full crawl before it."""
    crawls = consecutive_crawls(crawls_of(table(spark, d, "crawls"), "artworks", full_only=True)).drop("seq")
    columns = [c for c in _SHORT if c not in ("platform_artwork_id", "price")]
    ids = [text.clean_id(c).alias(c) for c in ("platform_artwork_id", "platform_artist_id")]
    rows = only_crawls(table(spark, d, "artworks").select(*columns, *ids), crawls)
    best = best_per_crawl(rows.filter("platform_artwork_id is not null"), ["platform_name", "crawl_date", "platform_artwork_id"], best_rank("has_detail", "crawled_at", "source_file"), ["platform_artist_id", "is_sold"])
    best = checkpoint(best)
    pairs = crawls.filter("previous is not null")
    before = best.withColumnRenamed("crawl_date", "previous").join(pairs, ["platform_name", "previous"]).drop("previous")
    after = best.join(pairs.drop("previous"), ["platform_name", "crawl_date"])
    found = diffs.vanished(before, after, "platform_artwork_id", "is_sold", "platform_artist_id", by=["platform_name", "crawl_date"])
    return found.withColumn("crawl_date", F.col("crawl_date").cast("string"))


@query(
    "WITH e AS (SELECT user_id, event_type, max(ts) AS ts FROM events GROUP BY 1, 2), k AS (SELECT user_id, event_type, max(ts) AS ts FROM events WHERE ts < TIMESTAMP '2024-01-15' AND event_type <> 'signup' GROUP BY 1, 2) "
    "SELECT CASE WHEN k.user_id IS NULL THEN 'new' WHEN e.ts > k.ts THEN 'updated' ELSE 'unchanged' END AS status, count(*) AS n FROM e LEFT JOIN k USING (user_id, event_type) GROUP BY 1"
)
def j_url_changes(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("user_id", "event_type", F.col("ts").cast("timestamp").alias("lastmod"))
    known = e.filter("lastmod < timestamp'2024-01-15' and event_type <> 'signup'")
    return diffs.url_changes(e, known, ["user_id", "event_type"]).groupBy("status").agg(F.count("*").alias("n"))


@query("SELECT source, crawl_date FROM crawls WHERE status = 'completed' AND dataset IN ('artists', 'artworks') GROUP BY 1, 2 HAVING count(DISTINCT dataset) = 2")
def j_completed_for_all(spark: SparkSession, d: str) -> DataFrame:
    return diffs.completed_for_all(table(spark, d, "crawls"), ["source", "crawl_date"], ["artists", "artworks"])


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL)")
def j_missing(spark: SparkSession, d: str) -> DataFrame:
    return diffs.missing(table(spark, d, "customer").select("c_custkey"), table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


# ── aggregations, windows, samples, sets ────────────────────────────────────────


@query("SELECT event_type, count(*) AS n, count(*) FILTER (WHERE value > 50) AS large, count(*) FILTER (WHERE props IS NULL) AS bare FROM events GROUP BY 1")
def a_counters(spark: SparkSession, d: str) -> DataFrame:
    return audit.counters(table(spark, d, "events"), ["event_type"], large=F.col("value") > 50, bare=F.col("props").isNull())


@query("SELECT count(*) AS n_rows, count(DISTINCT (platform_name, platform_artwork_id)) AS n_keys, count(*) - count(DISTINCT (platform_name, platform_artwork_id)) AS n_duplicates FROM artworks")
def a_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return audit.duplicates(table(spark, d, "artworks").select("platform_name", "platform_artwork_id"), ["platform_name", "platform_artwork_id"])


_TYPES = ("click", "purchase", "view")


@query(
    "WITH u AS (SELECT user_id, bool_or(event_type = 'click') AS c, bool_or(event_type = 'purchase') AS p, bool_or(event_type = 'view') AS v FROM events WHERE event_type IN ('click','purchase','view') GROUP BY 1) "
    "SELECT concat_ws('+', CASE WHEN c THEN 'click' END, CASE WHEN p THEN 'purchase' END, CASE WHEN v THEN 'view' END) AS combination, count(*) AS n FROM u GROUP BY 1"
)
def a_overlaps(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("user_id", "event_type")
    return diffs.overlaps({t: e.filter(F.col("event_type") == t) for t in _TYPES}, ["user_id"])


@query("SELECT o.l_orderkey, o.expected, coalesce(f.n, 0) AS found, greatest(o.expected - coalesce(f.n, 0), 0) AS missing FROM (SELECT l_orderkey, max(l_linenumber) AS expected FROM lineitem GROUP BY 1) o LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1) f USING (l_orderkey)")
def a_shortfall(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    expected = li.groupBy("l_orderkey").agg(F.max("l_linenumber").alias("expected"))
    return audit.shortfall(expected, li.filter("l_returnflag <> 'R'").select("l_orderkey"), ["l_orderkey"])


@query("SELECT l_orderkey, min(l_linenumber) AS first, max(l_linenumber) AS last, count(DISTINCT l_linenumber) AS n, max(l_linenumber) - min(l_linenumber) + 1 - count(DISTINCT l_linenumber) AS n_missing, max(l_linenumber) - min(l_linenumber) + 1 = count(DISTINCT l_linenumber) AS contiguous FROM lineitem GROUP BY 1")
def w_gaps(spark: SparkSession, d: str) -> DataFrame:
    return audit.gaps(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber"), ["l_orderkey"], "l_linenumber")


@query("SELECT o_orderstatus, CAST(floor(o_totalprice / 10000) AS BIGINT) AS bucket, count(*) AS n FROM orders WHERE o_totalprice IS NOT NULL GROUP BY 1, 2")
def a_histogram(spark: SparkSession, d: str) -> DataFrame:
    return audit.histogram(table(spark, d, "orders"), ["o_orderstatus"], "o_totalprice", 10000)


@query("SELECT event_id, rate FROM (SELECT event_id, avg(CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END) OVER w AS rate, count(*) OVER w AS k FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)) WHERE k = 10 AND rate >= 0.3")
def w_rate_alarm(spark: SparkSession, d: str) -> DataFrame:
    return audit.rate_alarm(table(spark, d, "events"), ["user_id"], [F.col("ts"), F.col("event_id")], F.col("event_type") == "error", rows=10, share=0.3).select("event_id", "rate")


@query("SELECT source, dataset, strftime(crawl_date, '%Y-%m-%d') AS crawl_date, strftime(lag(crawl_date) OVER (PARTITION BY source, dataset ORDER BY crawl_date), '%Y-%m-%d') AS previous FROM crawls WHERE status = 'completed' AND crawl_mode = 'full'")
def w_consecutive(spark: SparkSession, d: str) -> DataFrame:
    from vernissage.operators.snapdiff import consecutive_crawls

    led = table(spark, d, "crawls").filter("status = 'completed' and crawl_mode = 'full'").select(F.concat_ws("|", "source", "dataset").alias("s"), "crawl_date")
    c = consecutive_crawls(led, "s")
    return c.select(F.split("s", "[|]")[0].alias("source"), F.split("s", "[|]")[1].alias("dataset"), F.col("crawl_date").cast("string").alias("crawl_date"), F.col("previous").cast("string").alias("previous"))


@query()
def o_hash_sample(spark: SparkSession, d: str) -> DataFrame:
    return audit.hash_sample(table(spark, d, "orders").select("o_orderkey"), "o_orderkey", 100)


@query(
    "WITH heavy AS (SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10), rest AS (SELECT o_orderkey, o_orderdate, CAST(epoch(o_orderdate) AS BIGINT) AS e FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM heavy)), "
    "s AS (SELECT *, floor((e - (SELECT min(e) FROM rest)) * 30.0 / ((SELECT max(e) FROM rest) - (SELECT min(e) FROM rest) + 1)) AS slot FROM rest) "
    "SELECT o_orderkey, 'weight' AS chosen_by FROM heavy UNION ALL SELECT o_orderkey, 'time' FROM (SELECT o_orderkey, row_number() OVER (PARTITION BY slot ORDER BY o_orderdate, o_orderkey) AS k FROM s) WHERE k = 1"
)
def o_spread_sample(spark: SparkSession, d: str) -> DataFrame:
    return audit.spread_sample(table(spark, d, "orders"), 40, "o_totalprice", "o_orderdate", "o_orderkey")


@query("SELECT (SELECT count(*) FROM (SELECT DISTINCT c_nationkey FROM customer EXCEPT SELECT s_nationkey FROM supplier)) AS n_only_a, (SELECT count(*) FROM (SELECT DISTINCT s_nationkey FROM supplier EXCEPT SELECT c_nationkey FROM customer)) AS n_only_b, (SELECT count(*) FROM (SELECT DISTINCT c_nationkey FROM customer EXCEPT SELECT s_nationkey FROM supplier)) + (SELECT count(*) FROM (SELECT DISTINCT s_nationkey FROM supplier EXCEPT SELECT c_nationkey FROM customer)) = 0 AS same")
def x_same_set(spark: SparkSession, d: str) -> DataFrame:
    return diffs.same_set(table(spark, d, "customer").select(F.col("c_nationkey").alias("k")), table(spark, d, "supplier").select(F.col("s_nationkey").alias("k")), ["k"])


@query("SELECT regexp_extract(artwork_url, '^https?://[^/]+/([^/]+)', 1) AS category, count(*) AS n FROM artworks WHERE artwork_url IS NOT NULL GROUP BY 1")
def a_path_categories(spark: SparkSession, d: str) -> DataFrame:
    return audit.path_categories(table(spark, d, "artworks"), "artwork_url")


# ── ranges ──────────────────────────────────────────────────────────────────────


@query(
    "WITH RECURSIVE h AS (SELECT platform_name, CAST(year AS BIGINT) AS v, count(*) AS n, row_number() OVER (PARTITION BY platform_name ORDER BY year) AS k FROM artworks WHERE year IS NOT NULL GROUP BY platform_name, year), "
    "f AS (SELECT platform_name, k, v, n, v AS lo, n >= 800 AS alone, CASE WHEN n >= 800 THEN 0 ELSE n END AS acc, n < 800 AS open FROM h WHERE k = 1 UNION ALL "
    "SELECT h.platform_name, h.k, h.v, h.n, CASE WHEN h.n >= 800 OR NOT f.open OR f.acc + h.n > 800 THEN h.v ELSE f.lo END, h.n >= 800, CASE WHEN h.n >= 800 THEN 0 WHEN f.acc + h.n > 800 THEN h.n ELSE f.acc + h.n END, h.n < 800 "
    "FROM f JOIN h ON h.platform_name = f.platform_name AND h.k = f.k + 1), "
    "g AS (SELECT platform_name, lo, bool_or(alone) AS alone, CAST(sum(n) AS BIGINT) AS n FROM f GROUP BY 1, 2), e AS (SELECT platform_name, max(v) + 1 AS stop FROM h GROUP BY 1) "
    "SELECT g.platform_name, lo, CASE WHEN alone THEN lo + 1 ELSE coalesce(lead(lo) OVER (PARTITION BY g.platform_name ORDER BY lo), stop) END AS hi, n FROM g JOIN e USING (platform_name)"
)
def r_plan_ranges(spark: SparkSession, d: str) -> DataFrame:
    years = table(spark, d, "artworks").filter("year is not null").groupBy("platform_name", "year").agg(F.count("*").alias("n"))
    return partitioning.plan_ranges(years, ["platform_name"], "year", "n", 800)


@query(
    "WITH a AS (SELECT platform_name AS p, coalesce(category, '') AS c, coalesce(support, '') AS s FROM artworks), l1 AS (SELECT p, count(*) AS n FROM a GROUP BY 1), l2 AS (SELECT p, c, count(*) AS n FROM a GROUP BY 1, 2), l3 AS (SELECT p, c, s, count(*) AS n FROM a GROUP BY 1, 2, 3) "
    "SELECT p AS platform_name, NULL AS category, NULL AS support, 1 AS depth, n, true AS fits FROM l1 WHERE n <= 300 UNION ALL "
    "SELECT l2.p, l2.c, NULL, 2, l2.n, true FROM l2 JOIN l1 USING (p) WHERE l2.n <= 300 AND l1.n > 300 UNION ALL SELECT l3.p, l3.c, l3.s, 3, l3.n, l3.n <= 300 FROM l3 JOIN l2 USING (p, c) WHERE l2.n > 300"
)
def r_split_facets(spark: SparkSession, d: str) -> DataFrame:
    return partitioning.split_facets(table(spark, d, "artworks"), ["platform_name", "category", "support"], 300)


@query("SELECT strftime(m, '%Y-%m-%d') AS lo, strftime(m + INTERVAL 1 MONTH, '%Y-%m-%d') AS hi, m + INTERVAL 1 MONTH <= DATE '2025-05-01' AS settled FROM (SELECT unnest(generate_series(DATE '2025-01-01', DATE '2025-07-02', INTERVAL 1 MONTH)) AS m)")
def r_month_windows(spark: SparkSession, d: str) -> DataFrame:
    w = partitioning.month_windows("2025-01-03", "2025-07-02", spark, "2025-05-01")
    return w.select(F.col("lo").cast("string").alias("lo"), F.col("hi").cast("string").alias("hi"), "settled")


# ── incremental runs and streams ────────────────────────────────────────────────


@query(
    "SELECT source AS platform_name, strftime(crawl_date, '%Y-%m-%d') AS crawl_date, CASE WHEN e.status IS NULL THEN 'new' WHEN e.status <> 'completed' THEN 'resume' WHEN m.finished_at > e.started_at THEN 'stale' ELSE 'done' END AS action "
    "FROM (SELECT source, crawl_date, status, finished_at FROM crawls WHERE dataset = 'artists') m LEFT JOIN (SELECT source, crawl_date, status, started_at FROM crawls WHERE dataset = 'artworks' AND crawl_mode = 'full') e USING (source, crawl_date) WHERE m.status IN ('completed', 'failed')"
)
def i_pending(spark: SparkSession, d: str) -> DataFrame:
    led = table(spark, d, "crawls").withColumnRenamed("source", "platform_name")
    p = crawl.pending(led.filter("dataset = 'artists'"), led.filter("dataset = 'artworks' and crawl_mode = 'full'"))
    return p.select("platform_name", F.col("crawl_date").cast("string").alias("crawl_date"), "action")


@query(
    "WITH d AS (SELECT source AS platform_name, crawl_date FROM crawls WHERE status = 'completed' GROUP BY 1, 2 HAVING count(DISTINCT dataset) = 2), r AS (SELECT *, row_number() OVER (PARTITION BY platform_name ORDER BY crawl_date DESC) AS k FROM d) "
    "SELECT platform_name, strftime(crawl_date, '%Y-%m-%d') AS crawl_date FROM r WHERE k > 2"
)
def i_retention(spark: SparkSession, d: str) -> DataFrame:
    led = table(spark, d, "crawls").withColumnRenamed("source", "platform_name")
    r = crawl.retention(led.select("platform_name", "crawl_date").distinct(), led, ["artists", "artworks"])
    return r.select("platform_name", F.col("crawl_date").cast("string").alias("crawl_date"))


def _event_stream(spark: SparkSession, d: str) -> DataFrame:
    schema = table(spark, d, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d).withColumn("ts", F.col("ts").cast("timestamp"))


def _streamed(stream: DataFrame, mode: str) -> DataFrame:
    """Result of a stream over all files there are, written to the shared folder and read again."""
    spark = stream.sparkSession
    out = f"{_scratch(spark)}/{uuid.uuid4().hex}"
    ingest.run_to_table(stream, out, mode)
    return spark.read.parquet(out)


@query("SELECT CAST(time_bucket(INTERVAL 1 DAY, ts) AS VARCHAR)[:10] AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def i_stream_windows(spark: SparkSession, d: str) -> DataFrame:
    w = ingest.windowed_counts(_event_stream(spark, d), "ts", ["event_type"], "1 day")
    return _streamed(w, "complete").select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "n")


@query("SELECT DISTINCT user_id, event_type FROM events")
def i_stream_distinct(spark: SparkSession, d: str) -> DataFrame:
    s = ingest.distinct_stream(_event_stream(spark, d).select("ts", "user_id", "event_type"), ["user_id", "event_type"], "ts", "60 days")
    return _streamed(s, "append").select("user_id", "event_type")


@query(
    "WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM events), s AS (SELECT user_id, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g) "
    "SELECT user_id, n, count(*) AS sessions FROM (SELECT user_id, k, count(*) AS n FROM s GROUP BY 1, 2) GROUP BY 1, 2"
)
def i_sessions(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return ingest.sessions(e, "ts", ["user_id"], "6 hours").groupBy("user_id", "n").agg(F.count("*").alias("sessions"))


# ── payloads ────────────────────────────────────────────────────────────────────


@query("SELECT event_type, 'k' AS path, count(*) AS n_pages, CAST(1 AS INT) AS rank FROM events WHERE json_extract(props, '$.k') IS NOT NULL GROUP BY 1")
def p_features(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_type", "event_id", payload.leaf_paths("props").alias("features"))
    return audit.feature_counts(e, "event_type", "features", "event_id").select("event_type", "path", "n_pages", "rank")


@query("SELECT event_type, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS total FROM events GROUP BY 1")
def p_script_json(spark: SparkSession, d: str) -> DataFrame:
    """Payloads are put into pages, found again and read."""
    page = F.concat(F.lit("<html><script id=\"data\" type=\"application/json\">"), F.col("props"), F.lit("</script></html>"))
    v = table(spark, d, "events").select("event_type", F.try_variant_get(payload.script_json(page, "data"), "$.k", "bigint").alias("k"))
    return v.groupBy("event_type").agg(F.sum("k").alias("total"))


@query("SELECT event_type, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS total FROM events GROUP BY 1")
def p_assigned_literal(spark: SparkSession, d: str) -> DataFrame:
    page = F.concat(F.lit("<script>window.state = {a: '}', inner: "), F.col("props"), F.lit(", d: new Date(5)};</script>"))
    e = table(spark, d, "events").select("event_type", payload.assigned_udf("window.state")(page).alias("j"))
    return e.groupBy("event_type").agg(F.sum(F.try_variant_get(F.try_parse_json("j"), "$.inner.k", "bigint")).alias("total"))
