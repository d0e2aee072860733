"""Queries of sources, sinks, stores and connectors: tables are written as the files a crawl leaves and read again."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vernissage.functions import countries, scalars, sizes, urls
from vernissage.functions.text import clean_id
from vernissage.operators import audit, dedup, entries, merge, partitioning, search
from vernissage.operators.dedup import SortField
from vernissage.plans import disappearances, pages
from vernissage.session import spread, table
from vernissage.sources import crawl, lists
from vernissage.survey_queries import _ARTWORK_WINNERS, _SHORT, ARTIST_ORDER, ARTWORK_ORDER, _clean, _id, _scratch, query


def _folder(spark: SparkSession) -> str:
    return f"{_scratch(spark)}/{uuid.uuid4().hex}"


def _put(spark: SparkSession, path: str, text: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    stream.write(bytearray(text.encode()))
    stream.close()


def _crawl_folders(spark: SparkSession, d: str) -> str:
    """Folders of the ledger's crawls of artists, each with a page, a log of two entries and a manifest."""
    root = _folder(spark)
    # The ledger is a fixed table.
    for r in table(spark, d, "crawls").filter("dataset = 'artists'").withColumn("name", urls.page_filename("crawl_id")).collect():
        at = f"{root}/{r['source']}/{r['crawl_date']}"
        _put(spark, f"{at}/html/{r['name']}", f"<p>{r['crawl_id']}</p>")
        _put(spark, f"{at}/html/.part/{r['name']}", "hidden")
        log = [{"filename": r["name"], "url": "first", "timestamp": "2001-01-01T00:00:00Z"}, {"url": "no file"}]
        if r["status"] == "completed":
            log.append({"filename": r["name"], "url": r["crawl_id"], "timestamp": r["finished_at"].strftime("%Y-%m-%dT%H:%M:%SZ")})
        _put(spark, f"{at}/results.jsonl", "\n".join(map(json.dumps, log)) + "\n{broken\n")
        crawl.write_manifest(spark, at, {"marketplace": r["source"], "status": r["status"], "crawl_mode": r["crawl_mode"]})
    return root


@query(
    "SELECT source AS platform_name, strftime(crawl_date, '%Y-%m-%d') AS crawl_date, '<p>' || crawl_id || '</p>' AS html, CASE WHEN status = 'completed' THEN crawl_id ELSE 'first' END AS url, "
    "CASE WHEN status = 'completed' THEN strftime(finished_at, '%Y-%m-%d %H:%M:%S') ELSE '2001-01-01 00:00:00' END AS crawled_at FROM crawls WHERE dataset = 'artists'"
)
def s_pages_with_log(spark: SparkSession, d: str) -> DataFrame:
    root = _crawl_folders(spark, d)
    pages = crawl.pages_with_log(crawl.page_files(spark, root), crawl.crawl_log(spark, f"{root}/*/*/results.jsonl"))
    of = pages.withColumn("c", crawl.crawl_of_path("path"))
    return of.select("c.platform_name", F.col("c.crawl_date").cast("string").alias("crawl_date"), "html", "url", F.date_format("crawled_at", "yyyy-MM-dd HH:mm:ss").alias("crawled_at"))


@query("SELECT source AS platform_name, strftime(crawl_date, '%Y-%m-%d') AS crawl_date, status, crawl_mode FROM crawls WHERE dataset = 'artists'")
def s_manifests(spark: SparkSession, d: str) -> DataFrame:
    m = crawl.manifests(spark, f"{_crawl_folders(spark, d)}/*/*/manifest.json")
    return m.select("platform_name", F.col("crawl_day").cast("string").alias("crawl_date"), "status", "crawl_mode")


@query("SELECT source AS platform_name, strftime(crawl_date, '%Y-%m-%d') AS crawl_date FROM crawls WHERE dataset = 'artists'")
def s_crawl_folders(spark: SparkSession, d: str) -> DataFrame:
    root = _crawl_folders(spark, d)
    found = None
    for name in [r[0] for r in table(spark, d, "crawls").select("source").distinct().collect()]:
        part = crawl.crawl_folders(spark, root, name)
        found = part if found is None else found.unionByName(part)
    return found.select("platform_name", F.col("crawl_date").cast("string").alias("crawl_date"))


@query("SELECT user_id || '.html' AS filename, arg_max(event_id, event_id) AS last, strftime(arg_max(date_trunc('second', ts), event_id), '%Y-%m-%d %H:%M:%S') AS crawled_at FROM events GROUP BY user_id")
def s_log_last_wins(spark: SparkSession, d: str) -> DataFrame:
    """A log of many files: the last entry of each page counts, by the order of files and lines."""
    e = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    lines = e.select("event_id", F.concat(F.col("user_id").cast("string"), F.lit(".html")).alias("filename"), F.col("event_id").cast("string").alias("url"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"))
    path = _folder(spark)
    lines.repartitionByRange(8, "event_id").sortWithinPartitions("event_id").drop("event_id").write.json(path)
    return crawl.crawl_log(spark, path).select("filename", F.col("url").cast("bigint").alias("last"), F.date_format("crawled_at", "yyyy-MM-dd HH:mm:ss").alias("crawled_at"))


@query("SELECT platform_name, strftime(a.crawl_date, '%Y-%m-%d') AS crawl_date, count(*) AS n, count(price) AS n_price, 0 AS n_absent FROM artworks a JOIN crawls c ON c.dataset = 'artworks' AND c.source = a.platform_name AND c.crawl_date = a.crawl_date AND c.status = 'completed' GROUP BY 1, 2")
def s_finished_snapshots(spark: SparkSession, d: str) -> DataFrame:
    """Snapshots with a manifest, in a schema with a column they lack."""
    root = _folder(spark)
    table(spark, d, "artworks").select("platform_name", "crawl_date", "platform_artwork_id", "price", "title").write.partitionBy("platform_name", "crawl_date").parquet(root)
    for r in table(spark, d, "crawls").filter("dataset = 'artworks' and status = 'completed'").collect():
        _put(spark, f"{root}/platform_name={r['source']}/crawl_date={r['crawl_date']}/_manifest.json", "{}")
    rows = crawl.finished_snapshots(spark, root, "platform_artwork_id string, price decimal(14,2), absent string, platform_name string, crawl_date date")
    return rows.groupBy("platform_name", F.col("crawl_date").cast("string").alias("crawl_date")).agg(F.count("*").alias("n"), F.count("price").alias("n_price"), F.count("absent").cast("int").alias("n_absent"))


_MAP_RULES = (urls.Rule("customer", r"^/customer/(\d+)$"),)


@query("SELECT 'https://shop.example/customer/' || c_custkey AS url, CAST(c_custkey AS VARCHAR) AS entity_id, CASE WHEN c_acctbal > 0 THEN '2025-01-0' || (c_custkey % 9 + 1) END AS lastmod FROM customer")
def s_sitemap(spark: SparkSession, d: str) -> DataFrame:
    """All customers in sitemaps, with addresses of another kind between them."""
    c = table(spark, d, "customer")
    day = F.when(F.col("c_acctbal") > 0, F.concat(F.lit("2025-01-0"), (F.col("c_custkey") % 9 + 1).cast("string")))
    loc = F.explode(F.array(F.concat(F.lit(" HTTPS://Shop.example/customer/"), F.col("c_custkey").cast("string"), F.lit("/")), F.concat(F.lit("https://shop.example/about/"), F.col("c_custkey").cast("string"))))
    path = _folder(spark)
    c.select(loc.alias("loc"), day.alias("lastmod")).write.format("xml").option("rowTag", "url").option("rootTag", "urlset").option("compression", "gzip").save(path)
    found = lists.typed_entries(lists.sitemap_entries(spark, path), _MAP_RULES)
    return found.select("url", "entity_id", F.date_format("lastmod", "yyyy-MM-dd").alias("lastmod"))


@query("SELECT n_name AS name, 'https://shop.example/' || lower(n_name) || '.xml' AS url FROM nation WHERE n_name LIKE '%A%' AND n_name NOT LIKE 'I%'")
def s_sitemap_index(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation")
    path = _folder(spark)
    n.select(F.concat(F.lit("https://shop.example/"), F.lower("n_name"), F.lit(".xml")).alias("loc")).write.format("xml").option("rowTag", "sitemap").option("rootTag", "sitemapindex").save(path)
    found = lists.sitemap_children(spark, path, include=r"/[^/]*a[^/]*\.xml$", exclude=r"/i[^/]*\.xml$")
    return found.select(F.upper(F.regexp_extract("url", r"/([^/]+)\.xml$", 1)).alias("name"), "url")


@query("SELECT 'https://shop.example/o/' || o_orderkey AS url, count(*) AS n FROM (SELECT o_orderkey FROM orders UNION ALL SELECT o_orderkey FROM orders) GROUP BY 1")
def s_url_lists(spark: SparkSession, d: str) -> DataFrame:
    """All orders as lines of a list, and as JSON lines that name their address in four ways."""
    o = table(spark, d, "orders").select("o_orderkey", F.concat(F.lit("https://shop.example/o/"), F.col("o_orderkey").cast("string")).alias("url"))
    plain, coded = _folder(spark), _folder(spark)
    lists.write_url_list(o.select("url").unionByName(o.sparkSession.createDataFrame([("# comment",), ("",)], "url string")), plain)
    u, k = F.col("url"), F.col("o_orderkey") % 4
    line = F.when(k == 0, F.to_json(F.struct(u.alias("url")))).when(k == 1, F.to_json(F.struct(F.lit("").alias("url"), u.alias("input")))).when(k == 2, F.to_json(F.struct(F.struct(u.alias("endpoint")).alias("request")))).otherwise(F.to_json(F.struct(u.alias("request"))))
    o.select(line.alias("value")).write.text(coded)
    return lists.url_lines(spark, plain).unionByName(lists.url_json(spark, coded)).groupBy("url").agg(F.count("*").alias("n"))


@query("SELECT CASE WHEN p_size > 25 THEN 'sale' ELSE 'lot' END AS entity_type, CAST(p_partkey AS VARCHAR) AS entity_id, 2 AS n, '2025-02-01' AS lastmod FROM part")
def s_typed_cache(spark: SparkSession, d: str) -> DataFrame:
    """All parts appended to a cache twice; rows without an id are skipped."""
    p = table(spark, d, "part").select(F.when(F.col("p_size") > 25, "sale").alias("entity_type"), F.col("p_partkey").cast("string").alias("entity_id"), F.lit("u").alias("url"), F.lit("2025-02-01").alias("lastmod"))
    path = _folder(spark)
    lists.append_cache(p, path)
    lists.append_cache(p.unionByName(p.withColumn("entity_id", F.lit(" "))), path)
    found = lists.typed_cache(spark, path, "lot").groupBy("entity_type", "entity_id").agg(F.count("*").cast("int").alias("n"), F.date_format(F.max("lastmod"), "yyyy-MM-dd").alias("lastmod"))
    return found


# ── stores ──────────────────────────────────────────────────────────────────────

_KEYED = "platform_artwork_id <> ''"
_DETAIL_WINNERS = _ARTWORK_WINNERS.replace(f"WHERE {_KEYED}", f"WHERE {_KEYED} AND (platform_name <> 'murora' OR has_detail)")


@query(f"SELECT platform_name, strftime(crawl_date, '%Y-%m-%d') AS crawl_date, platform_artwork_id, price FROM {_DETAIL_WINNERS}")
def k_republish_drops_stale(spark: SparkSession, d: str) -> DataFrame:
    """One source is published again with fewer rows: versions that are not among them go."""
    store = merge.Store(spark, _folder(spark), "artworks", "platform_artwork_id", ARTWORK_ORDER)
    rows = table(spark, d, "artworks").select(*_SHORT)
    store.publish(rows)
    store.publish(rows.filter("platform_name = 'murora' and has_detail"))
    return store.read("versions").select("platform_name", F.col("crawl_date").cast("string").alias("crawl_date"), "platform_artwork_id", "price")


@query(
    f"WITH w AS (SELECT * FROM {_ARTWORK_WINNERS} WHERE NOT (platform_name = 'murora' AND crawl_date = (SELECT max(crawl_date) FROM artworks WHERE platform_name = 'murora'))) "
    "SELECT platform_name, platform_artwork_id, strftime(max(crawl_date), '%Y-%m-%d') AS latest_version, arg_max(source_file, crawl_date) AS source_file FROM w GROUP BY 1, 2"
)
def k_delete_crawl(spark: SparkSession, d: str) -> DataFrame:
    """The newest crawl of one source is deleted: the latest state falls back to older versions."""
    store = merge.Store(spark, _folder(spark), "artworks", "platform_artwork_id", ARTWORK_ORDER)
    rows = table(spark, d, "artworks").select(*_SHORT)
    store.publish(rows)
    store.compact()
    last = rows.filter("platform_name = 'murora'").agg(F.max("crawl_date").cast("string")).first()[0]
    if last is not None:
        store.delete_crawl("murora", last)
    return store.read("current").select("platform_name", "platform_artwork_id", F.col("latest_version").cast("string").alias("latest_version"), "source_file")


_ARTIST_KEYED = "(SELECT platform_name, crawl_date, platform_artist_id FROM artists WHERE platform_artist_id <> '' GROUP BY ALL)"


@query(
    f"SELECT a.platform_name, strftime(a.crawl_date, '%Y-%m-%d') AS crawl_date, 'completed' AS status, count(*) AS rows_in, count(*) FILTER (WHERE coalesce(platform_artist_id, '') = '') AS no_key, count(DISTINCT nullif(platform_artist_id, '')) AS published "
    "FROM artists a JOIN (SELECT platform_name, max(crawl_date) AS crawl_date FROM artists GROUP BY 1) m ON a.platform_name = m.platform_name AND a.crawl_date = m.crawl_date GROUP BY ALL"
)
def k_finalize(spark: SparkSession, d: str) -> DataFrame:
    """The newest crawl of every source is finalized; the ledger holds its counters."""
    store = merge.Store(spark, _folder(spark), "artists", "platform_artist_id", ARTIST_ORDER)
    a = table(spark, d, "artists").select("platform_name", "crawl_date", "platform_artist_id", "full_name", "crawled_at", "source_file")
    for r in a.groupBy("platform_name").agg(F.max("crawl_date").cast("string").alias("day")).collect():
        store.finalize(a.filter((F.col("platform_name") == r["platform_name"]) & (F.col("crawl_date") == F.lit(r["day"]).cast("date"))), r["platform_name"], r["day"])
    return store.ledger().select("platform_name", F.col("crawl_date").cast("string").alias("crawl_date"), "status", "rows_in", "no_key", "published")


@query(
    f"WITH n AS (SELECT * REPLACE ({_id('platform_artwork_id')} AS platform_artwork_id, {_id('platform_artist_id')} AS platform_artist_id) FROM artworks), "
    "w AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY platform_name, crawl_date, platform_artwork_id ORDER BY has_detail DESC NULLS LAST, crawled_at DESC NULLS LAST, source_file DESC NULLS LAST, platform_artist_id DESC NULLS LAST, is_sold DESC NULLS LAST) AS rn FROM n WHERE platform_artwork_id IS NOT NULL) WHERE rn = 1), "
    "ready AS (SELECT source, crawl_date FROM crawls WHERE status = 'completed' AND dataset IN ('artists', 'artworks') GROUP BY 1, 2 HAVING count(DISTINCT dataset) = 2), "
    "c AS (SELECT source, crawl_date, lag(crawl_date) OVER (PARTITION BY source ORDER BY crawl_date) AS previous FROM (SELECT DISTINCT source, crawl_date FROM crawls WHERE dataset = 'artworks' AND status = 'completed' AND crawl_mode = 'full')), "
    "p AS (SELECT c.* FROM c JOIN ready r ON r.source = c.source AND r.crawl_date = c.crawl_date JOIN ready q ON q.source = c.source AND q.crawl_date = c.previous), "
    "b AS (SELECT w.platform_name, p.crawl_date AS d, platform_artwork_id AS k, platform_artist_id AS o, is_sold FROM w JOIN p ON w.platform_name = p.source AND w.crawl_date = p.previous), "
    "a AS (SELECT w.platform_name, p.crawl_date AS d, platform_artwork_id AS k, platform_artist_id AS o, is_sold FROM w JOIN p ON w.platform_name = p.source AND w.crawl_date = p.crawl_date), "
    "nb AS (SELECT platform_name, d, count(*) AS n FROM b GROUP BY ALL), na AS (SELECT platform_name, d, count(*) AS n FROM a GROUP BY ALL), whole AS (SELECT platform_name, d FROM nb JOIN na USING (platform_name, d) WHERE na.n >= 0.8 * nb.n), "
    "f AS (SELECT platform_name, d, k, 'disappeared' AS reason FROM b JOIN whole USING (platform_name, d) WHERE NOT EXISTS (SELECT 1 FROM a WHERE (a.platform_name, a.d, a.k) = (b.platform_name, b.d, b.k)) "
    "AND (b.o IS NULL OR EXISTS (SELECT 1 FROM a WHERE (a.platform_name, a.d, a.o) = (b.platform_name, b.d, b.o))) "
    "UNION ALL SELECT a.platform_name, a.d, a.k, 'flagged' FROM a JOIN b USING (platform_name, d, k) WHERE a.is_sold AND NOT b.is_sold) "
    "SELECT platform_name, strftime(d, '%Y-%m-%d') AS crawl_date, k AS platform_artwork_id, reason FROM f"
)
def j_disappearances(spark: SparkSession, d: str) -> DataFrame:
    """Every full crawl against the one before, once both crawls' artists are there; a second run finds nothing to do."""
    ids = [clean_id(c).alias(c) for c in ("platform_artwork_id", "platform_artist_id")]
    rows = table(spark, d, "artworks").select(*[c for c in _SHORT if c not in ("platform_artwork_id", "price")], *ids)
    best = dedup.winners(rows, ["platform_name", "crawl_date", "platform_artwork_id"], [*ARTWORK_ORDER, SortField("platform_artist_id"), SortField("is_sold")])
    folder = _folder(spark)
    ledger = table(spark, d, "crawls")
    disappearances.run(spark, best, ledger, folder, "platform_artwork_id", "is_sold", "platform_artist_id")
    found = disappearances.run(spark, best.filter("false"), ledger, folder, "platform_artwork_id", "is_sold", "platform_artist_id")
    return found.select("platform_name", F.col("crawl_date").cast("string").alias("crawl_date"), "platform_artwork_id", "reason")


# ── connectors ──────────────────────────────────────────────────────────────────


@query("SELECT l_orderkey, l_linenumber, strftime(coalesce(CASE WHEN l_linestatus = 'F' THEN l_shipdate END, o_orderdate), '%Y-%m-%d') AS lastmod FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderpriority NOT IN ('1-URGENT', '5-LOW') AND l_returnflag <> 'R'")
def n_items_of_sales(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("sale"), "o_orderdate", "o_orderpriority")
    li = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("sale"), "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate")
    sold = F.when(F.col("l_linestatus") == "F", F.col("l_shipdate"))
    found = entries.items_of_sales(o, li, "sale", F.col("o_orderpriority").isin("1-URGENT", "5-LOW"), F.col("l_returnflag") != "R", [sold.cast("date"), F.col("o_orderdate").cast("date")])
    return found.select(F.col("sale").alias("l_orderkey"), "l_linenumber", F.col("lastmod").cast("string").alias("lastmod"))


@query("SELECT 'https://h.example/' || k || '/' || o_custkey AS url, k AS kind, strftime(max(o_orderdate), '%Y-%m-%d') AS lastmod FROM orders, (VALUES ('live'), ('realised')) t(k) GROUP BY 1, 2")
def n_twins(spark: SparkSession, d: str) -> DataFrame:
    """Each live entry stands under two addresses; the newest of each counts."""
    o = table(spark, d, "orders").select(F.concat(F.lit("https://h.example/live/"), F.col("o_custkey").cast("string")).alias("url"), F.col("o_orderdate").cast("date").alias("lastmod"))
    both = entries.with_twins(o, "url", F.replace("url", F.lit("/live/"), F.lit("/realised/")), kinds=("live", "realised"))
    return entries.newest_entries(both, ["url", "kind"]).select("url", "kind", F.col("lastmod").cast("string").alias("lastmod"))


@query(
    "SELECT o_orderkey AS child, kind, phase, number FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'sale' ELSE 'lot' END AS kind, CASE WHEN o_orderstatus = 'O' THEN 'upcoming' WHEN o_orderstatus = 'P' THEN 'past' END AS phase, CAST(o_custkey AS INT) AS number, o_orderpriority <> '1-URGENT' AS open FROM orders) "
    "WHERE open ORDER BY kind DESC, coalesce(phase, ''), number, 'https://h.example/map-' || o_orderkey || '/' || kind LIMIT 50"
)
def n_next_children(spark: SparkSession, d: str) -> DataFrame:
    """The next fifty lists to read: sales before lots, by phase and number; those done in this epoch are not read."""
    o = table(spark, d, "orders")
    kind, phase = F.when(F.col("o_orderstatus") == "F", "sale").otherwise("lots"), F.when(F.col("o_orderstatus") == "O", "-upcoming").when(F.col("o_orderstatus") == "P", "-past").otherwise("")
    url = F.concat(F.lit("https://h.example/map-"), F.col("o_orderkey").cast("string"), F.lit("/"), kind, phase, F.lit("-"), F.col("o_custkey").cast("string"), F.lit(".xml.gz"))
    children = o.select(url.alias("url"), F.lit("2025-01").alias("epoch"), F.col("o_orderkey").alias("child"))
    state = o.select(url.alias("url"), F.lit("2025-01").alias("epoch"), (F.col("o_orderpriority") == "1-URGENT").alias("done")).unionByName(children.select("url", F.lit("2024-12").alias("epoch"), F.lit(True).alias("done")))
    named = children.withColumn("l", entries.numbered_list("url"))
    order = [F.desc("l.kind"), F.coalesce("l.phase", F.lit("")), F.col("l.number")]
    return audit.next_children(named, state, "url", "epoch", order, 50).select("child", "l.kind", "l.phase", "l.number")


@query(
    "WITH w AS (SELECT o_orderstatus AS s, count(*) AS expected, o_orderstatus <> 'O' AS settled FROM orders GROUP BY 1), f AS (SELECT o_orderstatus AS s, count(DISTINCT o_custkey) AS found, count(*) - count(DISTINCT o_custkey) AS n_duplicates FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1) "
    "SELECT s, expected, coalesce(found, 0) AS found, coalesce(n_duplicates, 0) AS n_duplicates, greatest(expected - coalesce(found, 0), 0) AS missing, CASE WHEN NOT settled THEN 'open' WHEN expected > coalesce(found, 0) THEN 'incomplete' ELSE 'done' END AS status FROM w LEFT JOIN f USING (s)"
)
def a_window_summary(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select(F.col("o_orderstatus").alias("s"), "o_custkey")
    windows = o.groupBy("s").agg(F.count("*").alias("expected")).withColumn("settled", F.col("s") != "O")
    return audit.window_summary(windows, o.filter("s <> 'P'"), "s", ["o_custkey"]).drop("settled")


@query(
    "WITH RECURSIVE h AS (SELECT platform_name AS p, CAST(year AS BIGINT) AS v, count(*) AS n FROM artworks WHERE year IS NOT NULL GROUP BY 1, 2), "
    "t AS (SELECT p, min(v) AS lo, max(v) + 1 AS hi, CAST(sum(n) AS BIGINT) AS n FROM h GROUP BY p UNION ALL "
    "SELECT p, lo, hi, n FROM (SELECT x.p, x.lo, x.hi, CAST(sum(h.n) AS BIGINT) AS n FROM (SELECT p, unnest([lo, (lo + hi) // 2]) AS lo, unnest([(lo + hi) // 2, hi]) AS hi FROM t WHERE n > 300 AND hi - lo > 1) x JOIN h ON h.p = x.p AND h.v >= x.lo AND h.v < x.hi GROUP BY 1, 2, 3)) "
    "SELECT p AS platform_name, lo, hi, n, n <= 300 AS fits FROM t WHERE n <= 300 OR hi - lo = 1"
)
def r_range_parts(spark: SparkSession, d: str) -> DataFrame:
    return search.range_parts(table(spark, d, "artworks"), ["platform_name"], "year", 300)


_TERM = """CASE WHEN k <= 3 AND {f} <> '' THEN '{f}:"' || replace(replace({f}, '\\', '\\\\'), '"', '\\"') || '"' ELSE 'NOT {f}:common' END"""


def _facet_step(source: str, f: str, rest: str) -> str:
    ranked = f"(SELECT *, sum(v) OVER (PARTITION BY part) AS total, count(*) OVER (PARTITION BY part) AS kinds, row_number() OVER (PARTITION BY part ORDER BY v DESC, {f}) AS k FROM (SELECT part, {f}, sum(n) AS v FROM {source} GROUP BY 1, 2))"
    return f"SELECT {rest}s.n, CASE WHEN total > 500 AND kinds > 1 THEN concat_ws(' AND ', nullif(s.part, ''), {_TERM.format(f=f).replace(f, 'r.' + f, 1).replace(f'replace({f},', f'replace(r.{f},')}) ELSE s.part END AS part FROM {source} s JOIN {ranked} r ON r.part = s.part AND r.{f} = s.{f}"


@query(
    "WITH a0 AS (SELECT platform_name, coalesce(category, '') AS category, coalesce(support, '') AS support, count(*) AS n, '' AS part FROM artworks GROUP BY ALL), "
    f"a1 AS ({_facet_step('a0', 'platform_name', 's.category, s.support, ')}), a2 AS ({_facet_step('a1', 'category', 's.support, ')}), a3 AS ({_facet_step('a2', 'support', '')}) "
    "SELECT part, CAST(sum(n) AS BIGINT) AS n, sum(n) <= 500 AS fits FROM a3 GROUP BY 1"
)
def r_facet_parts(spark: SparkSession, d: str) -> DataFrame:
    return search.facet_parts(table(spark, d, "artworks"), ["platform_name", "category", "support"], 500, most=3)


# ── further functions ───────────────────────────────────────────────────────────

_NATIONS = {"ALGERIA": "DZ", "ARGENTINA": "AR", "BRAZIL": "BR", "CANADA": "CA", "CHINA": "CN", "EGYPT": "EG", "ETHIOPIA": "ET", "FRANCE": "FR", "GERMANY": "DE", "INDIA": "IN", "INDONESIA": "ID", "IRAN": "IR", "IRAQ": "IQ", "JAPAN": "JP", "JORDAN": "JO", "KENYA": "KE", "MOROCCO": "MA", "MOZAMBIQUE": "MZ", "PERU": "PE", "ROMANIA": "RO", "RUSSIA": "RU", "SAUDI ARABIA": "SA", "UNITED KINGDOM": "GB", "UNITED STATES": "US", "VIETNAM": "VN"}


@query(f"SELECT CASE n_name {' '.join(f'''WHEN '{k}' THEN '{v}' ''' for k, v in _NATIONS.items())} END AS code, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def f_country_code(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return countries.with_country_code(c.select("n_name"), "n_name", "code", countries.country_table(spark)).groupBy("code").agg(F.count("*").alias("n"))


@query(f"SELECT platform_name, {_clean('full_name')} AS name, count(*) AS n FROM artists GROUP BY ALL")
def f_unescape(spark: SparkSession, d: str) -> DataFrame:
    """Names written as HTML, their letters beyond ASCII as numbers, are read back."""
    coded = F.array_join(F.transform(F.split("full_name", ""), lambda ch: F.when(ch.isin("&", "<", ">"), F.concat(F.lit("&#"), F.ascii(ch).cast("string"), F.lit(";"))).when(F.ascii(ch) > 127, F.concat(F.lit("&#x"), F.hex(F.ascii(ch)), F.lit(";"))).otherwise(ch)), "")
    page = F.when(F.col("full_name").isNotNull(), F.concat(F.lit("<style>p {}</style><p><b>"), coded, F.lit("</b></p>")))
    return table(spark, d, "artists").groupBy("platform_name", scalars.plain_text(page).alias("name")).agg(F.count("*").alias("n"))


@query("SELECT event_type, strftime(max(ts - INTERVAL 2 HOUR), '%Y-%m-%d %H:%M:%S') AS newest, count(*) AS n FROM events GROUP BY 1")
def f_timestamp(spark: SparkSession, d: str) -> DataFrame:
    said = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'+02:00'")
    e = table(spark, d, "events").select("event_type", scalars.to_timestamp(said).alias("t"))
    return e.groupBy("event_type").agg(F.date_format(F.max("t"), "yyyy-MM-dd HH:mm:ss").alias("newest"), F.count("t").alias("n"))


@query("SELECT user_id, 'https://social.example/@' || 'u' || user_id AS url FROM events GROUP BY user_id")
def f_profile_url(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("user_id").distinct()
    return e.select("user_id", scalars.profile_url(F.concat(F.lit(" @u"), F.col("user_id").cast("string")), "https://social.example/@{}").alias("url"))


@query("SELECT platform_name, count(*) AS n, CAST(sum(round(CAST(width_in AS DECIMAL(20,6)) * 2.54, 1)) AS DECIMAL(18,1)) AS total FROM artworks WHERE width_in IS NOT NULL GROUP BY 1")
def f_inches(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "artworks").filter("width_in is not null").select("platform_name", scalars.inches_to_cm("width_in").cast("decimal(14,1)").alias("cm"))
    return a.groupBy("platform_name").agg(F.count("cm").alias("n"), F.sum("cm").cast("decimal(18,1)").alias("total"))


_SIDE = "round(CAST({c} AS DECIMAL(14,4)), 1)"
_BOTH = f"height_cm IS NOT NULL AND width_cm IS NOT NULL AND {_SIDE.format(c='height_cm')} BETWEEN 0.3 AND 2000 AND {_SIDE.format(c='width_cm')} BETWEEN 0.3 AND 2000"


@query(f"SELECT platform_artwork_id, source_file, CASE WHEN {_BOTH} THEN CAST({_SIDE.format(c='height_cm')} AS DOUBLE) END AS height, CASE WHEN {_BOTH} THEN CAST({_SIDE.format(c='width_cm')} AS DOUBLE) END AS width FROM artworks")
def c_size(spark: SparkSession, d: str) -> DataFrame:
    """Sizes in running text; one with an impossible side is none."""
    text = F.concat(F.lit("Oil on panel ("), F.col("height_cm").cast("decimal(14,4)").cast("string"), F.lit(" × "), F.col("width_cm").cast("decimal(14,4)").cast("string"), F.lit(" cm), framed"))
    s = table(spark, d, "artworks").select("platform_artwork_id", "source_file", sizes.size_cm(F.coalesce(text, F.lit("no size"))).alias("s"))
    return s.select("platform_artwork_id", "source_file", "s.height", "s.width")


# ── addresses of sites ──────────────────────────────────────────────────────────

_ADDRESSES = {
    "artsper": ("https://www.artsper.com/fr/contemporary-artworks/painting/{d}/title", "artwork", "{d}"), "artsy": ("https://www.artsy.net/artist/Name-{d}?x=1#y", "artist", "name-{d}"), "artmajeur": ("https://www.artmajeur.com/some-one/en/artworks/{d}/title", "artwork", "{d}"),
    "saatchi": ("http://saatchiart.com/art/Painting-Title/77/{d}/view", "artwork", "{d}"), "singulart": ("https://www.singulart.com/en/artist/ann-bell-{d}", "artist", "{d}"), "1stdibs": ("https://www.1stdibs.com/art/paintings/title/id-a_{d}/", "item", "{d}"), "artfinder": ("https://www.artfinder.com/product/Title-{d}/", "artwork", "title-{d}"),
    "fineartamerica": ("https://fineartamerica.com/featured/title-{d}.html", "artwork", "title-{d}"), "phaidon": ("https://www.phaidon.com/products/title-{d}", "product", "title-{d}"), "ugallery": ("https://www.ugallery.com/pages/ann-{d}", "artist", "ann-{d}"), "mutualart": ("https://www.mutualart.com/Exhibition/Title/abcdef00000{d}", "exhibition", "ABCDEF00000{d}"),
}
_NO_ENTITIES = ("https://www.artfinder.com/en-US/product/x{d}/", "https://www.phaidon.com/products/x{d}?y=1", "https://www.ugallery.com/pages/faq", "https://artmajeur.com/magazine", "https://example.com/artist/x{d}", "https://www.mutualart.com/Artist/Title/abcdef00000{d}/Graphs", "https://www.saatchiart.com/search")


def _text_of(pattern: str, key: str) -> str:
    return "'" + pattern.replace("{d}", f"' || {key} || '") + "'"


@query(" UNION ALL ".join(f"SELECT '{site}' AS site, '{kind}' AS entity_type, {_text_of(key, 'o_orderkey')} AS entity_id FROM orders" for site, (_, kind, key) in sorted(_ADDRESSES.items())))
def u_sites(spark: SparkSession, d: str) -> DataFrame:
    """Addresses of eleven sites for every order, and some that name no entity; each is judged by every site."""
    patterns = [url for url, _, _ in _ADDRESSES.values()] + list(_NO_ENTITIES)
    address = F.explode(F.array(*[F.replace(F.lit(p), F.lit("{d}"), F.col("o_orderkey").cast("string")) for p in patterns]))
    u = spread(table(spark, d, "orders").select("o_orderkey"), 2).select(address.alias("url"))
    return u.select(F.inline(urls.entities_of("url", urls.ENTITIES))).select("site", "k.entity_type", "k.entity_id")


@query("WITH p AS (SELECT o_custkey AS c, list(o_orderkey ORDER BY o_orderkey) AS k FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1) SELECT o_custkey, o_orderkey FROM orders WHERE (o_custkey, o_orderkey) NOT IN (SELECT c, unnest(k) FROM p)")
def m_delete_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Rows named by pairs of arrays are deleted."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderpriority")
    pairs = o.filter("o_orderpriority = '1-URGENT'").groupBy((F.col("o_orderkey") % 1000).alias("part")).agg(F.collect_list("o_custkey").alias("c"), F.collect_list("o_orderkey").alias("k"))
    return merge.delete_pairs(o.drop("o_orderpriority"), pairs, ["o_custkey", "o_orderkey"], ["c", "k"])


@query(
    "WITH f AS (SELECT platform_name, platform_artist_id, min((source_file, artist_name)) AS s FROM artworks WHERE artist_name IS NOT NULL AND platform_artist_id IS NOT NULL AND source_file IS NOT NULL GROUP BY 1, 2) "
    "SELECT a.platform_name, coalesce(a.artist_name, struct_extract(s, 2)) AS artist_name, count(*) AS n FROM artworks a LEFT JOIN f ON f.platform_name = a.platform_name AND f.platform_artist_id = a.platform_artist_id GROUP BY 1, 2"
)
def j_filled_names(spark: SparkSession, d: str) -> DataFrame:
    """Artworks without an artist's name get the first one their source gives for the artist."""
    a = table(spark, d, "artworks").select("platform_name", "platform_artist_id", "artist_name", "source_file")
    filled = pages.filled_names(a, "platform_name", "platform_artist_id", "artist_name", "source_file")
    return filled.groupBy("platform_name", "artist_name").agg(F.count("*").alias("n"))


# ── walks and runs ──────────────────────────────────────────────────────────────

_WALK = "SELECT o_custkey AS k, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS INT) AS page, CAST(CASE WHEN o_orderpriority = '5-LOW' THEN 0 WHEN o_orderpriority = '1-URGENT' THEN 7 ELSE 20 END AS INT) AS n FROM orders"


@query(
    f"WITH p AS ({_WALK}), w AS (SELECT *, CASE WHEN n = 0 AND lag(n) OVER (PARTITION BY k ORDER BY page) = 0 THEN 'empty' WHEN n > 0 AND n < 20 THEN 'short' WHEN page >= 12 THEN 'ceiling' END AS stop FROM p), "
    "l AS (SELECT k, min(page) AS last FROM w WHERE stop IS NOT NULL GROUP BY 1) SELECT k, page, n, stop FROM w LEFT JOIN l USING (k) WHERE last IS NULL OR page <= last"
)
def r_walked_pages(spark: SparkSession, d: str) -> DataFrame:
    """Every customer's orders as the pages of a listing."""
    o = merge.running_rank(table(spark, d, "orders").select(F.col("o_custkey").alias("k"), "o_orderkey", "o_orderpriority"), ["k"], [F.col("o_orderkey")], "page")
    n = F.when(F.col("o_orderpriority") == "5-LOW", 0).when(F.col("o_orderpriority") == "1-URGENT", 7).otherwise(20)
    p = o.select("k", F.col("page").cast("int").alias("page"), n.alias("n"))
    return partitioning.walked_pages(p, ["k"], "page", "n", 20, ceiling=12)


@query("SELECT CASE WHEN (SELECT count(*) FROM (SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders)) = 0 AND (SELECT count(*) FROM (SELECT o_custkey FROM orders EXCEPT SELECT c_custkey FROM customer)) = 0 THEN 'full' ELSE 'incremental' END AS crawl_mode, (SELECT count(*) FROM orders) AS n")
def s_results_and_mode(spark: SparkSession, d: str) -> DataFrame:
    """Download results are appended in two parts and read again; their addresses decide the mode of the crawl."""
    o = table(spark, d, "orders").select(F.concat(F.col("o_orderkey").cast("string"), F.lit(".html")).alias("filename"), F.col("o_custkey").cast("string").alias("url"), F.lit("2025-01-01T00:00:00Z").alias("timestamp"), (F.col("o_orderkey") % 2).alias("part"))
    folder = _folder(spark)
    for part in (0, 1):
        crawl.append_results(o.filter(F.col("part") == part).drop("part"), folder)
    log = crawl.crawl_log(spark, f"{folder}/results.jsonl")
    mode = crawl.crawl_mode(log.select(F.col("url").cast("bigint").alias("k")), table(spark, d, "customer").select(F.col("c_custkey").cast("bigint").alias("k")), ["k"])
    return mode.withColumn("n", log.agg(F.count("*")).scalar())


@query("WITH l AS (SELECT event_type, arg_max(user_id % 3, event_id) AS epoch FROM events GROUP BY 1) SELECT e.event_type, l.epoch, count(*) AS n FROM events e JOIN l ON l.event_type = e.event_type AND l.epoch = e.user_id % 3 GROUP BY 1, 2")
def w_latest_epoch(spark: SparkSession, d: str) -> DataFrame:
    log = table(spark, d, "events").select("event_type", (F.col("user_id") % 3).alias("epoch"), "event_id")
    return merge.latest_epoch(log, ["event_type"], "epoch", "event_id").groupBy("event_type", "epoch").agg(F.count("*").alias("n"))


@query(
    "WITH s AS (SELECT o_custkey AS k, min(o_orderkey) AS a, min(o_orderkey) FILTER (WHERE o_orderpriority = '1-URGENT') AS b FROM orders WHERE o_orderstatus = 'F' GROUP BY 1), "
    "t AS (SELECT o_custkey AS k, max(o_orderkey) AS a, max(o_orderkey) FILTER (WHERE o_orderpriority = '2-HIGH') AS b FROM orders GROUP BY 1) "
    "SELECT k, CASE WHEN s.k % 2 = 0 THEN coalesce(s.a, t.a) ELSE coalesce(t.a, s.a) END AS a, CASE WHEN s.k % 2 = 0 THEN coalesce(s.b, t.b) ELSE coalesce(t.b, s.b) END AS b FROM s FULL JOIN t USING (k)"
)
def m_own_priority(spark: SparkSession, d: str) -> DataFrame:
    """Columns merged: what an entity's own page says is kept, elsewhere the newer value wins."""
    o = table(spark, d, "orders").withColumnRenamed("o_custkey", "k")
    old = o.filter("o_orderstatus = 'F'").groupBy("k").agg(F.min("o_orderkey").alias("a"), F.min(F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_orderkey"))).alias("b"))
    new = o.groupBy("k").agg(F.max("o_orderkey").alias("a"), F.max(F.when(F.col("o_orderpriority") == "2-HIGH", F.col("o_orderkey"))).alias("b"))
    return merge.merge_columns(old, new, ["k"], own=F.col("k") % 2 == 0)


@query("SELECT 'https://h.example/x?id=' || o_orderkey || '&page=2' AS url, CASE o_orderkey % 3 WHEN 0 THEN 'no-url' WHEN 1 THEN 'order' ELSE 'other' END AS page_group FROM orders")
def u_tracking_and_groups(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey").cast("string")
    tracked = F.concat(F.lit("https://h.example/x?utm_source=a&id="), k, F.lit("&gclid=1&page=2#top"))
    page = F.when(F.col("o_orderkey") % 3 == 1, F.concat(F.lit("https://h.example/order/"), k)).when(F.col("o_orderkey") % 3 == 2, F.concat(F.lit("https://h.example/about/"), k))
    return table(spark, d, "orders").select(urls.drop_tracking(tracked).alias("url"), urls.page_group(page, (urls.template("order", "/order/{d}"),)).alias("page_group"))


@query("SELECT 'https://www.house.example/lot/' || o_orderkey || '/Ann Bell+Co' AS url, count(*) AS n FROM (SELECT o_orderkey FROM orders UNION ALL SELECT o_orderkey FROM orders) GROUP BY 1")
def u_canonical(spark: SparkSession, d: str) -> DataFrame:
    """Two ways of writing each address give one."""
    site = urls.Site("www.house.example", (), aliases=("house.example",), locales="en|fr|zh-cn")
    k = F.col("o_orderkey").cast("string")
    ways = F.array(F.concat(F.lit("http://House.example:80/zh-cn/lot/"), k, F.lit("/Ann%20Bell+Co/?utm_source=x#y")), F.concat(F.lit("https://www.house.example/fr/lot/"), k, F.lit("/Ann Bell+Co")))
    return table(spark, d, "orders").select(F.explode(ways).alias("u")).groupBy(urls.canonical_url("u", site).alias("url")).agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, strftime(m + to_days(CAST(least(o_orderkey % 31 + 1, date_part('day', last_day(m))) - 1 AS INT)), '%Y-%m-%d') AS day FROM (SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS m FROM orders)")
def r_monthly(spark: SparkSession, d: str) -> DataFrame:
    """The day of the month a schedule names, or the month's last one."""
    o = table(spark, d, "orders").select("o_orderkey", F.trunc(F.col("o_orderdate").cast("date"), "month").alias("m"))
    return o.select("o_orderkey", partitioning.monthly((F.col("o_orderkey") % 31 + 1).cast("int"), F.col("m")).cast("string").alias("day"))


@query(
    "WITH g AS (SELECT l_orderkey AS k, min(l_linenumber) AS lo, max(l_linenumber) AS hi, max(CASE WHEN l_orderkey % 2 = 0 THEN l_linenumber ELSE 99 END) AS size FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1) "
    "SELECT k, n FROM (SELECT k, unnest(generate_series(lo, hi)) AS n FROM g WHERE hi - lo + 1 = size) UNION ALL SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem JOIN g ON k = l_orderkey WHERE l_returnflag <> 'R' AND hi - lo + 1 <> size"
)
def r_fill_ranges(spark: SparkSession, d: str) -> DataFrame:
    """Numbers of lines between the first and the last are filled in where the size says there is no gap."""
    li = table(spark, d, "lineitem").filter("l_returnflag <> 'R'")
    size = F.when(F.col("l_orderkey") % 2 == 0, F.col("l_linenumber")).otherwise(99)
    return partitioning.fill_ranges(li.select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), size.alias("size")), ["k"], "n", "size")


@query("SELECT n_nationkey AS child FROM nation WHERE (SELECT count(DISTINCT c_custkey) FROM customer WHERE c_nationkey < 10) < 0.5 * (SELECT count(*) FROM customer) OR n_nationkey % 5 = 0")
def a_requeue(spark: SparkSession, d: str) -> DataFrame:
    """Lists are read again if the cache holds less than half of what they gave."""
    c = table(spark, d, "customer")
    given = c.groupBy("c_nationkey").agg(F.count("*").alias("found"))
    children = table(spark, d, "nation").join(given, F.col("n_nationkey") == F.col("c_nationkey"), "left").select(F.col("n_nationkey").alias("child"), (F.col("n_nationkey") % 5 != 0).alias("done"), "found")
    everything = children.withColumn("found", F.when(F.col("child") == 1, F.lit(c.count())).otherwise(0))
    return audit.requeue(everything, c.filter("c_nationkey < 10").select("c_custkey"), ["c_custkey"]).select("child")
