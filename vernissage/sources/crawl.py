"""Crawl folders: pages, download logs, manifests."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from vernissage.functions.scalars import folder_date, seen_at, to_timestamp
from vernissage.operators.dedup import SortField, winners
from vernissage.operators.diffs import same_set

LOG_SCHEMA = "url string, filename string, status_code int, error string, block_detected boolean, block_reason string, duration_ms int, timestamp string, skipped_existing boolean, _bad string"
MANIFEST_SCHEMA = "marketplace string, crawl_date string, started_at string, finished_at string, workers int, rps double, url_count int, status string, crawl_mode string"
MANIFEST_TYPE = f"struct<{MANIFEST_SCHEMA.replace(' ', ':').replace(',:', ',')}>"


def page_files(spark: SparkSession, root: str) -> DataFrame:
    """``path, filename, html, modified`` of all pages below ``root``.

    Hidden folders and the leftovers of archives are skipped. Bytes that are no
    UTF-8 become replacement characters.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.html").load(root)
    hidden = F.col("path").rlike(r"/(?:\.[^/]+|__MACOSX)/")
    return files.filter(~hidden).select("path", F.element_at(F.split("path", "/"), -1).alias("filename"), F.make_valid_utf8(F.col("content").cast("string")).alias("html"), F.col("modificationTime").alias("modified"))


def crawl_log(spark: SparkSession, path: str) -> DataFrame:
    """``filename, url, crawled_at``: the last entry of each file.

    Broken lines and entries without a file are dropped (``bad_lines`` counts
    them). Lines follow each other by the log's path, the place of their block
    in it, and their order within the block.
    """
    log = spark.read.schema(LOG_SCHEMA).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").json(path)
    at = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    rows = log.withColumn("_at", at).filter("_bad is null and filename is not null and filename <> ''")
    return winners(rows.select("filename", "url", to_timestamp("timestamp").alias("crawled_at"), "_at"), ["filename"], [SortField("_at")]).drop("_at")


def bad_lines(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.text(path).filter("trim(value) <> ''")
    return text.agg(F.count("*").alias("n_lines"), F.count_if(F.try_parse_json("value").isNull()).alias("n_bad"))


def pages_with_log(files: DataFrame, log: DataFrame, said: Column | None = None) -> DataFrame:
    """Pages with their address and time: what the page says, else the log, else the file's own time."""
    j = files.join(log, "filename", "left")
    times = ([] if said is None else [said]) + [F.col("crawled_at"), F.col("modified")]
    return j.withColumn("crawled_at", F.coalesce(*times)).drop("modified")


def _children(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, sorted; none if it is missing."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    return sorted(f.getPath().getName() for f in fs.listStatus(p) if f.isDirectory())


def html_root(spark: SparkSession, folder: str) -> str:
    """The ``html`` folder of a crawl's folder, or the folder itself if it has none."""
    return f"{folder.rstrip('/')}/html" if "html" in _children(spark, folder) else folder


def crawl_folders(spark: SparkSession, root: str, platform: str) -> DataFrame:
    """``platform_name, folder, crawl_date`` of a platform's dated folders, in order of their names."""
    names = _children(spark, f"{root.rstrip('/')}/{platform}")
    found = spark.createDataFrame([(platform, n) for n in names], "platform_name string, folder string")
    return found.withColumn("crawl_date", folder_date("folder")).filter("crawl_date is not null").orderBy("folder")


def platforms(spark: SparkSession, root: str) -> list[str]:
    """Platforms that have snapshots below a root."""
    return [n.removeprefix("platform_name=") for n in _children(spark, root) if n.startswith("platform_name=")]


def crawl_date_of(spark: SparkSession, folder: str, explicit: str | None = None) -> str:
    """A crawl's date: the one given, else that of the nearest folder whose name is one; it must have one."""
    if explicit is not None:
        return explicit
    found = spark.range(1).select(crawl_of_path(F.lit(folder))["crawl_date"].cast("string").alias("d")).first()["d"]
    if found is None:
        raise ValueError(f"{folder} lies in no dated folder")
    return found


def crawl_of_path(path: Column | str) -> Column:
    """``struct(platform_name, crawl_date)`` from ``…/<platform>/<date>/…``; nearest date wins."""
    p = F.col(path) if isinstance(path, str) else path
    parts = F.split(p, "/")
    dates = F.filter(F.transform(parts, lambda x, i: F.struct(i.alias("i"), folder_date(x).alias("d"))), lambda s: s["d"].isNotNull())
    last = F.element_at(dates, -1)
    return F.when(F.size(dates) > 0, F.struct(F.get(parts, last["i"] - 1).alias("platform_name"), last["d"].alias("crawl_date")))


def manifests(spark: SparkSession, glob: str) -> DataFrame:
    """Manifests of crawls with the crawl their folder names. A file that is no JSON object is an error."""
    raw = spark.read.option("wholetext", "true").text(glob).select("value", crawl_of_path(F.col("_metadata.file_path")).alias("_c"), F.col("_metadata.file_path").alias("path"))
    v = raw.withColumn("v", F.try_parse_json("value"))
    whole = F.when(F.coalesce(F.schema_of_variant("v").startswith("OBJECT"), F.lit(False)), F.from_json("value", MANIFEST_SCHEMA))
    checked = F.coalesce(whole, F.raise_error(F.concat(F.lit("no manifest: "), F.col("path"))).cast(MANIFEST_TYPE))
    return v.select(F.col("_c.platform_name").alias("platform_name"), F.col("_c.crawl_date").alias("crawl_day"), checked.alias("m")).select("platform_name", "crawl_day", "m.*")


def snapshots(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """Rows of partitioned Parquet snapshots in a fixed schema: absent columns are null, others ignored."""
    return spark.read.schema(schema).option("basePath", root).parquet(f"{root}/platform_name=*/crawl_date=*")


def finished_snapshots(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """Rows of snapshots whose folder holds a manifest beside its parts; others are still being written."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/platform_name=*/crawl_date=*/_manifest.json")
    # One name per crawl, from the listing alone.
    names = [str(f.getPath()) for f in p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p) or ()]
    done = spark.createDataFrame([(n,) for n in names], "path string")
    done = done.select(F.url_decode(F.regexp_extract("path", r"/platform_name=([^/]+)/", 1)).alias("platform_name"), F.regexp_extract("path", r"/crawl_date=([^/]+)/", 1).cast("date").alias("crawl_date"))
    return snapshots(spark, root, schema).join(done, ["platform_name", "crawl_date"], "left_semi")


def with_seen(df: DataFrame) -> DataFrame:
    return df.withColumn("seen_at", seen_at("crawled_at", "crawl_date"))


def pending(manifest: DataFrame, ledger: DataFrame, keys: Sequence[str] = ("platform_name", "crawl_date")) -> DataFrame:
    """Crawls with what to do: ``new``, ``resume``, ``stale`` (finished after it was read) or ``done``.

    Only finished crawls are looked at.
    """
    m = manifest.filter(F.col("status").isin("completed", "failed")).select(*keys, F.col("finished_at").alias("crawl_finished"))
    led = ledger.select(*keys, F.col("status").alias("etl_status"), F.col("started_at").alias("etl_started"))
    j = m.join(led, list(keys), "left")
    action = F.when(F.col("etl_status").isNull(), "new").when(F.col("etl_status") != "completed", "resume").when(F.col("crawl_finished") > F.col("etl_started"), "stale").otherwise("done")
    return j.withColumn("action", action)


def retention(folders: DataFrame, ledger: DataFrame, required: Sequence[str], keep: int = 2) -> DataFrame:
    """Dated folders that may go: completed for every required dataset and not among the newest ``keep``."""
    from vernissage.operators.dedup import top_k
    from vernissage.operators.diffs import completed_for_all

    done = completed_for_all(ledger, ["platform_name", "crawl_date"], required)
    whole = folders.join(done, ["platform_name", "crawl_date"], "left_semi")
    kept = top_k(whole, ["platform_name"], [F.desc("crawl_date")], keep)
    return whole.join(kept.select("platform_name", "crawl_date"), ["platform_name", "crawl_date"], "left_anti")


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """A state file as JSON lines, or None if it is missing."""
    try:
        return spark.read.json(path)
    except AnalysisException:
        return None


def write_manifest(spark: SparkSession, folder: str, manifest: Mapping[str, object]) -> None:
    """Writes a crawl's manifest, replacing an older one."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/manifest.json")
    stream = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    try:
        stream.write(bytearray(json.dumps(manifest, default=str).encode()))
    finally:
        stream.close()


def append_results(results: DataFrame, folder: str) -> None:
    """Appends download results, as JSON lines, to those of a crawl's folder; ``crawl_log`` reads them."""
    results.write.mode("append").json(f"{folder.rstrip('/')}/results.jsonl")


def crawl_mode(read: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row ``crawl_mode``: ``full`` if a crawl read exactly the known addresses, else ``incremental``."""
    return same_set(read, known, keys).select(F.when(F.col("same"), "full").otherwise("incremental").alias("crawl_mode"))
