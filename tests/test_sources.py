import datetime as dt
import gzip
import json

import pytest
from pyspark.sql import functions as F

from vernissage.functions.urls import Rule
from vernissage.sources import crawl, lists

from .conftest import rows, utc


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(path)


def test_pages_and_log(spark, tmp_path):
    root = tmp_path / "galerista" / "2025-01-03"
    write(root / "html" / "a.html", "<p>é</p>")
    write(root / "html" / "sub" / "b.html", b"<p>\xff</p>")
    write(root / "html" / "__MACOSX" / "x.html", "no")
    write(root / "html" / ".hidden" / "y.html", "no")
    write(root / "html" / "c.txt", "no")
    lines = [{"filename": "a.html", "url": "u0", "timestamp": "2025-01-03T01:00:00"}, {"filename": "a.html", "url": "u1", "timestamp": "2025-01-03T02:00:00"}, {"url": "no file"}]
    log = write(root / "results.jsonl", "\n".join(map(json.dumps, lines)) + "\n{broken\n\n")
    pages = crawl.pages_with_log(crawl.page_files(spark, str(root / "html")), crawl.crawl_log(spark, log))
    got = {r.filename: r for r in pages.collect()}
    assert set(got) == {"a.html", "b.html"}
    assert got["a.html"].url == "u1" and got["a.html"].html == "<p>é</p>" and got["a.html"].crawled_at.hour == 2
    assert got["b.html"].url is None and got["b.html"].crawled_at is not None and "�" in got["b.html"].html
    assert rows(crawl.bad_lines(spark, log)) == [(4, 1)]


def test_manifest_folder_and_pending(spark, tmp_path):
    for day, status in (("2025-01-03", "completed"), ("2025-02", "failed"), ("2025-03-01", "running")):
        write(tmp_path / "p" / day / "manifest.json", json.dumps({"status": status, "finished_at": "2025-01-05T00:00:00"}))
    m = crawl.manifests(spark, str(tmp_path / "p" / "*" / "manifest.json"))
    assert rows(m, "platform_name", "crawl_day", "status") == [("p", dt.date(2025, 1, 3), "completed"), ("p", dt.date(2025, 2, 1), "failed"), ("p", dt.date(2025, 3, 1), "running")]
    s = "platform_name string, crawl_date string, status string, started_at string, finished_at string"
    man = spark.createDataFrame([("p", d, "completed", None, "5") for d in "abcd"] + [("p", "e", "running", None, None)], s)
    led = spark.createDataFrame([("p", "a", "completed", "9", None), ("p", "b", "completed", "1", None), ("p", "c", "running", "1", None)], s)
    assert rows(crawl.pending(man, led), "crawl_date", "action") == [("a", "done"), ("b", "stale"), ("c", "resume"), ("d", "new")]


@pytest.mark.parametrize("text", ["[1, 2]", "{broken", ""])
def test_a_manifest_that_is_no_object_is_an_error(spark, tmp_path, text):
    write(tmp_path / "p" / "2025-04-01" / "manifest.json", text)
    with pytest.raises(Exception, match="no manifest" if text else ""):
        rows(crawl.manifests(spark, str(tmp_path / "p" / "*" / "manifest.json")), "status")
        assert not text, "an empty file has no line to complain about"
        raise ValueError


def test_folders_and_dates_of_crawls(spark, tmp_path):
    for day in ("2025-03", "2025-01-09", "notes", "2025-13-01"):
        write(tmp_path / "p" / day / "html" / "a.html", "x")
    write(tmp_path / "p" / "flat" / "a.html", "x")
    assert [(r.folder, r.crawl_date) for r in crawl.crawl_folders(spark, str(tmp_path), "p").collect()] == [("2025-01-09", dt.date(2025, 1, 9)), ("2025-03", dt.date(2025, 3, 1))]
    assert crawl.crawl_folders(spark, str(tmp_path), "none").count() == 0
    assert crawl.html_root(spark, str(tmp_path / "p" / "notes")).endswith("/notes/html") and crawl.html_root(spark, str(tmp_path / "p" / "flat")).endswith("/flat")
    assert crawl.crawl_date_of(spark, "/data/p/2025-03/html") == "2025-03-01" and crawl.crawl_date_of(spark, "/data/p", "2024-01-01") == "2024-01-01"
    with pytest.raises(ValueError, match="no dated folder"):
        crawl.crawl_date_of(spark, "/data/p/html")


def test_times_of_pages_in_order_of_trust(spark):
    f = spark.createDataFrame([("a", utc(2025, 1, 1), utc(2025, 3, 1)), ("b", utc(2025, 1, 1), None), ("c", utc(2025, 1, 1), None)], "filename string, modified timestamp, said timestamp")
    log = spark.createDataFrame([("a", "u", utc(2025, 2, 1)), ("b", "v", utc(2025, 2, 1))], "filename string, url string, crawled_at timestamp")
    assert [r.crawled_at.month for r in crawl.pages_with_log(f, log, F.col("said")).orderBy("filename").collect()] == [3, 2, 1]


def test_finished_snapshots(spark, tmp_path):
    spark.createDataFrame([("a b", "2025-01-01", "1"), ("a b", "2025-02-01", "2")], "platform_name string, crawl_date string, id string").write.partitionBy("platform_name", "crawl_date").parquet(str(tmp_path / "s"))
    folder = next(p for p in (tmp_path / "s").rglob("crawl_date=2025-01-01"))
    write(folder / "_manifest.json", "{}")
    assert rows(crawl.finished_snapshots(spark, str(tmp_path / "s"), "id string, platform_name string, crawl_date date"), "id") == [("1",)]
    assert crawl.platforms(spark, str(tmp_path / "s")) in (["a b"], ["a%20b"])


def test_retention_keeps_the_newest_complete(spark):
    f = spark.createDataFrame([("p", d) for d in "abcde"], "platform_name string, crawl_date string")
    led = spark.createDataFrame([("p", d, x, "completed") for d in "abce" for x in ("artists", "artworks")] + [("p", "d", "artists", "completed")], "platform_name string, crawl_date string, dataset string, status string")
    assert rows(crawl.retention(f, led, ["artists", "artworks"]), "crawl_date") == [("a",), ("b",)]


def test_snapshots_in_a_fixed_schema(spark, tmp_path):
    spark.createDataFrame([("1", 2, "x")], "id string, n int, extra string").write.parquet(str(tmp_path / "platform_name=p" / "crawl_date=2025-01-01"))
    got = crawl.snapshots(spark, str(tmp_path), "id string, n int, absent string, platform_name string, crawl_date date").first()
    assert (got.id, got.n, got.absent, got.platform_name) == ("1", 2, None, "p")
    assert crawl.read_or_none(spark, str(tmp_path / "nothing.json")) is None


SITEMAP = '<?xml version="1.0"?><urlset>{}</urlset>'


def test_sitemaps(spark, tmp_path):
    body = "".join(f"<url><loc> {u} </loc><lastmod>2025-01-0{i}</lastmod></url>" for i, u in enumerate(["https://h.example/art/1/", "https://h.example/art/1?x=2", "https://h.example/about"], 1)) + "<url><lastmod>2025-01-01</lastmod></url>"
    write(tmp_path / "a.xml", SITEMAP.format(body))
    write(tmp_path / "b.xml.gz", gzip.compress(SITEMAP.format("<url><loc>https://h.example/art/2</loc></url>").encode()))
    write(tmp_path / "c.xml", "<urlset><url><loc>broken")
    e = lists.sitemap_entries(spark, str(tmp_path))
    assert e.count() == 4
    typed = lists.typed_entries(e, [Rule("artwork", r"^/art/(\d+)$")], plain_only=True)
    assert rows(typed, "url", "entity_type", "entity_id") == [("https://h.example/art/1", "artwork", "1"), ("https://h.example/art/2", "artwork", "2")]
    write(tmp_path / "i" / "index.xml", "<sitemapindex><sitemap><loc>https://h.example/en-art.xml</loc></sitemap><sitemap><loc>https://h.example/news.xml</loc></sitemap></sitemapindex>")
    assert rows(lists.sitemap_children(spark, str(tmp_path / "i"), include="art", exclude="/fr-"), "url") == [("https://h.example/en-art.xml",)]


def test_lists_and_caches(spark, tmp_path):
    p = write(tmp_path / "urls.txt", "# c\nhttps://a\n\n  https://b \n")
    assert rows(lists.url_lines(spark, p)) == [("https://a",), ("https://b",)]
    j = write(tmp_path / "urls.jsonl", '{"url": "https://a"}\n{"request": "https://b"}\n{"request": {"endpoint": "https://c"}}\n{"url": "", "input": "https://d"}\nno json\n{}\n')
    assert rows(lists.url_json(spark, j)) == [("https://a",), ("https://b",), ("https://c",), ("https://d",)]
    c = write(tmp_path / "cache.jsonl", '{"entity_id": "1", "url": "u", "lastmod": "2025-01-01"}\n{"entity_type": "sale", "entity_id": "007", "url": "v"}\n{"entity_id": " ", "url": "w"}\nbad\n')
    got = lists.typed_cache(spark, c, "lot")
    assert rows(got, "entity_type", "entity_id", "url") == [("lot", "1", "u"), ("sale", "007", "v")]
    lists.append_cache(got, str(tmp_path / "out"))
    lists.append_cache(got, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 4
    lists.write_url_list(got, str(tmp_path / "list"))
    assert rows(spark.read.text(str(tmp_path / "list"))) == [("u",), ("v",)]


def test_line_chunks(spark, tmp_path):
    from vernissage.operators.partitioning import line_chunks

    line_chunks(spark.range(25).coalesce(1), "id", 10, str(tmp_path / "c"))
    sizes = sorted(len(f.read_text().split()) for f in (tmp_path / "c").glob("part-*"))
    assert sizes == [5, 10, 10]
