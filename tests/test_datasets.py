from vernissage.plans import datasets

from .conftest import SF, rows, utc


def test_schemas_are_those_of_the_tables(spark):
    for d, n in ((datasets.ARTWORKS, 38), (datasets.ARTISTS, 20)):
        have = [(f.name, f.dataType) for f in spark.read.parquet(f"{SF}/{d.name}.parquet").schema][:n]
        assert [(f.name, f.dataType) for f in d.schema] == have
    assert len(datasets.LOTS.schema) == 33 and datasets.LOTS.entity_type == "lot"


def test_conform(spark):
    df = spark.createDataFrame([("p", "2025-01-01", "1", "12.5", "x", "extra"), ("p", "2025-01-01", "", "1", "1", ""), ("p", "2025-01-01", None, "1", "1", "")], "platform_name string, crawl_date string, platform_artwork_id string, price string, year string, other string")
    got = datasets.ARTWORKS.conform(df)
    assert got.columns[:2] == ["platform_name", "crawl_date"] and len(got.columns) == 40
    r = got.collect()
    assert len(r) == 1 and float(r[0].price) == 12.5 and r[0].year is None and r[0].title is None
    assert rows(datasets.ARTWORKS.ids(got), "entity_id", "version_id") == [("p:1", "p:1:2025-01-01")]


def test_a_result_beats_a_live_page(spark):
    s = "platform_name string, crawl_date string, platform_lot_id string, is_result boolean, has_detail boolean, crawled_at timestamp, source_file string"
    df = spark.createDataFrame([("p", "d", "1", False, True, utc(2025, 1, 9), "live"), ("p", "d", "1", True, False, utc(2025, 1, 1), "result"), ("p", "d", "1", None, True, utc(2025, 1, 9), "z")], s)
    assert rows(datasets.LOTS.winners(df), "source_file") == [("result",)]


def test_fill_from_catalogue(spark):
    df = datasets.LOTS.conform(
        spark.createDataFrame(
            [("1", "Untitled", "Oil on canvas, signed lower right. Painted in 1965. 30 x 40 in. (76.2 x 101.6 cm.)", "A B (American, 1900-1980)", None), ("2", "Study, 1986", None, "C D", "Bronze")],
            "platform_lot_id string, title string, description string, artist_name string, medium string",
        )
    )
    a, b = sorted(datasets.fill_from_catalogue(df, 2026).collect(), key=lambda r: r.platform_lot_id)
    assert (a.height_cm, a.width_cm, a.medium, a.year, a.is_signed, a.artist_birth_year, a.artist_death_year, a.artist_nationality) == (76.2, 101.6, "Oil on canvas", 1965, True, 1900, 1980, "American")
    assert (b.year, b.medium, b.height_cm, b.is_signed) == (1986, "Bronze", None, None)
