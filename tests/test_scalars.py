import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from vernissage.functions import catalogue, countries, scalars, urls


@pytest.mark.parametrize("given, expected", [("7,250.4", Decimal("7250.40")), ("0.005", Decimal("0.01")), ("00", Decimal("0.00")), ("-3", None), ("-0.0001", None), ("12 EUR", None), ("2e11", Decimal("200000000000.00")), ("8e12", None), ("infinity", None), ("5f", None), ("9_9", None), ("", None), (None, None)])
def test_to_money(one, given, expected):
    assert one(scalars.to_money("s"), "s string", given) == expected


@pytest.mark.parametrize("given, expected", [("sek ", "SEK"), ("chf", "CHF"), ("£", None), ("pounds", None), ("N/A", None), (None, None)])
def test_currency_code(one, given, expected):
    assert one(scalars.currency_code("s"), "s string", given) == expected


@pytest.mark.parametrize("given, expected", [("after 1733", 1733), ("Gent 1899/1901", 1899), ("lot 88123", None), ("x1950y", None), ("2031", None), ("0780", None), (None, None)])
def test_year_of(one, given, expected):
    assert one(scalars.year_of("s", 2026), "s string", given) == expected


@pytest.mark.parametrize("given, expected", [("urn/gender/Man", "male"), ("F", "female"), ("Agender", "agender"), ("-", None), (None, None)])
def test_gender(one, given, expected):
    assert one(scalars.gender("s"), "s string", given) == expected


def test_country_names_and_codes(spark):
    names = countries.country_names(spark)
    given = [("pl",), ("POL",), ("pol",), ("Poland",), ("UK",), ("qq",), ("unknown",), (None,)]
    df = spark.createDataFrame(given, "s string")
    assert [r.v for r in df.select(scalars.country_name("s", names).alias("v")).collect()] == ["Poland", "Poland", "pol", "Poland", "United Kingdom", "qq", None, None]
    known = {"Polska": "PL", "polish": "PL", "SUÈDE": "SE", "Svensk": "SE", "Schweiz": "CH", "Côte d’Ivoire": "CI", "nigerian": "NG", "U K": None, "atlantis": None, "VN": "VN", "Brasilien": "BR"}
    df = spark.createDataFrame([(k,) for k in known], "s string")
    table = countries.country_table(spark)
    assert {r.s: r.v for r in countries.with_country_code(df, "s", "v", table).collect()} == known
    assert table.count() == table.select("word").distinct().count() < 5000


@pytest.mark.parametrize(
    "given, expected",
    [("studio.example/about me", None), ("studio.example/about", "https://studio.example/about"), ("//cdn.studio.example/a", "https://cdn.studio.example/a"), ("HTTPS://Studio.example", "HTTPS://Studio.example"), ("tel:+4912", None), ("data:text/plain,x", None), ("studio.example:8080", "https://studio.example:8080"), ("file://host.example/a", None), ("https://", None), ("https://.", None), ("gallery", None), (None, None)],
)
def test_to_url(one, given, expected):
    assert one(scalars.to_url("s"), "s string", given) == expected


@pytest.mark.parametrize("given, expected", [("http://MOBILE.Studio.example/x", "studio.example"), ("https://me:pw@www.studio.example:81/", "studio.example"), ("https://www.www.example", "www.example"), ("studio.example", None), ("", None), (None, None)])
def test_host_of(one, given, expected):
    assert one(scalars.host_of("s"), "s string", given) == expected


def test_sort_links(spark):
    df = spark.createDataFrame([(["https://vimeo.com/1", "instagram.com/ada", "https://m.instagr.am/b", "not an address", "ada.example", "https://tiktok.com/@ada", None, "ada2.example"],), (None,), ([],)], "u array<string>")
    links = df.select(scalars.sort_links("u", ("vimeo.com",)).alias("l"), scalars.fill_links(scalars.sort_links("u", ("vimeo.com",)), scalars.sort_links(F.array(F.lit("fb.com/ada"), F.lit("x.example")), ())).alias("f")).collect()
    assert links[0].l.asDict() == {"website": "https://ada.example", "facebook": None, "instagram": "https://instagram.com/ada", "tiktok": "https://tiktok.com/@ada", "twitter": None}
    assert links[0].f.facebook == "https://fb.com/ada" and links[0].f.website == "https://ada.example"
    assert links[1].l is None and links[2].l.website is None and links[2].f.website == "https://x.example"


@pytest.mark.parametrize("given, expected", [("@ada.b", "https://social.example/ada.b"), ("ada_b", "https://social.example/ada_b"), ("instagram.com", "https://instagram.com"), ("instagram.com/ada", "https://instagram.com/ada"), ("ada b", None), ("@", None), (None, None)])
def test_profile_url(one, given, expected):
    assert one(scalars.profile_url("s", "https://social.example/{}"), "s string", given) == expected


def test_text_list(spark):
    df = spark.createDataFrame([([" a", "N/A", "b"], ["a", None]), (None, None), ([], ["-"])], "x array<string>, y array<string>")
    assert [r.v for r in df.select(scalars.text_list("x", "y").alias("v")).collect()] == [["a", "b"], None, None]


@pytest.mark.parametrize(
    "given, expected",
    [
        ("<script>x < 1</script><h2>Wood</h2><ul><li>oak &lt; ash</li><li>b&eacute;che</li></ul>", "Wood\noak < ash\nbéche"), ("it&#8217;s &frac12; &pound;5", "it’s ½ £5"), ("&#x1F3A8;&#150;&#xD800;&#0;", "🎨–��"), ("a & b &unknown; &amp;lt; &copy 1", "a & b &unknown; &lt; © 1"),
        ("2 < 3 and 4 > 3", "2 < 3 and 4 > 3"), ("<!-- note -->x<img src=a>", "x"), ("", None), (None, None), ("&" * 50, "&" * 50),
    ],
)
def test_plain_text(one, given, expected):
    assert one(scalars.plain_text("s"), "s string", given) == expected


def test_entities_agree_with_the_standard(spark):
    import html
    import html.entities

    texts = [f"x{k if k.startswith('&') else '&' + k} y" for k in html.entities.html5] + [f"&#{n};" for n in [9, 10, *range(32, 127), *range(160, 400), 8364, 0x1F3A8]]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    wrong = [(r.s, r.v) for r in df.select("s", scalars.unescape("s").alias("v")).collect() if r.v != html.unescape(r.s)]
    assert not wrong, wrong[:5]


@pytest.mark.parametrize("given, expected", [("1998-12-31", dt.date(1998, 12, 31)), ("1998-12-31 23:59", dt.date(1998, 12, 31)), ("98-12-31", None), ("1234567890", dt.date(2009, 2, 13)), ("1234567890123", dt.date(2009, 2, 13)), ("999", None), ("0001-05-05", None), ("soon", None), (None, None), ("1999-02-29", None)])
def test_to_date(one, given, expected):
    assert one(scalars.to_date("s"), "s string", given) == expected


@pytest.mark.parametrize("given, expected", [("2019-02", dt.date(2019, 2, 1)), ("2019-02-11", dt.date(2019, 2, 11)), ("2019-00", None), ("pages", None), (None, None)])
def test_folder_date(one, given, expected):
    assert one(scalars.folder_date("s"), "s string", given) == expected


@pytest.mark.parametrize("given, expected", [("2019-02-11T23:30:00-05:00", "2019-02-12 04:30:00"), ("2019-02-11", "2019-02-11 00:00:00"), ("yesterday", None), (None, None)])
def test_to_timestamp(one, given, expected):
    assert one(F.date_format(scalars.to_timestamp("s"), "yyyy-MM-dd HH:mm:ss"), "s string", given) == expected


@pytest.mark.parametrize(
    "given, expected",
    [
        ("Sérigraphie sur papier", "Sérigraphie sur papier"), ("Giclée print", "Giclée print"), ("Silkscreen on paper, laid down on board", "Silkscreen on paper, laid down on board"), ("Bodycolour on paper", "Bodycolour on paper"), ("Fusain sur carton. Signé en bas", "Fusain sur carton"),
        ("Two herons at dusk, tempera and gold on oak panel, framed", "tempera and gold on oak panel"), ("The mill. Unique bronze with brown patina, 44 cm high", "Unique bronze with brown patina"), ("Original linocut 12/50, signed", "Original linocut"),
        ("Edition of 30 etchings", None), ("A view of the harbour, signed in pencil", None), ("Ölfarben", None), ("ink", "ink"), ("", None), (None, None), ("Öl auf Leinwand", "Öl auf Leinwand"),
    ],
)
def test_medium(one, given, expected):
    assert one(catalogue.medium("s"), "s string", given) == expected


@pytest.mark.parametrize(
    "text, title, born, expected",
    [
        ("Conceived in 1921 and cast in 1954", None, None, 1921), ("eseguito nel 1908", None, None, 1908), ("photographed circa 1933, dated verso 1940", None, None, 1933), ("inscribed and dated on the reverse 1717", None, None, 1717), ("dated twice, 3 June 1810", None, None, None),
        ("sold in 1950", "Still Life, 1911", None, 1911), ("peint vers 1889", None, 1886, None), ("peinte vers 1891", None, 1886, 1891), (None, "Catalogue of 1911", None, None), (None, None, None, None), ("made in 2044", None, None, None),
    ],
)
def test_year_made(one, text, title, born, expected):
    assert one(catalogue.year_made("t", "u", "b", 2026), "t string, u string, b int", text, title, born) == expected


@pytest.mark.parametrize("given, expected", [("Unsigned, but stamped", False), ("not signed", False), ("firmato in basso", True), ("bears a MONOGRAMMED seal", True), ("designed by her", None), ("tempera", None), (None, None)])
def test_is_signed(one, given, expected):
    assert one(catalogue.is_signed("s"), "s string", given) is expected


@pytest.mark.parametrize(
    "given, expected",
    [
        ("Ada Lindt (Swedish, born 1931)", (1931, None, "Swedish")), ("Ada Lindt (Malmö 1831–1909 Rome)", (1831, 1909, None)), ("Ada Lindt (1950)", None), ("Ada Lindt (active 1650-1690)", None), ("Ada Lindt (1831-1835)", None),
        ("Ada Lindt (née en 1940)", (1940, None, None)), ("Ada Lindt (b. 1700, d. 1777)", (1700, 1777, None)), ("Ada Lindt", None), ("(1831-1909) Ada", None), (None, None), ("Ada (Franco-Belgian, 1831/32-1909)", (1831, 1909, "Franco-Belgian")),
    ],
)
def test_life(one, given, expected):
    got = one(catalogue.life("s"), "s string", given)
    assert (tuple(got) if got else None) == expected


@pytest.mark.parametrize("given, expected", [(" Nigerian,", "Nigerian"), ("South African", "South African"), ("Polonaise", "Polonaise"), ("from Lagos", None), ("Munich", None), ("", None), (None, None)])
def test_nationality(one, given, expected):
    assert one(catalogue.nationality("s"), "s string", given) == expected


@pytest.mark.parametrize("given, expected", [("HTTPS://A.org/X/?q=1#f", "https://a.org/X"), ("http://a.org/", "http://a.org"), (None, None)])
def test_normalize_url(one, given, expected):
    assert one(urls.normalize_url("s"), "s string", given) == expected


def test_drop_tracking(one):
    assert one(urls.drop_tracking("s"), "s string", "https://a.org/x?utm_source=b&id=3&gclid=1#top") == "https://a.org/x?id=3"
    assert one(urls.drop_tracking("s"), "s string", "https://a.org/x?utm_source=b") == "https://a.org/x"


SITE = urls.Site("www.house.example", (urls.Rule("lot", r"^/lot/(\d+)/([a-z]+)$", (1, 2)), urls.Rule("artist", r"^/artist/([^/]+)$", lower=True)), aliases=("house.example",), locales="en|fr")


def test_classify_and_canonical_url(spark):
    df = spark.createDataFrame([("https://house.example/fr/lot/12/ab?x=1",), ("http://www.house.example/artist/JO",), ("https://other.example/x",), (None,)], "u string")
    got = df.select(urls.canonical_url("u", SITE).alias("c")).withColumn("k", urls.classify("c", SITE.rules)).collect()
    assert [r.c for r in got] == ["https://www.house.example/lot/12/ab", "https://www.house.example/artist/JO", "https://other.example/x", None]
    assert [tuple(r.k) if r.k else None for r in got] == [("lot", "12-ab"), ("artist", "jo"), None, None]
    scores = [r.s for r in df.select(urls.canonicality("u", SITE).alias("s")).collect()[:2]]
    assert scores == [2, 1]


def test_links_and_filename(one):
    assert one(urls.links_in("s"), "s string", "<a class=x href='/a'>1</a><a href=\"/b\">2</a><a href='/a'>") == ["/a", "/b"]
    assert one(urls.page_filename("s"), "s string", "u").endswith(".html")
