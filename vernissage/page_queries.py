"""Queries of payloads and pages: rows of the tables are put into synthetic pages, found and read again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vernissage.functions import countries, payload
from vernissage.plans import lots, mappings, marketplaces, pages
from vernissage.session import spread, table
from vernissage.survey_queries import _clean, _id, query

_HIDE = {"<": "&lt;", ">": "&gt;", "&": "&amp;", '"': "&quot;"}


def _script(json: Column, attributes: str) -> Column:
    # A closing tag inside a text would end the script.
    return F.concat(F.lit(f"<html><head><script {attributes}>"), F.replace(json, F.lit("</"), F.lit("<\\/")), F.lit("</script></head></html>"))


def _escaped(c: Column) -> Column:
    for a in "&<>\"":
        c = F.replace(c, F.lit(a), F.lit(_HIDE[a]))
    return c


def _rows(spark: SparkSession, d: str, html: Column, m: pages.Mapping, *cols: str) -> DataFrame:
    p = table(spark, d, "artworks").select(F.col("source_file").alias("filename"), "crawled_at", html.alias("html"))
    return pages.mapped(pages.parsed(p, m), m).select(F.col("filename").alias("source_file"), *cols)


_MONEY = "CAST(price AS DECIMAL(14,2)) AS price"
_CODE = f"CASE WHEN regexp_full_match(upper({_clean('currency')}), '[A-Z]{{3}}') THEN upper({_clean('currency')}) END AS currency"
_KEY = f"{_clean('platform_artwork_id')} AS platform_artwork_id"
_HAS_KEY = f"{_clean('platform_artwork_id')} IS NOT NULL"


@query(
    f"SELECT source_file, {_KEY}, {_clean('title')} AS title, {_clean('artist_name')} AS artist_name, {_id('platform_artist_id')} AS platform_artist_id, {_MONEY}, {_CODE}, CASE WHEN width_cm > 0 THEN width_cm END AS width_cm, "
    f"CAST(CASE WHEN year BETWEEN 1000 AND 2026 THEN year END AS INT) AS year, is_available_for_sale, CASE WHEN is_available_for_sale IS NULL THEN NULL ELSE NOT is_available_for_sale END AS is_sold, coalesce(len(list_distinct([{_clean('s')} FOR s IN styles IF {_clean('s')} IS NOT NULL])), 0) AS n_styles "
    f"FROM artworks WHERE {_HAS_KEY} AND has_detail IS NOT NULL"
)
def p_source_state(spark: SparkSession, d: str) -> DataFrame:
    """Artworks in the state embedded in their pages; pages of another kind are passed over."""
    status = F.when(F.col("is_available_for_sale"), "For sale").when(~F.col("is_available_for_sale"), "SOLD")
    work = F.struct(
        F.col("platform_artwork_id").alias("slug"), "title", F.struct(F.col("artist_name").alias("name"), F.col("platform_artist_id").alias("id")).alias("artist"), F.struct(F.col("price").cast("string").alias("amount"), "currency").alias("price"),
        F.struct(F.col("width_cm").alias("width")).alias("size"), F.col("year").cast("string").alias("year"), "styles", status.alias("availability"),
    )
    kind = F.when(F.col("has_detail").isNull(), "other").otherwise("artwork")
    page = _script(F.to_json(F.struct(F.struct(kind.alias("kind"), F.array(work).alias("artworks")).alias("page"))), 'id="__STATE__" type="application/json"')
    found = _rows(spark, d, page, mappings.STATE, "platform_artwork_id", "title", "artist_name", "platform_artist_id", "price", "currency", "width_cm", "year", "is_available_for_sale", "is_sold", "styles")
    return found.withColumn("n_styles", F.coalesce(F.size("styles"), F.lit(0)).cast("bigint")).withColumn("n_styles", F.greatest("n_styles", F.lit(0))).drop("styles")


@query(f"SELECT source_file, {_KEY}, {_clean('title')} AS title, {_clean('artist_name')} AS artist_name, {_MONEY}, {_CODE}, is_available_for_sale FROM artworks WHERE {_HAS_KEY}")
def p_source_linked_data(spark: SparkSession, d: str) -> DataFrame:
    """Artworks in linked data, beside an object of another type."""
    stock = F.when(F.col("is_available_for_sale"), "https://schema.org/InStock").when(~F.col("is_available_for_sale"), "https://schema.org/SoldOut")
    work = F.struct(
        F.lit("VisualArtwork").alias("@type"), F.col("platform_artwork_id").alias("sku"), F.col("title").alias("name"), F.struct(F.col("artist_name").alias("name")).alias("creator"),
        F.struct(F.col("price").cast("string").alias("price"), F.col("currency").alias("priceCurrency"), stock.alias("availability")).alias("offers"),
    )
    graph = F.concat(F.lit('{"@graph": [{"@type": "WebSite", "sku": "none"}, '), F.to_json(work), F.lit("]}"))
    return _rows(spark, d, _script(graph, 'type="application/ld+json"'), mappings.LINKED_DATA, "platform_artwork_id", "title", "artist_name", "price", "currency", "is_available_for_sale")


@query(f"SELECT source_file, {_KEY}, {_clean('title')} AS title, {_clean('artist_name')} AS artist_name, {_MONEY}, CASE WHEN price IS NOT NULL THEN 'EUR' END AS currency FROM artworks WHERE {_HAS_KEY}")
def p_source_cards(spark: SparkSession, d: str) -> DataFrame:
    """Artworks on the cards of a listing."""
    part = lambda tag, cls, c: F.coalesce(F.concat(F.lit(f'<{tag} class="{cls}">'), _escaped(c), F.lit(f"</{tag}>")), F.lit(""))
    price = F.coalesce(F.concat(F.lit('<p class="price">EUR '), F.format_number("price", 2), F.lit("</p>")), F.lit(""))
    card = F.concat(F.lit('<li class="big work" data-id="'), _escaped(F.coalesce("platform_artwork_id", F.lit(""))), F.lit('"><a href="/x"><img src="//cdn.example/i.jpg"></a>'), part("h3", "t", F.col("title")), part("span", "artist", F.col("artist_name")), price, F.lit("</li>"))
    page = F.concat(F.lit('<html><ul><li class="other" data-id="no"></li>'), card, F.lit("</ul></html>"))
    return _rows(spark, d, page, mappings.CARDS, "platform_artwork_id", "title", "artist_name", "price", "currency")


@query("SELECT event_type, count(*) AS n, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS total, count(*) AS n_cyclic FROM events GROUP BY 1")
def p_references(spark: SparkSession, d: str) -> DataFrame:
    """Tables whose members are indexes: shared values, a wrapper, and a reference back to the root."""
    k = F.get_json_object("props", "$.k")
    coded = F.concat(F.lit('[{"a": 1, "b": 1, "root": 0, "name": "inline"}, ["Reactive", 2], {"k": 3}, '), F.coalesce(k, F.lit("null")), F.lit("]"))
    v = table(spark, d, "events").select("event_type", F.try_parse_json(payload.resolved_json(coded)).alias("v"))
    both = (F.try_variant_get("v", "$.a.k", "bigint") + F.try_variant_get("v", "$.b.k", "bigint")) / 2
    cyclic = F.try_variant_get("v", "$.name", "string").eqNullSafe(F.lit("inline")) & F.try_variant_get("v", "$.root", "string").isNull()
    return v.groupBy("event_type").agg(F.count("*").alias("n"), F.sum(both.cast("bigint")).alias("total"), F.count_if(cyclic).alias("n_cyclic"))


@query("SELECT event_type, count(*) AS n, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS total FROM events WHERE json_extract(props, '$.k') IS NOT NULL GROUP BY 1")
def p_flight(spark: SparkSession, d: str) -> DataFrame:
    """Streamed chunks are put together; the first object that is the value of a key is read."""
    text = F.concat(F.lit('3:["$","div",{"lot" : null}]\n4:{"lot" :  '), F.col("props"), F.lit(', "lot": {"k": 0}}'))
    half = (F.length(text) / 2).cast("int")
    quoted = lambda t: F.to_json(F.array(t))
    chunk = lambda t: F.concat(F.lit("<script>self.__f.push([1,"), F.regexp_replace(quoted(t), r"^\[|\]$", ""), F.lit("])</script>"))
    page = F.concat(chunk(F.substring(text, F.lit(1), half)), chunk(F.substring(text, half + 1, F.length(text))))
    v = table(spark, d, "events").select("event_type", F.try_parse_json(payload.object_after("lot")(payload.flight_chunks(page))).alias("v"))
    k = F.try_variant_get("v", "$.k", "bigint")
    return v.filter(k.isNotNull()).groupBy("event_type").agg(F.count("*").alias("n"), F.sum(k).alias("total"))


@query("SELECT event_type, count(*) FILTER (WHERE value IS NOT NULL) AS n, CAST(sum(CAST(value AS DECIMAL(14,2))) AS DECIMAL(18,2)) AS total, count(DISTINCT user_id) AS n_users FROM events GROUP BY 1")
def p_meta_and_pairs(spark: SparkSession, d: str) -> DataFrame:
    """A price in a meta tag, and pairs of keys and values anywhere after an anchor."""
    value = F.col("value").cast("decimal(14,2)").cast("string")
    meta = F.coalesce(F.concat(F.lit("<meta content='"), value, F.lit("' property='og:price'>")), F.lit(""))
    page = F.concat(meta, F.lit('"user":"before" LOT'), F.repeat(F.lit(" "), 200), F.lit('"user":"'), F.col("user_id").cast("string"), F.lit('","user":"later"'))
    e = table(spark, d, "events").select("event_type", payload.meta_content(page, "og:price").cast("decimal(14,2)").alias("p"), F.try_element_at(payload.pairs_after(page, "LOT"), F.lit("user")).alias("u"))
    return e.groupBy("event_type").agg(F.count("p").alias("n"), F.sum("p").cast("decimal(18,2)").alias("total"), F.countDistinct("u").alias("n_users"))


@query("SELECT event_type, CASE WHEN user_id % 5 = 0 THEN 'status:429' WHEN user_id % 5 = 1 THEN 'header' WHEN user_id % 5 = 2 THEN 'keyword:captcha' END AS reason, count(*) AS n FROM events GROUP BY 1, 2")
def p_blocked(spark: SparkSession, d: str) -> DataFrame:
    """Why a response is a block page."""
    u = F.col("user_id") % 5
    status, header = F.when(u == 0, 429).otherwise(200), F.when(u == 1, "cf-mitigated: Challenge")
    body = F.when(u == 2, F.concat(F.coalesce("props", F.lit("")), F.lit(" solve the CAPTCHA"))).otherwise(F.col("props"))
    return table(spark, d, "events").groupBy("event_type", payload.blocked(status, header, body).alias("reason")).agg(F.count("*").alias("n"))


# ── lots of auction houses ──────────────────────────────────────────────────────

_LOT = (
    "CAST(p_partkey AS VARCHAR) AS platform_lot_id, p_name AS title, 'EUR' AS currency, CAST(CASE WHEN p_size > 10 THEN p_retailprice END AS DECIMAL(14,2)) AS low_estimate, "
    "CAST(CASE WHEN p_size > 25 THEN p_retailprice END AS DECIMAL(14,2)) AS price_realized, p_size > 25 AS is_result, p_brand AS selling_house_name, 'Bronze' AS medium, 30.0::DOUBLE AS height_cm, 1911::SMALLINT AS year, true AS is_signed"
)
_LOT_COLUMNS = ["platform_lot_id", "title", "currency", "low_estimate", "price_realized", "is_result", "selling_house_name", "medium", "height_cm", "year", "is_signed"]


def _lots(spark: SparkSession, d: str, source: str, page) -> DataFrame:
    """All parts as lots of one source; amounts of zero stand where there is none."""
    p = spread(table(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_size", "p_retailprice"), 2)
    money = F.col("p_retailprice").cast("decimal(14,2)")
    p = p.select(
        F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("name"), F.col("p_brand").alias("house"), F.when(F.col("p_size") > 10, money).otherwise(0).alias("low"), F.when(F.col("p_size") > 25, money).otherwise(0).alias("price"),
        (F.col("p_size") > 25).alias("sold"), F.concat("p_name", F.lit("\nBronze, signed. Cast in 1911. 30 x 20 cm")).alias("text"),
    )
    pages = p.select(F.col("id").alias("filename"), F.lit(None).cast("timestamp").alias("crawled_at"), page(p).alias("html"))
    return lots.lot_rows(pages, source, 2026).select(*_LOT_COLUMNS)


@query(f"SELECT {_LOT} FROM part")
def p_lots_invaluable(spark: SparkSession, d: str) -> DataFrame:
    lot = F.struct(F.col("id").alias("lotRef"), F.col("name").alias("lotTitle"), F.col("text").alias("lotDescription"), F.lit("eur").alias("currency"), F.col("low").alias("estimateLow"), F.col("price").alias("soldAmount"), F.col("sold").alias("isLotSold"))
    state = F.to_json(F.struct(F.struct(lot.alias("lotData"), F.struct(F.col("house").alias("name")).alias("auctionHouseData")).alias("pdp")))
    return _lots(spark, d, "invaluable", lambda p: F.concat(F.lit("<script>window.__PRELOADED_STATE__ = "), state, F.lit(";</script>")))


@query(f"SELECT {_LOT.replace('p_size > 25 AS is_result', 'true AS is_result')} FROM part")
def p_lots_liveauctioneers(spark: SparkSession, d: str) -> DataFrame:
    """The lot is named by its id on some pages, by the slug of the address on others."""
    item = F.struct(F.col("id").alias("slug"), F.col("name").alias("title"), F.col("text").alias("shortDescription"), F.lit("EUR").alias("currency"), F.col("low").alias("lowBidEstimate"), F.col("price").alias("salePrice"), F.col("sold").alias("isSold"), F.col("house").alias("sellerName"))
    other = F.struct(F.lit("other").alias("slug"), F.lit("Other").alias("title"))
    by_id = F.concat(F.lit('{"0": '), F.to_json(other), F.lit(', "7": '), F.to_json(item), F.lit("}"))
    named = F.when(F.col("id").cast("int") % 2 == 0, F.lit('"7"')).otherwise(F.lit("null"))
    data = F.concat(F.lit('{"data": {"itemSummary": {"byId": '), by_id, F.lit('}, "priceResults": {"slugItemId": '), named, F.lit("}}}"))
    link = F.concat(F.lit('<link href="https://h.example/price-result/'), F.col("id"), F.lit('/?x=1">'))
    return _lots(spark, d, "liveauctioneers", lambda p: F.concat(link, F.lit('<script id="__SERVER_DATA__">'), data, F.lit("</script>")))


@query(f"SELECT {_LOT} FROM part")
def p_lots_drouot(spark: SparkSession, d: str) -> DataFrame:
    """A JavaScript literal after one that is no lot."""
    sale = F.struct(F.struct(F.struct(F.col("house").alias("auctioneerName")).alias("link")).alias("auctioneerCard"))
    lot = F.struct(F.col("id"), F.col("text").alias("description"), F.lit("EUR").alias("currencyId"), F.col("low").alias("lowEstim"), F.col("price").alias("result"), sale.alias("saleInfo"))
    return _lots(spark, d, "drouot", lambda p: F.concat(F.lit("<script>a({data:{user:null}},{data:{lot:"), F.to_json(lot), F.lit(",metaData:{canonicalUrl:'x'},n:void 0}})</script>")))


@query(f"SELECT {_LOT} FROM part")
def p_lots_barnebys(spark: SparkSession, d: str) -> DataFrame:
    lot = F.struct(F.concat(F.lit("lot-"), "id").alias("id"), F.col("name").alias("title"), F.col("text").alias("description"), F.lit("EUR").alias("currency"), F.col("low").alias("estimatePrice"), F.lit(0).alias("soldPrice"), F.col("price").alias("hammer_price"), F.struct(F.col("house").alias("name")).alias("auctionHouse"))
    text = F.concat(F.lit('1:{"lot" : '), F.to_json(lot), F.lit("}"))
    chunk = F.regexp_replace(F.to_json(F.array(text)), r"^\[|\]$", "")
    return _lots(spark, d, "barnebys", lambda p: F.concat(F.lit("<script>self.__next_f.push([1,"), chunk, F.lit("])</script>")))


@query(f"SELECT {_LOT.replace('p_brand AS selling_house_name', 'NULL::VARCHAR AS selling_house_name')} FROM part")
def p_lots_artcurial(spark: SparkSession, d: str) -> DataFrame:
    """A table of references: root, data, lot, descriptions and their values."""
    quoted = lambda c: F.regexp_replace(F.to_json(F.array(c)), r"^\[|\]$", "")
    status = F.when(F.col("sold"), "sold").otherwise("open")
    table_text = F.concat(
        F.lit('[{"data": 1}, ["Reactive", 2], {"lot": 3}, {"uuid": 4, "descriptions": 5, "currency": 6, "low": 7, "adjudicationPrice": 8, "status": 9}, '), quoted("id"), F.lit(', {"en": 10}, "EUR", '), F.col("low").cast("string"), F.lit(", "), F.col("price").cast("string"), F.lit(", "), quoted(status),
        F.lit(', {"titleWithHtml": 11, "descriptionWithHtml": 12}, '), quoted("name"), F.lit(", "), quoted("text"), F.lit("]"),
    )
    return _lots(spark, d, "artcurial", lambda p: F.concat(F.lit('<script id="__NUXT_DATA__" type="application/json">'), table_text, F.lit("</script>")))


@query(f"SELECT {_LOT.replace('CAST(p_partkey AS VARCHAR)', "'2025/spring/' || p_partkey").replace('p_brand AS selling_house_name', 'NULL::VARCHAR AS selling_house_name')} FROM part")
def p_lots_sothebys(spark: SparkSession, d: str) -> DataFrame:
    """A store of objects that refer to each other; every other title holds the artist, too."""
    ref = lambda key: F.struct(F.lit(key).alias("__ref"))
    odd = F.col("id").cast("int") % 2 == 1
    title = F.when(odd, F.concat(F.lit("ANN BELL | "), "name")).otherwise(F.col("name"))
    lot = F.struct(F.col("id").alias("slug"), title.alias("title"), F.when(~odd, "Ann Bell").alias("creatorsDisplayTitle"), F.col("text").alias("description"), ref("Auction:1").alias("auction"), ref("Bid:1").alias("bidState"), F.struct(F.struct(F.col("low").alias("amount")).alias("lowEstimate")).alias("estimateV2"))
    auction = F.lit('{"slug": {"year": "2025", "name": "spring"}, "currencyV2": "EUR", "state": "Open"}')
    bid = F.struct(F.struct(F.col("sold").alias("isSold"), F.struct(F.struct(F.col("price").alias("amount")).alias("finalPriceV2")).alias("premiums")).alias("sold"))
    store = F.concat(F.lit('{"props": {"pageProps": {"apolloCache": {"Auction:1": '), auction, F.lit(', "LotV2:9": '), F.to_json(lot), F.lit(', "Bid:1": '), F.to_json(bid), F.lit("}}}}"))
    return _lots(spark, d, "sothebys", lambda p: F.concat(F.lit('<script id="__NEXT_DATA__" type="application/json">'), store, F.lit("</script>")))


@query(f"SELECT {_LOT.replace('p_brand AS selling_house_name', 'NULL::VARCHAR AS selling_house_name')} FROM part")
def p_lots_christies(spark: SparkSession, d: str) -> DataFrame:
    lot = F.struct(F.col("id").cast("int").alias("object_id"), F.col("name").alias("title_secondary_txt"), F.col("text").alias("description_txt"), F.lit("EUR 1,000").alias("estimate_txt"), F.col("low").alias("estimate_low"), F.col("price").alias("price_realised"), F.lit(False).alias("is_unsold"))
    data = F.to_json(F.struct(F.struct(F.array(lot).alias("lots")).alias("data")))
    return _lots(spark, d, "christies", lambda p: F.concat(F.lit("<script>window.chrComponents.lotHeader_12 =\n "), data, F.lit(";</script>")))


@query(f"SELECT {_LOT} FROM part")
def p_lots_saleroom(spark: SparkSession, d: str) -> DataFrame:
    """Pairs after an anchor, meta tags, and a currency and a price in the visible text."""
    pair = lambda k, c: F.concat(F.lit(f'"{k}":'), F.regexp_replace(F.to_json(F.array(c.cast("string"))), r"^\[|\]$", ""), F.lit(","))
    model = F.concat(F.lit('dataLayer.push({"LotDetailsViewModel":{'), pair("lotId", F.col("id")), pair("lotName", F.col("name")), pair("minEstimate", F.col("low")), pair("auctioneer", F.col("house")), F.lit('"n":1}})'))
    meta = F.concat(F.lit('<meta property="og:description" content="'), _escaped(F.col("text")), F.lit('">'))
    price = F.when(F.col("sold"), F.concat(F.lit("<b>Sold for "), F.format_number("price", 2), F.lit(" EUR</b>"))).otherwise(F.lit(""))
    return _lots(spark, d, "saleroom", lambda p: F.concat(meta, F.lit("<script>"), model, F.lit("</script><td>100 EUR - 150 EUR</td>"), price))


# ── marketplaces in linked data ─────────────────────────────────────────────────


def _ld(*objects: Column) -> Column:
    return F.concat(F.lit("<html>"), *[F.concat(F.lit('<script type="application/ld+json">'), F.replace(o, F.lit("</"), F.lit("<\\/")), F.lit("</script>")) for o in objects], F.lit("</html>"))


def _marketplace(spark: SparkSession, pages_of: DataFrame, name: str) -> DataFrame:
    m = marketplaces.mappings(2026, countries.country_names(spark))[name]
    return pages.mapped(pages.parsed(pages_of.withColumn("crawled_at", F.lit(None).cast("timestamp")), m), m)


@query(
    "SELECT 'title-' || p_partkey AS platform_artwork_id, p_name AS title, 'ann-' || p_size AS platform_artist_id, p_brand AS artist_name, CAST(p_retailprice AS DECIMAL(14,2)) AS price, 'USD' AS currency, CASE WHEN p_size > 25 THEN p_size > 40 END AS is_available_for_sale, p_type AS category FROM part"
)
def p_fineartamerica_artworks(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    k, size = F.col("p_partkey").cast("string"), F.col("p_size").cast("string")
    stock = F.when(F.col("p_size") > 25, F.array(F.struct(F.lit("https://schema.org/OutOfStock").alias("availability")), F.struct(F.when(F.col("p_size") > 40, "https://schema.org/InStock").otherwise("x").alias("availability"))))
    art = F.struct(
        F.array(F.lit("VisualArtwork"), F.lit("Painting")).alias("@type"), F.concat(F.lit("https://fineartamerica.com/featured/Title-"), k, F.lit(".html?x=1")).alias("url"), F.col("p_name").alias("name"), F.col("p_type").alias("artMedium"),
        F.struct(F.concat(F.lit("https://fineartamerica.com/profiles/Ann-"), size).alias("url"), F.col("p_brand").alias("name")).alias("creator"), F.struct(F.lit("USD").alias("priceCurrency"), stock.alias("offers")).alias("offers"),
    )
    meta = F.concat(F.lit('<meta property="og:price:amount" content="'), F.format_number("p_retailprice", 2), F.lit('">'))
    rows = _marketplace(spark, p.select(k.alias("filename"), F.concat(meta, _ld(F.lit('{"@type": "Person"}'), F.to_json(art))).alias("html")), "fineartamerica/artworks")
    return rows.select("platform_artwork_id", "title", "platform_artist_id", "artist_name", "price", "currency", "is_available_for_sale", "category")


@query(
    "SELECT 'c-' || c_custkey AS platform_artist_id, c_name AS full_name, 'https://fineartamerica.com/profiles/C-' || c_custkey AS profile_url, CASE WHEN c_custkey % 2 = 0 THEN 'https://i.example/' || c_custkey || '.jpg' END AS avatar, "
    "CASE c_custkey % 3 WHEN 0 THEN 'Poland' WHEN 1 THEN 'Poland' ELSE 'Atlantis' END AS country FROM customer"
)
def p_fineartamerica_artists(spark: SparkSession, d: str) -> DataFrame:
    """Profiles; pages of artworks name artists, too, and are none."""
    k = F.col("c_custkey").cast("string")
    land = F.when(F.col("c_custkey") % 3 == 0, "PL").when(F.col("c_custkey") % 3 == 1, "POL").otherwise("Atlantis")
    image = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("https://i.example/"), k, F.lit(".jpg"))).otherwise("https://i.example/headshotPlaceholder.png")
    person = F.struct(F.lit("Person").alias("@type"), F.concat(F.lit("https://fineartamerica.com/profiles/C-"), k).alias("url"), F.col("c_name").alias("name"), image.alias("image"), F.struct(F.struct(land.alias("addressCountry")).alias("address")).alias("homeLocation"))
    c = table(spark, d, "customer")
    own = c.select(k.alias("filename"), _ld(F.to_json(person)).alias("html"))
    other = c.select(k.alias("filename"), _ld(F.to_json(person), F.lit('{"@type": "Painting", "url": "/featured/x.html"}')).alias("html"))
    return _marketplace(spark, own.unionByName(other), "fineartamerica/artists").select("platform_artist_id", "full_name", "profile_url", "avatar", "country")


@query(
    "SELECT 'ABCDEF0000' || o_orderkey AS platform_artwork_id, 'Still life' AS title, CASE WHEN o_orderstatus = 'F' THEN 'AAAAAAAAAA' || o_custkey ELSE 'BBBBBBBBBB' || o_custkey END AS platform_artist_id, CASE WHEN o_orderstatus <> 'P' THEN true END AS is_available_for_sale, CAST(date_part('year', o_orderdate) AS INT) AS year FROM orders"
)
def p_mutualart_artworks(spark: SparkSession, d: str) -> DataFrame:
    """Two lists of an artist's page, one of articles beside them; a card without an artist is the page's."""
    k, c, year = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), F.year("o_orderdate").cast("string")
    base = F.concat(F.lit("https://www.mutualart.com/Artist/Ann/bbbbbbbbbb"), c)
    own = F.when(F.col("o_orderstatus") == "F", F.struct(F.concat(F.lit("https://www.mutualart.com/Artist/Bea/aaaaaaaaaa"), c).alias("@id")))
    item = F.struct(F.lit("VisualArtwork").alias("@type"), F.concat(F.lit("https://www.mutualart.com/Artwork/Title/abcdef0000"), k).alias("url"), F.concat(F.lit("Still life, "), year).alias("name"), year.alias("dateCreated"), own.alias("artist"))
    listed = F.when(F.col("o_orderstatus") == "P", "#auction-results").otherwise("#artworks")
    lst = lambda at, i: F.to_json(F.struct(F.lit("ItemList").alias("@type"), F.concat(base, at).alias("@id"), F.array(F.struct(i.alias("item"))).alias("itemListElement")))
    person = F.to_json(F.struct(F.lit("Person").alias("@type"), F.concat(base, F.lit("#artist")).alias("@id")))
    p = table(spark, d, "orders").select(k.alias("filename"), _ld(person, lst(F.lit("#articles"), item), lst(listed, item)).alias("html"))
    return _marketplace(spark, p, "mutualart/artworks").select("platform_artwork_id", "title", "platform_artist_id", "is_available_for_sale", "year")


@query("SELECT 'ABCDEF0000' || c_custkey AS platform_artist_id, c_name AS full_name, CAST(1900 + c_custkey % 90 AS INT) AS birth_year, 'https://www.mutualart.com/Artist/Ann/abcdef0000' || c_custkey AS profile_url FROM customer")
def p_mutualart_artists(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey").cast("string")
    person = F.struct(F.lit("Person").alias("@type"), F.concat(F.lit("https://www.mutualart.com/Artist/Ann/abcdef0000"), k, F.lit("#artist")).alias("@id"), F.col("c_name").alias("name"), F.concat((1900 + F.col("c_custkey") % 90).cast("string"), F.lit("-05-01")).alias("birthDate"))
    p = table(spark, d, "customer").select(k.alias("filename"), _ld(F.lit('{"@type": "Person", "@id": "https://x#author"}'), F.to_json(person)).alias("html"))
    return _marketplace(spark, p, "mutualart/artists").select("platform_artist_id", "full_name", "birth_year", "profile_url")


def _next_data(data: Column) -> Column:
    return _script(F.to_json(F.struct(F.struct(F.struct(F.struct(F.struct(data.alias("data")).alias("page")).alias("initialState")).alias("pageProps")).alias("props"))), 'id="__NEXT_DATA__"')


_SAATCHI = "CAST(p_partkey AS VARCHAR) AS platform_artwork_id, p_name AS title, CAST(p_size AS VARCHAR) AS platform_artist_id, 'Ann Bell' AS artist_name, CAST(p_retailprice AS DECIMAL(14,2)) AS price, 'USD' AS currency, CASE WHEN p_size > 10 THEN p_size > 25 END AS is_sold, 'https://www.saatchiart.com/art/x/' || p_partkey || '/view' AS artwork_url"
_SAATCHI_COLUMNS = ["platform_artwork_id", "title", "platform_artist_id", "artist_name", "price", "currency", "is_sold", "artwork_url", "has_detail", "styles"]


@query(f"SELECT {_SAATCHI}, false AS has_detail, ['Pop', p_type] AS styles FROM part UNION ALL SELECT {_SAATCHI}, true AS has_detail, ['Pop', p_type] AS styles FROM part")
def p_saatchi_artworks(spark: SparkSession, d: str) -> DataFrame:
    """Cards on profiles and pages of single works."""
    p = table(spark, d, "part")
    k, cents = F.col("p_partkey"), (F.col("p_retailprice").cast("decimal(14,2)") * 100).cast("bigint")
    status, path = F.when(F.col("p_size") > 25, "Sold").when(F.col("p_size") > 10, "avail"), F.concat(F.lit("/art/x/"), k.cast("string"), F.lit("/view"))
    styles = F.array(F.lit("Pop"), F.col("p_type"), F.lit("Pop"))
    card = F.struct(k.alias("artworkID"), F.col("p_name").alias("title"), path.alias("pdpUrl"), cents.alias("listPrice"), status.alias("originalStatus"), styles.alias("styles"))
    profile = F.struct(F.struct(F.col("p_size").alias("userId"), F.lit(" Ann").alias("firstName"), F.lit("Bell").alias("lastName"), F.array(card).alias("artworks")).alias("accountData"))
    product = F.struct(F.struct(cents.alias("listPrice")).alias("original"))
    single = F.struct(F.struct(k.alias("artworkId"), F.col("p_size").alias("userId"), F.col("p_name").alias("title"), styles.alias("styles"), F.array(product).alias("products")).alias("artwork"), F.struct(path.alias("artworkOriginalUrl"), status.alias("originalArtworkStatus")).alias("pdpArtwork"), F.struct(F.lit("Ann").alias("firstName"), F.lit("Bell").alias("lastName")).alias("artist"))
    both = [_marketplace(spark, p.select(k.cast("string").alias("filename"), _next_data(data).alias("html")), f"saatchi/{name}").select(*_SAATCHI_COLUMNS) for data, name in ((profile, "cards"), (single, "artworks"))]
    return both[0].unionByName(both[1])


@query("SELECT CAST(c_custkey AS VARCHAR) AS platform_artist_id, c_name AS full_name, 'https://www.saatchiart.com/u' || c_custkey AS profile_url, 'https://www.instagram.com/u' || c_custkey AS instagram, 'Poland' AS country, 'about' || chr(10) || 'her' AS biography FROM customer")
def p_saatchi_artists(spark: SparkSession, d: str) -> DataFrame:
    user = F.concat(F.lit("u"), F.col("c_custkey").cast("string"))
    account = F.struct(F.col("c_custkey").alias("userId"), user.alias("userName"), F.lit("").alias("firstName"), F.col("c_name").alias("displayName"), F.lit("PL").alias("countryCode"), F.struct(F.lit("<p>about</p>her").alias("about")).alias("aboutArtist"), F.struct(F.concat(F.lit("@"), user).alias("instagram")).alias("socialLinks"))
    p = table(spark, d, "customer").select(user.alias("filename"), _next_data(F.struct(account.alias("accountData"))).alias("html"))
    return _marketplace(spark, p, "saatchi/artists").select("platform_artist_id", "full_name", "profile_url", "instagram", "country", "biography")


@query("SELECT 'work-' || p_partkey AS platform_artwork_id, p_name AS title, 'a' || p_size AS platform_artist_id, CAST(p_retailprice AS DECIMAL(14,2)) AS price, 'GBP' AS currency, p_size > 25 AS is_available_for_sale, p_size <= 25 AS is_sold, 'United States' AS ships_from_country FROM part")
def p_artsy_artworks(spark: SparkSession, d: str) -> DataFrame:
    """Twice encoded answers, the artwork's among them."""
    p = table(spark, d, "part")
    work = F.struct(
        F.concat(F.lit("work-"), F.col("p_partkey").cast("string")).alias("slug"), F.col("p_name").alias("title"), F.array(F.struct(F.concat(F.lit("a"), F.col("p_size").cast("string")).alias("internalID"), F.lit('Ann "B" Bell').alias("name"))).alias("artists"),
        F.struct(F.col("p_retailprice").cast("decimal(14,2)").alias("major"), F.lit("GBP").alias("currencyCode")).alias("listPrice"), F.when(F.col("p_size") > 25, "For Sale").otherwise("sold").alias("availability"), (F.col("p_size") <= 25).alias("isSold"), F.lit("New York, NY, US").alias("shippingOrigin"),
    )
    answer = F.to_json(F.struct(F.struct(F.struct(work.alias("artworkResult")).alias("data")).alias("json")))
    key = lambda name: F.regexp_replace(F.to_json(F.array(F.lit(f'{{"queryID": "{name}"}}'))), r"^\[|\]$", "")
    pairs = F.concat(F.lit("[["), key("buildAppRoutesQuery"), F.lit(', {"json": {}}], ['), key("artworkRoutes_ArtworkQuery"), F.lit(", "), answer, F.lit("]]"))
    page = F.concat(F.lit("<script>var __RELAY_HYDRATION_DATA__ = "), F.regexp_replace(F.to_json(F.array(pairs)), r"^\[|\]$", ""), F.lit(";</script>"))
    rows = _marketplace(spark, p.select(F.lit("f").alias("filename"), page.alias("html")), "artsy/artworks")
    return rows.select("platform_artwork_id", "title", "platform_artist_id", "price", "currency", "is_available_for_sale", "is_sold", "ships_from_country")
