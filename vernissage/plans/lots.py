"""Lots of auction houses: eight sources as data, one shared path to typed rows.

A source names the payload of its pages and where each field stands in it. What
no source says (size, medium, year, signature, life dates) is read from the
catalogue text. Amounts of zero are no amounts, and a price counts only for what
was sold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vernissage.functions import payload
from vernissage.functions.scalars import currency_code, let, plain_text, to_date, to_money, to_url
from vernissage.functions.text import clean_id, clean_line, clean_text, stated
from vernissage.plans.datasets import LOTS, fill_from_catalogue
from vernissage.plans.pages import Mapping, mapped, parsed


def _money(c: Column) -> Column:
    return let(to_money(c), lambda m: F.when(m > 0, m))


def _line(c: Column) -> Column:
    return let(clean_line(plain_text(c)), stated)


def _at(path: str, kind: str = "string"):
    return lambda item: F.try_variant_get(item, path, kind)


def _if(flag, value):
    return lambda item: F.when(F.coalesce(flag(item), F.lit(False)), _money(value(item)))


_CONVERT = {
    "platform_lot_id": clean_id, "lot_number": clean_text, "title": _line, "description": plain_text, "artist_name": _line, "category": _line, "image_url": to_url, "currency": currency_code, "low_estimate": _money, "high_estimate": _money,
    "sale_id": clean_id, "sale_title": _line, "sale_date": to_date, "selling_house_name": _line, "sale_location": _line, "medium": _line,
}


def _mapping(payload_of, columns: dict, derived: dict, rows: str = "$", **convert) -> Mapping:
    # The type follows from the conversion: a text, or a number that a text stands for.
    return Mapping(payload_of, rows, "platform_lot_id", {c: (p, "string") for c, p in columns.items()}, {c: f for c, f in (_CONVERT | convert).items() if c in columns}, derived={"has_detail": lambda _: F.lit(True), **derived})


def _chosen_item(html: Column) -> Column:
    """The lot a page is about: by the id it names, else by the slug of its canonical address."""
    state = F.coalesce(payload.script_json(html, "__SERVER_DATA__"), F.try_parse_json(payload.assigned_udf("window.__data")(html)))
    items = F.try_variant_get(state, "$.data.itemSummary.byId", "map<string,variant>")
    named = F.try_element_at(items, F.try_variant_get(state, "$.data.priceResults.slugItemId", "string"))
    slug = F.regexp_extract(html, r"/price-result/([^\"'/?#]+)", 1)
    return F.coalesce(named, F.get(F.filter(F.map_values(items), lambda v: F.try_variant_get(v, "$.slug", "string") == slug), 0))


_sold_flag, _live_sold = _at("$.lotData.isLotSold", "boolean"), _at("$.isSold", "boolean")
_BARNEBYS_PRICES = ("soldPrice", "hammer_price", "price", "hammerPrice", "realizedPrice", "realisedPrice", "finalPrice")


def _any_price(item: Column) -> Column:
    return F.coalesce(*[_money(F.try_variant_get(item, f"$.{k}", "string")) for k in _BARNEBYS_PRICES])


def _sale_and_number(item: Column) -> Column:
    """``sale:number`` or ``sale:number-sub`` of a lot; its own id where the sale is not named."""
    at = lambda k: F.try_variant_get(item, f"$.data.lot.{k}", "string")
    sub = F.coalesce(F.concat(F.lit("-"), F.lower(F.nullif(F.trim(at("subIndex")), F.lit("")))), F.lit(""))
    return F.coalesce(F.concat(at("saleRef"), F.lit(":"), at("index"), sub), at("uuid"))


def _with_references(html: Column) -> Column:
    """The lot of a store of linked objects, with the auction and the bids it refers to."""
    store = F.try_variant_get(payload.script_json(html, "__NEXT_DATA__"), "$.props.pageProps.apolloCache", "map<string,variant>")

    def with_lot(objects: Column) -> Column:
        def whole(lot: Column) -> Column:
            def referred(name: str) -> Column:
                target = F.try_element_at(objects, F.try_variant_get(lot, f"$.{name}.__ref", "string"))
                return F.coalesce(target, F.try_variant_get(lot, f"$.{name}", "variant")).alias(name)

            return F.when(lot.isNotNull(), F.to_variant_object(F.struct(lot.alias("lot"), referred("auction"), referred("bidState"))))

        return let(F.get(F.map_values(F.map_filter(objects, lambda k, _: k.startswith("LotV2:"))), 0), whole)

    return let(store, with_lot)


def _named_before_bar(i: int, own: str):
    """The lot's own field, else a part of a title written ``ARTIST | TITLE``; the whole title has no artist."""

    def of(item: Column) -> Column:
        title, artist = F.try_variant_get(item, "$.lot.title", "string"), F.nullif(F.trim(F.try_variant_get(item, "$.lot.creatorsDisplayTitle", "string")), F.lit(""))
        split = F.when(artist.isNull() & title.contains(" | "), F.split(title, r" \| ", 2))
        return _line(F.coalesce(F.get(split, i), artist if own == "artist" else title))

    return of


def _view_model(html: Column) -> Column:
    """Pairs of the object a page pushes, its meta tags, and the currency and price it shows."""
    pairs = payload.pairs_after(html, "LotDetailsViewModel")
    shown = F.struct(
        pairs.alias("pairs"), *[payload.meta_content(html, f"og:{n}").alias(n) for n in ("url", "description", "image")],
        F.nullif(F.regexp_extract(html, r"[\d,.]+\s+([A-Z]{3})\s*-\s*[\d,.]+\s+[A-Z]{3}", 1), F.lit("")).alias("currency"),
        *[F.nullif(F.regexp_extract(html, r"(?i)sold for\s+([\d,.]+)\s+([A-Z]{3})", i), F.lit("")).alias(n) for i, n in ((1, "sold"), (2, "sold_currency"))],
    )
    return F.when(pairs.isNotNull(), F.to_variant_object(shown))


_CHRISTIES_UNSOLD = lambda v: F.coalesce(F.try_variant_get(v, "$.lots[0].is_unsold", "boolean"), F.try_variant_get(v, "$.lots[0].price_on_request", "boolean"), F.lit(False))

#: Where eight sources keep a lot's fields.
SOURCES = {
    "invaluable": _mapping(
        lambda html: F.try_variant_get(F.try_parse_json(payload.assigned_udf("window.__PRELOADED_STATE__")(html)), "$.pdp", "variant"),
        {"platform_lot_id": "$.lotData.lotRef", "lot_number": "$.lotData.lotNumber", "title": "$.lotData.lotTitle", "description": "$.lotData.lotDescription", "artist_name": "$.artistInfo.fullName", "category": ("$.catalogData.supercategory", "$.catalogData.category"), "image_url": ("$.lotData.photos[0].large", "$.lotData.photos[0].medium"), "currency": "$.lotData.currency", "low_estimate": "$.lotData.estimateLow", "high_estimate": "$.lotData.estimateHigh", "sale_id": "$.catalogData.ref", "sale_title": "$.catalogData.title", "sale_date": "$.catalogData.eventDate", "selling_house_name": "$.auctionHouseData.name"},
        {"price_realized": _if(_sold_flag, _at("$.lotData.soldAmount")), "is_result": lambda v: F.greatest(*[F.coalesce(F.try_variant_get(v, f"$.lotData.{k}", "boolean"), F.lit(False)) for k in ("isLotSold", "isLotPassed", "isLotClosed")])},
        platform_lot_id=lambda c: F.lower(clean_id(c)),
    ),
    "liveauctioneers": _mapping(
        _chosen_item,
        {"platform_lot_id": "$.slug", "lot_number": "$.lotNumber", "title": "$.title", "description": "$.shortDescription", "currency": "$.currency", "low_estimate": "$.lowBidEstimate", "high_estimate": "$.highBidEstimate", "sale_id": "$.catalogId", "sale_title": "$.catalogTitle", "sale_date": "$.saleStartTs", "selling_house_name": "$.sellerName", "sale_location": "$.sellerCity"},
        {"price_realized": _if(_live_sold, _at("$.salePrice")), "is_result": lambda _: F.lit(True)},
        platform_lot_id=lambda c: F.lower(clean_id(c)),
        sale_location=lambda c: let(_line(c), lambda t: F.when(t == F.upper(t), F.initcap(t)).otherwise(t)),
    ),
    "drouot": _mapping(
        lambda html: F.try_parse_json(payload.literal_with("data:", "lot")(html)),
        {"platform_lot_id": "$.lot.id", "lot_number": "$.lot.num", "description": "$.lot.description", "category": "$.structuredData.category", "image_url": "$.structuredData.image", "currency": "$.lot.currencyId", "low_estimate": "$.lot.lowEstim", "high_estimate": "$.lot.highEstim", "sale_id": ("$.lot.saleId", "$.lot.saleInfo.saleId"), "sale_title": "$.lot.saleInfo.title", "sale_date": ("$.lot.saleInfo.date", "$.lot.date"), "selling_house_name": "$.lot.saleInfo.auctioneerCard.link.auctioneerName", "sale_location": "$.lot.saleInfo.address.city"},
        {"title": lambda v: F.substring_index(plain_text(F.try_variant_get(v, "$.lot.description", "string")), "\n", 1), "price_realized": lambda v: _money(F.try_variant_get(v, "$.lot.result", "string")), "is_result": lambda v: F.coalesce(F.try_variant_get(v, "$.lot.result", "double") > 0, F.lit(False))},
    ),
    "barnebys": _mapping(
        lambda html: F.try_parse_json(payload.object_after("lot")(payload.flight_chunks(html))),
        {"platform_lot_id": "$.id", "title": "$.title", "description": "$.description", "category": "$.categoryName", "image_url": "$.imageUrl", "currency": "$.currency", "low_estimate": "$.estimatePrice", "sale_date": "$.auctionEndDate", "selling_house_name": "$.auctionHouse.name", "sale_location": "$.country"},
        {"price_realized": _any_price, "is_result": lambda v: _any_price(v).isNotNull() | F.coalesce(F.try_variant_get(v, "$.canonicalUrl", "string").rlike("/reali[sz]ed-prices/"), F.lit(False))},
        platform_lot_id=lambda c: F.nullif(F.regexp_extract(F.trim(c), r"(\d+)$", 1), F.lit("")),
        description=lambda c: F.when(~c.rlike(r"^\s*\$[0-9a-fA-F]+\s*$"), plain_text(c)),
    ),
    "artcurial": _mapping(
        lambda html: F.try_parse_json(payload.resolved_json(F.regexp_extract(html, r'(?is)<script\b[^>]*\bid="__NUXT_DATA__"[^>]*>(.*?)</script\s*>', 1))),
        {"lot_number": "$.data.lot.index", "title": ("$.data.lot.descriptions.en.titleWithHtml", "$.data.lot.descriptions.fr.titleWithHtml"), "description": ("$.data.lot.descriptions.en.descriptionWithHtml", "$.data.lot.descriptions.fr.descriptionWithHtml"), "artist_name": ("$.data.lot.artistName", "$.data.lot.artist.party.fullName"), "category": "$.data.lot.category", "currency": "$.data.lot.currency", "low_estimate": "$.data.lot.low", "high_estimate": "$.data.lot.high", "sale_id": ("$.data.lot.saleRef", "$.data['sale-lot-page'].ref"), "sale_title": "$.data['sale-lot-page'].name", "sale_date": ("$.data['sale-lot-page'].effectiveDate", "$.data.lot.adjudicationDate"), "medium": "$.data.lot.descriptions.en.technique"},
        {"platform_lot_id": _sale_and_number, "price_realized": _if(lambda v: F.upper(F.try_variant_get(v, "$.data.lot.status", "string")) == "SOLD", lambda v: F.coalesce(*[F.try_variant_get(v, f"$.data.lot.{k}", "string") for k in ("adjudicationPrice", "finalPrice")])), "is_result": lambda v: F.coalesce(F.upper(F.try_variant_get(v, "$.data.lot.status", "string")) == "SOLD", F.lit(False))},
    ),
    "sothebys": _mapping(
        _with_references,
        {"lot_number": "$.lot.lotNumber.lotDisplayNumber", "description": "$.lot.description", "currency": ("$.auction.currencyV2", "$.auction.currency"), "low_estimate": ("$.lot.estimateV2.lowEstimate.amount", "$.lot.estimateV2.lowEstimate"), "high_estimate": ("$.lot.estimateV2.highEstimate.amount", "$.lot.estimateV2.highEstimate"), "sale_id": ("$.lot.sapAuctionSaleNumber", "$.auction.sapSaleNumber"), "sale_title": "$.auction.title", "sale_date": ("$.auction.dates.closed", "$.auction.dates.acceptsBids"), "sale_location": ("$.auction.locationV2.name", "$.auction.location")},
        {
            "platform_lot_id": lambda v: F.coalesce(F.concat(*[x for i, p in enumerate(("$.auction.slug.year", "$.auction.slug.name", "$.lot.slug")) for x in (([F.lit("/")] if i else []) + [F.try_variant_get(v, p, "string")])]), F.try_variant_get(v, "$.lot.lotId", "string")),
            "title": _named_before_bar(1, "title"), "artist_name": _named_before_bar(0, "artist"),
            "price_realized": _if(_at("$.bidState.sold.isSold", "boolean"), lambda v: F.coalesce(*[F.try_variant_get(v, f"$.bidState.sold.premiums.finalPriceV2{x}", "string") for x in (".amount", ".value", "")])),
            "is_result": lambda v: F.coalesce(F.try_variant_get(v, "$.bidState.sold.isSold", "boolean"), F.lit(False)) | F.coalesce(F.try_variant_get(v, "$.auction.state", "string") == "Closed", F.lit(False)),
        },
    ),
    "christies": _mapping(
        lambda html: let(F.try_parse_json(payload.assigned_udf("window.chrComponents.lotHeader_", numbered=True)(html)), lambda v: F.coalesce(F.try_variant_get(v, "$.data", "variant"), v)),
        {"platform_lot_id": "$.lots[0].object_id", "lot_number": "$.lots[0].lot_id_txt", "title": "$.lots[0].title_secondary_txt", "artist_name": "$.lots[0].title_primary_txt", "description": "$.lots[0].description_txt", "image_url": "$.lots[0].lot_assets[0].image_url", "currency": ("$.lots[0].price_realised_txt", "$.lots[0].estimate_txt"), "low_estimate": "$.lots[0].estimate_low", "high_estimate": "$.lots[0].estimate_high", "sale_id": ("$.sale.sale_number", "$.sale.sale_id"), "sale_title": "$.sale.title_txt", "sale_date": ("$.sale.start_date", "$.sale.end_date"), "sale_location": "$.sale.location_txt"},
        {"price_realized": _if(lambda v: ~_CHRISTIES_UNSOLD(v), _at("$.lots[0].price_realised")), "is_result": lambda v: F.coalesce(F.try_variant_get(v, "$.sale.is_auction_over", "boolean"), F.lit(False)) | F.coalesce(F.try_variant_get(v, "$.lots[0].is_unsold", "boolean"), F.lit(False)) | F.coalesce(F.try_variant_get(v, "$.lots[0].price_realised", "double") > 0, F.lit(False))},
        currency=lambda c: currency_code(F.regexp_extract(c, r"\b([A-Z]{3})\b", 1)),
    ),
    "saleroom": _mapping(
        _view_model,
        {"platform_lot_id": "$.pairs.lotId", "title": "$.pairs.lotName", "description": "$.description", "category": "$.pairs.lotPrimaryCategory", "image_url": "$.image", "currency": ("$.sold_currency", "$.currency"), "low_estimate": "$.pairs.minEstimate", "high_estimate": "$.pairs.maxEstimate", "sale_id": "$.pairs.catalogueId", "sale_title": "$.pairs.catalogueName", "sale_date": "$.pairs.lotStartDate", "selling_house_name": "$.pairs.auctioneer"},
        {"price_realized": lambda v: F.coalesce(*[_money(F.try_variant_get(v, p, "string")) for p in ("$.pairs.hammerPrice", "$.pairs.priceRealised", "$.pairs.realisedPrice", "$.pairs.soldPrice", "$.sold")]), "is_result": lambda v: F.try_variant_get(v, "$.sold", "string").isNotNull() | F.coalesce(F.lower(F.try_variant_get(v, "$.pairs.lotStatus", "string")).isin("sold", "passed", "unsold"), F.lit(False))},
        platform_lot_id=lambda c: F.lower(clean_id(c)),
    ),
}


def lot_rows(pages: DataFrame, source: str, as_of: int) -> DataFrame:
    """Typed lots of a source's pages (``filename, crawled_at, html``), with facts from the catalogue text."""
    m = SOURCES[source]
    rows = mapped(parsed(pages, m), m).withColumnRenamed("filename", "source_file").withColumn("platform_name", F.lit(source))
    return fill_from_catalogue(LOTS.conform(rows, keep=("platform_name",)), as_of)
