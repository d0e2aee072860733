"""Three sources as data: embedded state, linked data, and cards of a listing.

They stand for the kinds of pages there are; a further source is a further
``Mapping``, not a further function. A column is filled only where the page says
so, and what the page says in its own words (availability) becomes flags.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vernissage.functions import payload
from vernissage.functions.scalars import currency_code, let, text_list, to_money, to_url, year_of
from vernissage.functions.text import clean_id, clean_text
from vernissage.plans.pages import Mapping

#: The year beyond which no work was made.
AS_OF = 2026


def availability(c: Column) -> Column:
    """Last part of an availability (a word or an address) in plain letters: ``instock``, ``soldout``…"""
    return F.lower(F.regexp_replace(F.element_at(F.split(c, "/"), -1), r"[^A-Za-z]", ""))


def for_sale(c: Column) -> Column:
    return let(availability(c), lambda a: F.when(a.isin("instock", "forsale", "available"), True).when(a.isin("soldout", "sold", "notforsale", "outofstock"), False))


def sold(c: Column) -> Column:
    return let(availability(c), lambda a: F.when(a.isin("soldout", "sold"), True).when(a != "", False))


def positive(c: Column) -> Column:
    """A number above zero; zero stands for no number."""
    return F.when(c > 0, c)


_TEXT = {"title": clean_text, "artist_name": clean_text, "platform_artist_id": clean_id, "currency": currency_code, "price": to_money, "image_url": to_url, "artwork_url": to_url}


#: Artworks within the state a page was rendered from; only pages of one work, an artist or a list count.
STATE = Mapping(
    payload=lambda html: payload.script_json(html, "__STATE__"),
    rows="$.page.artworks",
    key="platform_artwork_id",
    columns={
        "platform_artwork_id": ("$.slug", "string"), "title": ("$.title", "string"), "artist_name": ("$.artist.name", "string"), "platform_artist_id": ("$.artist.id", "string"), "price": ("$.price.amount", "string"), "currency": ("$.price.currency", "string"),
        "width_cm": ("$.size.width", "double"), "height_cm": ("$.size.height", "double"), "year": ("$.year", "string"), "styles": ("$.styles", "array<string>"), "is_available_for_sale": ("$.availability", "string"), "is_sold": ("$.availability", "string"), "image_url": ("$.image", "string"),
    },
    convert=_TEXT | {"width_cm": positive, "height_cm": positive, "year": lambda c: year_of(c, AS_OF), "styles": lambda c: text_list(c), "is_available_for_sale": for_sale, "is_sold": sold},
    relevant=lambda v: F.try_variant_get(v, "$.page.kind", "string").isin("artwork", "artist", "listing"),
)

#: Works a page describes in linked data; the offer may be absent.
LINKED_DATA = Mapping(
    payload=lambda html: F.to_variant_object(F.filter(payload.jsonld_objects(html), lambda v: F.try_variant_get(v, "$['@type']", "string").isin("VisualArtwork", "Product"))),
    rows="$",
    key="platform_artwork_id",
    columns={
        "platform_artwork_id": ("$.sku", "string"), "title": ("$.name", "string"), "artist_name": ("$.creator.name", "string"), "price": ("$.offers.price", "string"), "currency": ("$.offers.priceCurrency", "string"), "is_available_for_sale": ("$.offers.availability", "string"),
        "image_url": ("$.image", "string"), "artwork_url": ("$.url", "string"),
    },
    convert=_TEXT | {"is_available_for_sale": for_sale},
)

#: Cards of a listing: elements of class ``work``.
CARDS = Mapping(
    payload=lambda html: F.to_variant_object(payload.cards_udf("work", {"title": ("h3", "text"), "artist": ("artist", "text"), "price": ("price", "text"), "image": ("img", "src"), "url": ("a", "href")})(html)),
    rows="$",
    key="platform_artwork_id",
    columns={
        "platform_artwork_id": ("$['data-id']", "string"), "title": ("$.title", "string"), "artist_name": ("$.artist", "string"), "price": ("$.price", "string"), "currency": ("$.price", "string"), "image_url": ("$.image", "string"), "artwork_url": ("$.url", "string"),
    },
    convert=_TEXT | {"price": lambda c: to_money(F.regexp_extract(c, r"([\d.,]+)", 1)), "currency": lambda c: currency_code(F.regexp_extract(c, r"([A-Z]{3})", 1))},
)

MAPPINGS = {"state": STATE, "linked_data": LINKED_DATA, "cards": CARDS}
