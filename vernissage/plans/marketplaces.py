"""Four marketplaces with their artworks and artists: two in linked data, two in embedded state.

An artist's row comes from the artist's own page only. Names of artists are
those the page gives for their ids.
"""

from __future__ import annotations

from collections.abc import Mapping as Names
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from vernissage.functions import payload
from vernissage.functions.scalars import SOCIAL, country_name, currency_code, let, plain_text, profile_url, text_list, to_money, to_url, year_of
from vernissage.functions.text import clean_text
from vernissage.plans.pages import Mapping

#: Types of linked data that are artworks, and the name of the picture of artists without one.
ARTWORK_TYPES = ("VisualArtwork", "Painting", "Photograph", "Drawing", "Sculpture")
NO_PORTRAIT = "headshotPlaceholder"
#: How networks write the addresses of profiles.
PROFILES = {"facebook": "https://www.facebook.com/{}", "instagram": "https://www.instagram.com/{}", "tiktok": "https://www.tiktok.com/@{}", "twitter": "https://x.com/{}"}
#: Lists of an artist's page that hold artworks, and whether these are for sale (null: not told).
ARTWORK_LISTS = {"artworks": True, "auction-results": None}


def _first(objects: Column, *kinds: str) -> Column:
    return F.coalesce(*[payload.first_of_type(objects, k) for k in kinds])


def _id_in(pattern: str, upper: bool = False):
    def read(c: Column) -> Column:
        found = F.nullif(F.regexp_extract(c, pattern, 1), F.lit(""))
        return F.upper(found) if upper else F.lower(found)

    return read


def _picture(c: Column) -> Column:
    return F.when(~c.contains(NO_PORTRAIT), to_url(c))


def _artwork_page(html: Column) -> Column:
    def read(objects: Column) -> Column:
        art = _first(objects, *ARTWORK_TYPES)
        meta = [payload.meta_content(html, f"og:price:{n}").alias(n) for n in ("amount", "currency")]
        return F.when(art.isNotNull(), F.to_variant_object(F.struct(art.alias("art"), *meta)))

    return let(payload.jsonld_objects(html), read)


def _in_stock(item: Column) -> Column:
    said = F.transform(F.try_variant_get(item, "$.art.offers.offers", "array<variant>"), lambda o: F.coalesce(F.try_variant_get(o, "$.availability", "string"), F.lit("")))
    return F.when(F.size(said) > 0, F.exists(said, lambda a: a.endswith("InStock")))


def _artist_page(html: Column) -> Column:
    return let(payload.jsonld_objects(html), lambda o: F.when(_first(o, *ARTWORK_TYPES).isNull(), payload.first_of_type(o, "Person")))


def _listed_artworks(html: Column) -> Column:
    """Items of an artist's lists of artworks, each with its list and the list's page."""

    def read(objects: Column) -> Column:
        text = lambda v, path: F.try_variant_get(v, path, "string")
        person = F.exists(objects, lambda o: F.coalesce((text(o, "$['@type']") == "Person") & text(o, "$['@id']").endswith("#artist"), F.lit(False)))

        def rows(one: Column) -> Column:
            at = F.split(F.coalesce(text(one, "$['@id']"), F.lit("")), "#")
            elements = F.coalesce(F.try_variant_get(one, "$.itemListElement", "array<variant>"), F.array().cast("array<variant>"))
            items = F.array_compact(F.transform(elements, lambda e: F.try_variant_get(e, "$.item", "variant")))
            works = F.filter(items, lambda i: F.coalesce(text(i, "$['@type']") == "VisualArtwork", F.lit(False)))
            listed = F.coalesce(F.get(at, 1), F.lit(""))
            found = F.transform(works, lambda i: F.struct(i.alias("item"), listed.alias("list"), F.get(at, 0).alias("page")))
            return F.filter(found, lambda s: s["list"].isin(*ARTWORK_LISTS) & (text(one, "$['@type']") == "ItemList"))

        return F.when(person, F.to_variant_object(F.flatten(F.transform(objects, rows))))

    return let(payload.jsonld_objects(html), read)


def _without_year(item: Column) -> Column:
    """A title without the year it repeats at its end."""
    title, year = (F.try_variant_get(item, f"$.item.{k}", "string") for k in ("name", "dateCreated"))
    return clean_text(F.coalesce(F.regexp_replace(title, F.concat(F.lit(r",\s*\Q"), F.nullif(year, F.lit("")), F.lit(r"\E\s*$")), F.lit("")), title))


def _for_sale(item: Column) -> Column:
    listed = F.try_variant_get(item, "$.list", "string")
    return reduce(lambda out, kv: F.when(listed == kv[0], F.lit(kv[1]).cast("boolean")).otherwise(out), ARTWORK_LISTS.items(), F.lit(None).cast("boolean"))


def _one(c: Column) -> Column:
    text = clean_text(c)
    return F.when(text.isNotNull(), F.array(text))


def _page_state(html: Column) -> Column:
    return F.try_variant_get(payload.script_json(html, "__NEXT_DATA__"), "$.props.pageProps.initialState.page.data", "variant")


def _profile_cards(html: Column) -> Column:
    """Artworks on an artist's profile, each with the artist it is of."""

    def read(v: Column) -> Column:
        works = F.try_variant_get(v, "$.accountData.artworks", "array<variant>")
        artist = [F.try_variant_get(v, f"$.accountData.{k}", "string").alias(k) for k in ("userId", "firstName", "lastName")]
        return F.to_variant_object(F.transform(works, lambda w: F.struct(w.alias("item"), *artist)))

    return let(_page_state(html), read)


def _full_name(first: str, last: str):
    return lambda v: clean_text(F.concat_ws(" ", *[clean_text(F.try_variant_get(v, p, "string")) for p in (first, last)]))


def _on_site(base: str):
    return lambda c: to_url(F.when(c.startswith("/"), F.concat(F.lit(base), c)).otherwise(c))


def _cents(c: Column) -> Column:
    return to_money((c.try_cast("decimal(20,4)") / 100).cast("string"))


def _usd_if_priced(path: str):
    return lambda v: F.when(_cents(F.try_variant_get(v, path, "string")).isNotNull(), F.lit("USD"))


def _is(word: str, path: str):
    return lambda v: let(F.lower(clean_text(F.try_variant_get(v, path, "string"))), lambda t: t == word)


def _routed_artwork(html: Column) -> Column:
    """The artwork among the answers a page was rendered from: twice encoded pairs of a query and its answer."""
    text = payload.string_after("var __RELAY_HYDRATION_DATA__ = ")(html)
    pairs = F.try_variant_get(F.try_parse_json(text), "$", "array<variant>")
    asked = lambda p: F.try_variant_get(F.try_parse_json(F.try_variant_get(p, "$[0]", "string")), "$.queryID", "string")
    mine = F.filter(pairs, lambda p: F.coalesce(asked(p).startswith("artworkRoutes_Artwork"), F.lit(False)))
    return F.try_variant_get(F.get(mine, 0), "$[1].json.data.artworkResult", "variant")


def mappings(as_of: int, countries: Names[str, str]) -> dict[str, Mapping]:
    """The mappings by site and dataset; ``countries`` are names by codes (``countries.country_names``)."""
    faa_work, faa_artist = _id_in(r"/featured/([^/?#]+)\.html"), _id_in(r"/profiles/([^/?#]+)")
    sizes = lambda c: F.when(c > 0, c)
    saatchi, artsy = _on_site("https://www.saatchiart.com"), _on_site("https://www.artsy.net")
    hex_artist, hex_work = _id_in(r"/Artist/[^/?#]+/([0-9A-Fa-f]{10,})", True), _id_in(r"/Artwork/[^/?#]+/([0-9A-Fa-f]{10,})", True)
    return {
        "fineartamerica/artworks": Mapping(
            _artwork_page, "$", "platform_artwork_id",
            {"platform_artwork_id": (("$.art.url", "$.art['@id']"), "string"), "title": ("$.art.name", "string"), "artist_name": ("$.art.creator.name", "string"), "platform_artist_id": ("$.art.creator.url", "string"), "artwork_url": (("$.art.url", "$.art['@id']"), "string"), "category": ("$.art.artMedium", "string"), "price": ("$.amount", "string"), "currency": (("$.currency", "$.art.offers.priceCurrency"), "string"), "description": ("$.art.description", "string"), "mediums": ("$.art.artMedium", "string"), "image_url": ("$.art.image", "string")},
            {"platform_artwork_id": faa_work, "title": clean_text, "artist_name": clean_text, "platform_artist_id": faa_artist, "artwork_url": to_url, "category": clean_text, "price": to_money, "currency": currency_code, "description": plain_text, "mediums": _one, "image_url": to_url},
            derived={"is_available_for_sale": _in_stock, "has_detail": lambda _: F.lit(True)},
        ),
        "fineartamerica/artists": Mapping(
            _artist_page, "$", "platform_artist_id",
            {"platform_artist_id": ("$.url", "string"), "full_name": ("$.name", "string"), "profile_url": ("$.url", "string"), "avatar": ("$.image", "string"), "city": ("$.homeLocation.address.addressLocality", "string"), "state": ("$.homeLocation.address.addressRegion", "string"), "country": ("$.homeLocation.address.addressCountry", "string")},
            {"platform_artist_id": faa_artist, "full_name": clean_text, "profile_url": to_url, "avatar": _picture, "city": clean_text, "state": clean_text, "country": lambda c: country_name(c, countries)},
        ),
        "saatchi/cards": Mapping(
            _profile_cards, "$", "platform_artwork_id",
            {"platform_artwork_id": ("$.item.artworkID", "string"), "title": ("$.item.title", "string"), "platform_artist_id": ("$.userId", "string"), "artwork_url": ("$.item.pdpUrl", "string"), "category": ("$.item.category", "string"), "subject": ("$.item.subject", "string"), "width_cm": ("$.item.widthInCentimeters", "double"), "height_cm": ("$.item.heightInCentimeters", "double"), "depth_cm": ("$.item.depthInCentimeters", "double"), "price": ("$.item.listPrice", "string"), "styles": ("$.item.styles", "array<string>"), "mediums": ("$.item.mediums", "array<string>"), "image_url": ("$.item.artworkImage", "string")},
            {"title": clean_text, "platform_artist_id": clean_text, "artwork_url": saatchi, "category": clean_text, "subject": clean_text, "width_cm": sizes, "height_cm": sizes, "depth_cm": sizes, "price": _cents, "styles": lambda c: text_list(c), "mediums": lambda c: text_list(c), "image_url": saatchi},
            derived={"artist_name": _full_name("$.firstName", "$.lastName"), "currency": _usd_if_priced("$.item.listPrice"), "is_sold": _is("sold", "$.item.originalStatus"), "has_detail": lambda _: F.lit(False)},
        ),
        "saatchi/artworks": Mapping(
            _page_state, "$", "platform_artwork_id",
            {"platform_artwork_id": (("$.artwork.artworkId", "$.pdpArtwork.artworkId"), "string"), "title": ("$.artwork.title", "string"), "platform_artist_id": (("$.artwork.userId", "$.artist.userId"), "string"), "artwork_url": ("$.pdpArtwork.artworkOriginalUrl", "string"), "category": ("$.artwork.category", "string"), "subject": ("$.artwork.subject", "string"), "description": ("$.artwork.description", "string"), "year": ("$.artwork.yearProduced", "string"), "width_cm": ("$.pdpArtwork.dimensions.widthInCentimeters", "double"), "height_cm": ("$.pdpArtwork.dimensions.heightInCentimeters", "double"), "price": ("$.artwork.products[0].original.listPrice", "string"), "ships_from_country": ("$.artwork.products[0].original.shippingCountry", "string"), "is_available_for_sale": ("$.artwork.products[0].isAvailableForSale", "boolean"), "styles": (("$.artwork.styles", "$.pdpArtwork.styles"), "array<string>"), "mediums": (("$.artwork.mediums", "$.pdpArtwork.mediums"), "array<string>"), "image_url": ("$.artwork.artworkImage.imageUrl", "string")},
            {"title": clean_text, "platform_artist_id": clean_text, "artwork_url": saatchi, "category": clean_text, "subject": clean_text, "description": plain_text, "year": lambda c: year_of(c, as_of), "width_cm": sizes, "height_cm": sizes, "price": _cents, "ships_from_country": lambda c: country_name(c, countries), "styles": lambda c: text_list(c), "mediums": lambda c: text_list(c), "image_url": saatchi},
            relevant=lambda v: F.try_variant_get(v, "$.artwork", "variant").isNotNull(),
            derived={"artist_name": _full_name("$.artist.firstName", "$.artist.lastName"), "currency": _usd_if_priced("$.artwork.products[0].original.listPrice"), "is_sold": _is("sold", "$.pdpArtwork.originalArtworkStatus"), "has_detail": lambda _: F.lit(True)},
        ),
        "saatchi/artists": Mapping(
            _page_state, "$.accountData", "platform_artist_id",
            {"platform_artist_id": ("$.userId", "string"), "avatar": ("$.avatar", "string"), "biography": ("$.aboutArtist.about", "string"), "website": ("$.socialLinks.artistHomepage", "string"), **{n: (f"$.socialLinks.{n}", "string") for n in SOCIAL}, "city": ("$.city", "string"), "state": ("$.state", "string"), "zip_code": ("$.zipcode", "string"), "country": (("$.country", "$.countryCode"), "string")},
            {"avatar": saatchi, "biography": plain_text, "website": to_url, **{n: (lambda c, n=n: profile_url(c, PROFILES[n])) for n in SOCIAL}, "city": clean_text, "state": clean_text, "zip_code": clean_text, "country": lambda c: country_name(c, countries)},
            derived={"full_name": lambda v: F.coalesce(_full_name("$.firstName", "$.lastName")(v), clean_text(F.try_variant_get(v, "$.displayName", "string"))), "profile_url": lambda v: to_url(F.concat(F.lit("https://www.saatchiart.com/"), clean_text(F.try_variant_get(v, "$.userName", "string"))))},
        ),
        "artsy/artworks": Mapping(
            _routed_artwork, "$", "platform_artwork_id",
            {"platform_artwork_id": ("$.slug", "string"), "title": ("$.title", "string"), "artist_name": (("$.artistNames", "$.artists[0].name"), "string"), "platform_artist_id": ("$.artists[0].internalID", "string"), "artwork_url": ("$.href", "string"), "category": ("$.category", "string"), "width_cm": ("$.widthCm", "double"), "height_cm": ("$.heightCm", "double"), "depth_cm": ("$.depthCm", "double"), "price": ("$.listPrice.major", "string"), "currency": (("$.priceCurrency", "$.listPrice.currencyCode"), "string"), "year": ("$.date", "string"), "description": ("$.descriptionHTML", "string"), "mediums": ("$.medium", "string"), "dimensions_cm": ("$.dimensions.cm", "string"), "dimensions_in": ("$.dimensions.in", "string"), "is_sold": ("$.isSold", "boolean"), "image_url": ("$.image.resized.src", "string"), "has_certificate": ("$.hasCertificateOfAuthenticity", "boolean"), "signature": ("$.signatureInfo.details", "string"), "ships_from_country": ("$.shippingOrigin", "string")},
            {"title": clean_text, "artist_name": clean_text, "platform_artist_id": clean_text, "artwork_url": artsy, "category": clean_text, "price": to_money, "currency": currency_code, "year": lambda c: year_of(c, as_of), "description": plain_text, "mediums": _one, "dimensions_cm": clean_text, "dimensions_in": clean_text, "image_url": to_url, "signature": clean_text, "ships_from_country": lambda c: country_name(F.element_at(F.split(c, ","), -1), countries)},
            derived={"is_available_for_sale": _is("for sale", "$.availability"), "has_detail": lambda _: F.lit(True)},
        ),
        "mutualart/artworks": Mapping(
            _listed_artworks, "$", "platform_artwork_id",
            {"platform_artwork_id": ("$.item.url", "string"), "artwork_url": ("$.item.url", "string"), "year": ("$.item.dateCreated", "string"), "description": ("$.item.description", "string"), "mediums": ("$.item.artMedium", "string"), "support": ("$.item.artworkSurface", "string"), "image_url": ("$.item.image", "string")},
            {"platform_artwork_id": hex_work, "artwork_url": to_url, "year": lambda c: year_of(c, as_of), "description": plain_text, "mediums": _one, "support": clean_text, "image_url": to_url},
            derived={"title": _without_year, "is_available_for_sale": _for_sale, "has_detail": lambda _: F.lit(False), "platform_artist_id": lambda v: F.coalesce(hex_artist(F.try_variant_get(v, "$.item.artist['@id']", "string")), hex_artist(F.try_variant_get(v, "$.page", "string")))},
        ),
        "mutualart/artists": Mapping(
            lambda html: let(payload.jsonld_objects(html), lambda o: F.get(F.filter(o, lambda v: F.coalesce((F.try_variant_get(v, "$['@type']", "string") == "Person") & F.try_variant_get(v, "$['@id']", "string").endswith("#artist"), F.lit(False))), 0)), "$", "platform_artist_id",
            {"platform_artist_id": ("$['@id']", "string"), "full_name": ("$.name", "string"), "profile_url": ("$['@id']", "string"), "birth_year": ("$.birthDate", "string"), "death_year": ("$.deathDate", "string"), "nationality": ("$.nationality", "string"), "biography": ("$.description", "string")},
            {"platform_artist_id": hex_artist, "full_name": clean_text, "profile_url": lambda c: to_url(F.substring_index(c, "#", 1)), "birth_year": lambda c: year_of(c, as_of), "death_year": lambda c: year_of(c, as_of), "nationality": clean_text, "biography": plain_text},
        ),
    }


