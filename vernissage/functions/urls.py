"""Canonical addresses, file names of pages, and entity keys by ordered rules."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from vernissage.functions.scalars import let
from vernissage.functions.text import _col

#: Query parameters that only track visits.
TRACKING = r"(?i)(?:utm_[a-z]+|gclid|fbclid|msclkid|mc_[ce]id|ref|source)"


def normalize_url(c: Column | str) -> Column:
    """Scheme and host in lower case; no query, fragment or closing slash."""
    t = F.regexp_replace(F.trim(_col(c)), r"[?#].*$", "")
    head = F.lower(F.regexp_extract(t, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/]*)", 1))
    return F.regexp_replace(F.concat(head, F.substring(t, F.length(head) + 1, F.length(t))), "/+$", "")


def page_filename(url: Column | str) -> Column:
    return F.concat(F.sha1(_col(url)), F.lit(".html"))


def drop_tracking(c: Column | str, tracking: str = TRACKING) -> Column:
    """Without fragment and tracking parameters; other parameters stay in order."""
    t = F.regexp_replace(_col(c), "#.*$", "")
    parts = F.split(t, r"\?", 2)
    kept = F.filter(F.split(F.coalesce(F.get(parts, 1), F.lit("")), "&"), lambda p: (p != "") & ~p.rlike(rf"^{tracking}(?:=|$)"))
    base = F.get(parts, 0)
    return F.when(F.size(kept) > 0, F.concat(base, F.lit("?"), F.array_join(kept, "&"))).otherwise(base)


@dataclass(frozen=True)
class Rule:
    """A pattern on the path; its groups, joined by ``-``, are the entity's id."""

    entity_type: str
    pattern: str
    groups: tuple[int, ...] = (1,)
    lower: bool = False


@dataclass(frozen=True)
class Site:
    """How one site writes its addresses."""

    host: str
    rules: tuple[Rule, ...]
    aliases: tuple[str, ...] = ()
    locales: str = ""
    keep_query: bool = False
    canonical_paths: dict[str, str] = field(default_factory=dict)


def classify(url: Column | str, rules: Sequence[Rule]) -> Column:
    """``struct(entity_type, entity_id)`` by the first rule that matches, else null."""
    return let(_path(_col(url)), lambda path: _first_rule(path, rules))


def _path(url: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*", ""), r"[?#].*$", "")


def _first_rule(path: Column, rules: Sequence[Rule]) -> Column:
    def key(r: Rule) -> Column:
        found = F.concat_ws("-", *[F.nullif(F.regexp_extract(path, r.pattern, g), F.lit("")) for g in r.groups]) if len(r.groups) > 1 else F.regexp_extract(path, r.pattern, r.groups[0])
        return F.lower(found) if r.lower else found

    # A pattern that does not match gives no id, so each is tried once.
    named = [let(key(r), lambda k, r=r: F.when(k != "", F.struct(F.lit(r.entity_type).alias("entity_type"), k.alias("entity_id")))) for r in rules]
    return F.coalesce(*named, F.lit(None).cast("struct<entity_type:string,entity_id:string>"))


#: Parts of a template and the patterns they stand for.
_PARTS = {"{d}": r"(\d+)", "{s}": r"([A-Za-z0-9_-]+)", "{x}": r"([0-9A-Fa-f]{10,})", "*": r"[^/?#]+", "~": r"(?:[A-Za-z]{2}/)?", "**": r"[^?#]*"}


def template(entity_type: str, path: str, lower: bool = False) -> Rule:
    """Rule of a path template: ``{d}``, ``{s}``, ``{x}`` are an id of digits, letters or hex, ``*`` a part, ``**`` the rest, ``~`` an optional language."""
    pieces = re.split(r"(\{[dsx]\}|\*\*|\*|~)", path)
    return Rule(entity_type, "^" + "".join(_PARTS.get(p) or re.escape(p) for p in pieces) + "/?$", lower=lower)


@dataclass(frozen=True)
class Entities:
    """Entity pages of one site. ``plain``: addresses with a query or fragment are none; ``reserved``: ids that are none."""

    host: str
    rules: tuple[Rule, ...]
    plain: bool = False
    reserved: frozenset[str] = frozenset()
    upper: bool = False


def entity_of(url: Column | str, site: Entities) -> Column:
    """``struct(entity_type, entity_id)`` of an address of the site, also on a subdomain of it; else null."""
    return let(_parts(_col(url)), lambda a: _entity(a, site))


def entities_of(url: Column | str, sites: Mapping[str, Entities]) -> Column:
    """Array of ``struct(site, k)`` with the entity ``k`` of each site whose address it is; host and path are read once for all sites."""
    each = lambda a: F.array(*[F.struct(F.lit(name).alias("site"), _entity(a, site).alias("k")) for name, site in sites.items()])
    return let(_parts(_col(url)), lambda a: F.filter(each(a), lambda x: x["k"].isNotNull()))


def _parts(u: Column) -> Column:
    host = F.lower(F.regexp_extract(u, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*://)?(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.struct(host.alias("host"), _path(u).alias("path"), u.rlike("[?#]").alias("more"))


def _entity(a: Column, site: Entities) -> Column:
    ours = (a["host"] == site.host) | a["host"].endswith("." + site.host)
    if site.plain:
        ours = ours & ~a["more"]

    def allowed(k: Column) -> Column:
        key = F.upper(k["entity_id"]) if site.upper else k["entity_id"]
        return F.when(k.isNotNull() & ~F.lower(key).isin(*(site.reserved or {""})), F.struct(k["entity_type"].alias("entity_type"), key.alias("entity_id")))

    return F.when(ours, let(_first_rule(a["path"], site.rules), allowed))


#: How sites write the addresses of their entities, and first parts that are no entity.
ENTITIES = {
    "artsper": Entities("artsper.com", (template("artwork", "/~contemporary-artworks/*/{d}/**"), template("artist", "/~contemporary-artists/*/{d}/**"))),
    "saatchi": Entities("saatchiart.com", (template("artwork", "/art/*/*/{d}"), template("artwork", "/art/*/*/{d}/view"), template("artist", "/account/profile/{s}", True), template("artist", "/{s}", True)), reserved=frozenset("art account accounts search collections stories magazine api www".split())),
    "artsy": Entities("artsy.net", (template("artwork", "/artwork/{s}", True), template("artist", "/artist/{s}", True))),
    "artmajeur": Entities("artmajeur.com", (template("artwork", "/*/~artworks/{d}/**"), template("artist", "/{s}", True)), reserved=frozenset("en fr de es it pt nl pl ru ja zh magazine help search blog faq www api cdn-cgi".split())),
    "singulart": Entities("singulart.com", (template("artist", "/~artist/*-{d}"), template("artwork", "/~artworks/*-{d}")), plain=True),
    "1stdibs": Entities("1stdibs.com", (template("item", "/art/**/id-a_{d}"), template("dealer", "/dealers/{s}", True)), plain=True),
    "artfinder": Entities("artfinder.com", (template("artwork", "/product/{s}", True), template("artist", "/artist/{s}", True)), plain=True),
    "fineartamerica": Entities("fineartamerica.com", (template("artwork", "/featured/{s}.html", True), template("artist", "/profiles/{s}", True)), plain=True),
    "phaidon": Entities("phaidon.com", (template("product", "/products/{s}", True),), plain=True),
    "ugallery": Entities("ugallery.com", (template("artwork", "/products/{s}", True), template("artist", "/pages/{s}", True)), plain=True, reserved=frozenset("contact terms about-us faq for-artists commissions quiz privacy-policy accessibility a-guide-to-choosing-art-for-your-home how-to-decorate-your-living-room-with-original-art".split())),
    "mutualart": Entities("mutualart.com", tuple(template(k.lower(), f"/{k}/*/{{x}}") for k in ("Artist", "Organization", "Exhibition", "Auction")), plain=True, upper=True),
}


def page_group(url: Column | str, rules: Sequence[Rule]) -> Column:
    """Type of the first rule that matches, ``other`` if none does, ``no-url`` without an address."""
    return F.when(_col(url).isNull() | (F.trim(_col(url)) == ""), "no-url").otherwise(F.coalesce(classify(url, rules)["entity_type"], F.lit("other")))


def canonical_url(url: Column | str, site: Site) -> Column:
    """https, the site's one host, no fragment, tracking, locale or closing slash; the path is unquoted.

    A port stays on hosts the site does not know.
    """
    t = drop_tracking(url) if site.keep_query else F.regexp_replace(_col(url), r"[?#].*$", "")
    host = F.lower(F.regexp_extract(t, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]+)", 1))
    rest = F.regexp_replace(t, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*", "")
    if site.locales:
        rest = F.regexp_replace(rest, rf"^/(?:{site.locales})(?=/|$)", "")
    path = F.regexp_extract(rest, r"^[^?]*", 0)
    # A plus is itself in a path; what cannot be unquoted stays.
    plain = F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)
    rest = F.concat(plain, F.substring(rest, F.length(path) + 1, F.length(rest)))
    one = F.when(F.regexp_replace(host, r":\d+$", "").isin(site.host, *site.aliases), site.host).otherwise(host)
    return F.when(host != "", F.regexp_replace(F.concat(F.lit("https://"), one, rest), "/+$", ""))


def canonicality(url: Column | str, site: Site) -> Column:
    """The higher, the nearer an address is to its canonical form."""
    u = _col(url)
    return (u == canonical_url(u, site)).cast("int") * 4 + u.startswith("https://").cast("int") * 2 + (~u.contains("?")).cast("int")


def links_in(html: Column | str) -> Column:
    """Targets of links, each once, in page order."""
    return F.array_distinct(F.regexp_extract_all(_col(html), F.lit(r"(?i)<a\b[^>]*?\bhref\s*=\s*[\"']([^\"'#]+)"), 1))
