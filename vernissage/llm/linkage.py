"""Matching entities of two sources that share no key, with a confidence.

Candidates share a token of the name that is rare in both sources, or one that
differs from it by one edit (deletion neighbourhoods). Names that share only a
frequent token are candidates if a second token is equal, differs by one edit
or is the other's initial: all pairs whose names relate are candidates, however
frequent their tokens are. Equal whole names are always candidates.

Many heuristic functions vote on each candidate: how the names relate, how far
the birth years are apart, whether nationalities, countries (also those the
cities lie in) and cities agree. A generative label model with a latent class
(same person or not) learns from the votes alone how accurate each function is:
each has a table of probabilities per class, abstentions included. Votes on
nationality and country depend on each other, so they share one table; among
different persons all votes depend on how the names relate. The posterior is the
confidence.

The votes have few levels, so the model is fitted by expectation-maximisation
on counts of vote patterns, of which there are at most a few thousand at any
size of the data.

Defined cases: records without a usable name match nothing; missing values are
abstentions; repeated rows of an artist count once (the newest usable value of
each field); a listing may match several artists and an artist several
listings; empty tables give no pairs.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vernissage.functions.countries import country_table, with_country_code
from vernissage.functions.text import fold, usable, usable_year
from vernissage.llm.canonical import canonical
from vernissage.llm.survivor import artist_rows, survivors
from vernissage.session import checkpoint

#: A token with more records than this is no key by itself: it is split by a second token, one
#: that differs from it by one edit, or an initial.
RARE = 64
#: Vote patterns at most (the levels of all functions multiplied).
MAX_PATTERNS = 20_000

_NOTE = regex.compile(r"\([^()]*\)|\[[^\[\]]*\]")
_TOKEN = regex.compile(r"[\p{L}\p{N}]+(?:[-'’][\p{L}\p{N}]+)*")
_YEAR = regex.compile(r"(?:born|b\.|né|née|geb\.)\s*(\d{4})")


def name_tokens(name: str | None) -> list[str]:
    """Tokens of a name in one form and order, without notes in brackets."""
    if not name:
        return []
    t = _NOTE.sub(" ", canonical(name)).lower().replace("ß", "ss").replace("ł", "l").replace("ø", "o").replace("đ", "d").replace("æ", "ae").replace("œ", "oe")
    t = "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c))
    return sorted(regex.sub(r"[-'’]", "", x) for x in _TOKEN.findall(t))


@F.pandas_udf(T.ArrayType(T.StringType()))
def _tokens_udf(names: pd.Series) -> pd.Series:
    return names.map(name_tokens)


def one_edit(a: str, b: str) -> str | None:
    """``swap``, ``double`` or ``lost`` for letters swapped, doubled, lost or added, ``near`` for one replaced, else None."""
    if a == b:
        return None
    if len(a) > len(b):
        a, b = b, a
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    if len(b) - len(a) == 1:
        if a[i:] != b[i + 1 :]:
            return None
        return "double" if i and b[i] == b[i - 1] or b[i : i + 1] == b[i + 1 : i + 2] else "lost"
    if len(a) != len(b):
        return None
    if a[i + 1 :] == b[i + 1 :]:
        return "near"
    return "swap" if a[i + 2 :] == b[i + 2 :] and a[i] == b[i + 1] and a[i + 1] == b[i] else None


def name_relation(a: Sequence[str], b: Sequence[str]) -> str:
    """How two names relate: exact, middle, initial, swap, double, lost, near or other."""
    if list(a) == list(b):
        return "exact"
    rest_a, rest_b = list(a), list(b)
    same = 0
    for t in a:
        if t in rest_b:
            rest_a.remove(t)
            rest_b.remove(t)
            same += len(t) > 1
    kinds = set()
    for t in rest_a.copy():
        for u in rest_b:
            kind = one_edit(t, u) if min(len(t), len(u)) >= 4 else None
            if kind:
                kinds.add(kind)
                rest_a.remove(t)
                rest_b.remove(u)
                break
    for t in rest_a.copy():
        u = next((u for u in rest_b if (len(t) == 1) != (len(u) == 1) and t[0] == u[0]), None)
        if u:
            kinds.add("initial")
            rest_a.remove(t)
            rest_b.remove(u)
    if rest_a and rest_b or not same or len(kinds) > 1:
        return "other"
    if kinds:
        return kinds.pop()
    return "middle" if same > 1 else "other"


@lru_cache(1 << 16)
def _relation(a: tuple[str, ...], b: tuple[str, ...]) -> str:
    return name_relation(a, b)


@F.pandas_udf(T.StringType())
def _relation_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([_relation(tuple(x), tuple(y)) for x, y in zip(a, b)], dtype=object)


#: What makes two records the same for every label function.
PROFILE = ("tokens", "year", "nat", "country", "city", "land")


def profiles(df: DataFrame, id_cols: Sequence[str]) -> DataFrame:
    """``id (struct), tokens, year, nat, country, city, land`` of records with a usable name."""
    noted = F.regexp_extract("full_name", _YEAR.pattern, 1).try_cast("int")
    year = F.coalesce(F.when(usable_year("birth_year"), F.col("birth_year").cast("int")), noted)
    p = df.filter(usable("full_name")).select(
        F.struct(*id_cols).alias("id"), _tokens_udf("full_name").alias("tokens"), year.alias("year"), F.col("nationality").alias("_nat"), F.col("country").alias("_country"), F.when(usable("city"), fold("city")).alias("city"), F.lit(None).cast("string").alias("land")
    )
    words = country_table(df.sparkSession)
    p = with_country_code(with_country_code(p, "_nat", "nat", words), "_country", "country", words).select("id", *PROFILE)
    return p.filter(F.size("tokens") > 0)


def classes(p: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct profiles with the least id of their records and their number, and ``id, member``.

    Copies are compared once, so that a name borne by a third of all records
    costs as many comparisons as it has different years and places.
    """
    one = p.groupBy(*PROFILE).agg(F.min("id").alias("id"), F.count("*").alias("n"))
    key = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\u0001")) for c in PROFILE])
    same = one.select(key.alias("k"), *[F.col(c).alias(f"_{c}") for c in PROFILE], F.col("id").alias("rep"))
    equal = F.lit(True)
    for c in PROFILE:
        equal = equal & F.col(c).eqNullSafe(F.col(f"_{c}"))
    members = p.withColumn("k", key).join(same, "k").filter(equal).select(F.col("rep").alias("id"), F.col("id").alias("member"))
    return one, members


def towns(*sides: DataFrame, least_share: float = 0.6) -> DataFrame:
    """``city, land``: the country most records of a city name, if most of them agree."""
    named = None
    for p in sides:
        part = p.select("city", F.coalesce("nat", "country").alias("land")).filter("city is not null and land is not null")
        named = part if named is None else named.unionByName(part)
    counted = named.groupBy("city", "land").agg(F.count("*").alias("n"))
    best = counted.groupBy("city").agg(F.max(F.struct("n", "land")).alias("b"), F.sum("n").alias("n"))
    return best.filter(F.col("b.n") >= F.col("n") * least_share).select("city", F.col("b.land").alias("land"))


def with_land(p: DataFrame, known: DataFrame) -> DataFrame:
    """Profiles with the country their city lies in."""
    return p.drop("land").join(known, "city", "left")


def _deletions(t: Column) -> Column:
    """A token and, from four letters on, what is left of it without one letter."""
    cut = F.transform(F.sequence(F.lit(1), F.length(t)), lambda i: F.concat(F.substring(t, F.lit(1), i - 1), F.substring(t, i + 1, F.length(t))))
    return F.when(F.length(t) >= 4, F.array_append(cut, t)).otherwise(F.array(t))


def _relatives(df: DataFrame) -> DataFrame:
    """``token, near``: tokens that may be one edit away, where one of both is frequent.

    Two rare ones meet by their deletions.
    """
    cut = lambda rows, name: rows.filter(F.length("token") >= 4).select(F.col("token").alias(name), F.explode(F.array_distinct(_deletions(F.col("token")))).alias("cut"))
    frequent = cut(df.filter(F.col("df") > RARE), "f")
    pairs = frequent.join(cut(df, "t"), "cut").filter("f <> t").select("f", "t").distinct()
    both = pairs.select(F.col("f").alias("token"), F.col("t").alias("near")).unionByName(pairs.select(F.col("t").alias("token"), F.col("f").alias("near")))
    return both.groupBy("token").agg(F.collect_set("near").alias("near"))


def _keys(p: DataFrame, df: DataFrame, near: DataFrame | None = None) -> DataFrame:
    """``id, key`` of every block a record belongs to.

    One side is given ``near`` and writes its tokens the other side's way, too,
    so that a pair meets once for a kind of agreement and not once for each deletion.
    """
    counted = p.select("id", "tokens", "year", F.explode(F.array_distinct("tokens")).alias("token")).join(df, "token")
    counted = counted.withColumn("near", F.array().cast("array<string>")) if near is None else counted.join(near, "token", "left")
    per = counted.groupBy("id").agg(F.first("tokens").alias("tokens"), F.first("year").alias("year"), F.collect_list(F.struct("df", "token", "near")).alias("t"))
    per = per.withColumn("near", F.map_from_entries(F.transform("t", lambda x: F.struct(x["token"], x["near"]))))
    kept = F.filter("t", lambda x: F.length(x["token"]) > 1)
    # An initial meets the whole tokens of the other side alone.
    own, other = ("p", "q") if near is None else ("q", "p")

    def blocks(x: Column) -> Column:
        t = x["token"]
        others = F.filter("tokens", lambda o, i: i + 1 != F.array_position("tokens", t))
        years = F.when(F.col("year").isNull(), F.array()).otherwise(F.array(F.col("year") - 1, F.col("year"), F.col("year") + 1))
        spelled = F.concat(others, F.flatten(F.transform(others, lambda o: F.coalesce(F.try_element_at("near", o), F.array().cast("array<string>")))))
        split = F.concat(
            F.transform(spelled, lambda o: F.concat(F.lit("f|"), t, F.lit("|"), o)),
            F.transform(others, lambda o: F.concat(F.when(F.length(o) == 1, F.lit(f"{own}|")).otherwise(F.lit(f"{other}|")), t, F.lit("|"), F.substring(o, 1, 1))),
            F.flatten(F.transform(others, lambda o: F.transform(years, lambda y: F.concat(F.lit("i|"), t, F.lit("|"), F.substring(o, 1, 1), F.lit("|"), y.cast("string"))))),
        )
        return F.when(x["df"] <= RARE, F.transform(_deletions(t), lambda d: F.concat(F.lit("d|"), d))).otherwise(split)

    whole = F.array(F.concat(F.lit("n|"), F.array_join("tokens", " ")))
    return per.select("id", F.explode(F.array_distinct(F.concat(whole, F.flatten(F.transform(kept, blocks))))).alias("key"))


def candidates(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct pairs ``a_id, b_id`` that share a block."""
    tokens = a.select("tokens").unionByName(b.select("tokens"))
    df = checkpoint(tokens.select(F.explode(F.array_distinct("tokens")).alias("token")).groupBy("token").agg(F.count("*").alias("df")))
    pairs = _keys(a, df).withColumnRenamed("id", "a_id").join(_keys(b, df, _relatives(df)).withColumnRenamed("id", "b_id"), "key")
    return pairs.select("a_id", "b_id").distinct()


def with_known(b: DataFrame, a: DataFrame) -> DataFrame:
    """Profiles with those of their tokens that names of the other side hold, too."""
    there = a.select(F.explode(F.array_distinct("tokens")).alias("token")).distinct()
    known = b.select("id", F.explode(F.array_distinct("tokens")).alias("token")).join(there, "token").groupBy("id").agg(F.collect_set("token").alias("known"))
    return b.drop("known").join(known, "id", "left")


def votes(pairs: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    """``a_id, b_id`` with the votes ``name, years, place, town, fresh`` and the ``n`` pairs of records they stand for."""
    left = a.select(F.col("id").alias("a_id"), *[F.col(c).alias(f"a_{c}") for c in ("tokens", "year", "nat", "country", "city", "land", "n")])
    right = b.select(F.col("id").alias("b_id"), *[F.col(c).alias(f"b_{c}") for c in ("tokens", "year", "nat", "country", "city", "known", "n")])
    j = pairs.join(left, "a_id").join(right, "b_id")
    gap = F.abs(F.col("a_year") - F.col("b_year"))
    years = F.when(gap.isNull(), "?").when(gap == 0, "0").when(gap == 1, "1").when(gap == 2, "2").when(gap < 10, "3").otherwise("10")

    def place(c: str) -> Column:
        # A listing may name the place of birth where the other side names the residence, or
        # only a town in it.
        own, known = F.col(f"b_{c}"), [F.col(f"a_{x}") for x in ("nat", "country", "land")]
        return F.when(own.isNull() | F.coalesce(*known).isNull(), "?").when(F.greatest(*[F.coalesce(own == k, F.lit(False)) for k in known]), "+").otherwise("-")

    town = F.when(F.col("a_city").isNull() | F.col("b_city").isNull(), "?").when(F.col("a_city") == F.col("b_city"), "+").otherwise("-")
    voted = j.select("a_id", "b_id", _relation_udf("a_tokens", "b_tokens").alias("name"), years.alias("years"), F.concat(place("nat"), place("country")).alias("place"), town.alias("town"), "a_tokens", "b_tokens", "b_known", (F.col("a_n") * F.col("b_n")).alias("n"))
    # A token spelled differently is rather a slip if nobody else bears it.
    others = F.array_intersect(F.array_except("b_tokens", "a_tokens"), F.coalesce("b_known", F.array().cast("array<string>")))
    fresh = F.when(~F.col("name").isin("swap", "double", "lost", "near"), "?").when(F.size(others) > 0, "-").otherwise("+")
    return voted.select("a_id", "b_id", "name", "years", "place", "town", fresh.alias("fresh"), "n")


#: The label functions. Years are judged only where both are known, which is a vote of its own.
FUNCTIONS = ("name", "noted", "years", "place", "town", "fresh")


@dataclass
class LabelModel:
    """Two latent classes with a table of probabilities of every function's votes.

    In the class of the same person the functions err independently. In the
    other class the votes depend on how the names relate: namesakes differ from
    relatives and from strangers. A table given the name falls back on the
    table of all names with the weight of ``smooth`` cases: without it a rare
    kind of name could become a class of its own.
    """

    prior: float
    same: dict[str, dict[str, float]]
    other: dict[str, dict[tuple[str, str], float]]

    @classmethod
    def fit(cls, patterns: pd.DataFrame, iterations: int = 300, smooth: float = 200.0) -> LabelModel:
        """``patterns``: columns ``name, years, place, town, fresh, n``."""
        p = cls._with_noted(patterns)
        n = p["n"].to_numpy(float)
        # The first guess is a majority vote in which a contradiction outweighs an agreement.
        score = p["name"].map({"exact": 2.0, "middle": 1.5, "initial": 1.0, "swap": 1.0, "double": 1.0, "lost": 1.0, "near": -0.5, "other": -3.0}).to_numpy(float)
        score += p["years"].map({"0": 2.0, "1": 1.5, "2": -0.5, "3": -2.0, "10": -3.0, "?": 0.0}).to_numpy(float)
        score += np.array([(("+" in x) - 2.0 * ("-" in x and "+" not in x)) for x in p["place"]]) + p["town"].map({"+": 0.5, "-": 0.0, "?": 0.0}).to_numpy(float)
        # Names that do not relate are taken for different persons at first; what that is worth is learned.
        post = (p["name"] != "other").to_numpy() / (1 + np.exp(-2 * (score - 1.5)))
        # Votes as numbers: a table is a count by vote, or by name and vote.
        levels = {f: np.unique(p[f]) for f in FUNCTIONS}
        votes = {f: np.searchsorted(levels[f], p[f]) for f in FUNCTIONS}
        seen = {f: (p[f] != "?").to_numpy() if f in ("years", "fresh") else np.ones(len(p), bool) for f in FUNCTIONS}
        names, name = levels["name"], votes["name"]

        def maximised(post: np.ndarray) -> tuple[float, dict[str, np.ndarray], dict[str, np.ndarray]]:
            same, other = {}, {}
            for f in FUNCTIONS:
                k, w = len(levels[f]), seen[f]
                m, u = (np.bincount(votes[f][w], (n * x)[w], k) for x in (post, 1 - post))
                there = np.bincount(votes[f][w], minlength=k) > 0
                kinds = max(1, int(there.sum()))
                same[f], share = ((x + 0.5) / (x.sum() + 0.5 * kinds) for x in (m, u))
                if f == "name":
                    other[f] = np.repeat(share[None, :], len(names), axis=0)
                    continue
                given = np.bincount(name[w] * k + votes[f][w], (n * (1 - post))[w], len(names) * k).reshape(len(names), k)
                other[f] = (given + smooth * share) / (given.sum(axis=1, keepdims=True) + smooth)
            part = float((n * post).sum() / max(n.sum(), 1e-9))
            return min(0.999, max(0.0001, part)), same, other

        for _ in range(iterations):
            prior, same, other = maximised(post)
            odds = np.full(len(p), np.log(prior / (1 - prior)))
            for f in FUNCTIONS:
                odds += np.where(seen[f], np.log(same[f][votes[f]] / other[f][name, votes[f]]), 0.0)
            new = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
            if np.abs(new - post).max() < 1e-6:
                break
            post = new
        return cls(
            prior,
            {f: {v: float(same[f][i]) for i, v in enumerate(levels[f])} for f in FUNCTIONS},
            {f: {(k, v): float(other[f][j, i]) for j, k in enumerate(names) for i, v in enumerate(levels[f])} for f in FUNCTIONS},
        )

    @staticmethod
    def _with_noted(p: pd.DataFrame) -> pd.DataFrame:
        return p.assign(noted=np.where(p["years"] == "?", "no", "yes"))

    def posterior(self, patterns: pd.DataFrame) -> np.ndarray:
        p = self._with_noted(patterns)
        odds = np.full(len(p), np.log(self.prior / (1 - self.prior)))
        for f in FUNCTIONS:
            odds += np.array([0.0 if f in ("years", "fresh") and v == "?" else np.log(self.same[f][v] / self.other[f][(k, v)]) for k, v in zip(p["name"], p[f])])
        return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


def link(a: DataFrame, b: DataFrame) -> DataFrame:
    """Candidates ``a_id, b_id, confidence`` of two sets of distinct profiles."""
    spark = a.sparkSession
    a, b = checkpoint(a), checkpoint(with_known(b, a))
    v = checkpoint(votes(candidates(a, b), a, b))
    columns = ["name", "years", "place", "town", "fresh"]
    patterns = v.groupBy(*columns).agg(F.sum("n").alias("n")).limit(MAX_PATTERNS + 1).toPandas().sort_values(columns, ignore_index=True)
    if len(patterns) > MAX_PATTERNS:
        raise ValueError("too many vote patterns")
    if patterns.empty:
        return v.select("a_id", "b_id", F.lit(0.0).alias("confidence"))
    model = LabelModel.fit(patterns)
    table = spark.createDataFrame([(*r, float(c)) for r, c in zip(patterns[columns].itertuples(index=False, name=None), model.posterior(patterns))], "name string, years string, place string, town string, fresh string, confidence double")
    return v.join(F.broadcast(table), columns).select("a_id", "b_id", "confidence")


def artist_listing_links(artists: DataFrame, listings: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Candidates between classes of equal profiles, and the members of the classes.

    Returns ``(a_id, b_id, confidence)``, and for artists and listings
    ``(id, member)``. Ids are structs ``(platform_name, platform_artist_id)``
    and ``(house_artist_id)``.
    """
    fields = ["full_name", "birth_year", "nationality", "country", "city"]
    keys = ["platform_name", "platform_artist_id"]
    one = survivors(artist_rows(artists, fields), keys, fields, ["crawl_date", "crawled_at", "source_file"])
    people = profiles(one.select(*keys, *[F.col(f"{f}.value").alias(f) for f in fields]), keys)
    houses = profiles(listings.select("house_artist_id", *fields).filter("house_artist_id is not null").dropDuplicates(["house_artist_id"]), ["house_artist_id"])
    people, houses = checkpoint(people), checkpoint(houses)
    people = with_land(people, towns(people, houses))
    (a, a_members), (b, b_members) = classes(people), classes(houses)
    return link(a, b), a_members, b_members


def matches(artists: DataFrame, listings: DataFrame, least: float = 0.5) -> DataFrame:
    """``platform_name, platform_artist_id, house_artist_id, confidence`` of all records of matching classes."""
    pairs, people, houses = artist_listing_links(artists, listings)
    sure = pairs.filter(F.col("confidence") >= least)
    named = sure.join(people.withColumnsRenamed({"id": "a_id", "member": "a"}), "a_id").join(houses.withColumnsRenamed({"id": "b_id", "member": "b"}), "b_id")
    return named.select("a.*", "b.*", "confidence")
