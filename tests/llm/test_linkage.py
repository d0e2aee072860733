import random

import pytest

from vernissage.llm import linkage as K

from ..conftest import utc


@pytest.mark.parametrize("text, tokens", [("NALOTUCZYK, Łucja", ["lucja", "nalotuczyk"]), ("Jean-Luc  Ste​go (born 1968)", ["jeanluc", "stego"]), ("Ｓｏｌèｎｅ (artist)", ["solene"]), (None, []), ("—", []), ("J. Müller", ["j", "muller"])])
def test_name_tokens(text, tokens):
    assert K.name_tokens(text) == tokens


@pytest.mark.parametrize(
    "a, b, relation",
    [
        ("ann bell", "ann bell", "exact"), ("ann eve bell", "ann bell", "middle"), ("a bell", "ann bell", "initial"), ("a bell", "ann eve bell", "initial"), ("ann belll", "ann bell", "double"), ("ann eblls", "ann bells", "swap"), ("ann blls", "ann bells", "lost"), ("ann belts", "ann bells", "near"),
        ("eve bell", "ann bell", "other"), ("b bell", "ann bell", "other"), ("ann", "ann bell", "other"), ("x", "y", "other"),
    ],
)
def test_name_relation(a, b, relation):
    assert K.name_relation(sorted(a.split()), sorted(b.split())) == relation
    assert K.name_relation(sorted(b.split()), sorted(a.split())) == relation


ARTISTS = "platform_name string, platform_artist_id string, full_name string, birth_year smallint, nationality string, country string, city string, crawl_date string, crawled_at timestamp, source_file string, tokens string"
HOUSES = "house_artist_id string, full_name string, birth_year smallint, nationality string, country string, city string, key string"


def people(n):
    rnd = random.Random(5)
    syl = ["ba", "co", "di", "fu", "ga", "le", "mi", "no", "ra", "su", "ta", "vo"]
    first = ["Ann", "Bea", "Cleo", "Dora", "Emil", "Finn", "Gus", "Hugo"]
    lands = [("French", "France"), ("Dutch", "NL"), ("Italian", "IT"), ("Polish", "Poland")]
    return [(rnd.choice(first), "".join(rnd.choice(syl) for _ in range(4)).capitalize() + "sen", rnd.randrange(1900, 1995), *rnd.choice(lands)) for _ in range(n)]


def test_linkage_finds_noisy_listings_and_not_namesakes(spark):
    rnd = random.Random(7)
    a, h, truth = [], [], set()
    for i, (f, s, y, nat, land) in enumerate(people(300)):
        a.append(("p", f"a{i}", f"{f} {s}", y if rnd.random() < 0.8 else None, nat, land, None, "d", utc(2025, 1, 1), "f", "x"))
        kind = i % 6
        name = [f"{s.upper()}, {f}", f"{f} {s}", f"{f[0]}. {s}", f"{f} {s[:3]}{s[4:]}", f"{f} {s} (artist)", f"{f} {s}"][kind]
        if kind == 5:
            h.append((f"h{i}", name, y + 30, "German", "DE", None, "k"))  # a namesake
        else:
            h.append((f"h{i}", name, y if kind == 2 or rnd.random() < 0.8 else None, nat if rnd.random() < 0.8 else None, land, None, "k"))
            truth.add((f"a{i}", f"h{i}"))
    h.append((None, "Ann", None, None, None, None, "k"))
    h.append(("h_null", None, None, None, None, None, "k"))
    got = K.matches(spark.createDataFrame(a, ARTISTS), spark.createDataFrame(h, HOUSES))
    found = {(r.platform_artist_id, r.house_artist_id) for r in got.collect()}
    assert len(found & truth) >= 0.97 * len(truth) and len(found - truth) <= 0.02 * len(truth)


def test_hot_token_is_split_and_still_linked(spark, monkeypatch):
    monkeypatch.setattr(K, "RARE", 5)
    names = [f"{g} Smith" for g in ("Ann", "Bea", "Cleo", "Dora", "Emil", "Finn", "Gus", "Hugo", "Iris", "Jo")]
    a = [("p", f"a{i}", n, 1900 + i, "French", "FR", None, "d", utc(2025, 1, 1), "f", "x") for i, n in enumerate(names)]
    h = [(f"h{i}", n.upper(), 1900 + i, "French", "FR", None, "k") for i, n in enumerate(names)]
    h.append(("h_initial", "E. Smith", 1904, "French", "FR", None, "k"))
    pairs, _, _ = K.artist_listing_links(spark.createDataFrame(a, ARTISTS), spark.createDataFrame(h, HOUSES))
    got = {(r.a_id.platform_artist_id, r.b_id.house_artist_id) for r in pairs.collect()}
    assert {(f"a{i}", f"h{i}") for i in range(10)} <= got and ("a4", "h_initial") in got and len(got) < 40


def test_copies_are_compared_once_and_all_found(spark):
    a = [("p", f"a{i:03d}", "Ann Belkova", 1950, "Polish", "PL", None, "d", utc(2025, 1, 1), "f", "x") for i in range(60)]
    h = [(f"h{i:03d}", "BELKOVA, Ann", 1950, "Polish", None, None, "k") for i in range(50)]
    others = people(80)
    a += [("p", f"o{i}", f"{f} {s}", y, nat, land, None, "d", utc(2025, 1, 1), "f", "x") for i, (f, s, y, nat, land) in enumerate(others)]
    h += [(f"x{i}", f"{f} {s}", y, nat, land, None, "k") for i, (f, s, y, nat, land) in enumerate(others)]
    artists, houses = spark.createDataFrame(a, ARTISTS), spark.createDataFrame(h, HOUSES)
    pairs, m, n = K.artist_listing_links(artists, houses)
    assert pairs.filter("a_id.platform_artist_id like 'a%' and b_id.house_artist_id like 'h%'").count() == 1
    assert m.count() == len(a) and n.count() == len(h)
    assert K.matches(artists, houses).filter("platform_artist_id like 'a%'").count() == 60 * 50


@pytest.mark.parametrize("rare", [64, 5])
def test_every_related_pair_is_a_candidate_however_frequent_its_tokens(spark, monkeypatch, rare):
    # Smith, Johannes, Smit and Anna are borne by more than five; no listing has a year.
    monkeypatch.setattr(K, "RARE", rare)
    names = ["Johannes Smith", "Anna Smith", "J. Smith", "Johannes Smit", "Anna Smit", "Smith Smith"] + [f"{g} Smith" for g in ("Bea", "Cleo", "Dora", "Emil")] + [f"Johannes {s}" for s in ("Kolb", "Lund", "Marr", "Nowak")] + [f"{g} Smit" for g in ("Finn", "Gus", "Hugo", "Iris")] + [f"Anna {s}" for s in ("Orth", "Pohl", "Quint", "Roth")]
    listed = ["J. Smith", "Johanes Smith", "Johannes Smth", "Johannes Smith", "Johannes Smit", "Jhoannes Smith", "Johannes B. Smith", "Anna Smyth", "Anna Smith", "S. Smith", "Smith Smit", "Johannes"]
    profile = "id string, tokens array<string>, year int"
    a = spark.createDataFrame([(n, K.name_tokens(n), 1950) for n in names], profile)
    b = spark.createDataFrame([(n, K.name_tokens(n), None) for n in listed], profile)
    want = {(x, y) for x in names for y in listed if K.name_relation(K.name_tokens(x), K.name_tokens(y)) != "other"}
    got = [(r.a_id, r.b_id) for r in K.candidates(a, b).collect()]
    assert {("Johannes Smith", n) for n in ("J. Smith", "Johanes Smith", "Johannes Smth")} | {("Smith Smith", "Smith Smit")} <= want
    assert want <= set(got) and len(got) == len(set(got))
    if rare == 5:
        assert ("Anna Smith", "Johanes Smith") not in got  # no initial, nothing but a frequent token


@pytest.mark.parametrize("n", [400, 4_000, 40_000])
def test_recall_of_slips_does_not_fall_with_size(spark, n):
    # Eight given names and four surnames; the listings have a slip of one letter or an initial, and no year.
    from pyspark.sql import functions as F

    given, surnames = ["johannes", "margareta", "theodor", "katharina", "sebastian", "elisabeth", "cornelius", "magdalena"], ["lindqvist", "hartmann", "vandenberg", "moreau"]
    pick = lambda words, i: F.get(F.array(*map(F.lit, words)), i.cast("int"))
    i = F.col("i")
    named = spark.range(n).withColumnRenamed("id", "i").select(F.concat(F.lit("a"), i).alias("id"), pick(given, i % 8).alias("g"), pick(surnames, F.floor(i / 8) % 4).alias("s"), (F.lit(1800) + F.floor(i / 32) % 200).cast("int").alias("year"))
    artists = named.select("id", F.array_sort(F.array("g", "s")).alias("tokens"), "year", F.concat_ws(" ", "g", "s").alias("name"))
    listed = [(f"{g} {s} {k}", f"{g} {s}", sorted(t)) for g in given for s in surnames for k, t in (("lost", [g, s[:2] + s[3:]]), ("swap", [g[0] + g[2] + g[1] + g[3:], s]), ("initial", [g[0], s]))]
    houses = spark.createDataFrame([(i, t, None) for i, _, t in listed], "id string, tokens array<string>, year int")
    found = K.candidates(artists.drop("name"), houses)
    right = found.join(artists.select(F.col("id").alias("a_id"), "name"), "a_id").filter(F.col("b_id").startswith(F.col("name")))
    assert right.count() == 3 * n  # every artist with the three listings of its name
    assert found.count() <= 12 * n
