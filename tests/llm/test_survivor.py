from pyspark.sql import functions as F

from vernissage.llm import survivor

from ..conftest import rows, utc

S = "platform_name string, platform_artist_id string, crawl_date string, full_name string, birth_year smallint, city string, crawled_at timestamp, source_file string"
KEYS = ["platform_name", "platform_artist_id", "crawl_date"]


def row(at, src, name=None, year=None, city=None, key="1"):
    return ("p", key, "d", name, year, city, utc(2025, 1, at) if at else None, src)


def find(spark, *data):
    df = survivor.artist_rows(spark.createDataFrame(list(data), S).withColumn("crawl_date", F.col("crawl_date")), ["full_name", "birth_year", "city"])
    got = survivor.survivors(df, KEYS, ["full_name", "birth_year", "city"], ["crawled_at", "source_file"])
    return got, rows(survivor.chosen_sources(got, KEYS, ["full_name", "birth_year", "city"]), "platform_artist_id", "field_name", "source_file")


def test_newest_usable_value_field_by_field(spark):
    _, got = find(spark, row(1, "a", "Ann", 1950, "Lyon"), row(3, "c", "N/A", 0, "  "), row(2, "b", None, 1951, None), row(None, "z", "Zoe", 1900, "Rome"))
    assert got == [("1", "birth_year", "b"), ("1", "city", "a"), ("1", "full_name", "a")]


def test_ties_copies_and_singles(spark):
    _, got = find(spark, row(1, "a", "A"), row(1, "b", "B"), row(1, "a", "A", key="2"), row(1, "a", "A", key="2"), row(1, "a", "A", key="3"), row(1, "a", None, key=None))
    assert got == [("1", "full_name", "b"), ("2", "full_name", "a")]
    full, got = find(spark, row(1, "a"), row(2, "b", "-"))
    assert got == [] and full.first().n_rows == 2 and full.first().city is None


def test_quality_model_recovers_good_and_bad_sources(spark):
    import random

    rnd = random.Random(1)
    data = []
    for e in range(300):
        truth = f"t{e}"
        for s, good in (("a", 0.95), ("b", 0.9), ("c", 0.85), ("bad", 0.2)):
            data.append((f"e{e}", s, truth if rnd.random() < good else f"w{rnd.randrange(3)}"))
    df = spark.createDataFrame(data, "e string, s string, v string")
    judged, quality = survivor.value_quality(df, ["e"], ["v"], F.col("s"))
    q = {r.source: r for r in quality.collect()}
    assert q["bad"].sensitivity < 0.4 < 0.75 < min(q[s].sensitivity for s in "abc") and q["bad"].specificity < q["a"].specificity
    right = judged.filter(F.col("value") == F.concat(F.lit("t"), F.substring("e", 2, 9)))
    assert right.filter("retained").count() > 0.97 * right.count()
    wrong = judged.filter("value like 'w%'")
    # Values do not exclude each other: what one good source alone states may be kept.
    assert wrong.filter("retained").count() < 0.25 * wrong.count()


def test_quality_model_keeps_several_true_values(spark):
    data = [(f"e{i}", s, v) for i in range(50) for s in ("a", "b") for v in (f"x{i}", f"y{i}")] + [(f"e{i}", "c", f"z{i}") for i in range(50)]
    df = spark.createDataFrame(data, "e string, s string, v string")
    judged, _ = survivor.value_quality(df, ["e"], ["v"], F.col("s"))
    kept = judged.filter("retained").groupBy("e").count()
    assert kept.filter("count >= 2").count() == 50
    assert survivor.value_quality(df.filter("false"), ["e"], ["v"], F.col("s"))[0].count() == 0


def test_quality_model_judges_long_values_whole(spark):
    bio, other = "Born in Lyon. " * 40, "Born in Lyon. " * 40 + "x"
    data = [(f"e{i}", s, v) for i in range(20) for s, v in (("a", bio), ("b", bio), ("c", other))] + [("short", "a", "x" * survivor.LONG), ("short", "b", "x" * (survivor.LONG + 1))]
    judged = survivor.value_quality(spark.createDataFrame(data, "e string, s string, v string"), ["e"], ["v"], F.col("s"))[0].collect()
    assert len(judged) == 42 and {(r.value, r.n_witnesses) for r in judged if r.e != "short"} == {(bio.strip().lower(), 2), (other.lower(), 1)}
    assert {r.value for r in judged if r.e == "short"} == {"x" * survivor.LONG, "x" * (survivor.LONG + 1)}


def test_every_field_is_judged_and_survives(spark):
    from vernissage.llm.queries import QUERIES

    from ..conftest import SF

    assert {r.field_name for r in QUERIES["p2_value_quality"](spark, SF).select("field_name").distinct().collect()} == set(survivor.ARTIST_FIELDS)
    records = QUERIES["p2_records"](spark, SF)
    assert set(survivor.ARTIST_FIELDS) < set(records.columns) and records.filter("biography is not null").count() > 0


def brute_quality(data, iterations):
    """The model with plain dictionaries: data are (group, source, witness, value)."""
    import math
    from collections import defaultdict

    present, said = defaultdict(lambda: defaultdict(set)), defaultdict(lambda: defaultdict(set))
    for g, s, w, v in data:
        present[g][s].add(w)
        said[g, v][s].add(w)
    cases = {(g, v): [(s, len(by.get(s, ())), len(there) - len(by.get(s, ()))) for s, there in present[g].items()] for (g, v), by in said.items()}
    clip = lambda x: 1 / (1 + math.exp(-max(-30, min(30, x))))
    p = {k: clip(math.log((sum(a for _, a, _ in c) + 0.5) / (sum(b for *_, b in c) + 0.5))) for k, c in cases.items()}
    for _ in range(iterations):
        sums = defaultdict(lambda: [0.0] * 4)
        for k, c in cases.items():
            for s, a, b in c:
                for i, x in enumerate((p[k] * a, p[k] * (a + b), (1 - p[k]) * b, (1 - p[k]) * (a + b))):
                    sums[s][i] += x
        se, sp = ({s: (x[i] + 1) / (x[i + 1] + 2) for s, x in sums.items()} for i in (0, 2))
        share = min(0.99, max(0.01, sum(p.values()) / len(p)))
        p = {k: clip(math.log(share / (1 - share)) + sum(a * math.log(se[s] / (1 - sp[s])) + b * math.log((1 - se[s]) / sp[s]) for s, a, b in c)) for k, c in cases.items()}
    return p


def test_quality_model_against_brute_force(spark):
    import random

    rnd = random.Random(7)
    data = [(f"g{rnd.randrange(12)}", f"s{rnd.randrange(4)}", f"w{rnd.randrange(5)}", f"v{rnd.randrange(3)}") for _ in range(150)]
    df = spark.createDataFrame([*data, *data[:20], ("g1", None, "w", "v1"), ("g1", "s1", "w", "N/A")], "e string, s string, w string, v string")
    judged, _ = survivor.value_quality(df, ["e"], ["v"], F.col("s"), F.col("w"), iterations=4)
    want = brute_quality(data, 4)
    got = {(r.e, r.value): r.posterior for r in judged.collect()}
    assert got.keys() == want.keys() and max(abs(got[k] - want[k]) for k in got) < 1e-6


def test_a_hot_group_and_many_sources(spark, monkeypatch):
    # A third of all rows in one group, and more patterns than are broadcast.
    data = [("hot", f"s{i % 50}", f"w{i}", "a" if i % 3 else f"b{i % 7}") for i in range(3000)] + [(f"e{i}", f"s{i % 90}", f"w{j}", f"v{j}") for i in range(300) for j in range(2)]
    df = spark.createDataFrame(data, "e string, s string, w string, v string")
    whole = rows(survivor.value_quality(df, ["e"], ["v"], F.col("s"), F.col("w"), iterations=2)[0].withColumn("posterior", F.round("posterior", 6)))
    monkeypatch.setattr(survivor, "BROADCAST_PATTERNS", 0)
    assert rows(survivor.value_quality(df, ["e"], ["v"], F.col("s"), F.col("w"), iterations=2)[0].withColumn("posterior", F.round("posterior", 6))) == whole
    assert [r for r in whole if r[0] == "hot" and r[2] == "a"][0][3] == 2000


def test_rule_and_model_are_compared_case_by_case(spark):
    data = [("p", "1", "d", "Ann", None, None, utc(2025, 1, d), f"f{d}") for d in (1, 2, 3)] + [("p", "1", "d", "Bea", None, None, utc(2025, 1, 9), "f9")]
    got = survivor.rule_and_model(
        survivor.artist_rows(spark.createDataFrame(data, S), ["full_name"]), KEYS, ["full_name"],
        spark.createDataFrame([("p", "1", "d", "full_name", "ann", 0.9, True), ("p", "1", "d", "full_name", "bea", 0.2, False)], "platform_name string, platform_artist_id string, crawl_date string, field_name string, value string, posterior double, retained boolean"),
        ["crawled_at", "source_file"],
    )
    assert rows(got) == [("full_name", 2, 1, 0, 0)]
