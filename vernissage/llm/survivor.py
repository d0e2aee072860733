"""Best representative of each group of duplicate records, field by field.

Two parts, which a caller may combine:

* ``survivors`` builds one record per group. Each field comes from the row that
  ranks highest among the rows where the field is usable. It is one map-side
  combined aggregation, so a group with a third of all rows costs one partial
  row per task.
* ``value_quality`` is a latent two-sided quality model. Each distinct value of
  a field in a group is true or false; a witness (a page, a file) of the group
  that fills the field either states the value or does not. Witnesses belong to
  sources, whose sensitivity (states a true value) and specificity (does not
  state a false one) are inferred by expectation-maximisation. Since the values
  are judged one by one, a field may keep several values judged true.

Defined cases: null, blank and placeholder values and the year 0 are never
chosen; a group without a usable value has null (no row in ``chosen_sources``);
a single row is its own survivor; among rows with equal rank the greatest value
wins; repeated rows count once as evidence; rows without a key or a source are
ignored; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vernissage.functions.text import clean_id, clean_line, usable, usable_year
from vernissage.session import checkpoint

#: The fields of an artist's record that are chosen one by one.
ARTIST_FIELDS = ("full_name", "birth_year", "nationality", "country", "city", "biography")

#: Characters from which on the quality model keys a value by a hash and joins the text at the end.
LONG = 64

#: Patterns of evidence that are broadcast at most; more are joined by shuffle, spread over ``SALT`` parts.
BROADCAST_PATTERNS, SALT = 200_000, 64


def is_usable(df: DataFrame, field: str) -> Column:
    if isinstance(df.schema[field].dataType, T.NumericType):
        return usable_year(field)
    return usable(F.col(field).cast("string"))


def survivors(df: DataFrame, keys: Sequence[str], fields: Sequence[str], rank: Sequence[str | Column], extra: str = "source_file", with_values: bool = True) -> DataFrame:
    """``keys…, n_rows`` and for each field a struct ``(extra, value)`` of the row it is taken from."""
    order = [F.col(r) if isinstance(r, str) else r for r in rank]

    def chosen(f: str) -> Column:
        parts = [o.alias(f"r{i}") for i, o in enumerate(order)] + [F.col(extra).alias("extra")] + ([F.col(f).alias("value")] if with_values else [])
        return F.max(F.when(is_usable(df, f), F.struct(*parts))).alias(f)

    found = df.groupBy(*keys).agg(F.count("*").alias("n_rows"), *[chosen(f) for f in fields])
    take = lambda f: F.when(F.col(f).isNotNull(), F.struct(F.col(f)["extra"].alias(extra), *([F.col(f)["value"].alias("value")] if with_values else []))).alias(f)
    return found.select(*keys, "n_rows", *[take(f) for f in fields])


def chosen_sources(found: DataFrame, keys: Sequence[str], fields: Sequence[str], extra: str = "source_file") -> DataFrame:
    """Survivors of groups of two or more rows, unpivoted: ``keys…, field_name, source_file``."""
    each = F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f)[extra].alias(extra), F.col(f).isNotNull().alias("there")) for f in fields])
    return found.filter("n_rows > 1").select(*keys, F.inline(each)).filter("there").drop("there")


def artist_rows(artists: DataFrame, fields: Sequence[str] = ARTIST_FIELDS) -> DataFrame:
    cols = dict.fromkeys(["platform_name", "crawl_date", "crawled_at", "source_file", *fields])
    return artists.select(clean_id("platform_artist_id").alias("platform_artist_id"), *cols).filter("platform_artist_id is not null")


def evidence(df: DataFrame, keys: Sequence[str], fields: Sequence[str], source: Column, witness: Column) -> DataFrame:
    """``keys…, field_name, value, n_witnesses, cases, pattern`` of every distinct value of every group.

    ``cases`` holds ``(source, said, silent)``: how many witnesses of a source
    state the value, and how many fill the field with other values only. Only
    counts per source are collected, so that a group of any size is one short
    array per value.
    """
    each = F.array(*[F.struct(F.lit(f).alias("field_name"), F.when(is_usable(df, f), F.lower(clean_line(F.col(f).cast("string")))).alias("value")) for f in fields])
    long = df.select(*keys, source.alias("source"), F.xxhash64(witness).alias("witness"), F.inline(each)).filter("source is not null and value is not null and value <> ''")
    # A short value cannot equal the key of a long one, which has more than LONG characters.
    keyed = long.withColumn("key", F.when(F.length("value") > LONG, F.concat(F.lit("sha256:"), F.sha2("value", 256))).otherwise(F.col("value")))
    group = [*keys, "field_name"]
    said = keyed.groupBy(*group, "key", "source").agg(F.countDistinct("witness").alias("said"), F.max("value").alias("value"))
    present = keyed.groupBy(*group, "source").agg(F.countDistinct("witness").alias("there"))
    present = present.groupBy(*group).agg(F.map_from_entries(F.collect_list(F.struct("source", "there"))).alias("present"))
    stated = said.groupBy(*group, "key").agg(F.max("value").alias("value"), F.map_from_entries(F.collect_list(F.struct("source", "said"))).alias("said"))

    def case(s: Column) -> Column:
        n = F.coalesce(F.try_element_at("said", s), F.lit(0))
        return F.struct(s.alias("source"), n.alias("said"), (F.try_element_at("present", s) - n).alias("silent"))

    found = stated.join(present, group).withColumn("cases", F.transform(F.array_sort(F.map_keys("present")), case))
    n = F.aggregate("cases", F.lit(0).cast("bigint"), lambda acc, c: acc + c["said"])
    return found.select(*group, "value", n.alias("n_witnesses"), "cases", F.md5(F.concat_ws("|", "field_name", F.to_json("cases"))).alias("pattern"))


def value_quality(
    df: DataFrame, keys: Sequence[str], fields: Sequence[str], source: Column, witness: Column | None = None, iterations: int = 12, keep: float = 0.5
) -> tuple[DataFrame, DataFrame]:
    """Posterior truth of every value, and the quality of every source and field.

    Returns ``(keys…, field_name, value, n_witnesses, posterior, retained)`` and
    ``(field_name, source, sensitivity, specificity)``. ``source`` names whose
    parameters a row shares, ``witness`` what counts as one voice (by default
    the source itself). The steps work on distinct patterns of evidence with
    their counts; an iteration is one job over that table and keeps the
    parameters in a table, so that neither groups nor sources are bounded.
    """
    found = checkpoint(evidence(df, keys, fields, source, source if witness is None else witness))
    patterns = found.groupBy("pattern", "field_name").agg(F.first("cases").alias("cases"), F.count("*").alias("n"))
    # The share of true values is the parameter of one more source, without a name, that always speaks.
    prior = F.struct(F.lit("").alias("source"), F.lit(1).cast("bigint").alias("said"), F.lit(0).cast("bigint").alias("silent"))
    named = F.transform("cases", lambda c: F.struct(F.concat(F.lit("="), c["source"]).alias("source"), c["said"].alias("said"), c["silent"].alias("silent")))
    cases = checkpoint(patterns.select("pattern", "field_name", "n", F.inline(F.array_append(named, prior))))
    whole = Window.partitionBy("pattern")

    def maximised(judged: DataFrame) -> DataFrame:
        """Log-odds a statement and a silence of each source are worth, from values judged with ``p``."""
        t, f = F.col("n") * F.col("p"), F.col("n") * (1 - F.col("p"))
        sums = judged.groupBy("field_name", "source").agg(F.sum(t * F.col("said")).alias("tp"), F.sum(t * (F.col("said") + F.col("silent"))).alias("t"), F.sum(f * F.col("silent")).alias("tn"), F.sum(f * (F.col("said") + F.col("silent"))).alias("f"))
        # One case of each kind is added, so that no parameter reaches 0 or 1.
        rated = sums.withColumn("sensitivity", (F.col("tp") + 1) / (F.col("t") + 2)).withColumn("specificity", (F.col("tn") + 1) / (F.col("f") + 2))
        share = F.greatest(F.lit(0.01), F.least(F.lit(0.99), F.col("t") / (F.col("t") + F.col("f"))))
        se, sp = F.col("sensitivity"), F.col("specificity")
        spoken = F.when(F.col("source") == "", F.ln(share / (1 - share))).otherwise(F.ln(se / (1 - sp)))
        return checkpoint(rated.select("field_name", "source", "sensitivity", "specificity", spoken.alias("spoken"), F.ln((1 - se) / sp).alias("silence")))

    # The first guess: a value is true if most witnesses present state it.
    said, silent = (F.sum(F.when(F.col("source") != "", F.col(c)).otherwise(0)).over(whole) for c in ("said", "silent"))
    judged = cases.withColumn("p", _probability(F.ln((said + 0.5) / (silent + 0.5))))
    for _ in range(iterations):
        quality = maximised(judged)
        worth = cases.join(quality.select("field_name", "source", "spoken", "silence"), ["field_name", "source"])
        judged = worth.withColumn("p", _probability(F.sum(F.col("said") * F.col("spoken") + F.col("silent") * F.col("silence")).over(whole)))
    posterior = checkpoint(judged.groupBy("pattern").agg(F.max("p").alias("posterior")))
    result = _with_posterior(found, posterior).select(*keys, "field_name", "value", "n_witnesses", "posterior", (F.col("posterior") >= keep).alias("retained"))
    named_quality = quality.filter("source <> ''").select("field_name", F.expr("substring(source, 2)").alias("source"), "sensitivity", "specificity")
    return result, named_quality


def _with_posterior(found: DataFrame, posterior: DataFrame) -> DataFrame:
    """Most groups share a few patterns: they are broadcast, or spread where there are too many."""
    if posterior.count() <= BROADCAST_PATTERNS:
        return found.join(F.broadcast(posterior), "pattern")
    salted = posterior.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    return found.withColumn("_salt", F.pmod(F.xxhash64(*[c for c in found.columns if c != "cases"]), F.lit(SALT)).cast("int")).join(salted, ["pattern", "_salt"]).drop("_salt")


def _probability(odds: Column) -> Column:
    return 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), odds))))


def page_source(rows: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> tuple[DataFrame, Column]:
    """Rows with ``_newest`` (the time of their group's newest row), and what an artist's page is as a source.

    A source is a platform, a kind of page (by how many of the fields it fills)
    and whether the page is the newest of its group or an older one. Each page is
    a witness of its own; pages of one source share their parameters.
    """
    newest = rows.groupBy(*keys).agg(F.max(F.struct("crawled_at", "source_file")).alias("_newest"))
    filled = sum((is_usable(rows, f).cast("int") for f in fields), F.lit(0))
    kind = F.when(filled >= 4, "full").when(filled >= 2, "partial").otherwise("card")
    age = F.when(F.struct("crawled_at", "source_file").eqNullSafe(F.col("_newest")), "newest").otherwise("older")
    return rows.join(newest, list(keys)), F.concat_ws("#", F.col(keys[0]), kind, age)


def rule_and_model(rows: DataFrame, keys: Sequence[str], fields: Sequence[str], judged: DataFrame, rank: Sequence[str]) -> DataFrame:
    """How often the rank's choice is the model's: ``field_name, n_values, cases, same, retained``.

    ``n_values`` is the number of different values (2 stands for two or more),
    ``same`` counts groups in which no value has a higher posterior than the
    ranked one, ``retained`` those in which the model keeps it.
    """
    chosen = survivors(rows, keys, fields, rank)
    picked = chosen.select(*keys, F.inline(F.array(*[F.struct(F.lit(f).alias("field_name"), F.lower(clean_line(F.col(f)["value"].cast("string"))).alias("picked")) for f in fields]))).filter("picked is not null")
    group = [*keys, "field_name"]
    best = judged.join(picked, group).groupBy(*group).agg(F.count("*").alias("n"), F.max("posterior").alias("top"), F.max(F.when(F.col("value") == F.col("picked"), F.col("posterior"))).alias("own"), F.max(F.when(F.col("value") == F.col("picked"), F.col("retained"))).alias("kept"))
    return best.groupBy("field_name", F.least("n", F.lit(2)).alias("n_values")).agg(F.count("*").alias("cases"), F.count_if(F.col("own") >= F.col("top")).alias("same"), F.count_if("kept").alias("retained"))
