"""Splitting a collection into ranges that each stay within a budget.

Ranges are planned on a histogram, whose size is that of the axis and not of
the data. The greedy cut is sequential by nature; it runs as a fold over the
sorted histogram of each group inside the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def plan_ranges(counts: DataFrame, by: Sequence[str], value: str, n: str, budget: int) -> DataFrame:
    """Half-open ranges ``lo, hi`` of values with at most ``budget`` rows each.

    A value that alone reaches the budget gets a range of its own. ``counts``
    has one row per group and value (integers).
    """
    # In number, type and order: the fold keeps closed ranges and the open one.
    kind = "struct<done:array<struct<lo:bigint,hi:bigint,n:bigint>>,lo:bigint,n:bigint>"
    packed = counts.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(F.col(value).cast("bigint").alias("v"), F.col(n).cast("bigint").alias("n")))).alias("h"))
    empty = F.struct(F.array().cast("array<struct<lo:bigint,hi:bigint,n:bigint>>").alias("done"), F.lit(None).cast("bigint").alias("lo"), F.lit(0).cast("bigint").alias("n")).cast(kind)

    def close(acc: Column, hi: Column) -> Column:
        return F.when(acc["lo"].isNotNull(), F.array_append(acc["done"], F.struct(acc["lo"].alias("lo"), hi.alias("hi"), acc["n"].alias("n")))).otherwise(acc["done"])

    def step(acc: Column, x: Column) -> Column:
        alone = F.struct(F.array_append(close(acc, x["v"]), F.struct(x["v"].alias("lo"), (x["v"] + 1).alias("hi"), x["n"].alias("n"))).alias("done"), F.lit(None).cast("bigint").alias("lo"), F.lit(0).cast("bigint").alias("n")).cast(kind)
        fresh = F.struct(close(acc, x["v"]).alias("done"), x["v"].alias("lo"), x["n"].alias("n")).cast(kind)
        more = F.struct(acc["done"].alias("done"), F.coalesce(acc["lo"], x["v"]).alias("lo"), (acc["n"] + x["n"]).alias("n")).cast(kind)
        return F.when(x["n"] >= budget, alone).when(acc["n"] + x["n"] > budget, fresh).otherwise(more)

    folded = packed.select(*by, F.aggregate("h", empty, step).alias("f"), F.element_at("h", -1)["v"].alias("last"))
    return folded.select(*by, F.inline(close(F.col("f"), F.col("last") + 1)))


def split_facets(df: DataFrame, ladder: Sequence[str], cap: int) -> DataFrame:
    """Groups of at most ``cap`` rows, by the first columns of the ladder that suffice.

    One rollup counts all levels; a group is taken where it fits and its parent
    does not. Groups that do not fit at the last level are marked.
    """
    levels = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ladder]
    counts = df.select(*levels).rollup(*ladder).agg(F.count("*").alias("n"), F.grouping_id().alias("g"))
    depth = len(ladder) - F.bit_count("g")
    c = counts.withColumn("depth", depth)
    parents = c.select(*[F.col(x).alias(f"p_{x}") for x in ladder], F.col("n").alias("parent_n"), (F.col("depth") + 1).alias("depth"))
    same = None
    for i, x in enumerate(ladder):
        term = F.when(F.col("depth") > i + 1, F.col(x).eqNullSafe(F.col(f"p_{x}"))).otherwise(F.col(f"p_{x}").isNull())
        same = term if same is None else same & term
    key = F.concat_ws("\t", *[F.when(F.col("depth") > i + 1, F.col(x)) for i, x in enumerate(ladder)])
    pkey = F.concat_ws("\t", *[F.when(F.col("depth") > i + 1, F.col(f"p_{x}")) for i, x in enumerate(ladder)])
    j = c.withColumn("_k", key).join(parents.withColumn("_k", pkey), ["depth", "_k"], "left")
    last = F.col("depth") == len(ladder)
    fits = F.col("n") <= cap
    return j.filter((fits | last) & (F.col("parent_n").isNull() | (F.col("parent_n") > cap))).select(*ladder, "depth", "n", fits.alias("fits"))


def month_windows(start: str, end: str, spark, settled_before: str | None = None) -> DataFrame:
    """Calendar months ``lo, hi`` (half-open) that meet a period; ``settled`` if over long enough."""
    m = spark.range(1).select(F.explode(F.sequence(F.trunc(F.lit(start).cast("date"), "month"), F.lit(end).cast("date"), F.expr("interval 1 month"))).alias("lo"))
    m = m.withColumn("hi", F.add_months("lo", 1))
    return m.withColumn("settled", F.col("hi") <= F.lit(settled_before).cast("date") if settled_before else F.lit(None).cast("boolean"))


def monthly(day: Column, month_start: Column) -> Column:
    """The given day of a month, or its last one if the month is shorter."""
    return F.date_add(month_start, (F.least(day, F.dayofmonth(F.last_day(month_start))) - 1).cast("int"))


def line_chunks(df: DataFrame, column: str, rows: int, path: str) -> None:
    """Writes one value per line in files of at most ``rows`` lines."""
    df.select(F.col(column).cast("string").alias("value")).filter("value is not null").write.mode("overwrite").option("maxRecordsPerFile", rows).text(path)


def fill_ranges(df: DataFrame, by: Sequence[str], number: str, expected: str) -> DataFrame:
    """Numbers of each group: the whole range where its ends and expected size say it has no gap, else those seen."""
    per = df.groupBy(*by).agg(F.min(number).alias("lo"), F.max(number).alias("hi"), F.max(expected).alias("size"))
    whole = per.filter(F.col("hi") - F.col("lo") + 1 == F.col("size")).select(*by, F.explode(F.sequence("lo", "hi")).alias(number))
    rest = df.join(whole.select(*by).distinct(), list(by), "left_anti").select(*by, number).distinct()
    return whole.unionByName(rest)


def walked_pages(pages: DataFrame, by: Sequence[str], page: str, n_items: str, size: int, empty_streak: int = 2, ceiling: int | None = None) -> DataFrame:
    """Pages of a listing that are read, with ``stop``: why the walk ends at its last page, else null.

    A walk ends at the first page that is ``short`` (fewer items than ``size``,
    but some), at the last of ``empty_streak`` empty pages in a row (``empty``),
    or at the ``ceiling``. Pages are numbered from 1 without gaps.
    """
    w = Window.partitionBy(*by).orderBy(page)
    n = F.coalesce(F.col(n_items), F.lit(0))
    empty = F.sum(F.when(n == 0, 1).otherwise(0)).over(w.rowsBetween(-(empty_streak - 1), 0)) == empty_streak
    why = F.when(empty, "empty").when((n > 0) & (n < size), "short")
    if ceiling is not None:
        why = F.coalesce(why, F.when(F.col(page) >= ceiling, "ceiling"))
    ends = pages.withColumn("stop", why)
    last = F.min(F.when(F.col("stop").isNotNull(), F.col(page))).over(Window.partitionBy(*by))
    return ends.withColumn("_last", last).filter(F.col("_last").isNull() | (F.col(page) <= F.col("_last"))).drop("_last")
