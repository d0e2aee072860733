"""Parts of an index whose searches show a bounded number of hits.

A search shows at most ``cap`` hits. A part that has more is split by the
facets in order, each into its commonest values and the rest, or by the halves
of a range of numbers. Parts are counted on histograms of the attributes, whose
size is that of the attributes and not of the data.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def range_clause(attribute: str, low: Column, high: Column) -> Column:
    """``attribute:low TO high`` for the whole numbers from ``low`` to before ``high``."""
    return F.concat(F.lit(f"{attribute}:"), low.cast("string"), F.lit(" TO "), (high - 1).cast("string"))


def facet_clause(attribute: str, value: Column) -> Column:
    """``attribute:"value"`` with marks and backslashes escaped."""
    return F.concat(F.lit(f'{attribute}:"'), F.replace(F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))


def facet_parts(df: DataFrame, facets: Sequence[str], cap: int, most: int = 50) -> DataFrame:
    """``part, n, fits`` of the parts a collection falls into, ``part`` being their filter.

    A part that does not fit is split by the next facet: one part for each of
    its ``most`` commonest values, one for all others and rows without a value. A
    facet all of whose rows have one value does not split. What still does not
    fit after the last facet is marked.
    """
    keys = [F.coalesce(F.col(f).cast("string"), F.lit("")).alias(f) for f in facets]
    # Rows with equal facets move together: the collection is counted once.
    rows = df.select(*keys).groupBy(*facets).agg(F.count("*").alias("n")).withColumn("part", F.lit(""))
    whole = Window.partitionBy("part")
    for f in facets:
        values = rows.groupBy("part", f).agg(F.sum("n").alias("v"))
        values = values.withColumn("total", F.sum("v").over(whole)).withColumn("kinds", F.count("*").over(whole))
        values = values.withColumn("rank", F.row_number().over(whole.orderBy(F.desc("v"), f)))
        splits = (F.col("total") > cap) & (F.col("kinds") > 1)
        named = (F.col("rank") <= most) & (F.col(f) != "")
        term = F.when(named, facet_clause(f, F.col(f))).otherwise(F.lit(f"NOT {f}:common"))
        step = values.select("part", f, F.when(splits, F.concat_ws(" AND ", F.nullif("part", F.lit("")), term)).otherwise(F.col("part")).alias("_next"))
        rows = rows.join(step, ["part", f]).drop("part").withColumnRenamed("_next", "part")
    return rows.groupBy("part").agg(F.sum("n").alias("n")).withColumn("fits", F.col("n") <= cap)


def range_parts(df: DataFrame, by: Sequence[str], value: str, cap: int) -> DataFrame:
    """``by…, lo, hi, n, fits``: ranges of whole numbers, halved until they fit or hold one number.

    Empty ranges are left out. Each group's first range is from its least to its
    greatest number.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, F.col(value).cast("bigint").alias("v")).agg(F.count("*").alias("n"))
    fields = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in by)

    def halved(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("v")
        v, total = pdf["v"].to_numpy(), [0, *pdf["n"].cumsum()]
        key, out, todo = [pdf[c].iloc[0] for c in by], [], [(int(v[0]), int(v[-1]) + 1)]
        while todo:
            lo, hi = todo.pop()
            a, b = v.searchsorted([lo, hi])
            n = int(total[b] - total[a])
            if n and (n <= cap or hi - lo == 1):
                out.append((*key, lo, hi, n, n <= cap))
            elif n:
                mid = (lo + hi) // 2
                todo += [(mid, hi), (lo, mid)]
        return pd.DataFrame(out, columns=[*by, "lo", "hi", "n", "fits"])

    return counts.groupBy(*by).applyInPandas(halved, f"{fields}, lo bigint, hi bigint, n bigint, fits boolean")


def collected(parts: DataFrame, hits: DataFrame, part: str, key: Sequence[str], cap: int) -> DataFrame:
    """Per part the hits expected and seen and whether it is whole: ``ok``, ``unsplittable`` or ``count_mismatch``."""
    seen = hits.select(part, *key).distinct().groupBy(part).agg(F.count("*").alias("seen"))
    j = parts.join(seen, part, "left").withColumn("seen", F.coalesce("seen", F.lit(0)))
    return j.withColumn("status", F.when(F.col("n") > cap, "unsplittable").when(F.col("seen") != F.col("n"), "count_mismatch").otherwise("ok"))


def any_of(attribute: str, values: Iterable[str]) -> str:
    """A filter for any of some ids, each once and digits only, in order."""
    return " OR ".join(f"{attribute}:{v}" for v in dict.fromkeys(values) if v.isdigit())
