"""Argmax de-duplication: one row per key by an order in which nulls are last.

``winners`` keeps whole rows by one ``max`` over a struct, which Spark combines
map-side: a hot key costs one row per task. Ties are broken by the rest of the
row, so results do not depend on partitioning. ``first_rows`` is the variant
that keeps the first row by an explicit position.

Defined cases: rows whose key is null or empty are returned by ``rejects`` and
never win; empty inputs give empty results; exact copies count once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class SortField:
    name: str
    descending: bool = True

    def rank(self, df: DataFrame) -> Column:
        """Column whose maximum wins; null ranks below every value in either direction."""
        c = F.col(self.name)
        if self.descending:
            return c
        kind = df.schema[self.name].dataType
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            return -F.unix_micros(c.cast("timestamp"))
        if isinstance(kind, T.DateType):
            return -F.unix_date(c)
        if isinstance(kind, T.BooleanType):
            return ~c
        if isinstance(kind, T.StringType):
            # Complemented code points with a high end mark order texts the other way round.
            return F.concat(F.translate(F.hex(c.cast("binary")), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("~"))
        return -c


def _key(keys: Sequence[str]) -> Column:
    ok = F.lit(True)
    for k in keys:
        ok = ok & F.col(k).isNotNull() & (F.col(k).cast("string") != "")
    return ok


def _comparable(kind: T.DataType) -> bool:
    if isinstance(kind, (T.MapType, T.VariantType)):
        return False
    if isinstance(kind, T.ArrayType):
        return _comparable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_comparable(f.dataType) for f in kind.fields)
    return True


def winners(df: DataFrame, keys: Sequence[str], order: Sequence[SortField]) -> DataFrame:
    """The best row of each key."""
    rest = [c for c in df.columns if c not in keys]
    rank = [s.rank(df).alias(f"_r{i}") for i, s in enumerate(order)]
    good = df.filter(_key(keys))
    plain = [c for c in rest if _comparable(df.schema[c].dataType)]
    if len(plain) == len(rest):
        best = F.max(F.struct(*rank, F.struct(*rest).alias("_row") if rest else F.lit(0).alias("_row"))).alias("_b")
        take = [F.col(f"_b._row.{c}").alias(c) for c in rest]
    else:
        # Maps and variants have no order: they follow the winner of the comparable columns.
        best = F.max_by(F.struct(*rest), F.struct(*rank, *plain)).alias("_b")
        take = [F.col(f"_b.{c}").alias(c) for c in rest]
    return good.groupBy(*keys).agg(best).select(*keys, *take).select(*df.columns)


def rejects(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.filter(~_key(keys))


def first_rows(df: DataFrame, keys: Sequence[str], position: str) -> DataFrame:
    """The row with the least position of each key."""
    return winners(df, keys, [SortField(position, descending=False)])


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows per key; Spark limits each partition's groups before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def latest_and_canonical(df: DataFrame, keys: Sequence[str], at: str, url: str, score: Column) -> DataFrame:
    """Newest time and most canonical address of each key, chosen independently, with first and last seen."""
    best = F.max(F.struct(score.alias("s"), F.col(url).alias("url")))["url"]
    return df.filter(_key(keys)).groupBy(*keys).agg(F.max(at).alias("last_seen"), F.min(at).alias("first_seen"), best.alias(url), F.count("*").alias("n_rows"))


def priority_union(sources: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Rows of sources in order of trust: a key is taken from the first source that has it."""
    parts = [s.withColumn("_source", F.lit(i)) for i, s in enumerate(sources)]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p, allowMissingColumns=True)
    return winners(rows, keys, [SortField("_source", descending=False)]).withColumnRenamed("_source", "source_rank")
