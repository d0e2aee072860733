"""Positions and sliding windows within groups of any size.

A window function over a group sorts the group in one task. Here rows are
sorted by ranges of the whole order instead, so that a group with a third of all
rows is spread over many tasks; a row's position is its place in its range plus
the rows of its group in the ranges before, which is a table of one row per group
and range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vernissage.session import checkpoint


def positions(df: DataFrame, by: Sequence[str], order: Sequence[Column], out: str = "position") -> DataFrame:
    """Adds each row's position in its group, from 1; rows that tie have any order among themselves.

    The ranges are written once: they are drawn from a sample and would not be
    the same when a lost task is run again.
    """
    ranged = checkpoint(df.repartitionByRange(*[F.col(c) for c in by], *order).withColumn("_range", F.spark_partition_id()))
    sizes = ranged.groupBy(*by, "_range").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*by).orderBy("_range")) - F.col("_n")
    offsets = sizes.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(by)], F.col("_range").alias("_r"), before.alias("_before"))
    same = F.col("_range") == F.col("_r")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_k{i}"))
    within = F.row_number().over(Window.partitionBy(*by, "_range").orderBy(*order))
    placed = ranged.withColumn("_within", within).join(offsets, same)
    return placed.select(*df.columns, (F.col("_before") + F.col("_within")).alias(out))


def sliding(df: DataFrame, by: Sequence[str], order: Sequence[Column], rows: int, block: int = 100_000, **aggs: Column) -> DataFrame:
    """Adds aggregates over the last ``rows`` rows of each group, in blocks of positions.

    Each block also holds the ``rows - 1`` rows before it, so that no window is cut.
    """
    size = max(block, rows)
    placed = positions(df, by, order, "_position")
    at = F.floor((F.col("_position") - 1) / size)
    late = F.pmod(F.col("_position") - 1, F.lit(size)) >= size - (rows - 1)
    blocks = placed.withColumn("_block", F.explode(F.when(late, F.array(at, at + 1)).otherwise(F.array(at)))).withColumn("_own", F.col("_block") == at)
    w = Window.partitionBy(*by, "_block").orderBy("_position").rowsBetween(-(rows - 1), 0)
    return blocks.select("*", *[c.over(w).alias(n) for n, c in aggs.items()]).filter("_own").drop("_position", "_block", "_own")
