"""What changed between full snapshots, by digests of hash ranges.

Rows of a snapshot are put into hash ranges of their key; a range's digest
combines the hashes of its rows, a parent's digest those of its children. Two
snapshots are compared from the root down, and only rows in leaves whose
digests differ are compared one by one. Leaves are chosen by the number of
rows, so that a leaf stays small at any size; parents are built from their
children, level by level. The digests, not the rows, are
what is compared between snapshots: they are a few bytes per leaf.

Defined cases: a null value equals a null value only; rows without a key are
ignored; repeated rows count once (the best row); ties are broken by the
values; empty snapshots and a single snapshot give no change.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vernissage.functions.text import clean_id
from vernissage.operators.observations import LEDGER_BROADCAST_ROWS, best_per_crawl, best_rank, crawls_of
from vernissage.session import broadcast_if_small, checkpoint

#: Rows of one snapshot that share a leaf, on average, and children per inner node (a power of two).
ROWS_PER_LEAF, FAN_OUT = 16, 16
_BITS = FAN_OUT.bit_length() - 1


def consecutive_crawls(crawls: DataFrame, source: str = "platform_name", at: str = "crawl_date") -> DataFrame:
    """Crawls with their number and predecessor: one window over the ledger."""
    w = Window.partitionBy(source).orderBy(at)
    return crawls.select(source, at).distinct().withColumn("seq", F.row_number().over(w)).withColumn("previous", F.lag(at).over(w))


def digest(rows: DataFrame, by: Sequence[str], values: Sequence[str | Column]) -> DataFrame:
    """Order-free digest of rows per group: two independent 64-bit xors and the count."""
    return rows.groupBy(*by).agg(F.bit_xor(F.xxhash64(*values)).alias("_xor"), F.bit_xor(F.xxhash64(F.lit("second"), *values)).alias("_xor2"), F.count("*").alias("_n"))


def levels_for(rows_per_snapshot: int) -> int:
    """Levels below the root; as many as the size asks for, up to all bits of the key's hash."""
    levels, leaves = 0, 1
    while (levels + 1) * _BITS < 64 and leaves * ROWS_PER_LEAF < rows_per_snapshot:
        levels, leaves = levels + 1, leaves * FAN_OUT
    return levels


def merkle_levels(leaves: DataFrame, source: str, levels: int) -> list[DataFrame]:
    """Nodes ``source, seq, _node, _xor, _xor2, _n`` of every level, root first.

    Parents are built from their children, each level from the one below it,
    which is written first: the plan of a level does not hold those below.
    """
    tree = [leaves.select(source, "seq", F.col("_leaf").cast("bigint").alias("_node"), "_xor", "_xor2", "_n")]
    for _ in range(levels):
        parents = tree[0].groupBy(source, "seq", F.shiftright("_node", _BITS).alias("_node"))
        tree.insert(0, checkpoint(parents.agg(F.bit_xor("_xor").alias("_xor"), F.bit_xor("_xor2").alias("_xor2"), F.sum("_n").alias("_n"))))
    return tree


def differing_nodes(nodes: DataFrame, last: DataFrame, source: str, parents: DataFrame | None) -> DataFrame:
    """``source, seq, _node`` of one level that differ between ``seq - 1`` and ``seq``, below parents that do."""
    # A node stands for its own snapshot and, as the earlier side, for the next one: one
    # aggregation compares both sides, also where only one of them has the node.
    two = F.array(F.struct(F.col("seq").alias("seq"), F.lit(1).alias("side")), F.struct((F.col("seq") + 1).alias("seq"), F.lit(-1).alias("side")))
    sides = nodes.select(source, F.inline(two), "_node", "_xor", "_xor2", "_n")
    if parents is not None:
        under = parents.select(source, "seq", F.col("_node").alias("_parent"))
        sides = sides.withColumn("_parent", F.shiftright("_node", _BITS)).join(under, [source, "seq", "_parent"], "left_semi")
    return (
        sides.groupBy(source, "seq", "_node")
        .agg(F.bit_xor("_xor").alias("_x"), F.bit_xor("_xor2").alias("_y"), F.sum(F.col("_n") * F.col("side")).alias("_m"))
        .filter("_x <> 0 or _y <> 0 or _m <> 0")
        .join(last, source)
        .filter("seq > _first and seq <= _last")
        .select(source, "seq", "_node")
    )


def differing_leaves(leaves: DataFrame, source: str, levels: int) -> DataFrame:
    """``source, seq, _leaf``: leaves that differ between snapshot ``seq - 1`` and ``seq``.

    ``leaves`` has ``source, seq, _leaf, _xor, _xor2, _n`` of every snapshot. The
    tree is walked from the root: a node is looked at only under a parent that
    differs. Each level is one join and one aggregation over written tables.
    """
    tree = merkle_levels(leaves, source, levels)
    last = tree[0].groupBy(source).agg(F.max("seq").alias("_last"), F.min("seq").alias("_first"))
    differ: DataFrame | None = None
    for nodes in tree:
        differ = checkpoint(differing_nodes(nodes, last, source, differ))
    return differ.select(source, "seq", F.col("_node").alias("_leaf"))


def snapshot_diff(snapshots: DataFrame, source: str, key: str, values: Sequence[str], levels: int) -> DataFrame:
    """``source, key, seq, change_kind`` between consecutive snapshots of each source.

    ``snapshots`` holds one row per source, ``seq`` (consecutive numbers) and
    key; it is read twice, so it should be checkpointed or stored. Columns of
    other names are ignored.
    """
    leaf = F.shiftrightunsigned(F.xxhash64(key), 64 - _BITS * levels) if levels else F.lit(0).cast("bigint")
    rows = snapshots.filter(F.col(key).isNotNull()).select(source, "seq", key, *values, leaf.alias("_leaf"))
    # Nulls take part: xxhash64 skips them, so each value's nullness is hashed as well.
    leaves = checkpoint(digest(rows, [source, "seq", "_leaf"], [key, *values, *[F.col(v).isNull() for v in values]]))
    differ = differing_leaves(leaves, source, levels)
    # As above a row is the later side of its own snapshot and the earlier side of the next; a
    # side is kept only where its leaf differs, before any row is moved.
    two = F.array(F.struct(F.col("seq").alias("seq"), F.lit(True).alias("_later")), F.struct((F.col("seq") + 1).alias("seq"), F.lit(False).alias("_later")))
    state = F.struct(*[F.col(v) for v in values])
    sides = rows.select(source, key, "_leaf", state.alias("_state"), F.inline(two)).join(differ, [source, "seq", "_leaf"], "left_semi")
    pairs = (
        sides.groupBy(source, key, "seq")
        .agg(F.max(F.when(F.col("_later"), F.col("_state"))).alias("_after"), F.max(F.when(~F.col("_later"), F.col("_state"))).alias("_before"))
        .filter("_before is null or _after is null or not (_before <=> _after)")
    )
    kind = F.when(F.col("_before").isNull(), "added").when(F.col("_after").isNull(), "removed").otherwise("changed")
    return pairs.select(source, key, "seq", kind.alias("change_kind"))


def artwork_changes(artworks: DataFrame, ledger: DataFrame) -> DataFrame:
    """``platform_name, platform_artwork_id, crawl_date, change_kind`` between consecutive full crawls."""
    crawls = consecutive_crawls(crawls_of(ledger, "artworks", full_only=True)).select("platform_name", "crawl_date", "seq")
    crawls = broadcast_if_small(crawls, LEDGER_BROADCAST_ROWS)
    cols = ["platform_name", "platform_artwork_id", "crawl_date", "price", "is_available_for_sale", "has_detail", "crawled_at", "source_file"]
    rows = artworks.select(*cols).join(crawls, ["platform_name", "crawl_date"]).withColumn("platform_artwork_id", clean_id("platform_artwork_id")).filter("platform_artwork_id is not null")
    best = best_per_crawl(rows, ["platform_name", "platform_artwork_id", "seq"], best_rank("has_detail", "crawled_at", "source_file"), ["price", "is_available_for_sale"])
    best = checkpoint(best)
    largest = best.groupBy("platform_name", "seq").count().agg(F.max("count")).first()[0] or 0
    changes = snapshot_diff(best, "platform_name", "platform_artwork_id", ["price", "is_available_for_sale"], levels_for(largest))
    dated = changes.join(crawls, ["platform_name", "seq"])
    return dated.select("platform_name", "platform_artwork_id", F.col("crawl_date").cast("string").alias("crawl_date"), "change_kind")
