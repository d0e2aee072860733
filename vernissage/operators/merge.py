"""Upserts as joins and aggregations, and a versioned store of Parquet files.

``merge_columns`` and ``fold_columns`` are the column-wise merges; ``Store``
keeps every version per crawl, the latest state, rejected rows and a ledger.
Publishing replaces the partition of its crawl and nothing else, so that it can
be run again, and the latest state is a pure function of the versions: late,
repeated or deleted crawls cannot corrupt it. The latest state is written to a
folder of its own, and a pointer file that is replaced atomically names the
folder to read: readers find the old state or the new one, never none.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from vernissage.operators.dedup import SortField, winners
from vernissage.operators.ordering import positions
from vernissage.session import checkpoint


def merge_columns(old: DataFrame, new: DataFrame, keys: Sequence[str], own: Column | None = None) -> DataFrame:
    """Full outer merge per column: a new value wins, a null keeps the old one.

    With ``own`` (a condition on ``old``'s columns) old values win in rows
    where it holds. Both sides must have each key at most once.
    """
    cols = [c for c in old.columns if c not in keys]
    left = old.select(*keys, *[F.col(c).alias(f"_o_{c}") for c in cols], (own if own is not None else F.lit(False)).alias("_own"))
    right = new.select(*keys, *[F.col(c).alias(f"_n_{c}") for c in cols])

    def one(c: str) -> Column:
        o, n = F.col(f"_o_{c}"), F.col(f"_n_{c}")
        return F.when(F.coalesce(F.col("_own"), F.lit(False)), F.coalesce(o, n)).otherwise(F.coalesce(n, o)).alias(c)

    return left.join(right, list(keys), "full_outer").select(*keys, *[one(c) for c in cols])


def fold_columns(df: DataFrame, keys: Sequence[str], position: str) -> DataFrame:
    """Per key and column the last value that is not null (nor an empty list), in order of position."""

    def last(c: str) -> Column:
        v = F.col(c)
        if df.schema[c].dataType.typeName() == "array":
            v = F.when(F.size(v) > 0, v)
        return F.max_by(v, F.when(v.isNotNull(), F.col(position))).alias(c)

    return df.groupBy(*keys).agg(*[last(c) for c in df.columns if c not in keys and c != position])


def replace_children(existing: DataFrame, incoming: DataFrame, owner: Sequence[str]) -> DataFrame:
    """Children of the incoming owners are replaced, all others stay."""
    return existing.join(incoming.select(*owner).distinct(), list(owner), "left_anti").unionByName(incoming)


def assign_ids(known: DataFrame, values: DataFrame, value: str, id_col: str = "id") -> DataFrame:
    """Ids for values that have none yet: a hash of the value, so that no counter is shared."""
    new = values.select(value).filter(F.col(value).isNotNull()).distinct().join(known, value, "left_anti")
    return known.select(id_col, value).unionByName(new.select(F.xxhash64(value).alias(id_col), value))


def children(df: DataFrame, keys: Sequence[str], array: str, value: str = "value") -> DataFrame:
    """Rows of an array column with their position."""
    return df.select(*keys, F.posexplode(array).alias("position", value))


#: Columns of the ledger: one row for each run of a crawl; the last one counts.
LEDGER = "dataset string, platform_name string, crawl_date date, status string, rows_in bigint, no_key bigint, duplicates bigint, published bigint, rejected bigint, error string, run_at timestamp"


class Store:
    """Versions, latest state, rejected rows and ledger of one dataset under a folder."""

    def __init__(self, spark: SparkSession, root: str, dataset: str, key: str, order: Sequence[SortField]):
        self.spark, self.root, self.dataset, self.key, self.order = spark, root.rstrip("/"), dataset, key, list(order)

    def path(self, what: str) -> str:
        return f"{self.root}/{what}/dataset={self.dataset}"

    def read(self, what: str) -> DataFrame | None:
        """``versions``, ``rejects``, ``ledger`` or ``current``; None if nothing was written yet."""
        path = self.path(what)
        if what == "current":
            name = self._pointer()
            if name is None:
                return None
            path = f"{path}/{name}"
        try:
            return self.spark.read.parquet(path)
        except AnalysisException:
            return None

    def publish(self, rows: DataFrame, replace: bool = True) -> None:
        """Winners of ``rows`` (with ``platform_name``, ``crawl_date``) become the versions of their crawls.

        ``replace=False`` keeps versions of keys that are not in ``rows``. Files
        follow the size: a large crawl is written by many tasks, small ones share one.
        """
        best = winners(rows, ["platform_name", "crawl_date", self.key], self.order)
        if not replace and (old := self.read("versions")) is not None:
            crawls = best.select("platform_name", "crawl_date").distinct()
            kept = old.join(crawls, ["platform_name", "crawl_date"], "left_semi").join(best, ["platform_name", "crawl_date", self.key], "left_anti")
            best = checkpoint(best.unionByName(kept, allowMissingColumns=True))
        self._write(best, "versions", "overwrite")

    def finalize(self, rows: DataFrame, platform: str, crawl_date: str, rejected: DataFrame | None = None) -> dict[str, int]:
        """Publishes one crawl's rows with its rejected ones and adds a row of counters to the ledger.

        ``rejected`` has ``source_file, error``. Rows without a key are counted
        and left out. Returns the counters.
        """
        named = rows.withColumn("platform_name", F.lit(platform)).withColumn("crawl_date", F.lit(crawl_date).cast("date"))
        has_key = F.col(self.key).isNotNull() & (F.col(self.key) != "")
        bad = rejected if rejected is not None else self.spark.createDataFrame([], "source_file string, error string")
        bad = checkpoint(bad.select("source_file", "error", F.lit(platform).alias("platform_name"), F.lit(crawl_date).cast("date").alias("crawl_date")))
        self.publish(named)
        self._write(bad, "rejects", "overwrite")
        counted = named.agg(F.count("*").alias("rows_in"), F.count_if(~F.coalesce(has_key, F.lit(False))).alias("no_key")).first()
        mine = (F.col("platform_name") == platform) & (F.col("crawl_date") == F.lit(crawl_date).cast("date"))
        versions = self.read("versions")
        published = 0 if versions is None else versions.filter(mine).count()
        out = {"rows_in": counted["rows_in"], "no_key": counted["no_key"], "published": published, "rejected": bad.count()}
        out["duplicates"] = out["rows_in"] - out["no_key"] - published
        self.record(platform, crawl_date, "completed", **out)
        return out

    def record(self, platform: str, crawl_date: str, status: str, error: str | None = None, **counters: int) -> None:
        """Adds a row to the ledger."""
        values = {"dataset": self.dataset, "platform_name": platform, "status": status, "error": error, **counters}
        fields = T._parse_datatype_string(LEDGER)
        row = self.spark.range(1).select(*[F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) if f.name not in ("crawl_date", "run_at") else (F.lit(crawl_date).cast("date").alias("crawl_date") if f.name == "crawl_date" else F.current_timestamp().alias("run_at")) for f in fields])
        row.coalesce(1).write.mode("append").parquet(self.path("ledger"))

    def ledger(self) -> DataFrame | None:
        """The last row of each crawl."""
        rows = self.read("ledger")
        return None if rows is None else winners(rows, ["platform_name", "crawl_date"], [SortField("run_at")])

    def delete_crawl(self, platform: str, crawl_date: str) -> None:
        """Removes a crawl's versions and rejects and repairs the latest state.

        Entities last seen in that crawl go back to their newest other version,
        entities seen in no other crawl go.
        """
        for what in ("versions", "rejects"):
            self._remove(f"{self.path(what)}/platform_name={_escaped(self.spark, platform)}/crawl_date={crawl_date}")
        self.record(platform, crawl_date, "deleted")
        if self.read("versions") is None:
            self._remove(self.path("current"))  # it was the only crawl
        else:
            self.compact()

    def current(self, versions: DataFrame | None = None) -> DataFrame:
        """Latest version of each entity with first and last seen, from all versions."""
        v = versions if versions is not None else self.read("versions")
        if v is None:
            raise ValueError("nothing was published")
        return current_state(v, ["platform_name", self.key])

    def compact(self) -> None:
        """Writes the latest state to a new folder and turns the pointer to it.

        The folder read before stays until the next run, for readers that still use it.
        """
        before = self._pointer()
        name = f"state={uuid.uuid4().hex}"
        self.current().write.option("compression", "zstd").parquet(f"{self.path('current')}/{name}")
        self._point(name)
        fs, folder = self._fs(self.path("current"))
        for entry in fs.listStatus(folder):
            if entry.isDirectory() and entry.getPath().getName() not in (name, before):
                fs.delete(entry.getPath(), True)

    def _write(self, rows: DataFrame, what: str, mode: str) -> None:
        (
            rows.hint("rebalance", "platform_name", "crawl_date")
            .write.mode(mode).option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
            .partitionBy("platform_name", "crawl_date").parquet(self.path(what))
        )

    def _fs(self, path: str):
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _remove(self, path: str) -> None:
        fs, p = self._fs(path)
        if fs.exists(p) and not fs.delete(p, True):
            raise OSError(f"{path} could not be removed")

    def _pointer(self) -> str | None:
        fs, p = self._fs(f"{self.path('current')}/_CURRENT")
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _point(self, name: str) -> None:
        """Replaces the pointer: a whole new file takes the old one's place in one step."""
        jvm = self.spark._jvm
        fs, p = self._fs(f"{self.path('current')}/_CURRENT")
        _, new = self._fs(f"{self.path('current')}/_CURRENT.{uuid.uuid4().hex}")
        stream = fs.create(new, True)
        try:
            stream.write(bytearray(name.encode()))
        finally:
            stream.close()
        kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        how = self.spark.sparkContext._gateway.new_array(kind, 1)
        how[0] = kind.valueOf("OVERWRITE")
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), self.spark._jsc.hadoopConfiguration())
        context.rename(new, p, how)


def _escaped(spark: SparkSession, value: str) -> str:
    """A partition value as it stands in a folder's name."""
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)


def current_state(versions: DataFrame, keys: Sequence[str], at: str = "crawl_date") -> DataFrame:
    """The newest version of each entity, its date, and when it was first and last seen."""
    rest = [c for c in versions.columns if c not in keys and c != at]
    seen = F.coalesce(F.col("crawled_at"), F.col(at).cast("timestamp")) if "crawled_at" in rest else F.col(at).cast("timestamp")
    newest = F.max(F.struct(F.col(at).alias("at"), seen.alias("seen"), F.struct(*rest).alias("row")))
    oldest = F.min(F.struct(F.col(at).alias("at"), seen.alias("seen")))
    c = versions.groupBy(*keys).agg(newest.alias("n"), oldest.alias("o"))
    return c.select(*keys, *[F.col(f"n.row.{r}").alias(r) for r in rest], F.col("n.at").alias("latest_version"), F.col("o.seen").alias("first_seen_at"), F.col("n.seen").alias("last_seen_at"))


def latest_epoch(log: DataFrame, window: Sequence[str], epoch: str, position: str) -> DataFrame:
    """Rows of the epoch that comes last in each window of an append-only log."""
    last = log.groupBy(*window).agg(F.max_by(epoch, position).alias(epoch))
    return log.join(last, [*window, epoch], "left_semi")


def running_rank(df: DataFrame, keys: Sequence[str], order: Sequence[Column], out: str = "rank") -> DataFrame:
    """Adds each row's rank in its group, which may be of any size."""
    return positions(df, keys, order, out)


def delete_pairs(df: DataFrame, pairs: DataFrame, columns: Sequence[str], arrays: Sequence[str]) -> DataFrame:
    """Rows without those whose ``columns`` stand side by side in the ``arrays`` of a row of ``pairs``."""
    named = F.transform(F.arrays_zip(*arrays), lambda z: F.struct(*[z[a].alias(c) for a, c in zip(arrays, columns)]))
    return df.join(pairs.select(F.inline(named)).distinct(), list(columns), "left_anti")
