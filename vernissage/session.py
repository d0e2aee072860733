"""Session helpers: table access, durable cut points and size-checked broadcasts."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "vernissage", cores: int | str = "*", **conf: str) -> SparkSession:
    """A local session with the settings the engine expects (UTC, AQE, Arrow)."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return ship(b.getOrCreate())


def ship(spark: SparkSession) -> SparkSession:
    """Sends this package to the executors' Python workers, once per application.

    The driver serves the archive; executors need neither the repository nor
    a path to it.
    """
    sc = spark.sparkContext
    if getattr(sc, "_vernissage_shipped", False):
        return spark
    package = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="vernissage-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = Path(folder) / "vernissage_code.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent))
    sc.addPyFile(str(archive))
    sc._vernissage_shipped = True
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own, which is removed
    at the end: on a cluster such a folder would be lost with its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        sc = spark.sparkContext
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = getattr(sc, "_vernissage_folder", None)
        if folder is None:
            folder = sc._vernissage_folder = tempfile.mkdtemp(prefix="vernissage-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder.rstrip("/")


def checkpoint(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the folder the cluster names."""
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager)


def small_rows(df: DataFrame, limit: int, what: str) -> list:
    """Rows of a reference table of proven size; more than ``limit`` is an error."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{what} has more than {limit} rows; it is not a reference table")
    return rows


def broadcast_if_small(df: DataFrame, limit: int) -> DataFrame:
    """Broadcast ``df`` only when it is counted to hold at most ``limit`` rows."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def spread(df: DataFrame, least: float = 0.25) -> DataFrame:
    """The same rows over all cores, where the input comes in far fewer parts than there are cores.

    A file with one row group is read by one task. For maps that cost much more
    than moving their rows; inputs of many parts, and so all large ones, stay where they are.
    ``least`` is the number of parts a core that is enough: a file of few row groups counts as
    more parts than are read, so the dearest maps ask for more.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = df._jdf.queryExecution().toRdd().getNumPartitions()
    return df.repartition(max(cores, int(cores * least))) if 0 < parts < cores * least else df
