"""Session defaults, shared-folder lookup and the size check behind every broadcast hint."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A hinted side must be provably below this; otherwise the plan is left to AQE.
BROADCAST_ROWS = 200_000


def build_session(app: str = "broadsheet", master: str | None = None, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names in spark.checkpoint.dir. Without one, a session inside a single process gets a
    private folder; on a cluster that is an error, since executors would not see it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="broadsheet-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


_scratch: list[list[str]] = []  # folders named inside each open `scratch`, innermost last


def new_folder(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if _scratch:
        _scratch[-1].append(path)
    return path


def delete_folder(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end the folders that were named inside; what is still needed has to lie in a folder named before."""
    _scratch.append([])
    try:
        yield
    finally:
        for path in _scratch.pop():
            delete_folder(spark, path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage through a written table in the shared folder, so lost executors cost nothing."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """True when `df` provably has at most `rows` rows; reads no more than rows + 1 of them."""
    return df.limit(rows + 1).count() <= rows


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only behind a size check; a larger side keeps the shuffle join."""
    return F.broadcast(df) if small(df, rows) else df


def spread(df: DataFrame) -> DataFrame:
    """Use all cores where a table comes in fewer pieces than the cluster has; otherwise leave it."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
