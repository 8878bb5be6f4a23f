"""Session settings and the few session-derived choices the operators share."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Intermediate folders named inside the innermost ``scratch``.
_NAMED: ContextVar[list[str] | None] = ContextVar("named", default=None)


# Runtime settings the plans are written for; all can be set on a running session.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # A join on (store, month) may reuse rows already hashed by store.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # Above 8000 bytes HotSpot interprets a generated method; Spark's split code is faster then.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A task writes so many partitions of a table side by side; only rows of further ones are sorted first.
    "spark.sql.maxConcurrentOutputFileWriters": "32",
}


def importable(spark: SparkSession) -> None:
    """Lets Python workers that run beside the driver import this package from where it lies.

    On a cluster the package is installed or sent with the job, and this changes nothing.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join(p for p in (*paths, root) if p)


def tune(spark: SparkSession) -> SparkSession:
    """The session with these settings, its workers able to import this package."""
    importable(spark)
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "16g") -> SparkSession:
    """Session for tests and the bench; on a cluster the submitter's settings apply."""
    session = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tillcast")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    return tune(session)


def shuffle_width(spark: SparkSession) -> int:
    """Number of partitions for an explicit repartition: the session's own shuffle setting."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def by_store(df: DataFrame) -> DataFrame:
    """Rows hashed by store, the one shuffle all per-store windows share.

    The explicit width keeps adaptive execution from merging CPU-heavy windows into few
    tasks.  Callers guarantee one row per store and day, so a store is never more rows than
    the calendar has days.
    """
    return df.repartition(shuffle_width(df.sparkSession), "Store")


def unpacked(columns: list[str], packed: str = "_row") -> list[Column]:
    """Columns of a packed row, but for the store: read from the struct, it would no longer be known to place the rows."""
    return [F.col("Store") if c == "Store" else F.col(f"{packed}.{c}").alias(c) for c in columns]


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for intermediate data that the driver and every executor can reach.

    It lies in the folder named by ``spark.checkpoint.dir``.  Only a local master, whose
    executors are threads of the driver, may do without that setting and gets a temporary
    folder; elsewhere a missing setting is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError(f"spark.checkpoint.dir must name a folder shared by all executors of {master}")
        root = tempfile.mkdtemp(prefix="tillcast-")
    path = f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    named = _NAMED.get()
    if named is not None:
        named.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Intermediate folders named inside are removed at its end; those taken off the list it gives stay.

    For work whose result doesn't depend on them any more: one that has been written or collected.  Results that
    are returned as plans still read theirs.
    """
    named: list[str] = []
    token = _NAMED.set(named)
    try:
        yield named
    finally:
        _NAMED.reset(token)
        context = spark.sparkContext
        for path in named:
            folder = context._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of a result that several later jobs read.

    The files go to the shared folder, so a lost executor costs a re-read and not a recompute.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        configured = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        context.setCheckpointDir(configured or shared_folder(df.sparkSession, "checkpoint"))
    return df.checkpoint(eager=True)


def stored(df: DataFrame, purpose: str, path: str | None = None) -> DataFrame:
    """The rows written once as Parquet in the shared folder and read back: column pruning
    and true sizes for what follows, and no recomputation when an executor is lost."""
    path = path or shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
