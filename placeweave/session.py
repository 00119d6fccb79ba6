"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that matter on a cluster; callers may override any of them.
CLUSTER_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # keep the skew split even where it costs one more exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "placeweave", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the defaults above; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(CLUSTER_DEFAULTS)
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Only a local session without the setting gets a temporary folder of its
    own; a cluster session without it is an error, because a machine-local
    folder would not be visible to the executors.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(folder)
        return folder
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


@contextmanager
def _shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Queries run within delete their shuffle files at their end, not when the
    driver's garbage collector comes to them."""
    earlier = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if earlier is None else spark.conf.set(SHUFFLE_CLEANUP, earlier)


def settle(df: DataFrame, label: str = "settled") -> DataFrame:
    """Write ``df`` to the shared folder once and read it back.

    For results that several later branches use: they scan only the columns
    they need, and the lineage is cut at files that outlive a lost executor.
    What was shuffled on the way is deleted as soon as the result is written.
    """
    path = scratch_path(df.sparkSession, label)
    with _shuffles_deleted(df.sparkSession):
        df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored._settled_at = path
    return stored


def discard(*settled: DataFrame) -> None:
    """Delete the files of results of ``settle`` that nothing reads any more."""
    for df in settled:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._settled_at)
        path.getFileSystem(df.sparkSession._jsc.sc().hadoopConfiguration()).delete(path, True)


class Scratch:
    """Results that one computation settles and later deletes together."""

    def __init__(self) -> None:
        self.held: list[DataFrame] = []

    def settle(self, df: DataFrame, label: str = "settled") -> DataFrame:
        self.held.append(settle(df, label))
        return self.held[-1]

    def clear(self) -> None:
        discard(*self.held)
        self.held = []
