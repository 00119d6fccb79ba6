"""Repeated ingestion as streams.

Each job writes batch results under the batch id, so a batch that is run
again after a failure replaces its own output and nothing is counted twice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from placeweave.operators.keyed import one_per_key


STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def _start(
    stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(work)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _run(checkpoint: str) -> str:
    """Name of a job's outputs: a new checkpoint counts its batches from 0 again
    and must not replace those of an earlier one."""
    return hashlib.md5(checkpoint.encode()).hexdigest()[:16]


def _earlier(batch: DataFrame, path: str, run: str, batch_id: int) -> DataFrame | None:
    """Output of the batches before this one and of other runs."""
    try:
        stored = batch.sparkSession.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    return stored.filter((F.col("run") != run) | (F.col("batch") < batch_id)).drop("run", "batch")


def _store(df: DataFrame, path: str, run: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/run={run}/batch={batch_id}")


def incremental_compare(
    stream: DataFrame,
    base_path: str,
    pairs_path: str,
    checkpoint: str,
    make_pairs: Callable[[DataFrame, DataFrame | None], DataFrame],
    key: str = "contentid",
    block: str = "cell",
) -> StreamingQuery:
    """Compare each arriving batch with everything that arrived before.

    ``make_pairs`` gets the new places and the earlier ones (or None) of the
    blocks with arrivals, and pairs the new ones with each other and with the
    earlier ones; earlier places are not paired again.
    """
    run = _run(checkpoint)

    def work(batch: DataFrame, batch_id: int) -> None:
        old = _earlier(batch, base_path, run, batch_id)
        arrived = batch.dropDuplicates([key])
        fresh = arrived if old is None else arrived.join(old.select(key), key, "left_anti")
        _store(fresh, base_path, run, batch_id)
        new = batch.sparkSession.read.schema(batch.schema).parquet(f"{base_path}/run={run}/batch={batch_id}")
        if old is not None:
            old = old.join(new.select(block).distinct(), block, "left_semi")
        _store(make_pairs(new, old), pairs_path, run, batch_id)

    return _start(stream, work, checkpoint)


def stream_upsert(
    stream: DataFrame, table_path: str, checkpoint: str, keys: list[str], order: list[str]
) -> StreamingQuery:
    """Keep the latest version of each key.

    A batch appends its own winners as a new version of their keys;
    ``latest_versions`` reads the table. Nothing is rewritten per batch;
    ``compact`` writes the current rows alone to a new table from time to time.
    """
    run = _run(checkpoint)

    def work(batch: DataFrame, batch_id: int) -> None:
        newest = one_per_key(batch, keys, [F.col(c).desc_nulls_last() for c in order])
        _store(newest, table_path, run, batch_id)

    return _start(stream, work, checkpoint)


def latest_versions(table: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Current rows of a table kept by ``stream_upsert``."""
    ranking: list[Column] = [*[F.col(c).desc_nulls_last() for c in order], F.col("batch").desc(), F.col("run")]
    return one_per_key(table, keys, ranking).drop("run", "batch")


def compact(table: DataFrame, path: str, keys: list[str], order: list[str]) -> None:
    """Current rows of a table kept by ``stream_upsert`` as a new table at
    ``path``, which later batches may go on from."""
    _store(latest_versions(table, keys, order), path, "compacted", 0)


def first_seen(stream: DataFrame, key: str, time: str, delay: str = "10 minutes") -> DataFrame:
    """Drop keys that were seen within the delay; state older than the
    watermark is forgotten."""
    timed = stream.withColumn(time, F.col(time).cast("timestamp"))
    return timed.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def _ids_of_other_runs(spark: SparkSession, path: str, checkpoint: str, schema: T.StructType, key: str) -> DataFrame:
    """What other runs stored at ``path`` as a second source of the stream. The
    list is written beside the checkpoint at its first start and stays, so a
    restart has the same sources."""
    place = f"{checkpoint}/earlier"
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{place}/_SUCCESS")
    if not done.getFileSystem(spark._jsc.sc().hadoopConfiguration()).exists(done):
        listed = spark.createDataFrame([], T.StructType([schema[key]]))
        stored = _earlier(listed, path, _run(checkpoint), 0)
        ids = listed if stored is None else stored.select(key).distinct()
        ids.write.mode("overwrite").parquet(place)
    return spark.readStream.schema(T.StructType([schema[key]])).parquet(place)


def first_seen_ever(stream: DataFrame, path: str, checkpoint: str, key: str, order: list[str]) -> StreamingQuery:
    """Store the first arrival of each key, without a time limit.

    The state holds one row per key in RocksDB; a batch looks up its own keys
    there and reads nothing that is stored. Of the rows of a key in one batch
    the first in ``order`` counts; tasks send one row per key, so a frequent
    key is no special case. Null keys are dropped. Ids that other runs stored
    at ``path`` are read once, with the first batch of a checkpoint.
    """
    run = _run(checkpoint)
    spark = stream.sparkSession
    row = F.struct(*[F.col(f"`{c}`") for c in stream.columns])
    arrivals = stream.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("_key"), F.lit(1).alias("_new"), F.struct(*order).alias("_order"), row.alias("_row")
    )
    before = _ids_of_other_runs(spark, path, checkpoint, stream.schema, key).select(
        F.col(key).alias("_key"),
        F.lit(0).alias("_new"),
        *[F.lit(None).cast(arrivals.schema[c].dataType).alias(c) for c in ("_order", "_row")],
    )
    # one value per batch, the same when a batch is run again
    timed = arrivals.unionByName(before).withColumn("_at", F.current_timestamp())
    firsts = timed.groupBy("_key").agg(
        F.min_by(F.struct("_new", "_row"), F.struct("_at", "_new", "_order")).alias("_first"),
        F.min("_at").alias("_since"),
        F.max("_at").alias("_until"),
    )

    def work(batch: DataFrame, batch_id: int) -> None:
        fresh = batch.filter("_first._new = 1 and _since = _until").select("_first._row.*")
        _store(fresh, path, run, batch_id)

    with _state_on_disk(spark):
        return _start(firsts, work, checkpoint, "update")


@contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Queries started within keep their state in RocksDB and store changes only."""
    earlier = {name: spark.conf.get(name, None) for name in STATE_SETTINGS}
    for name, value in STATE_SETTINGS.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in earlier.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
