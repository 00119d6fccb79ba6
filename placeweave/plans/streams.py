"""Streaming jobs, run to the end of the input and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from placeweave.operators import copies
from placeweave.plans.matching import _DIST, _PROFILES_SQL
from placeweave.plans.places import places
from placeweave.plans.registry import query, table
from placeweave.session import scratch_path
from placeweave.streaming import jobs


def _as_files(spark, df, label: str, parts: int = 3):
    """Store ``df`` as a few files and stream them one by one."""
    path = scratch_path(spark, label)
    df.repartition(parts).write.parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


@query(
    "stream_incremental_pairs",
    sql=f"""{_PROFILES_SQL}
    SELECT a.contentid AS contentid1, b.contentid AS contentid2, round({_DIST}, 2) AS distance_m
    FROM rows_ a JOIN rows_ b ON a.cell = b.cell AND a.contentid < b.contentid WHERE {_DIST} <= 50""",
)
def stream_incremental_pairs(spark, sf_dir):
    """Places arrive in batches; each is compared with all earlier ones. Pairs of
    points are stored with their ids, pairs of places formed as they are read."""
    stream = _as_files(spark, places(spark, sf_dir).drop("description"), "arrivals")
    pairs = scratch_path(spark, "pairs")

    def near(new, old):
        return copies.near_spots(new, old, 50, "contentid", "latitude", "longitude", "cell")

    jobs.incremental_compare(
        stream, scratch_path(spark, "base"), pairs, scratch_path(spark, "progress"), near
    ).awaitTermination()
    rounded = spark.read.parquet(pairs).withColumn("distance_m", F.round("distance_m", 2))
    return copies.unfolded(rounded, "contentid")


@query(
    "stream_upsert",
    sql="""SELECT user_id, event_id, event_type FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
)
def stream_upsert(spark, sf_dir):
    """Latest event per user, kept up to date by a stream."""
    stream = _as_files(spark, table(spark, sf_dir, "events"), "arrivals")
    path = scratch_path(spark, "latest")
    jobs.stream_upsert(stream, path, scratch_path(spark, "progress"), ["user_id"], ["ts", "event_id"]).awaitTermination()
    small = scratch_path(spark, "compacted")
    jobs.compact(spark.read.parquet(path), small, ["user_id"], ["ts", "event_id"])
    latest = jobs.latest_versions(spark.read.parquet(small), ["user_id"], ["ts", "event_id"])
    return latest.select("user_id", "event_id", "event_type")


@query(
    "stream_seen_ids",
    sql="SELECT DISTINCT user_id AS place_id FROM events",
)
def stream_seen_ids(spark, sf_dir):
    """Ids stored at their first arrival only."""
    arrivals = table(spark, sf_dir, "events").select(F.col("user_id").alias("place_id"), "event_id")
    stream = _as_files(spark, arrivals, "arrivals")
    path = scratch_path(spark, "seen")
    jobs.first_seen_ever(stream, path, scratch_path(spark, "progress"), "place_id", ["event_id"]).awaitTermination()
    return spark.read.parquet(path).select("place_id")


@query(
    "stream_seen_within_delay",
    sql="SELECT DISTINCT event_type AS place_id FROM events",
)
def stream_seen_within_delay(spark, sf_dir):
    """The same with a time limit, as state of the stream: the whole input
    lies within the delay, so each id is stored once."""
    arrivals = table(spark, sf_dir, "events").select(F.col("event_type").alias("place_id"), "ts")
    stream = jobs.first_seen(_as_files(spark, arrivals, "arrivals"), "place_id", "ts", "60 days")
    path = scratch_path(spark, "seen")
    stream.writeStream.format("parquet").option("path", path).option(
        "checkpointLocation", scratch_path(spark, "progress")
    ).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("place_id string, ts timestamp").parquet(path).select("place_id")
