"""Joining rows of one block with each other, hot blocks split into tiles.

A block join compares rows that share a key. Where a key holds more than
``tile_rows`` rows of a side, that side is cut into chunks by a hash of the row id
and every chunk meets every one of the other side under its own key, so no task receives
more than about ``tile_rows`` rows of either side for one key. Residual
conditions become part of the join, so only pairs that pass leave it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeweave.functions import geo
from placeweave.session import settle

TILE_ROWS = 1024
# Small tiles grow up to TILE_ROWS before a side is cut into more chunks, as
# every row is copied once per chunk it meets.
MOST_SMALL_CHUNKS = 32
# Pairs looked at and rows held by one task of a block join.
PAIRS_PER_TASK = 20_000_000
ROWS_PER_TASK = 1_000_000
# Up to this many hot keys are sent to every executor; more are joined.
BROADCAST_KEYS = 20_000


@dataclass(frozen=True)
class HotKeys:
    """Keys with more rows than a tile and the number of chunks of each."""

    table: DataFrame | None
    small: bool

    def attach(self, df: DataFrame, keys: list[str]) -> DataFrame:
        if self.table is None:
            return df.withColumn("_chunks", F.lit(1))
        table = F.broadcast(self.table) if self.small else self.table
        joined = df.join(table, keys, "left")
        return joined.withColumn("_chunks", F.coalesce("_chunks", F.lit(1)))


def chunk_count(rows: Column, tile_rows: int, largest: int = TILE_ROWS) -> Column:
    """Chunks of a block of ``rows``: of ``tile_rows`` each, or more in a block
    that would be cut into very many, but never above ``largest`` for that."""
    grown = F.least(F.lit(max(largest, tile_rows)), F.ceil(rows / MOST_SMALL_CHUNKS))
    return F.ceil(rows / F.greatest(F.lit(tile_rows), grown)).cast("int")


def hot_keys(df: DataFrame, keys: list[str], tile_rows: int = TILE_ROWS) -> HotKeys:
    """Find the hot keys. Runs one counting job over the key columns.

    The count decides the plan: no hot key means no splitting, a list of
    proven size is broadcast, and a longer one is joined by key.
    """
    hot = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .filter(F.col("_rows") > tile_rows)
        .select(*keys, F.ceil(F.col("_rows") / tile_rows).cast("int").alias("_chunks"))
    )
    found = hot.limit(BROADCAST_KEYS + 1).collect()
    if not found:
        return HotKeys(None, True)
    if len(found) <= BROADCAST_KEYS:
        return HotKeys(df.sparkSession.createDataFrame(found, hot.schema), True)
    return HotKeys(hot, False)


def chunked(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_id: str,
    right_id: str,
    tile_rows: int = TILE_ROWS,
) -> tuple[DataFrame, DataFrame, list[str], int]:
    """Both sides ready to be joined: their tiles' keys and a number of
    partitions that fits the work.

    Each side is cut by its own count and copied once per chunk of the other
    side, so one row that meets a crowd leaves the crowd uncopied.
    """
    sides = left.select(*keys, F.lit(1).alias("_l")).unionByName(right.select(*keys, F.lit(0).alias("_l")))
    counts = settle(
        sides.groupBy(*keys)
        .agg(F.sum("_l").alias("_lefts"), F.sum(1 - F.col("_l")).alias("_rights"))
        .filter("_lefts > 0 and _rights > 0"),
        "key-counts",
    )
    total = counts.agg(
        F.sum(F.col("_lefts").cast("double") * F.col("_rights")), F.sum(F.col("_lefts") + F.col("_rights"))
    ).first()
    floor = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    partitions = max(floor, -(-int(total[0] or 0) // PAIRS_PER_TASK), -(-int(total[1] or 0) // ROWS_PER_TASK))
    hot = counts.filter((F.col("_lefts") > tile_rows) | (F.col("_rights") > tile_rows)).select(
        *keys,
        chunk_count(F.col("_lefts"), tile_rows).alias("_lchunks"),
        chunk_count(F.col("_rights"), tile_rows).alias("_rchunks"),
    )
    if hot.isEmpty():
        return left, right, keys, partitions

    def cut(df: DataFrame, id_col: str, own: str, own_chunks: str, other: str, other_chunks: str) -> DataFrame:
        met = df.join(hot, keys, "left")
        one = F.lit(1)
        chunk = F.pmod(F.xxhash64(F.col(id_col)), F.coalesce(own_chunks, one)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.coalesce(other_chunks, one) - 1))
        return met.withColumn(own, chunk).withColumn(other, every).drop("_lchunks", "_rchunks")

    a = cut(left, left_id, "_lc", "_lchunks", "_rc", "_rchunks")
    b = cut(right, right_id, "_rc", "_rchunks", "_lc", "_lchunks")
    return a, b, [*keys, "_lc", "_rc"], partitions


def block_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_id: str,
    right_id: str,
    condition: Column,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """Pairs of rows with equal ``keys`` that meet ``condition``.

    Apart from the keys the two sides must have different column names. Both
    sides are spread alike over a number of partitions that follows from the
    pairs to look at, since the work per row grows with its block and merging
    partitions by their bytes would leave cores idle.
    """
    a, b, tiles, partitions = chunked(left, right, keys, left_id, right_id, tile_rows)
    spread = a.repartition(partitions, *tiles).join(b.repartition(partitions, *tiles), tiles)
    return spread.filter(condition).drop("_lc", "_rc")


def suffixed(df: DataFrame, suffix: str, keep: list[str]) -> DataFrame:
    """Rename every column except ``keep``."""
    return df.select(*[F.col(c) if c in keep else F.col(c).alias(c + suffix) for c in df.columns])


def self_pairs(
    df: DataFrame,
    keys: list[str],
    id_col: str,
    condition: Column | None = None,
    include_self: bool = False,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """Each unordered pair of a block once: columns get suffixes 1 and 2, the
    smaller id is side 1. ``condition`` refers to the suffixed names."""
    df = df.filter(_all_present(keys))
    one, two = F.col(id_col + "1"), F.col(id_col + "2")
    order = one <= two if include_self else one < two
    condition = order if condition is None else order & condition
    return block_join(
        suffixed(df, "1", keys), suffixed(df, "2", keys), keys, id_col + "1", id_col + "2",
        condition, tile_rows,
    )


def near_pairs(
    df: DataFrame,
    id_col: str,
    lat: str,
    lon: str,
    metres: float,
    distance: str = "haversine",
    block: str | None = None,
    condition: Column | None = None,
    include_self: bool = False,
    tile_rows: int = TILE_ROWS,
    against: DataFrame | None = None,
) -> DataFrame:
    """Unordered pairs at most ``metres`` apart, with their ``distance_m``.

    ``against``: other rows of the same columns to pair ``df`` with instead of
    itself; then side 1 is ``df`` and side 2 the others, whatever their ids.

    Side 1 is spread over its neighbouring fine cells and meets side 2 in its
    own cell, so a block is never compared as a whole. ``block`` names a
    column both sides must share; without it pairs cross block edges.
    """
    level = geo.near_level(metres)
    spots = df.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull())
    if block:
        spots = spots.filter(F.col(block).isNotNull())
    shared = [block] if block else []
    keys = [*shared, "_row", "_col"]
    row, col = geo.near_keys(F.col(lat), F.col(lon), level)
    offsets = geo.near_offsets(F.col(lat + "1"), F.col(lon + "1"), level, metres)
    left = suffixed(spots, "1", shared).withColumn("_key", F.explode(offsets))
    left = left.withColumns({"_row": F.col("_key.row"), "_col": F.col("_key.col")}).drop("_key")
    others = spots
    if against is not None:
        others = against.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull())
    right = suffixed(others.withColumns({"_row": row, "_col": col}), "2", keys)
    one, two = F.col(id_col + "1"), F.col(id_col + "2")
    order = one <= two if include_self else one < two
    if against is not None:
        order = F.lit(True)
    apart = geo.DISTANCES[distance](
        F.col(lat + "1"), F.col(lon + "1"), F.col(lat + "2"), F.col(lon + "2")
    )
    test = order & (apart <= metres)
    if condition is not None:
        test = test & condition
    pairs = block_join(left, right, keys, id_col + "1", id_col + "2", test, tile_rows)
    return pairs.withColumn("distance_m", apart).drop("_row", "_col")


def _all_present(names: list[str]) -> Column:
    test = F.lit(True)
    for name in names:
        test = test & F.col(name).isNotNull()
    return test
