"""Pairs of similar vectors within blocks.

Small blocks are joined natively. Larger ones are cut into tiles whose
vectors are multiplied as matrices, one tile pair per group, so the cost per
pair is that of a matrix product and only pairs above the limit leave it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placeweave.functions import vectors
from placeweave.functions.shipping import ship_by_value
from placeweave.operators.blocking import chunk_count, hot_keys, suffixed

ship_by_value(__name__)

# Blocks up to this size are joined natively, larger ones go through tiles.
NATIVE_ROWS = 64
VECTOR_TILE_ROWS = 1024
# Rows of a tile whose scores are held at a time.
ROWS_AT_ONCE = 64


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Vectors as unit rows; a tile's vectors have one length."""
    lists = column.combine_chunks()
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(lists), len(flat) // max(1, len(lists)))
    length = np.linalg.norm(rows, axis=1)
    return rows / np.where(length > 0, length, 1.0)[:, None]


def _taken(left: pa.Table, right: pa.Table, i: np.ndarray, j: np.ndarray, names: list[str]) -> list:
    """Columns of pairs: rows ``i`` of one table, ``j`` of the other, a key
    column from either, as both sides hold the same value."""
    one, two = pa.array(i), pa.array(j)
    columns = []
    for name in names:
        if name in right.column_names:
            columns.append(right.column(name).take(two))
        else:
            columns.append(left.column(name if name in left.column_names else name + "1").take(one))
    return columns


def _similar(id_col: str, vec: str, limit: float, include_self: bool, names: list[str]):
    def tile(left: pa.Table, right: pa.Table) -> pa.Table:
        a, b = _matrix(left.column(vec + "1")), _matrix(right.column(vec + "2"))
        left, right = left.drop_columns([vec + "1"]), right.drop_columns([vec + "2"])
        ids1, ids2 = left.column(id_col + "1").combine_chunks(), right.column(id_col + "2").combine_chunks()
        # two chunks meet in this tile alone: pairs that lie the other way are turned
        turn = bool(len(a)) and left.column("_lc1")[0].as_py() < left.column("_rc1")[0].as_py()
        other_left = right.rename_columns([c[:-1] + "1" for c in right.column_names])
        other_right = left.rename_columns([c[:-1] + "2" for c in left.column_names])
        found = []
        # a few rows at a time, so that only pairs that are kept take memory
        for start in range(0, len(a), ROWS_AT_ONCE):
            scores = a[start : start + ROWS_AT_ONCE] @ b.T if len(b) else np.zeros((0, 0))
            i, j = np.nonzero(scores > limit)
            score = scores[i, j]
            i += start
            one, two = ids1.take(pa.array(i)), ids2.take(pa.array(j))
            before = (pc.less_equal if include_self else pc.less)(one, two).to_numpy(zero_copy_only=False)
            ways = [(before, left, right, i, j)]
            if turn:
                after = pc.greater(one, two).to_numpy(zero_copy_only=False)
                ways.append((after, other_left, other_right, j, i))
            for kept, first, second, at, to in ways:
                columns = _taken(first, second, at[kept], to[kept], names[:-1])
                found.append(pa.table([*columns, pa.array(score[kept], pa.float64())], names=names))
        if not found:
            none = np.zeros(0, dtype=np.int64)
            columns = _taken(left, right, none, none, names[:-1])
            return pa.table([*columns, pa.array([], pa.float64())], names=names)
        return pa.concat_tables(found)

    return tile


def cosine_pairs(
    df: DataFrame,
    keys: list[str],
    id_col: str,
    vec: str,
    limit: float,
    include_self: bool = False,
    native_rows: int = NATIVE_ROWS,
    tile_rows: int = VECTOR_TILE_ROWS,
) -> DataFrame:
    """Unordered pairs of a block with cosine above ``limit`` (at least 0).

    Columns get suffixes 1 and 2 as in ``self_pairs``, without the vectors,
    plus ``score``. Only vectors of one length are compared: the length is part
    of the key, so neither the road nor the tile size changes the result.
    """
    if limit < 0:
        raise ValueError("limit must not be negative")
    df = df.filter(vectors.has_vector(F.col(vec))).dropna(subset=keys)
    rest = [c for c in df.columns if c not in keys and c != vec]
    names = [*keys, *[c + "1" for c in rest], *[c + "2" for c in rest]]
    df = df.withColumn("_width", F.size(vec))
    keys = [*keys, "_width"]
    hot = hot_keys(df, keys, native_rows)
    if hot.table is None:
        return _native(df, keys, id_col, vec, limit, include_self).select(*names, "score")
    # _chunks counts native sizes here, so it marks the large blocks
    marked = hot.attach(df, keys)
    small = marked.filter("_chunks = 1").drop("_chunks")
    tiles = chunk_count(F.col("_chunks") * F.lit(native_rows), tile_rows, VECTOR_TILE_ROWS)
    large = marked.filter("_chunks > 1").withColumn("_chunks", tiles)
    return (
        _native(small, keys, id_col, vec, limit, include_self).select(*names, "score")
        .unionByName(_tiled(large, keys, id_col, vec, limit, include_self, names))
    )


def _native(df, keys, id_col, vec, limit, include_self) -> DataFrame:
    df = df.withColumn("_norm", vectors.norm(F.col(vec)))
    a, b = suffixed(df, "1", keys), suffixed(df, "2", keys)
    score = vectors.cosine(F.col(vec + "1"), F.col(vec + "2"), F.col("_norm1"), F.col("_norm2"))
    one, two = F.col(id_col + "1"), F.col(id_col + "2")
    pairs = a.join(b, keys).filter((one <= two if include_self else one < two) & (score > limit))
    return pairs.withColumn("score", score)


def _tiled(df, keys, id_col, vec, limit, include_self, names) -> DataFrame:
    # each unordered pair of chunks is one tile, the smaller chunk on its left
    df = df.withColumn("_own", F.pmod(F.xxhash64(id_col), F.col("_chunks")).cast("int"))
    later = F.explode(F.sequence("_own", F.col("_chunks") - 1))
    earlier = F.explode(F.sequence(F.lit(0), "_own"))
    groups = [*keys, "_lc", "_rc"]
    a = df.withColumn("_rc", later).withColumnRenamed("_own", "_lc").drop("_chunks")
    b = df.withColumn("_lc", earlier).withColumnRenamed("_own", "_rc").drop("_chunks")
    a, b = suffixed(a, "1", []), suffixed(b.select(*a.columns), "2", [])
    kinds = {f.name: f.dataType for f in (*df.schema.fields, *a.schema.fields, *b.schema.fields)}
    schema = T.StructType(
        [T.StructField(n, kinds[n]) for n in names] + [T.StructField("score", T.DoubleType())]
    )
    work = _similar(id_col, vec, limit, include_self, [*names, "score"])
    left = a.groupBy(*[g + "1" for g in groups])
    right = b.groupBy(*[g + "2" for g in groups])
    return left.cogroup(right).applyInArrow(work, schema)
