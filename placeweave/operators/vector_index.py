"""Inverted lists for vector search.

Centroids are fitted on a bounded sample of the vectors (``SAMPLE``, by a hash
of the id) on the driver; every vector then goes to the list of its nearest
centroid. A query looks into its ``probes`` nearest lists, whose vectors are
scored exactly, so only the choice of lists is approximate. The number of probes
is measured on the sample: the fewest that find ``recall`` of the neighbours
there. The sample is sparser than the table, its neighbours lie further apart,
so the table's recall is no lower as a rule; ``recall_of`` measures it.

Vectors of different lengths never meet; a length that the sample lacks has one
list. As in the exact search, null and empty vectors are left out and a vector
of zeros scores 0.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placeweave.functions import vectors
from placeweave.functions.shipping import ship_by_value
from placeweave.operators.search import search_top_k
from placeweave.session import settle

ship_by_value(__name__)

SAMPLE = 20_000  # vectors that centroids and probes are fitted on
ASKED = 256  # of them, as queries of the measurement
MOST_LISTS = 4096
ROUNDS = 10
SEED = 11


@dataclass
class Centroids:
    """Unit centroids of one vector length, and how many lists a query needs."""

    rows: np.ndarray
    probes: int

    def nearest(self, unit: np.ndarray, n: int) -> np.ndarray:
        """Numbers of the ``n`` nearest centroids of each row, nearest first."""
        scores = unit @ self.rows.T
        return np.argsort(-scores, axis=1, kind="stable")[:, :n]


def unit_rows(lists: pa.Array, width: int) -> np.ndarray:
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
    norms = np.sqrt(np.einsum("ij,ij->i", flat, flat))
    return flat / np.where(norms > 0, norms, 1.0)[:, None]


def fit_centroids(sample: np.ndarray, lists: int) -> np.ndarray:
    """Spherical k-means of unit rows; an empty list keeps its centroid."""
    draw = np.random.default_rng(SEED)
    rows = sample[draw.choice(len(sample), min(lists, len(sample)), replace=False)]
    for _ in range(ROUNDS):
        owner = np.argmax(sample @ rows.T, axis=1)
        sums = np.zeros_like(rows)
        np.add.at(sums, owner, sample)
        norms = np.linalg.norm(sums, axis=1)
        rows = np.where(norms[:, None] > 0, sums / np.where(norms > 0, norms, 1.0)[:, None], rows)
    return rows


def probes_for(sample: np.ndarray, rows: np.ndarray, k: int, recall: float) -> int:
    """Fewest lists in which the sample's own neighbours are found."""
    asked = sample[:: max(1, len(sample) // ASKED)]
    scores = asked @ sample.T
    k = min(k, scores.shape[1])
    best = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    owner = np.argmax(sample @ rows.T, axis=1)
    order = np.argsort(-(asked @ rows.T), axis=1, kind="stable")
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(order.shape[1])[None, :], axis=1)
    needed = np.sort(np.take_along_axis(place, owner[best], axis=1).reshape(-1))
    return int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))]) + 1


def _placed(index: dict[int, Centroids], vec: str, many: bool):
    """Lists of each row: the nearest one, or as many as a query looks into."""

    def run(batches):
        for batch in batches:
            column = batch.column(vec)
            widths = np.diff(column.offsets.to_numpy())
            lists: list = [[0]] * batch.num_rows
            for width in np.unique(widths):
                rows = np.flatnonzero(widths == width)
                found = index.get(int(width))
                if found is not None:
                    unit = unit_rows(column.take(pa.array(rows)), int(width))
                    for row, near in zip(rows, found.nearest(unit, found.probes if many else 1).tolist()):
                        lists[row] = near
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lists, pa.list_(pa.int32()))], names=[*batch.schema.names, "_lists"]
            )

    return run


class VectorIndex:
    """All items in inverted lists, and the centroids to find the lists by."""

    def __init__(self, centroids: dict[int, Centroids], items: DataFrame, item_id: str, vec: str):
        self.centroids, self.items, self.item_id, self.vec = centroids, items, item_id, vec

    def _in_lists(self, df: DataFrame, many: bool) -> DataFrame:
        schema = T.StructType([*df.schema.fields, T.StructField("_lists", T.ArrayType(T.IntegerType()))])
        placed = df.mapInArrow(_placed(self.centroids, self.vec, many), schema)
        return placed.withColumn("_list", F.explode("_lists")).drop("_lists")

    def search(
        self,
        queries: DataFrame,
        k: int,
        query_id: str = "query_id",
        filters: list[str] | None = None,
        popularity: str | None = None,
        exact: bool = False,
    ) -> DataFrame:
        """``(query_id, item_id, score, rank)``; ``exact`` looks into all lists."""
        asked = queries.filter(vectors.has_vector(F.col(self.vec)))
        options = dict(item_id=self.item_id, query_id=query_id, vec=self.vec, popularity=popularity)
        if exact:
            return search_top_k(self.items, asked, k, filters=filters, **options)
        lists = [*(filters or []), "_list"]
        return search_top_k(self.items, self._in_lists(asked, True), k, filters=lists, **options)


def build_index(
    items: DataFrame,
    item_id: str = "contentid",
    vec: str = "embedding",
    k: int = 10,
    recall: float = 0.95,
    lists: int | None = None,
) -> VectorIndex:
    """Put every vector into its list; about the square root of their number of
    lists unless given. The items are stored in the shared folder."""
    kept = items.filter(vectors.has_vector(F.col(vec)))
    total = kept.count()
    lists = min(MOST_LISTS, lists or max(1, round(total**0.5)))
    sample = kept.select(vec).orderBy(F.xxhash64(item_id), vec).limit(SAMPLE).toArrow().column(vec)
    sample = sample.combine_chunks()
    sample = sample.chunk(0) if isinstance(sample, pa.ChunkedArray) and sample.num_chunks else sample
    centroids = {}
    if total:
        widths = np.diff(sample.offsets.to_numpy())
        for width in np.unique(widths):
            unit = unit_rows(sample.take(pa.array(np.flatnonzero(widths == width))), int(width))
            rows = fit_centroids(unit, max(1, round(lists * len(unit) / len(widths))))
            centroids[int(width)] = Centroids(rows, probes_for(unit, rows, k, recall))
    index = VectorIndex(centroids, kept, item_id, vec)
    index.items = settle(index._in_lists(kept, False), "vector-lists")
    return index


def recall_of(found: DataFrame, exact: DataFrame, query_id: str, item_id: str) -> DataFrame:
    """One row: queries, neighbours, found, recall, of results against the exact
    ones; a neighbour that ties with the last exact one counts as that one."""
    hits = exact.select(query_id, item_id, F.lit(1).alias("hit"))
    limit = exact.groupBy(query_id).agg(F.min("score").alias("_least"), F.count(F.lit(1)).alias("_k"))
    good = found.join(limit, query_id).join(hits, [query_id, item_id], "left")
    good = good.filter("hit = 1 or score >= _least").groupBy(query_id).agg(F.count(F.lit(1)).alias("_found"))
    per_query = limit.join(good, query_id, "left").select("_k", F.coalesce("_found", F.lit(0)).alias("_found"))
    return per_query.agg(
        F.count(F.lit(1)).alias("queries"),
        F.coalesce(F.sum("_k"), F.lit(0)).alias("neighbours"),
        F.coalesce(F.sum(F.least("_k", "_found")), F.lit(0)).alias("found"),
    ).withColumn("recall", F.col("found") / F.col("neighbours"))
