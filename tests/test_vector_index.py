"""Inverted lists against the exact search."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placeweave.operators import vector_index

ROWS = T.StructType(
    [
        T.StructField("contentid", T.LongType()),
        T.StructField("kind", T.IntegerType()),
        T.StructField("embedding", T.ArrayType(T.DoubleType())),
    ]
)


def clustered(n, width, seed):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(20, width))
    return (centres[draw.integers(0, 20, n)] + 0.3 * draw.normal(size=(n, width))).tolist()


@pytest.fixture(scope="module")
def items(spark):
    rows = [(i, i % 3, v) for i, v in enumerate(clustered(1500, 12, 1))]
    rows += [(2000 + i, i % 3, v) for i, v in enumerate(clustered(60, 5, 2))]
    rows += [(3000, 0, None), (3001, 0, []), (3002, 0, [0.0] * 12), (4000, 1, rows[0][2]), (4001, 1, rows[0][2])]
    return spark.createDataFrame(rows, ROWS).repartition(3)


def found(frame):
    return {(r.query_id, r["rank"]): (r.contentid, round(r.score, 9)) for r in frame.collect()}


def test_recall_and_all_lists(items):
    index = vector_index.build_index(items)
    kept = index.items.select("contentid").collect()
    assert len(kept) == len({r.contentid for r in kept}) == 1500 + 60 + 3
    asked = items.filter("contentid % 20 = 0").withColumnRenamed("contentid", "query_id")
    exact = index.search(asked, 10, exact=True)
    measured = vector_index.recall_of(index.search(asked, 10), exact, "query_id", "contentid").first()
    assert measured.queries == 79 and measured.recall >= 0.9
    assert index.centroids[12].probes < len(index.centroids[12].rows)
    for one in index.centroids.values():
        one.probes = len(one.rows)
    assert found(index.search(asked, 10)) == found(exact)
    assert found(index.search(asked, 4, filters=["kind"])) == found(index.search(asked, 4, filters=["kind"], exact=True))


def test_length_without_centroids(items, monkeypatch):
    monkeypatch.setattr(vector_index, "SAMPLE", 1)
    index = vector_index.build_index(items, lists=4)
    assert len(index.centroids) == 1
    asked = items.filter("contentid in (0, 2000)").withColumnRenamed("contentid", "query_id")
    assert found(index.search(asked, 5)) == found(index.search(asked, 5, exact=True))


def test_empty_table(items):
    index = vector_index.build_index(items.limit(0))
    asked = items.select(F.col("contentid").alias("query_id"), "kind", "embedding")
    assert index.search(asked, 3).collect() == []
