"""Clusters of densely occupied cells, across any number of cells.

Rows are counted per cell first, so copies and hot spots weigh one row; only
dense cells are connected, and the labels go back to the rows in one join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeweave.functions import geo
from placeweave.operators.reports import cluster_bbox
from placeweave.session import discard, settle


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``(node, component)``: the smallest node reachable from each node.

    ``nodes`` has a column ``node``; ``edges`` has ``a`` and ``b``, each edge
    in both directions. Every node points to a smaller one; a round lets nodes
    and what they point to take the smallest that a neighbour's pointer points
    to. Paths are halved as they go, so rounds grow with the logarithm of the
    longest path. Each round is written and the one before deleted.
    """
    edges = settle(edges.select("a", "b"), "edges")
    parents = settle(nodes.select("node", F.col("node").alias("parent")).distinct(), "parents")
    settled = False
    while not settled:
        above = parents.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
        known = parents.join(above, "parent").select("node", "parent", "grand")
        near = (
            edges.join(known.select(F.col("node").alias("b"), "grand"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("grand").alias("nearest"))
        )
        seen = known.join(near, "node", "left")
        own = seen.select("node", F.least("grand", "nearest").alias("to"), F.col("parent").alias("was"))
        theirs = seen.filter("nearest is not null").select(
            F.col("parent").alias("node"), F.col("nearest").alias("to"), F.lit(None).cast("long").alias("was")
        )
        offers = own.unionByName(theirs).groupBy("node")
        after = settle(offers.agg(F.min("to").alias("parent"), F.max("was").alias("was")), "parents")
        settled = after.filter("parent <> was").isEmpty()
        discard(parents)
        parents = after
    discard(edges)
    return parents.select("node", F.col("parent").alias("component"))


def density_clusters(
    df: DataFrame, id_col: str, lat: str, lon: str, level: int = geo.COARSE_LEVEL, min_rows: int = 4
) -> DataFrame:
    """``df`` with ``cluster``, the smallest id of the rows of its cluster.

    A cell of ``level`` with at least ``min_rows`` rows is dense; dense cells
    that touch, corners and the date line included, form a cluster. Rows in
    other cells and rows without a coordinate have none. The poles join
    nothing. ``df`` must not have columns ``cluster`` or ``_cell``.
    """
    row, col = geo.cell_row(F.col(lat), level), geo.cell_col(F.col(lon), level)
    columns = 2 ** (level + 1)
    rows = df.withColumn("_cell", geo.cell_of(row, F.pmod(col, F.lit(columns))))
    dense = settle(
        rows.filter(F.col("_cell").isNotNull())
        .groupBy("_cell")
        .agg(F.count(F.lit(1)).alias("n"), F.min(id_col).alias("least"))
        .filter(F.col("n") >= min_rows)
        .select(F.col("_cell").alias("node"), "least"),
        "dense-cells",
    )
    own_row = F.floor(F.col("node") / F.lit(geo.COLUMN_SPAN)).cast("long")
    own_col = F.pmod("node", F.lit(geo.COLUMN_SPAN))
    around = [
        geo.cell_of(own_row + up, F.pmod(own_col + right, F.lit(columns)))
        for up in (-1, 0, 1)
        for right in (-1, 0, 1)
        if up or right
    ]
    touching = dense.select(F.col("node").alias("a"), F.explode(F.array(*around)).alias("b"))
    edges = touching.join(dense.select(F.col("node").alias("b")), "b", "left_semi")
    grouped = components(dense, edges).join(dense, "node")
    names = grouped.groupBy("component").agg(F.min("least").alias("cluster"))
    labels = grouped.join(names, "component").select(F.col("node").alias("_cell"), "cluster")
    return rows.join(labels, "_cell", "left").drop("_cell")


def cluster_boxes(clustered: DataFrame, lat: str, lon: str) -> DataFrame:
    """Bounding box and rows of each cluster."""
    members = clustered.filter(F.col("cluster").isNotNull())
    sizes = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("members"))
    return cluster_bbox(members, "cluster", lat, lon).join(sizes, "cluster")
