"""Connected components of a link table by alternating star contractions.

Every round rewires each node's larger neighbours, then its smaller ones, to the
smallest node it knows. Rounds grow with the logarithm of a component, not with
its diameter. Minima are partial aggregates and the join back to the edges is
between two plain scans, so a hub is split by adaptive execution; each round is
written to the shared folder, which cuts lineage and outlives lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeweave.session import discard, settle


def _large_star(edges: DataFrame) -> DataFrame:
    both = settle(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))), "both")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    least = settle(least, "minima")
    met = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    out = settle(met.distinct(), "large")
    discard(both, least)
    return out


def _small_star(edges: DataFrame) -> DataFrame:
    least = settle(edges.groupBy("u").agg(F.min("v").alias("m")), "minima")
    met = edges.join(least, "u")
    lower = met.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    out = settle(lower.unionByName(met.select("u", F.col("m").alias("v"))).distinct(), "edges")
    discard(least)
    return out


def _print(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
    ).first()
    return row.n, row.h


def connected(links: DataFrame) -> DataFrame:
    """(node, component) of the nodes of ``links`` (a, b), in any order and
    repeated at will; component: the smallest node reachable. Settled."""
    kind = links.schema["a"].dataType
    directed = links.filter("a <> b").select(
        F.greatest("a", "b").cast(kind).alias("u"), F.least("a", "b").cast(kind).alias("v")
    )
    edges = settle(directed.distinct(), "edges")
    seen = _print(edges)
    while seen[0]:
        large = _large_star(edges)
        before, edges = edges, _small_star(large)
        discard(large, before)
        now = _print(edges)
        if now == seen:
            break
        seen = now
    labels = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    found = settle(labels.unionByName(roots), "components")
    discard(edges)
    return found
