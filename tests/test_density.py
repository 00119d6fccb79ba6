"""Density clusters and components against a plain search."""

import random
from collections import defaultdict

import pytest

from placeweave.operators import density


def _plain(links, nodes):
    least = {}
    for start in sorted(nodes):
        todo = [start] if start not in least else []
        while todo:
            node = todo.pop()
            if node not in least:
                least[node] = start
                todo += links[node]
    return least


def _components(spark, nodes, pairs):
    edges = [*pairs, *[(b, a) for a, b in pairs]]
    rows = density.components(
        spark.createDataFrame([(n,) for n in nodes], "node long"), spark.createDataFrame(edges, "a long, b long")
    ).collect()
    assert len(rows) == len(set(nodes))
    links = defaultdict(list)
    for a, b in edges:
        links[a].append(b)
    assert {r.node: r.component for r in rows} == _plain(links, nodes)


def test_components_of_a_random_chain_and_pairs(spark):
    rng = random.Random(1)
    chain = rng.sample(range(10_000), 60)
    others = list(range(20_000, 20_080))
    pairs = list(zip(chain, chain[1:])) + [tuple(rng.sample(others, 2)) for _ in range(50)]
    _components(spark, chain + others, pairs)


def test_components_of_nothing(spark):
    _components(spark, [5, 5, 3], [])
    _components(spark, [], [])


def test_density_clusters(spark):
    rng = random.Random(2)
    spots = [(i, rng.uniform(-3, 3), rng.choice([-1, 1]) * rng.uniform(177, 180)) for i in range(400)]
    spots += [(1000 + i, 50.0, 50.0) for i in range(5)] + [(2000, None, 1.0), (2001, 1.0, None), (2002, 80.0, 80.0)]
    level, size, columns = 8, 180 / 2**8, 2**9
    cells = defaultdict(list)
    for i, lat, lon in spots:
        if lat is not None and lon is not None:
            cells[int((lat + 90) // size), int((lon + 180) // size) % columns].append(i)
    dense = {c: min(ids) for c, ids in cells.items() if len(ids) >= 4}
    links = {c: [((c[0] + u), (c[1] + r) % columns) for u in (-1, 0, 1) for r in (-1, 0, 1)] for c in dense}
    links = {c: [n for n in around if n in dense] for c, around in links.items()}
    root = _plain(links, dense)
    names = defaultdict(lambda: 10**9)
    for cell, top in root.items():
        names[top] = min(names[top], dense[cell])
    want = {i: None for i, _, _ in spots}
    want.update({i: names[root[c]] for c in dense for i in cells[c]})
    df = spark.createDataFrame(spots, "id long, lat double, lon double")
    got = density.density_clusters(df, "id", "lat", "lon", level, 4)
    assert {r.id: r.cluster for r in got.collect()} == want and got.count() == len(spots)
    boxes = {r.cluster: r for r in density.cluster_boxes(got, "lat", "lon").collect()}
    assert set(boxes) == {c for c in want.values() if c is not None}
    assert (boxes[1000].members, boxes[1000].min_lat, boxes[1000].max_lon) == (5, 50.0, 50.0)
