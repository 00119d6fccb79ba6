"""Vector links against all cosines."""

import math
import random

import numpy as np
import pyarrow as pa

from placeweave.llm import embeddings

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    def sound(v):
        return v and all(c is not None and math.isfinite(c) for c in v) and any(c != 0 for c in v)

    n = len(rows)
    vectors = [np.array(v, np.float32).astype(float) if sound(v) else None for _, v, _ in rows]
    owner, links = list(range(n)), [0] * n

    def root(i):
        while owner[i] != i:
            i = owner[i]
        return i

    for i in range(n):
        for j in range(i):
            a, b = vectors[i], vectors[j]
            if a is None or b is None or rows[i][2] is None or rows[i][2] != rows[j][2] or len(a) != len(b):
                continue
            if a @ b / (np.sqrt(a @ a) * np.sqrt(b @ b)) >= 0.98:
                links[i] += 1
                links[j] += 1
                owner[root(i)] = root(j)
    least = {}
    for i, (v, *_) in enumerate(rows):
        if v is not None:
            least[root(i)] = min(v, least.get(root(i), v))
    out = []
    for i, (v, *_) in enumerate(rows):
        alone = vectors[i] is None or rows[i][2] is None
        c = v if alone else least.get(root(i))
        out.append((v, links[i], c, v is not None and v == c))
    return out


def check(spark, rows):
    got = embeddings.near_vectors(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    key = lambda r: tuple((v is None, v or 0) for v in r)
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows), key=key)
    return got


def crowd(seed, width, groups, noise=(0.0, 0.01, 0.1, 0.15, 0.2, 0.25)):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        base = rng.normal(size=width)
        base /= np.linalg.norm(base)
        for c in range(int(rng.integers(1, 12)) if g else 120):
            v = base + rng.choice(noise) * rng.normal(size=width) / math.sqrt(width) if c else base
            rows.append((len(rows), [float(x) for x in (v * rng.choice([1, 3])).astype(np.float32)], int(g % 3)))
    random.Random(seed).shuffle(rows)
    return rows


def test_odd_rows(spark):
    unit = [1.0, 0.0, 0.0]
    rows = [
        (1, None, 0), (2, [], 0), (3, [0.0, 0.0, 0.0], 0), (4, [1.0, None, 0.0], 0),
        (5, [float("nan"), 1.0, 0.0], 0), (6, [float("inf"), 1.0, 0.0], 0), (7, unit, None),
        (8, unit, 0), (8, unit, 0), (9, unit, 1), (10, [1.0, 0.0], 0), (11, [2.0, 0.0], 0),
        (None, unit, 0), (12, [1e-30, 1e-32, 0.0], 0), (13, [1e30, 0.0, 0.0], 0), (14, [-1.0, 0.0, 0.0], 0),
        (15, [5.0], 0), (16, [7.0], 0), (17, [-7.0], 0), (None, [0.0, 1.0], 4),
    ]
    check(spark, rows)


def test_all_pairs(spark):
    got = check(spark, crowd(1, 64, 60))
    assert sum(r.n_links for r in got) > 1000


def test_small_tiles_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "TILE", 16)
    monkeypatch.setattr(embeddings, "PAIRS_AT_ONCE", 7)
    check(spark, crowd(2, 20, 25) + [(5000 + i, r[1], r[2]) for i, r in enumerate(crowd(3, 13, 10))])


def test_empty_table(spark):
    assert embeddings.near_vectors(spark.createDataFrame([], SCHEMA)).collect() == []


def _batch(rows):
    return pa.RecordBatch.from_arrays(
        [
            pa.array([r[2] for r in rows], pa.int32()),
            pa.array([r[0] for r in rows], pa.int64()),
            pa.array([r[1] for r in rows], pa.list_(pa.float32())),
        ],
        names=["label", "node", "embedding"],
    )


def test_cells_hold_no_vectors():
    """What is shuffled per vector and cell is a name and a block's coordinates, many in one row."""
    rng = np.random.default_rng(4)
    rows = [(n, [float(x) for x in rng.normal(size=64).astype(np.float32)], n % 2) for n in range(4000)]
    placed = pa.Table.from_batches(embeddings._places("<f4")([_batch(rows)]))
    members = sum(placed.column("members").to_pylist())
    assert sum(map(len, placed.column("data").to_pylist())) == 24 * members < len(rows) * 64 * 4 * 3
    assert placed.num_rows * 5 < members and max(placed.column("members").to_pylist()) <= embeddings.MEMBERS


def test_rounded_coordinates_hide_no_link(monkeypatch):
    monkeypatch.setattr(embeddings, "SCORES_AT_ONCE", 500)
    rows = crowd(5, 64, 12)
    vectors = np.array([r[1] for r in rows])
    whole = embeddings.turned(vectors)
    every = np.arange(len(rows))
    linked = 0
    for number, (start, end, *_) in enumerate(embeddings.blocks(64)):
        at = np.rint(whole[:, start:end] * (embeddings.STEP / embeddings.UNIT)).astype(np.float32)
        one, two = embeddings.hopeful(at, 64, number, every, every, True)
        for i, j in embeddings.linked_pairs(vectors, whole, number, every, every, True):
            assert (one | two)[i].all() and (one | two)[j].all()
            linked += len(i)
    assert linked > 1000
