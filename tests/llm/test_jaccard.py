"""The join against all pairs, in small and in large tiles."""

import random
import re

import numpy as np
import pytest

from placeweave.llm import jaccard
from placeweave.llm.components import connected
from placeweave.session import Scratch


def brute(rows):
    def shingles(text):
        words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return {tuple(words[i : i + 4]) for i in range(max(len(words) - 3, min(1, len(words))))}

    sets = [shingles(t) for _, t, *_ in rows]
    owner = list(range(len(rows)))

    def root(i):
        while owner[i] != i:
            i = owner[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                owner[root(i)] = root(j)
    least = {}
    for i, (doc, *_) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    return [(rows[i][0], len(sets[i]), least.get(root(i)) if sets[i] else rows[i][0]) for i in range(len(rows))]


def key(row):
    return tuple((v is None, v or 0) for v in row)


def check(documents, rows):
    got = [tuple(r) for r in jaccard.shingle_components(documents(rows)).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)
    return got


def edited(rng, words, share):
    return [w if rng.random() > share else f"x{rng.randrange(10**6)}" for w in words]


def corpus(seed, groups, copies):
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(9)]
    rows = []
    for g in range(groups):
        words = [f"w{rng.randrange(3000)}" for _ in range(int(rng.lognormvariate(3.4, 1.0)) + 1)]
        if g % 2:
            words[3:3] = passage
        for c in range(copies if g else 4 * copies):
            share = rng.choice([0, 0.005, 0.01, 0.03, 0.05])
            rows.append((len(rows), " ".join(edited(rng, words, share if c else 0)), "en", "s"))
    rng.shuffle(rows)
    return rows


def test_odd_rows(documents, odd_rows):
    rows = [
        *odd_rows,
        (40, "Only three Words", "en", "s"),
        (41, "only\tTHREE words", "en", "s"),
        (42, "Only three words more", "en", "s"),
        (43, "É é É é É é", "en", "s"),
        (44, "é É é É é É", "en", "s"),
        (45, "a a a a a a a a", "en", "s"),
        (46, "A a a a", "en", "s"),
    ]
    check(documents, rows)


def test_all_pairs(documents):
    rows = corpus(1, 60, 8)
    got = check(documents, rows)
    assert len({r[2] for r in got}) < len(got)


def test_chunked_tiles_give_the_same(documents, monkeypatch):
    monkeypatch.setattr(jaccard, "PAIRS_KEPT", 5)
    monkeypatch.setattr(jaccard, "FIRST_TILES", 2)
    monkeypatch.setattr(jaccard, "CHUNK", 4)
    monkeypatch.setattr(jaccard, "BROADCAST_ADDRESSES", 5)
    check(documents, corpus(2, 25, 8))


@pytest.mark.parametrize("firsts", [0, 1, 3, 99])
def test_every_crossing_pair_is_looked_at_once_at_least(firsts):
    rng = random.Random(firsts)
    keys = {n: sorted(rng.sample(range(40), rng.randint(3, 15))) for n in range(30)}
    bits = jaccard.bitmap(np.arange(8, dtype=np.uint64))
    rows = [
        {"key": k, "tile": "0-0", "side": 0, "across": False, "node": n, "n": 8, "component": n // 2, "bits": bits, "firsts": own[:firsts]}
        for n, own in keys.items()
        for k in own
    ]
    rows.sort(key=lambda r: r["key"])
    import pyarrow as pa

    tiles = [pa.RecordBatch.from_pylist([r for r in rows if r["key"] == k]) for k in range(40) if any(r["key"] == k for r in rows)]
    # one task per tile: nothing is remembered from tile to tile
    got = [(p["a"], p["b"]) for t in tiles for batch in jaccard._cross_pairs(jaccard.RULE)([t]) for p in batch.to_pylist()]
    want = {(a, b) for a in keys for b in keys if a < b and a // 2 != b // 2 and set(keys[a]) & set(keys[b])}
    assert set(got) == want
    if firsts == 99:
        assert len(got) == len(want)


def test_tiles_of_the_same_nodes_are_compared_once(spark):
    keys = [(k, n) for k in range(100) for n in (1, 2)] + [(100, n) for n in (1, 2, 3)]
    members = spark.createDataFrame([(k, n, 8, n) for k, n in keys], "key long, node long, n int, component long")
    bits = jaccard.bitmap(np.arange(8, dtype=np.uint64))
    sets = spark.createDataFrame([(n, bits, bits) for n in (1, 2, 3)], "node long, bits binary, brief binary")
    rows = jaccard._tiles(members, sets, Scratch()).collect()
    assert sorted((r.key, r.node) for r in rows) == [(0, 1), (0, 2), (100, 1), (100, 2), (100, 3)]
    assert {tuple(r.firsts) for r in rows if r.node < 3} == {(0, 100)}


def near_copies(groups, copies):
    """Rows of one tile: ``groups`` of sets that differ in one member of 60 each,
    every set a component of its own. Sets of different groups have 0.79."""
    rows = []
    rng = np.random.default_rng(5)
    shared = rng.integers(0, 1 << 63, 54).astype(np.uint64)
    for _ in range(groups):
        own = np.concatenate((shared, rng.integers(0, 1 << 63, 6).astype(np.uint64)))
        for _ in range(copies):
            members = np.unique(np.concatenate((own, rng.integers(0, 1 << 63, 1).astype(np.uint64))))
            node = len(rows)
            common = {"key": 1, "tile": "0-0", "side": 0, "across": False, "node": node, "n": len(members), "component": node}
            rows.append(common | {"bits": jaccard.bitmap(members), "firsts": [1], "members": members.tobytes()})
    return rows


@pytest.mark.parametrize("copies", [10, 40])
def test_a_tile_gives_links_that_join_it_and_not_its_pairs(spark, copies):
    import pyarrow as pa

    rows = near_copies(3, copies)
    at = [pa.RecordBatch.from_pylist(rows[i : i + 7]) for i in range(0, len(rows), 7)]
    got = [(p["a"], p["b"]) for batch in jaccard._cross_pairs(jaccard.RULE)(at) for p in batch.to_pylist()]
    assert len(got) == 3 * (copies - 1)
    joined = connected(spark.createDataFrame(got, "a long, b long")).collect()
    assert {r.node: r.component for r in joined} == {n: n - n % copies for n in range(3 * copies)}


def test_rows_with_a_possible_partner_stay_in_their_tile():
    import pyarrow as pa

    rows = near_copies(2, 6)
    lone = np.arange(60, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    rows.append(rows[0] | {"node": 99, "n": 60, "component": 99, "bits": jaccard.bitmap(lone)})
    rows += [x | {"key": 2} for x in rows[:1] + rows[-1:]]
    out = jaccard._possible_rows(jaccard.RULE)([pa.RecordBatch.from_pylist(rows)])
    got = [(x["key"], x["node"]) for batch in out for x in batch.to_pylist()]
    assert got == [(1, n) for n in range(12)]


def test_sets_are_found_without_a_shuffle_of_them(documents, monkeypatch):
    plans, real = {}, Scratch.settle

    def kept(self, df, label="settled"):
        plans[label] = df._jdf.queryExecution().optimizedPlan().toString()
        return real(self, df, label)

    monkeypatch.setattr(Scratch, "settle", kept)
    docs = documents([(i, " ".join(f"w{i // 2}x{j}" for j in range(30)), "en", "s") for i in range(20)])
    jaccard._owned(docs, jaccard.RULE)
    assert "Aggregate" not in plans["sets"]


@pytest.mark.parametrize("size", [1, 7, 300, 5000])
def test_short_bitmaps_bound_the_overlap_too(size):
    rng = np.random.default_rng(size)
    a = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
    b = np.concatenate((a[size // 20 :], rng.integers(0, 1 << 63, size // 20).astype(np.uint64)))
    short = [jaccard.bitmap(x, 1) for x in (a, b)]
    assert all(2 * len(s) <= len(jaccard.bitmap(a)) or size < 16 for s in short)
    assert not jaccard.RULE.links(a, b) or jaccard.RULE.may_link(len(a), short[0], len(b), short[1])
    other = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
    assert size < 300 or not jaccard.RULE.may_link(len(a), short[0], len(other), jaccard.bitmap(other, 1))


def test_linked_sets_share_a_tile():
    rng = np.random.default_rng(0)
    linked = 0
    for _ in range(4000):
        n = int(np.exp(rng.uniform(0, 7)))
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2))
        drop = int(rng.integers(0, max(1, n * 0.17) + 1))
        add = int(rng.integers(0, max(1, n * 0.17) + 1))
        b = np.unique(np.concatenate((a[drop:], rng.integers(0, 1 << 63, add).astype(np.uint64))))
        if len(b) and jaccard.RULE.links(a, b):
            linked += 1
            same = jaccard.node_of(a) == jaccard.node_of(b)
            assert same or set(jaccard.RULE.tile_keys(a)) & set(jaccard.RULE.tile_keys(b))
            assert jaccard.RULE.may_link(len(a), jaccard.bitmap(a), len(b), jaccard.bitmap(b))
    assert linked > 1000


def test_bands_hold_linked_sizes():
    starts = jaccard.RULE.band_starts
    for a in range(1, 3000):
        band = max(i for i, s in enumerate(starts[:80]) if s <= a)
        assert a * 20 // 17 < starts[band + 2]


def test_one_of_each_group_stays(documents):
    rows = corpus(3, 20, 6) + [(9000, None, "en", "s"), (9001, "", "en", "s"), (None, "no id here at all", "en", "s")]
    docs = documents(rows).withColumnRenamed("lang", "node").withColumnRenamed("source", "row")
    out = jaccard.keep_one_each(docs)
    assert out.columns == docs.columns
    kept = [r.doc_id for r in out.collect()]
    want = [d for d, _, c in brute(rows) if d == c or d is None]
    assert sorted(kept, key=lambda d: (d is None, d)) == sorted(want, key=lambda d: (d is None, d))


def test_repeated_and_missing_ids(documents):
    a, b, c = ("".join(f"{x}{i} " for i in range(30)) for x in "abc")
    rows = [(1, a), (5, a), (5, b), (7, c), (7, c), (None, a), (None, "alone " * 3), (None, "alone " * 3), (8, ""), (8, "")]
    out = jaccard.keep_one_each(documents([(*r, "en", "s") for r in rows]))
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert got == sorted([(1, a), (5, b), (7, c), (None, "alone " * 3), (8, ""), (8, "")], key=str)


def test_another_rule(documents):
    rule = jaccard.Rule(words=5, percent=80)
    rng = random.Random(4)
    rows = []
    for g in range(25):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(4, 120))]
        for _ in range(5):
            rows.append((len(rows), " ".join(edited(rng, words, rng.choice([0, 0.01, 0.03]))), "en", "s"))
    sets = [rule.shingle_set(t.encode(), jaccard._Words()) for _, t, *_ in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                low, high = sorted((group[i], group[j]))
                group = [low if x == high else x for x in group]
    got = {r.doc_id: r.component_id for r in jaccard.shingle_components(documents(rows), rule).collect()}
    assert [got[i] for i in range(len(rows))] == group
    assert {r.doc_id for r in jaccard.keep_one_each(documents(rows), rule).collect()} == set(group)


def test_empty_table(documents):
    assert jaccard.shingle_components(documents([])).collect() == []


@pytest.mark.parametrize("shape", ["path", "star", "random", "none"])
def test_components(spark, shape):
    rng = random.Random(7)
    edges = {
        "path": [(i, i + 1) for i in range(200)],
        "star": [(0, i) for i in range(1, 300)],
        "random": [(rng.randrange(400), rng.randrange(400)) for _ in range(250)] + [(5, 5)],
        "none": [],
    }[shape]
    owner = {n: n for e in edges if e[0] != e[1] for n in e}

    def root(n):
        while owner[n] != n:
            n = owner[n]
        return n

    for a, b in edges:
        if a != b:
            low, high = sorted((root(a), root(b)))
            owner[high] = low
    got = connected(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == {n: root(n) for n in owner} and len(got) == len(owner)
