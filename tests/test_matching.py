"""Block joins and tiers against brute force, hot blocks included."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from placeweave.functions import geo, vectors
from placeweave.operators import blocking, compare, keyed, search, tiers, vector_join
from placeweave.operators.tiers import TierRules

RULES = TierRules()


@pytest.fixture(scope="module")
def world(spark):
    """300 places; a third of them at one point, many of those exact copies."""
    rng = random.Random(11)
    words = ["river", "cafe", "museum", "north", "gate", "old", "mill", "garden"]
    rows, vecs = [], []
    for i in range(300):
        if i % 3 == 0:
            title = "city centre" if i % 2 else f"city centre {rng.choice(words)}"
            lat, lon = 40.7, -74.0
        else:
            title = " ".join(rng.choices(words, k=3))
            lat, lon = 40.7 + rng.randint(0, 12) / 1e4, -74.0 + rng.randint(0, 12) / 1e4
        rows.append((f"id{i:04d}", title if i % 50 else None, lat, lon, 7 if i % 3 == 0 else i % 4))
        if i % 5:
            base = rng.choice([[1, 0, 0, 0.2], [0, 1, 0, 0.2], [0.5, 0.5, 0, 0], [0, 0, 0, 0]])
            vecs.append((f"id{i:04d}", [float(x + rng.choice([0, 0, 0.3])) if any(base) else 0.0 for x in base]))
    vecs.append(("id0001x", []))
    base = spark.createDataFrame(rows, "contentid string, title string, latitude double, longitude double, cell long")
    table = spark.createDataFrame(vecs, "contentid string, embedding array<float>")
    return base.cache(), table.cache()


def _set(df, *columns):
    return {tuple(row) for row in df.select(*columns).collect()}


@pytest.mark.parametrize("tile_rows", [5, 40, 10_000])
def test_self_pairs_once_each_at_any_tile_size(world, tile_rows):
    base, _ = world
    pairs = blocking.self_pairs(base, ["cell"], "contentid", tile_rows=tile_rows)
    rows = base.collect()
    want = {
        (a.contentid, b.contentid)
        for a in rows for b in rows if a.cell == b.cell and a.contentid < b.contentid
    }
    got = pairs.select("contentid1", "contentid2").collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want


@pytest.mark.parametrize("tile_rows", [8, 10_000])
@pytest.mark.parametrize("block", ["cell", None])
def test_near_pairs_equal_brute_force(spark, world, tile_rows, block):
    base, _ = world
    near = blocking.near_pairs(
        base, "contentid", "latitude", "longitude", 50, "spheroid", block=block, tile_rows=tile_rows
    )
    a, b = base.alias("a"), base.alias("b")
    apart = geo.distance_spheroid(
        F.col("a.latitude"), F.col("a.longitude"), F.col("b.latitude"), F.col("b.longitude")
    )
    test = (F.col("a.contentid") < F.col("b.contentid")) & (apart <= 50)
    if block:
        test = test & (F.col("a.cell") == F.col("b.cell"))
    want = a.join(b, test).select("a.contentid", "b.contentid")
    got = near.select("contentid1", "contentid2").collect()
    assert len(got) == len(set(got)) and {tuple(r) for r in got} == {tuple(r) for r in want.collect()}


@pytest.mark.parametrize("lat", [0.0, 60.0, -78.0, 84.9999, 85.0001, 89.9])
def test_near_pairs_at_any_latitude_and_date_line(spark, lat):
    rng = random.Random(int(lat * 10))
    degree = 111_320 * max(0.0005, abs(__import__("math").cos(__import__("math").radians(lat))))
    rows = []
    for i in range(120):
        lon = 179.9999 + rng.uniform(-200, 200) / degree
        lon = lon - 360 if lon >= 180 else lon
        rows.append((i, lat + rng.uniform(-100, 100) / 111_320, lon))
    df = spark.createDataFrame(rows, "id long, lat double, lon double").filter("abs(lat) < 90")
    got = _set(blocking.near_pairs(df, "id", "lat", "lon", 50.0), "id1", "id2")
    a, b = df.alias("a"), df.alias("b")
    apart = geo.distance_haversine(F.col("a.lat"), F.col("a.lon"), F.col("b.lat"), F.col("b.lon"))
    want = a.join(b, (F.col("a.id") < F.col("b.id")) & (apart <= 50)).select("a.id", "b.id")
    assert got == {tuple(r) for r in want.collect()} and got


@pytest.mark.parametrize("native_rows, tile_rows", [(64, 1024), (3, 7), (3, 1024)])
def test_cosine_pairs_equal_native_scores(world, native_rows, tile_rows):
    base, table = world
    rows = base.select("contentid", "cell").join(table, "contentid")
    both = blocking.self_pairs(rows, ["cell"], "contentid", include_self=True)
    score = vectors.cosine(F.col("embedding1"), F.col("embedding2"))
    for limit in (0.3, 0.0):
        want = both.filter(score > limit).select("contentid1", "contentid2", F.round(score, 9))
        got = vector_join.cosine_pairs(
            rows, ["cell"], "contentid", "embedding", limit, True, native_rows, tile_rows
        ).select("contentid1", "contentid2", F.round("score", 9))
        assert sorted(got.collect()) == sorted(want.collect()) and got.count() > 0


@pytest.mark.parametrize("tile_rows", [6, 4096])
def test_tiers_equal_the_complete_pair_table(world, tile_rows):
    base, table = world
    pairs = compare.compare(base, block="cell").cache()
    scores = compare.score_vectors(pairs, table)
    want = _set(tiers.tag_pairs(pairs, scores), "contentid", "tag")
    got = _set(
        tiers.duplicate_tiers(base, table, block="cell", tile_rows=tile_rows, vector_tile_rows=tile_rows),
        "contentid", "tag",
    )
    assert got == want
    assert {tag for _, tag in got} == {"red", "lightred", "darkred", "pink", "purple"}


def test_tier_inclusions(world):
    base, table = world
    tags = _set(tiers.duplicate_tiers(base, table, block="cell"), "contentid", "tag")
    by_tag = {t: {i for i, tag in tags if tag == t} for t in ("red", "lightred", "darkred", "pink", "purple")}
    assert by_tag["lightred"] <= by_tag["red"] & by_tag["darkred"]
    assert by_tag["pink"] <= by_tag["purple"] and by_tag["darkred"] <= by_tag["purple"]


def test_second_compare_adds_nothing(world):
    base, _ = world
    first = compare.compare(base, block="cell", max_metres=50).cache()
    assert first.count() > 0
    assert compare.compare(base, existing_pairs=first, block="cell", max_metres=50).count() == 0


def test_compare_columns_and_limits(world):
    base, _ = world
    everything = compare.compare(base, block="cell")
    cut = compare.compare(base, block="cell", max_metres=30, min_title_score=0.8, descriptions=False)
    kept = everything.filter("distance_in_meters <= 30 and similarity_score > 0.8")
    assert _set(cut, "duplicateid") == _set(kept, "duplicateid")
    assert everything.filter("contentid1 >= contentid2").count() == 0


def test_expand_neighbors_adds_pairs_across_blocks(world):
    base, _ = world
    inside = _set(compare.compare(base, block="cell", max_metres=50), "duplicateid")
    across = _set(compare.compare(base, block="cell", max_metres=50, expand_neighbors=True), "duplicateid")
    assert inside < across


def test_fill_scores_only_where_null(world):
    base, _ = world
    pairs = compare.compare(base, block="cell", max_metres=20)
    holes = pairs.withColumns(
        {
            "similarity_score": F.when(F.col("contentid1") < "id0100", F.lit(-1.0)).cast("float"),
            "distance_in_meters": F.lit(None).cast("float"),
        }
    )
    filled = compare.fill_distances(compare.fill_title_scores(holes, base), base)
    assert filled.count() == pairs.count()
    back = filled.filter("contentid1 >= 'id0100'")
    assert _set(back, "duplicateid", "similarity_score", "distance_in_meters") == _set(
        pairs.filter("contentid1 >= 'id0100'"), "duplicateid", "similarity_score", "distance_in_meters"
    )
    assert filled.filter("contentid1 < 'id0100' and similarity_score <> -1").count() == 0


def test_is_compared(world):
    base, _ = world
    sourced = base.withColumn("source_url", F.when(F.col("cell") == 7, "a").otherwise("b"))
    pairs = compare.compare(sourced, block="cell", max_metres=50).filter("cell = 7")
    assert compare.is_compared(pairs, sourced, "a").first().compared is True
    assert compare.is_compared(pairs, sourced, "b").first().compared is False


@pytest.mark.parametrize("native_rows, tile_rows", [(64, 1024), (1000, 1024), (3, 7), (10, 20)])
def test_cosine_pairs_of_mixed_lengths(spark, native_rows, tile_rows):
    rows = spark.range(100).selectExpr("id", "1 as cell", "if(id % 2 = 0, array(1F, 2F), array(1F, 2F, 3F)) as vec")
    pairs = vector_join.cosine_pairs(rows, ["cell"], "id", "vec", 0.5, False, native_rows, tile_rows)
    got = pairs.collect()
    assert len(got) == 2 * (50 * 49 // 2) and all((r.id1 - r.id2) % 2 == 0 for r in got)
    assert pairs.columns == ["cell", "id1", "id2", "score"]


@pytest.mark.parametrize("include_self", [False, True])
def test_cosine_tiles_meet_once(spark, include_self):
    rng = np.random.default_rng(4)
    vecs = rng.normal(size=(60, 3))
    names = [f"n{(i * 37) % 101}" for i in range(60)]
    rows = spark.createDataFrame([(n, 1, v.tolist(), i) for i, (n, v) in enumerate(zip(names, vecs))], "id string, cell int, vec array<double>, extra long")
    got = vector_join.cosine_pairs(rows, ["cell"], "id", "vec", 0.6, include_self, 5, 10).collect()
    unit = vecs / np.linalg.norm(vecs, axis=1)[:, None]
    want = {
        (names[i], names[j], i, j)
        for i in range(60) for j in range(60)
        if (names[i] < names[j] or include_self and i == j) and unit[i] @ unit[j] > 0.6
    }
    assert len(got) == len(want) and {(r.id1, r.id2, r.extra1, r.extra2) for r in got} == want


def test_merge_keeps_one_shape_and_partner_order(spark):
    base = spark.createDataFrame([(i, f"d{i}") for i in range(30)], "contentid long, description string")
    pairs = spark.createDataFrame([(0, i) for i in range(1, 30)], "contentid1 long, contentid2 long")
    ids = base.filter("contentid = 0").select("contentid")
    rows = tiers.merge_descriptions(base, pairs, ids).orderBy("position").collect()
    assert [tuple(r) for r in rows] == [(0, i, i, f"d{i}") for i in range(30)]
    whole = tiers.merge_descriptions(base, pairs, ids, "|").collect()
    assert [r.description for r in whole] == ["|".join(f"d{i}" for i in range(30))]


@pytest.mark.parametrize("many, few", [(3000, 1), (1, 3000), (2500, 1500)])
def test_uneven_block_join_copies_little(spark, many, few):
    left = spark.range(many).selectExpr("id as a", "1 as k")
    right = spark.range(few).selectExpr("id as b", "1 as k")
    rows = blocking.block_join(left, right, ["k"], "a", "b", F.col("a") % 7 == F.col("b") % 7, tile_rows=100)
    want = left.join(right, "k").filter(F.col("a") % 7 == F.col("b") % 7).count()
    assert rows.count() == want == rows.distinct().count()
    a, b = blocking.chunked(left, right, ["k"], "a", "b", tile_rows=100)[:2]
    assert a.count() == many * -(-few // 100) and b.count() == few * -(-many // 100)


def test_archive_and_survivors(world):
    base, table = world
    tags = tiers.duplicate_tiers(base, table, block="cell").cache()
    assert tiers.archive_duplicates(base, tags).count() == tags.count()
    every = tiers.one_tag_per_row(base, tags)
    assert every.count() == base.count()
    assert keyed.uniqueness_violations(every, ["contentid"]).count() == 0


def test_vector_scores_empty_and_missing(spark):
    vecs = spark.createDataFrame(
        [("a", [1.0, 0.0]), ("b", []), ("c", None), ("d", [0.0, 2.0])], "contentid string, embedding array<float>"
    )
    pairs = spark.createDataFrame([("a", "b"), ("a", "c"), ("a", "d"), ("b", "b")], "contentid1 string, contentid2 string")
    assert _set(compare.score_vectors(pairs, vecs), "contentid1", "contentid2", "score") == {
        ("a", "b", 0.0), ("a", "d", 0.0), ("b", "b", 0.0)
    }


def _edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


@pytest.mark.parametrize("most", [0, 1, 3])
def test_edit_pairs_match_brute_force(spark, most):
    rng = random.Random(most)
    titles = ["", "a", "ab", "é", "aaaa", "aaaaaaaa", "bababababa"]
    titles += ["".join(rng.choice("abé") for _ in range(rng.randint(0, 14))) for _ in range(120)]
    for t in titles[20:60]:
        at = rng.randint(0, len(t))
        titles.append(t[:at] + rng.choice(["x", "", "ab"]) + t[at + rng.randint(0, 2):])
    rows = [(i, t) for i, t in enumerate(titles)] + [(900, None), (None, "only"), (901, titles[-1]), (902, titles[-1])]
    df = spark.createDataFrame(rows, "id long, title string").withColumns({"size": F.lit(1), "part": F.lit("p")})
    smallest = {}
    for i, t in rows:
        if t is not None and i is not None:
            smallest.setdefault(t, i)
    want = set()
    for a, i in smallest.items():
        for b, j in smallest.items():
            if i < j and _edits(a, b) <= most:
                want.add((i, j, _edits(a, b)))
    got = [tuple(r) for r in search.edit_pairs(df, "id", "title", most, tile_rows=16).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert search.edit_pairs(df.limit(0), "id", "title", most).count() == 0
