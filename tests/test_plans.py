"""Shapes of physical plans."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from placeweave.functions import geo
from placeweave.functions.similarity import title_may_exceed, title_profile
from placeweave.operators import blocking, keyed
from placeweave.plans import places
from placeweave.session import settle


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, sf_dir):
    return settle(places.places(spark, sf_dir))


def test_box_reaches_the_scan_and_columns_are_pruned(spark, stored):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    box = geo.in_bbox(F.col("latitude"), F.col("longitude"), 40.5, -74.2, 40.9, -73.7)
    plan = _plan(stored.filter(box).select("contentid"))
    assert "GreaterThan(latitude,40.5)" in plan and "LessThan(longitude,-73.7)" in plan
    assert "description" not in plan.split("ReadSchema")[1]


def test_block_join_reads_only_what_it_needs(stored):
    rows = stored.select("contentid", "cell", "latitude", "longitude")
    pairs = blocking.near_pairs(rows, "contentid", "latitude", "longitude", 50, block="cell")
    plan = _plan(pairs)
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "description" not in plan


def test_distance_is_part_of_the_join(stored):
    rows = stored.select("contentid", "cell", "latitude", "longitude")
    plan = _plan(blocking.near_pairs(rows, "contentid", "latitude", "longitude", 50, block="cell"))
    join = next(line for line in plan.splitlines() if "Join" in line and "Inner" in line)
    assert "ASIN" in join


def test_hot_keys_are_split(spark):
    rows = spark.range(1000).selectExpr("id", "if(id < 400, 0, id) as k")
    hot = blocking.hot_keys(rows, ["k"], 100)
    assert [tuple(r) for r in hot.table.collect()] == [(0, 4)] and hot.small
    assert blocking.hot_keys(rows, ["k"], 1000).table is None


def test_many_hot_keys_are_joined_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(blocking, "BROADCAST_KEYS", 3)
    rows = spark.range(200).selectExpr("id", "id % 10 as k")
    assert not blocking.hot_keys(rows, ["k"], 5).small
    pairs = blocking.self_pairs(rows, ["k"], "id", tile_rows=5)
    assert pairs.count() == 10 * 190 and pairs.distinct().count() == 10 * 190


def test_upsert_sends_one_row_per_key_and_task(spark):
    df = spark.range(1000).selectExpr("id % 3 as k", "id")
    assert "WindowGroupLimit" in _plan(keyed.upsert_rows(df.limit(0), df, ["k"], ["id"]))


@pytest.mark.parametrize(
    "name", ["boundary_join", "coverage_status", "dedup_places", "fallback_enrich", "topk_filtered", "trigram_pairs"]
)
def test_no_cross_products(spark, sf_dir, name):
    plan = _plan(entry_points.queries()[name](spark, sf_dir))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_join_code_is_short_enough_to_be_compiled(spark):
    """The JVM leaves methods of more than 8000 bytes interpreted."""
    titled = spark.range(50).selectExpr(
        "id as gid", "'a title' as title", "1 as cell", "id % 2 = 0 as scored", "40.7 as latitude", "-74.0 as longitude"
    )
    groups = settle(titled.withColumn("profile", title_profile(F.col("title"))))
    bound = title_may_exceed("profile1", "profile2", 0.85, looser=0.7, when="scored1 AND scored2")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for distance in ("haversine", "spheroid"):
            near = blocking.near_pairs(groups, "gid", "latitude", "longitude", 50, distance, "cell", bound)
            code = near._jdf.queryExecution().debug().codegenToSeq()
            sizes = [code.apply(i)._3().maxMethodCodeSize() for i in range(code.size())]
            assert sizes and max(sizes) < 8000, sizes
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
