import math

import pytest
from pyspark.sql import functions as F

from placeweave.functions import geo
from placeweave.operators import ingest, spatial


def _one(spark, *columns):
    return spark.range(1).select(*columns).first()


@pytest.fixture(scope="module")
def square(spark):
    """A square with a square hole, and a feature without geometry."""
    outer = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]
    hole = [(1.0, 1.0), (3.0, 1.0), (3.0, 3.0), (1.0, 3.0), (1.0, 1.0)]
    return spark.createDataFrame(
        [("s", [outer, hole]), ("n", None)], "name string, rings array<array<struct<x:double,y:double>>>"
    )


POINTS = [("in", 0.5, 0.5), ("hole", 2.0, 2.0), ("out", 5.0, 5.0), ("edge", 0.0, 2.0), ("corner", 4.0, 4.0)]


def test_polygon_holes_edges_and_nulls(spark, square):
    points = spark.createDataFrame(POINTS + [("null", None, 1.0)], "id string, latitude double, longitude double")
    joined = spatial.boundary_join(points, square, "name")
    assert [r.id for r in joined.collect()] == ["in"]
    coarse = spatial.boundary_join(points, square, "name", level=3)
    assert [r.id for r in coarse.collect()] == ["in"]


def test_boundary_join_equals_direct_test(spark, square):
    grid = spark.range(41).selectExpr("id / 10e0 + 0.01 as latitude").crossJoin(
        spark.range(41).selectExpr("id / 10e0 + 0.013 as longitude")
    ).withColumn("id", F.monotonically_increasing_id()).cache()
    rings = square.filter("name = 's'")
    joined = spatial.boundary_join(grid, rings, "name", level=8).select("id")
    direct = grid.crossJoin(rings).filter(geo.in_polygon(F.col("latitude"), F.col("longitude"), F.col("rings")))
    assert {r.id for r in joined.collect()} == {r.id for r in direct.collect()}
    assert spatial.within_boundary(grid, square, "name", "id").count() == direct.count()


def test_cells_contain_their_points_and_parents(spark):
    lat, lon = F.lit(40.7128), F.lit(-74.006)
    row = _one(
        spark,
        geo.geo_cell(lat, lon, 20).alias("fine"),
        geo.geo_cell(lat, lon, 14).alias("coarse"),
        geo.cell_parent(geo.geo_cell(lat, lon, 20), 6).alias("parent"),
        geo.geo_cell(F.lit(None).cast("double"), lon, 14).alias("none"),
    )
    assert row.parent == row.coarse and row.none is None and row.fine > row.coarse


@pytest.mark.parametrize("lat", [0.0, 40.7, -70.0])
@pytest.mark.parametrize("dlat, dlon", [(1e-4, 0.0), (0.0, 1e-4), (3e-3, -4e-3), (0.05, 0.05)])
def test_spheroid_close_to_geodesic(spark, lat, dlat, dlon):
    points = [F.lit(lat), F.lit(-74.0), F.lit(lat + dlat), F.lit(-74.0 + dlon)]
    row = _one(spark, geo.distance_spheroid(*points).alias("s"), geo.distance_geodesic(*points).alias("g"))
    assert row.s == pytest.approx(row.g, rel=2e-6)


def test_geodesic_known_values(spark):
    # one degree along the equator and along a meridian at the equator
    def metres(*p):
        return _one(spark, geo.distance_geodesic(*[F.lit(float(v)) for v in p]).alias("m")).m

    assert metres(0, 0, 0, 1) == pytest.approx(math.radians(1) * geo.SEMI_MAJOR, abs=1e-3)
    assert metres(0, 0, 1, 0) == pytest.approx(110574.389, abs=1e-2)
    assert metres(0, 179.5, 0, -179.5) == pytest.approx(metres(0, 0, 0, 1), abs=1e-6)
    assert metres(10, 20, 10, 20) == 0
    assert metres(0, 0, 0.2, 179.9) > 1.99e7


def test_move_point_distance(spark):
    y, x = geo.move_point(F.lit(40.7), F.lit(-74.0), F.lit(1500.0), F.lit(-2000.0))
    row = _one(spark, geo.distance_geodesic(F.lit(40.7), F.lit(-74.0), y, x).alias("m"))
    assert row.m == pytest.approx(2500, rel=1e-3)


def test_disk_list_equals_arithmetic(spark):
    df = spark.range(400).selectExpr("40.5 + (id % 20) / 50e0 as lat", "-74.2 + floor(id / 20) / 50e0 as lon")
    df = df.withColumn("cell", geo.geo_cell(F.col("lat"), F.col("lon"), 14))
    listed = spatial.areas_with_cells(df, spatial.cell_disk(spark, 40.7, -74.0, 14, 9))
    direct = df.filter(geo.in_disk(F.col("lat"), F.col("lon"), 40.7, -74.0, 14, 9))
    assert sorted(listed.select("lat", "lon").collect()) == sorted(direct.select("lat", "lon").collect())
    assert spatial.cell_disk(spark, 40.7, -74.0, 14, 23).count() == 47 * 47


@pytest.mark.parametrize("tile_rows", [4, 4096])
def test_nearby_equals_brute_force(spark, tile_rows):
    points = spark.range(200).selectExpr("id", "40.7 + (id % 14) / 1e3 as latitude", "-74 + floor(id / 14) / 1e3 as longitude")
    hot = spark.range(60).selectExpr("id + 1000 as id", "40.7 as latitude", "-74.0 as longitude")
    points = points.unionByName(hot)
    centers = spark.createDataFrame([("a", 40.7, -74.0), ("b", 40.706, -73.994)], "c string, latitude double, longitude double")
    got = spatial.nearby(points, centers, 400, "id", "c", tile_rows=tile_rows)
    p, c = points.alias("p"), centers.alias("c")
    apart = geo.distance_haversine(F.col("p.latitude"), F.col("p.longitude"), F.col("c.latitude"), F.col("c.longitude"))
    want = p.crossJoin(c).filter(apart <= 400).select("c.c", "p.id")
    assert sorted(got.select("c", "id").collect()) == sorted(want.collect())


def test_index_fills_only_missing_cells(spark):
    df = spark.createDataFrame([(1, 40.7, -74.0, 5), (2, 40.7, -74.0, None), (3, None, None, None)],
                               "id int, latitude double, longitude double, cell_coarse long")
    rows = {r.id: r for r in ingest.index_cells(df).collect()}
    assert rows[1].cell_coarse == 5 and rows[2].cell_coarse is not None
    assert rows[3].cell_coarse is None and rows[1].cell_fine == rows[2].cell_fine


def _star(n, radius, lat=40.7, lon=-74.0, jags=0.4):
    """A closed, jagged ring with ``n`` corners."""
    spokes = [(2 * math.pi * k / n, radius * (1 - jags + jags * ((k * 7919) % 13) / 13)) for k in range(n)]
    ring = [(lon + r * math.cos(a), lat + r * math.sin(a)) for a, r in spokes]
    return [{"x": x, "y": y} for x, y in [*ring, ring[0]]]


def test_cover_of_several_sizes(spark):
    rows = [
        ("big", [_star(400, 1.5)]),
        ("holed", [_star(60, 0.4), _star(50, 0.2)]),
        ("small", [_star(7, 0.01)]),
        ("point", [[{"x": -74.0, "y": 40.7}] * 3]),
        ("none", None),
        ("empty", []),
    ]
    polygons = spark.createDataFrame(rows, "name string, rings array<array<struct<x: double, y: double>>>")
    points = spark.range(6_000).selectExpr(
        "id", "39.1 + (id * 7 % 1201) * 0.00271 as latitude", "-75.6 + (id * 11 % 1187) * 0.00277 as longitude"
    )
    near = spark.range(900).selectExpr("id + 20000 as id", "40.69 + (id % 30) / 1.5e3 as latitude", "-74.01 + floor(id / 30) / 1.5e3 as longitude")
    points = points.unionByName(near).unionByName(spark.createDataFrame([(1, None, None)], points.schema))
    for level in (18, 7, 2):
        got = spatial.boundary_join(points, polygons, "name", level=level).select("name", "id")
        want = points.crossJoin(polygons).filter(geo.in_polygon(F.col("latitude"), F.col("longitude"), F.col("rings")))
        assert sorted(got.collect()) == sorted(want.select("name", "id").collect())
    assert spatial.boundary_join(points, polygons.limit(0), "name").collect() == []


def test_cover_grows_with_the_border(spark):
    schema = "name string, rings array<array<struct<x: double, y: double>>>"
    size = lambda n, radius: spatial.boundary_cover(
        spark.createDataFrame([("a", [_star(n, radius, jags=0.01)])], schema), "name"
    )
    one, wide, fine = size(300, 0.5), size(300, 4.0), size(2400, 0.5)
    assert wide.count() < 4 * one.count()
    assert fine.count() < 16 * one.count()
    edges = fine.agg(F.sum(F.size("edges")).alias("n"), F.max(F.size("edges")).alias("most")).first()
    assert edges.n < 4 * 2400 and edges.most <= spatial.LEAF_EDGES
    assert fine.filter("size(edges) = 0").count() > 0


def test_polygon_filter_counts_crossings_on_an_edge(spark, tmp_path):
    """Places with the very longitude of the west edge follow the SQL."""
    import duckdb

    from placeweave.plans import catalog

    title = next(
        "the" + a + b + c
        for a in "abcdefgh" for b in "abcdefghijklmnopqrstuvwxyz" for c in "abcdefghijklmnopqrstuvwxyz"
        if (ord(a) * 31 + ord(b) * 17 + ord(c) * 7) % 558 == 59
    )
    docs = [(n, title + " place", "s", "en") for n in range(1, 40)]
    spark.createDataFrame(docs, "doc_id long, text string, source string, lang string").write.parquet(
        str(tmp_path / "documents.parquet")
    )
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = set(duck.execute(catalog.ORACLES["polygon_filter"]).fetchall())
    got = catalog.QUERIES["polygon_filter"](spark, str(tmp_path)).collect()
    assert {1, 9, 17} <= {row[0] for row in want}
    assert {tuple(row) for row in got} == want


def test_search_points_of_one_file_are_dealt_to_all_tasks(spark):
    centers = spark.range(200).selectExpr("id AS area", "40e0 + id / 1e3 AS latitude", "-74e0 AS longitude").coalesce(1)
    grid = spatial.coverage_grid(centers, "area")
    used = grid.select(F.spark_partition_id().alias("task")).distinct().count()
    assert used > 1 and grid.count() == 200 * 81
    y, x = geo.move_point(F.lit(40.05), F.lit(-74.0), F.lit(1500.0), F.lit(-500.0))
    want = _one(spark, y.alias("latitude"), x.alias("longitude"))
    got = grid.filter("area = 50 AND step_east = 3 AND step_north = -1").select("latitude", "longitude").first()
    assert got == want
