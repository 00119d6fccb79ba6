"""Boundary joins, radius search, disks and coverage grids."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from placeweave.functions import geo
from placeweave.operators.blocking import TILE_ROWS, block_join
from placeweave.session import settle

BOUNDARY_LEVEL = 18  # finest cells of a cover
LEAF_EDGES = 16  # a border cell with so few edges isn't split
DEEPEST = 8  # levels below the polygon's first cells
MARGIN = 1e-9  # degrees


def _box(level: Column, row: Column, col: Column) -> list[Column]:
    """South, west, north and east of a cell."""
    size = F.lit(180.0) / F.pow(F.lit(2.0), level)
    return [row * size - 90.0, col * size - 180.0, (row + 1) * size - 90.0, (col + 1) * size - 180.0]


def _edges_in(edges: Column, south: Column, west: Column, north: Column, east: Column) -> Column:
    """Edges that reach into the cell: their own box meets it, and its corners
    are not all on one side of their line."""

    def meets(e: Column) -> Column:
        side = lambda x, y: (e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"])
        corners = [side(x, y) for x in (west, east) for y in (south, north)]
        return (
            (F.greatest(e["y1"], e["y2"]) >= south - MARGIN)
            & (F.least(e["y1"], e["y2"]) <= north + MARGIN)
            & (F.greatest(e["x1"], e["x2"]) >= west - MARGIN)
            & (F.least(e["x1"], e["x2"]) <= east + MARGIN)
            & (F.least(*corners) <= MARGIN)
            & (F.greatest(*corners) >= -MARGIN)
        )

    return F.filter(edges, meets)


def boundary_cover(polygons: DataFrame, id_col: str, rings: str = "rings", level: int = BOUNDARY_LEVEL) -> DataFrame:
    """Cells of several sizes that cover each polygon: ``(id, _level, _row,
    _col, _odd, edges)``, settled.

    A polygon starts with at most four cells of about its own size. Cells with
    more than ``LEAF_EDGES`` edges are split into sixteen, down to ``level`` or
    ``DEEPEST`` levels below the first; cells without edges are inside as a whole or go. So large inner cells carry
    nothing, border cells their own edges and, as ``_odd``, whether their
    south-east corner is inside: the cover grows with the border, not the area.
    """
    outlined = (
        polygons.filter(F.col(rings).isNotNull())
        .select(F.col(id_col), geo.edges_of(F.col(rings)).alias("edges"))
        .filter(F.size("edges") > 0)
    )
    ends = {
        "_south": F.array_min(F.transform("edges", lambda e: F.least(e["y1"], e["y2"]))),
        "_north": F.array_max(F.transform("edges", lambda e: F.greatest(e["y1"], e["y2"]))),
        "_west": F.array_min(F.transform("edges", lambda e: F.least(e["x1"], e["x2"]))),
        "_east": F.array_max(F.transform("edges", lambda e: F.greatest(e["x1"], e["x2"]))),
    }
    outlined = settle(outlined.withColumns(ends), "outlines")
    extent = F.greatest(F.col("_north") - F.col("_south"), F.col("_east") - F.col("_west"), F.lit(1e-9))
    first = F.least(F.floor(F.log2(F.lit(180.0) / extent) / 2) * 2, F.lit(level - level % 2))
    cells = outlined.withColumn("_level", F.greatest(first, F.lit(0)).cast("int"))
    cells = cells.withColumn("_last", F.least(F.col("_level") + DEEPEST, F.lit(level)))
    size = F.lit(180.0) / F.pow(F.lit(2.0), F.col("_level"))
    span = lambda low, high, base: F.sequence(
        F.floor((F.col(low) + base) / size).cast("long"), F.floor((F.col(high) + base) / size).cast("long")
    )
    cells = cells.withColumn("_row", F.explode(span("_south", "_north", 90.0)))
    cells = cells.withColumn("_col", F.explode(span("_west", "_east", 180.0)))
    south, west, north, east = _box(F.col("_level"), F.col("_row"), F.col("_col"))
    cells = cells.select(
        id_col, "_last", "_level", "_row", "_col",
        (geo.crossings_east(south, east, F.lit(400.0), F.col("edges")) % 2 == 1).alias("_odd"),
        _edges_in(F.col("edges"), south, west, north, east).alias("_e"),
    ).withColumnRenamed("_e", "edges")
    done = []
    while True:
        cells = settle(cells.filter((F.size("edges") > 0) | F.col("_odd")), "cells")
        splits = (F.size("edges") > LEAF_EDGES) & (F.col("_level") + 2 <= F.col("_last"))
        done.append(cells.filter(~splits))
        parents = cells.filter(splits)
        if parents.isEmpty():
            return settle(reduce(DataFrame.unionByName, done).drop("_last"), "cover")
        quarter = F.sequence(F.lit(0), F.lit(3))
        parents = parents.withColumn("_dr", F.explode(quarter)).withColumn("_dc", F.explode(quarter))
        from_south, _, _, from_east = _box(F.col("_level"), F.col("_row"), F.col("_col"))
        inner = F.col("_level") + 2, F.col("_row") * 4 + F.col("_dr"), F.col("_col") * 4 + F.col("_dc")
        south, west, north, east = _box(*inner)
        # from the corner of the large cell up its side, then west to the small one's
        met = geo.crossings_north(from_east, from_south, south, F.col("edges")) + geo.crossings_east(
            south, east, from_east, F.col("edges")
        )
        # under new names first: inside lambdas an alias hides the column it reuses
        cells = parents.select(
            id_col, "_last", inner[0].alias("_l"), inner[1].alias("_r"), inner[2].alias("_c"),
            (F.col("_odd") != (met % 2 == 1)).alias("_o"),
            _edges_in(F.col("edges"), south, west, north, east).alias("_e"),
        ).toDF(id_col, "_last", "_level", "_row", "_col", "_odd", "edges")


def boundary_join(
    points: DataFrame,
    polygons: DataFrame,
    polygon_id: str,
    lat: str = "latitude",
    lon: str = "longitude",
    rings: str = "rings",
    level: int = BOUNDARY_LEVEL,
) -> DataFrame:
    """Points with each polygon that contains them.

    An equi-join on the cell, once per size of cells in the cover, and a test
    against the edges of the cell. Spark broadcasts the cover when its measured
    size is small and splits crowded cells otherwise.
    """
    cover = boundary_cover(polygons, polygon_id, rings, level)
    # at most one per level, whatever the number of polygons
    levels = sorted(r["_level"] for r in cover.select("_level").distinct().collect())
    at = [
        F.struct(
            F.lit(n).alias("_level"),
            geo.cell_row(F.col(lat), n).alias("_row"),
            geo.cell_col(F.col(lon), n).alias("_col"),
        )
        for n in levels
    ]
    kind = "array<struct<_level: int, _row: bigint, _col: bigint>>"
    cells = F.array(*at) if at else F.array()
    placed = points.withColumn("_cell", F.explode(cells.cast(kind)))
    placed = placed.withColumns({c: F.col(f"_cell.{c}") for c in ("_level", "_row", "_col")}).drop("_cell")
    south, _, _, east = _box(F.col("_level"), F.col("_row"), F.col("_col"))
    inside = geo.in_cell(F.col(lat), F.col(lon), south, east, F.col("_odd"), F.col("edges"))
    return (
        placed.join(cover, ["_level", "_row", "_col"])
        .filter(inside)
        .drop("_level", "_row", "_col", "_odd", "edges")
    )


def within_boundary(points: DataFrame, polygons: DataFrame, polygon_id: str, key: str, **options) -> DataFrame:
    """Points inside any of the polygons, each once."""
    inside = boundary_join(points, polygons, polygon_id, **options).select(key)
    return points.join(inside, key, "left_semi")


def nearby(
    points: DataFrame,
    centers: DataFrame,
    radius_m: float,
    point_id: str,
    center_id: str,
    lat: str = "latitude",
    lon: str = "longitude",
    distance: str = "haversine",
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """``(center_id, point_id, distance_m)`` for points within the radius.

    Centres are spread over the neighbouring cells; cells with many points
    are split, since a single cell may hold a large part of them.
    """
    level = geo.near_level(radius_m)
    places = points.select(point_id, F.col(lat).alias("_lat1"), F.col(lon).alias("_lon1"))
    places = places.dropna(subset=["_lat1", "_lon1"])
    row, col = geo.near_keys(F.col("_lat1"), F.col("_lon1"), level)
    spots = centers.select(center_id, F.col(lat).alias("_lat2"), F.col(lon).alias("_lon2"))
    spots = spots.dropna(subset=["_lat2", "_lon2"]).withColumn(
        "_key", F.explode(geo.near_offsets(F.col("_lat2"), F.col("_lon2"), level, radius_m))
    )
    spots = spots.withColumns({"_row": F.col("_key.row"), "_col": F.col("_key.col")}).drop("_key")
    apart = geo.DISTANCES[distance](F.col("_lat1"), F.col("_lon1"), F.col("_lat2"), F.col("_lon2"))
    return block_join(
        places.withColumns({"_row": row, "_col": col}), spots, ["_row", "_col"], point_id, center_id,
        apart <= radius_m, tile_rows,
    ).select(center_id, point_id, apart.alias("distance_m"))


def cell_disk(spark: SparkSession, lat: float, lon: float, level: int, k: int) -> DataFrame:
    """Ids of the cells within ``k`` rings of a centre, a table of fixed size."""
    start = spark.range(1).select(
        geo.cell_row(F.lit(lat), level).alias("r"), geo.cell_col(F.lit(lon), level).alias("c")
    )
    rows = start.select(F.explode(F.sequence(F.col("r") - k, F.col("r") + k)).alias("r"), "c")
    return rows.select("r", F.explode(F.sequence(F.col("c") - k, F.col("c") + k)).alias("c")).select(
        geo.cell_of(F.col("r"), F.col("c")).alias("cell")
    )


def coverage_grid(
    centers: DataFrame,
    area: str,
    lat: str = "latitude",
    lon: str = "longitude",
    step_m: float = 500,
    area_m: float = 2000,
) -> DataFrame:
    """Search points around each centre: ``(area, step_east, step_north,
    latitude, longitude)``, the square of 2 * area_m / step_m + 1 per side."""
    n = int(area_m / step_m)
    steps = F.sequence(F.lit(-n), F.lit(n))
    # a small file of centres has one task, its search points need all
    tasks = int(centers.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = centers.select(area, F.col(lat).alias("_lat"), F.col(lon).alias("_lon")).repartition(tasks)
    # the way north first: radii are computed once per row of the square
    rows = rows.select("*", F.explode(steps).alias("step_north"))
    y = F.col("_lat") + F.degrees(F.col("step_north") * float(step_m) / geo.meridian_radius(F.col("_lat")))
    rows = rows.withColumn("latitude", y).withColumn("_radius", geo.parallel_radius(F.col("latitude")))
    grid = rows.select("*", F.explode(steps).alias("step_east"))
    x = F.col("_lon") + F.degrees(F.col("step_east") * float(step_m) / F.col("_radius"))
    return grid.select(area, "step_east", "step_north", "latitude", x.alias("longitude"))


def coverage_status(
    points: DataFrame,
    grid: DataFrame,
    area: str,
    point_id: str,
    radius_m: float = 250,
    sparse: int = 50,
    full: int = 100,
) -> DataFrame:
    """Places found around each area's search points: ``sparse`` below the
    first limit (search finer), ``full`` from the second on (stop)."""
    searches = grid.withColumn("_search", F.struct(area, "step_east", "step_north"))
    hits = nearby(points, searches, radius_m, point_id, "_search")
    counts = hits.groupBy(F.col(f"_search.{area}").alias(area)).agg(F.count(F.lit(1)).alias("places"))
    found = F.coalesce("places", F.lit(0).cast("long"))
    return (
        grid.select(area).distinct().join(counts, area, "left")
        .select(
            area,
            found.alias("places"),
            F.when(found < sparse, "sparse").when(found < full, "ok").otherwise("full").alias("status"),
        )
    )


def _searched(
    points: DataFrame, searches: DataFrame, area: str, point_id: str, radius_m: float, per_search: int
) -> DataFrame:
    """Distinct (area, point) of searches that return their nearest places up
    to a number, as paged services do."""
    hits = nearby(points, searches.withColumn("_search", F.struct(area, "step_east", "step_north")), radius_m, point_id, "_search")
    nearest = Window.partitionBy("_search").orderBy(F.round("distance_m", 3), point_id)
    hits = hits.withColumn("_turn", F.row_number().over(nearest)).filter(F.col("_turn") <= per_search)
    return hits.select(F.col(f"_search.{area}").alias(area), point_id).distinct()


def refine_coverage(
    points: DataFrame,
    centers: DataFrame,
    area: str,
    point_id: str,
    lat: str = "latitude",
    lon: str = "longitude",
    area_m: float = 2000,
    finest_m: float = 250,
    per_search: int = 60,
    sparse: int = 50,
    full: int = 100,
) -> DataFrame:
    """Search each area again on ever finer grids until it is covered:
    ``(area, round, step_m, searches, places, status)``.

    The first round searches once around the centre, ``area_m`` wide; an area
    with at least ``sparse`` places is done. In the others a grid of half the
    step before covers the area, searched a step wide, until ``full`` places are
    known or the step would fall below ``finest_m``. A search returns its
    ``per_search`` nearest places, so finer grids find more. Areas that are
    open and what they found are tables of the round; an area without places
    counts as 0.
    """
    todo = centers.select(area, F.col(lat).alias("_lat"), F.col(lon).alias("_lon"))
    found = None
    done = []
    step, number = float(area_m), 0
    while True:
        if number == 0:
            grid = todo.select(
                area, F.lit(0).alias("step_east"), F.lit(0).alias("step_north"),
                F.col("_lat").alias("latitude"), F.col("_lon").alias("longitude"),
            )
        else:
            grid = coverage_grid(todo, area, "_lat", "_lon", step, area_m)
        hits = _searched(points, grid, area, point_id, step, per_search)
        if found is not None:
            hits = found.join(todo.select(area), area, "left_semi").unionByName(hits).distinct()
        found = settle(hits, "covered")
        counts = found.groupBy(area).agg(F.count(F.lit(1)).alias("places"))
        state = todo.join(counts, area, "left").withColumn("places", F.coalesce("places", F.lit(0).cast("long")))
        state = settle(state, "areas")
        last = step / 2 < finest_m
        enough = F.lit(True) if last else F.col("places") >= (sparse if number == 0 else full)
        done.append(
            state.filter(enough).select(
                area, F.lit(number).alias("round"), F.lit(step).alias("step_m"),
                F.lit(1 if number == 0 else (2 * int(area_m / step) + 1) ** 2).alias("searches"), "places",
                F.when(F.col("places") < sparse, "sparse").when(F.col("places") < full, "ok").otherwise("full").alias("status"),
            )
        )
        todo = state.filter(~enough).drop("places")
        if last or todo.isEmpty():
            return reduce(DataFrame.unionByName, done)
        step, number = step / 2, number + 1


def areas_with_cells(points: DataFrame, cells: DataFrame, cell: str = "cell") -> DataFrame:
    """Points whose cell is listed."""
    return points.join(cells.select(cell), cell, "left_semi")
