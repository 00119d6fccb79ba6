"""From raw place records to the typed, indexed place table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placeweave.functions import geo, text
from placeweave.operators.keyed import fill_nulls, upsert_rows
from placeweave.schemas import DEFAULT_TAG, PLACE_SCHEMA, conform, ensure_columns
from placeweave.sources.readers import read_places_json


def coordinate(c: Column, narrow: bool = False) -> Column:
    """Text to a coordinate; anything unreadable gives null."""
    value = c.try_cast("float" if narrow else "double")
    return value.cast("double")


def cells(lat: Column, lon: Column, narrow: bool = True) -> tuple[Column, Column]:
    """Coarse and fine cell. ``narrow`` rounds coordinates to 32 bits first,
    as the stored index does."""
    if narrow:
        lat, lon = lat.cast("float").cast("double"), lon.cast("float").cast("double")
    return tuple(geo.geo_cell(lat, lon, level) for level in (geo.COARSE_LEVEL, geo.FINE_LEVEL))


def project_places(raw: DataFrame) -> DataFrame:
    """Raw text records to the place table's columns."""
    lat, lon = coordinate(F.col("latitude")), coordinate(F.col("longitude"))
    coarse, fine = cells(lat, lon)
    typed = raw.withColumns(
        {
            "cell_coarse": coarse,
            "cell_fine": fine,
            "latitude": lat,
            "longitude": lon,
            "image_urls": text.split_literal(F.col("image_urls"), ","),
            "additional_info": F.lit("{}"),
            "primary_data": F.lit(False),
            "is_title_duplicate": F.lit(False),
            "embeddings": F.lit("{}"),
            "word_count": F.lit(0),
            "tag": F.lit(DEFAULT_TAG),
        }
    )
    return conform(typed, PLACE_SCHEMA)


def ingest(
    spark: SparkSession,
    path: str,
    existing: DataFrame | None = None,
    on_bad: str = "drop",
    order: list[str] | None = None,
) -> DataFrame:
    """Read JSON lines, type them and replace existing rows of the same id."""
    fresh = project_places(read_places_json(spark, path, on_bad))
    order = order or ["source_url", "source_id", "title"]
    if existing is None:
        existing = fresh.limit(0)
    return upsert_rows(existing, fresh, ["contentid"], order)


def index_cells(
    df: DataFrame,
    lat: str = "latitude",
    lon: str = "longitude",
    levels: tuple[int, int] = (geo.COARSE_LEVEL, geo.FINE_LEVEL),
    narrow: bool = False,
) -> DataFrame:
    """Add both cell columns where absent and fill them where null."""
    y, x = F.col(lat), F.col(lon)
    if narrow:
        y, x = y.cast("float").cast("double"), x.cast("float").cast("double")
    df = ensure_columns(df, {"cell_coarse": ("long", None), "cell_fine": ("long", None)})
    return fill_nulls(
        df,
        {name: geo.geo_cell(y, x, level) for name, level in zip(("cell_coarse", "cell_fine"), levels)},
    )


def fill_word_counts(df: DataFrame, column: str = "description") -> DataFrame:
    return df.withColumn("word_count", text.word_count(F.col(column)))
