"""Declared schemas and schema evolution."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RAW_TEXT = [
    "contentid", "source_id", "title", "subtitle", "breadcrumb", "category", "subcategory",
    "description", "short_description", "keywords", "source_url", "address", "address_detailed",
    "zipcode", "phone", "latitude", "longitude", "running_hours", "featured_image_url",
    "image_urls", "city", "country", "state",
]

# Raw JSON lines: every field is text, images are comma separated.
RAW_PLACE_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in _RAW_TEXT])

PLACE_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in _RAW_TEXT[:15]]
    + [
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("running_hours", T.StringType()),
        T.StructField("featured_image_url", T.StringType()),
        T.StructField("image_urls", T.ArrayType(T.StringType())),
        T.StructField("additional_info", T.StringType()),
        T.StructField("primary_data", T.BooleanType()),
        T.StructField("city", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("cell_coarse", T.LongType()),
        T.StructField("cell_fine", T.LongType()),
        T.StructField("word_count", T.IntegerType()),
        T.StructField("tag", T.StringType()),
        T.StructField("is_title_duplicate", T.BooleanType()),
        T.StructField("embeddings", T.StringType()),
    ]
)

PAIR_SCHEMA = T.StructType(
    [
        T.StructField("duplicateid", T.StringType()),
        T.StructField("contentid1", T.StringType()),
        T.StructField("contentid2", T.StringType()),
        T.StructField("titles", T.ArrayType(T.StringType())),
        T.StructField("cell", T.LongType()),
        T.StructField("point1", T.ArrayType(T.FloatType())),
        T.StructField("point2", T.ArrayType(T.FloatType())),
        T.StructField("descriptions", T.ArrayType(T.StringType())),
        T.StructField("similarity_score", T.FloatType()),
        T.StructField("similarity_score_2", T.FloatType()),
        T.StructField("distance_in_meters", T.FloatType()),
        T.StructField("soft_deleted", T.BooleanType()),
    ]
)

SCORE_SCHEMA = T.StructType(
    [
        T.StructField("contentid1", T.StringType()),
        T.StructField("contentid2", T.StringType()),
        T.StructField("score", T.FloatType()),
    ]
)

# The tags of the five tiers and the tag of everything else.
TIER_TAGS = ["red", "lightred", "darkred", "pink", "purple"]
DEFAULT_TAG = "blue"


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def empty_like(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], df.schema)


def ensure_columns(df: DataFrame, columns: dict[str, tuple[str, object]]) -> DataFrame:
    """Add each missing column as ``name: (type, default)``."""
    missing = {n: F.lit(d).cast(t) for n, (t, d) in columns.items() if n not in df.columns}
    return df.withColumns(missing) if missing else df


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to ``schema``: casts what is there, nulls for what is not."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Replace nulls by column defaults."""
    return df.withColumns({n: F.coalesce(F.col(n), F.lit(d)) for n, d in defaults.items()})
