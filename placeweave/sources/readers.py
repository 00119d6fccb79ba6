"""Sources. Each returns a lazy DataFrame with a declared schema where the
format has none of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placeweave.schemas import RAW_PLACE_SCHEMA
from placeweave.sources.json_elements import read_elements

_JSON_MODES = {"drop": "DROPMALFORMED", "fail": "FAILFAST", "null": "PERMISSIVE"}

_GEOJSON_SCHEMA = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("properties", T.StringType()),
        T.StructField(
            "geometry",
            T.StructType(
                [T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())]
            ),
        ),
    ]
)


def read_jsonl(
    spark: SparkSession, path: str, schema: T.StructType | str, on_bad: str = "drop"
) -> DataFrame:
    """JSON lines; blank lines are skipped, broken ones dropped, fatal or
    null by ``on_bad``."""
    return spark.read.schema(schema).option("mode", _JSON_MODES[on_bad]).json(path)


def read_places_json(spark: SparkSession, path: str, on_bad: str = "drop") -> DataFrame:
    return read_jsonl(spark, path, RAW_PLACE_SCHEMA, on_bad)


def read_json_array(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A file that holds one JSON array of values of any kind. One task reads a
    file; ``json_elements.read_object_array`` reads large arrays of objects."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_array_parts(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Elements of a document that was written in part files, one per line."""
    lines = spark.read.text(path).select(F.regexp_replace("value", r"^,", "").alias("value"))
    framed = F.col("value").isin("[", "]", "]}", '{"type":"FeatureCollection","features":[')
    return lines.filter(~framed).select(F.from_json("value", schema).alias("e")).select("e.*")


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, multiline: bool = False
) -> DataFrame:
    """CSV with a header; without a schema every column is a string. Quotes
    inside quoted fields are doubled."""
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multiline)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_table(spark: SparkSession, source: str) -> DataFrame:
    """A parquet folder or a catalogue table."""
    return spark.read.parquet(source) if "/" in source else spark.table(source)


def read_geojson(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Features as ``(feature, properties, kind, coordinates, rings)``.

    ``rings`` is an array of rings of (x, y) for polygons and multipolygons
    and null for other geometries. A collection is read by many tasks, cut at
    its braces; a file of one feature per line (``lines``) at its lines.
    """
    if lines:
        features = spark.read.schema(_GEOJSON_SCHEMA).json(path).withColumn("feature", F.lit(None).cast("int"))
    else:
        features = (
            read_elements(spark, path, "features")
            .select(F.col("element").cast("int").alias("feature"), F.from_json("value", _GEOJSON_SCHEMA).alias("f"))
            .select("feature", "f.*")
            .filter(F.col("type") == "Feature")
        )
    kind, text = F.col("geometry.type"), F.col("geometry.coordinates")
    polygon = F.from_json(F.when(kind == "Polygon", text), "array<array<array<double>>>")
    several = F.from_json(F.when(kind == "MultiPolygon", text), "array<array<array<array<double>>>>")
    rings = F.coalesce(polygon, F.flatten(several))
    return features.select(
        "feature",
        "properties",
        kind.alias("kind"),
        text.alias("coordinates"),
        F.transform(
            rings, lambda ring: F.transform(ring, lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))
        ).alias("rings"),
    )


def first_boundary(features: DataFrame) -> DataFrame:
    """The first feature of a collection."""
    return features.filter(F.col("feature") == 0)


def read_jdbc(spark: SparkSession, table: str, **options: str) -> DataFrame:
    """One relational table; connection options come from the caller.

    Give ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions`` to read in parallel.
    """
    return spark.read.format("jdbc").option("dbtable", table).options(**options).load()


def jdbc_tables(spark: SparkSession, schema: str = "public", **options: str) -> DataFrame:
    """Names of the tables of a relational schema."""
    listing = read_jdbc(spark, "information_schema.tables", **options)
    return listing.filter(F.col("table_schema") == schema).select("table_name")


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Tables and views of the session catalogue."""
    where = f" IN {database}" if database else ""
    return spark.sql(f"SHOW TABLES{where}").select(F.col("tableName").alias("table_name"))


def describe(df: DataFrame) -> DataFrame:
    """Column names and types as rows."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, column_type string, nullable boolean")
