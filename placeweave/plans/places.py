"""Points of interest derived from the documents table.

The title is the opening words of the text, the description the whole text.
Coordinates follow from the first letters of the title, so near copies land
in the same cell; the id moves a point by steps of about 11 m.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeweave.functions import geo
from placeweave.plans.registry import table
from placeweave.operators.tiers import TierRules

# Fixed value: up to six words of at most fifteen characters.
TITLE = r"^\S{1,15}(?:\s\S{1,15}){0,5}"

# The test vectors are random, so thresholds are lower than the defaults.
TEST_RULES = TierRules(vector=0.15, vector_loose=0.10)


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    named = docs.select(
        F.col("doc_id").alias("contentid"),
        F.regexp_extract("text", TITLE, 0).alias("title"),
        F.col("text").alias("description"),
        "source",
        F.col("lang").alias("category"),
    )

    def letter(n: int):
        return F.ascii(F.substring("title", n, 1))

    north = (letter(1) * 31 + letter(2) * 17 + letter(3) * 7) % 440
    east = (letter(4) * 31 + letter(5) * 17 + letter(6) * 7) % 558
    return named.withColumns(
        {
            "latitude": F.lit(40.4774) + north / F.lit(1e3) + F.pmod("contentid", F.lit(16)) / F.lit(1e4),
            "longitude": F.lit(-74.2591) + east / F.lit(1e3) + F.pmod("contentid", F.lit(8)) / F.lit(1e4),
        }
    ).withColumn("cell", geo.geo_cell(F.col("latitude"), F.col("longitude"), geo.COARSE_LEVEL))


PLACES_SQL = r"""
named AS (
  SELECT doc_id AS contentid, regexp_extract(text, '^\S{1,15}(?:\s\S{1,15}){0,5}') AS title,
         text AS description, source, lang AS category
  FROM documents),
located AS (
  SELECT *,
    40.4774e0 + ((ascii(substr(title,1,1))*31 + ascii(substr(title,2,1))*17 + ascii(substr(title,3,1))*7) % 440)/1e3 + (contentid % 16)/1e4 AS latitude,
    -74.2591e0 + ((ascii(substr(title,4,1))*31 + ascii(substr(title,5,1))*17 + ascii(substr(title,6,1))*7) % 558)/1e3 + (contentid % 8)/1e4 AS longitude
  FROM named),
poi AS (
  SELECT *, CAST(floor((latitude+90)/(180/pow(2e0,14))) AS BIGINT)*4294967296
          + CAST(floor((longitude+180)/(180/pow(2e0,14))) AS BIGINT) AS cell
  FROM located)
"""


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"2*6371008.8e0*asin(sqrt(pow(sin(radians({lat2}-{lat1})/2),2)"
        f"+cos(radians({lat1}))*cos(radians({lat2}))*pow(sin(radians({lon2}-{lon1})/2),2)))"
    )


def spheroid_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    """The default distance: radii of WGS84 at the mean latitude."""
    s2 = f"pow(sin(radians(({lat1}+{lat2})/2)),2)"
    root = f"(1-{geo.ECCENTRICITY_2!r}*{s2})"
    north = f"(radians({lat2}-{lat1})*{geo.SEMI_MAJOR!r}*(1-{geo.ECCENTRICITY_2!r})/pow({root},1.5e0))"
    east = f"(radians({lon2}-{lon1})*{geo.SEMI_MAJOR!r}*cos(radians(({lat1}+{lat2})/2))/sqrt({root}))"
    return f"sqrt(pow({north},2)+pow({east},2))"
