"""Counts, distributions, profiles and map-ready output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeweave.functions import text
from placeweave.operators.order import exact_quantiles, running_totals
from placeweave.schemas import DEFAULT_TAG, TIER_TAGS
from placeweave.session import settle


def block_occupancy(df: DataFrame, cell: str = "cell", min_count: int = 2) -> DataFrame:
    """Cells with at least ``min_count`` rows; null cells never qualify."""
    return (
        df.groupBy(cell).agg(F.count(cell).alias("count")).filter(F.col("count") >= min_count)
    )


def multi_occupancy_members(df: DataFrame, cell: str = "cell", min_count: int = 2) -> DataFrame:
    """Rows in cells with at least ``min_count`` rows."""
    return df.join(block_occupancy(df, cell, min_count).select(cell), cell, "left_semi")


def histogram(df: DataFrame, value: str) -> DataFrame:
    """Rows per value, ordered by value."""
    return df.groupBy(value).agg(F.count(F.lit(1)).alias("frequency")).orderBy(value)


def cumulative_share(counts: DataFrame, value: str, frequency: str = "frequency") -> DataFrame:
    """Share of rows up to each value of a histogram.

    Running totals are taken within ranges of values and over the sums of the
    ranges, so the values are never sorted in one place.
    """
    totals = running_totals(counts.select(value, F.col(frequency).alias("_n")), value, "_n")
    return totals.select(value, ((F.col("before") + F.col("_n")) / F.col("total")).alias("cumulative"))


def box_plot(df: DataFrame, value: str) -> DataFrame:
    """Median, quartiles, whiskers (furthest value within 1.5 quartile
    ranges) and the number of values beyond them."""
    def at(fraction: float) -> Column:
        return F.max(F.when(F.col("fraction") == fraction, F.col("quantile")))

    spread = (
        settle(exact_quantiles(df, value, [0.25, 0.5, 0.75]), "quartiles")
        .agg(at(0.25).alias("q1"), at(0.5).alias("median"), at(0.75).alias("q3"))
        .withColumn("reach", (F.col("q3") - F.col("q1")) * 1.5)
    )
    low = spread.select(F.col("q1") - F.col("reach")).scalar()
    high = spread.select(F.col("q3") + F.col("reach")).scalar()
    inside = F.col(value).between(low, high)
    return df.agg(
        F.min(F.when(inside, F.col(value))).alias("whisker_low"),
        F.max(F.when(inside, F.col(value))).alias("whisker_high"),
        F.count(F.when(~inside, 1)).alias("outliers"),
    ).select(
        spread.select("q1").scalar().alias("q1"),
        spread.select("median").scalar().alias("median"),
        spread.select("q3").scalar().alias("q3"),
        "whisker_low",
        "whisker_high",
        "outliers",
    )


def kernel_density(values: DataFrame, value: str, points: int = 200, cut: float = 3.0) -> DataFrame:
    """Gaussian kernel density of the values at evenly spaced points.

    Bandwidth by Scott's rule, n ** (-1/5) standard deviations; the range
    reaches ``cut`` bandwidths beyond the values.
    """
    stats = values.agg(
        F.count(value).alias("n"),
        F.stddev_samp(value).alias("s"),
        F.min(value).alias("low"),
        F.max(value).alias("high"),
    ).withColumn("h", F.col("s") * F.pow(F.col("n"), F.lit(-0.2)))
    h = stats.select("h").scalar()
    start = stats.select(F.col("low") - cut * F.col("h")).scalar()
    step = stats.select((F.col("high") - F.col("low") + 2 * cut * F.col("h")) / (points - 1)).scalar()
    spread = values.select(
        F.col(value).alias("_v"), F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point")
    ).withColumn("x", start + F.col("point") * step)
    z = (F.col("x") - F.col("_v")) / h
    kernel = F.exp(-(z * z) / 2)
    n = F.count(F.lit(1))
    return spread.groupBy("point").agg(
        F.first("x").alias("x"),
        (F.sum(kernel) / (n * F.first(h) * F.sqrt(2 * F.pi()))).alias("density"),
    )


def distribution_report(df: DataFrame, column: str = "description") -> dict[str, DataFrame]:
    """Histogram, cumulative share, box plot and density of word counts."""
    counted = df.select(text.word_count(F.col(column)).alias("word_count"))
    counts = counted.groupBy("word_count").agg(F.count(F.lit(1)).alias("frequency"))
    return {
        "histogram": counts.orderBy("word_count"),
        "cumulative": cumulative_share(counts, "word_count"),
        "box_plot": box_plot(counts, "frequency"),
        "density": kernel_density(counts, "word_count"),
    }


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def count_distinct(df: DataFrame, column: str, approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approximate else F.countDistinct
    return df.agg(count(column).alias("distinct_values"))


def tag_domain_counts(
    df: DataFrame, tag: str = "tag", domain: list[str] | None = None
) -> DataFrame:
    """Rows per tag of a fixed list; absent tags count 0, others are ignored."""
    domain = domain or [*TIER_TAGS, DEFAULT_TAG]
    known = df.filter(F.col(tag).isin(domain)).groupBy(tag).agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.createDataFrame([(d,) for d in domain], f"{tag} string")
    return every.join(known, tag, "left").select(tag, F.coalesce("n", F.lit(0).cast("long")).alias("rows"))


def map_ready(df: DataFrame) -> DataFrame:
    """Columns a map needs: place, colour and a popup text."""
    return df.select(
        "contentid",
        "latitude",
        "longitude",
        F.col("tag").alias("color"),
        text.label(
            Title=F.col("title"),
            Duplicate=F.col("is_title_duplicate"),
            Description=text.preview(F.col("description")),
            Source=text.or_empty(F.col("source_url")),
            Id=F.col("contentid"),
            Point=F.concat_ws(",", F.col("latitude").cast("string"), F.col("longitude").cast("string")),
        ).alias("popup"),
    )


def cluster_bbox(df: DataFrame, cluster: str, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Bounding box of each cluster."""
    return df.groupBy(cluster).agg(
        F.min(lat).alias("min_lat"), F.max(lat).alias("max_lat"),
        F.min(lon).alias("min_lon"), F.max(lon).alias("max_lon"),
    )


def table_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns of each table: ``(table_name, rows, columns)``."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"), "rows", F.lit(", ".join(df.columns)).alias("columns")
        )
        for name, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def first_rows(df: DataFrame, order: list[Column], n: int = 10) -> DataFrame:
    """First rows in an order; Spark keeps only ``n`` per task."""
    return df.orderBy(*order).limit(n)
