"""Running totals and exact quantiles; no task sees all values.

Values are dealt out by range, summed within each range and moved by the sums of
the ranges before. Only those sums, one row a range, meet in one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from placeweave.session import settle


def running_totals(counts: DataFrame, value: str, amount: str, ranges: int | None = None) -> DataFrame:
    """``counts`` with ``before`` (amounts at smaller values) and ``total``.

    One row per value is expected, as ``groupBy(value)`` gives them, so a
    value that most rows share weighs no more than another. Null values are
    left out; without rows the result has none. ``ranges`` is the number of
    shuffle partitions if not given.
    """
    ranges = ranges or int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = settle(
        counts.filter(F.col(value).isNotNull())
        .repartitionByRange(ranges, value)
        .withColumn("_range", F.spark_partition_id()),
        "ranges",
    )
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy("_range").agg(F.sum(amount).alias("_sum")).select(
        "_range",
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"),
        F.sum("_sum").over(Window.partitionBy()).alias("total"),
    )
    within = Window.partitionBy("_range").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    return (
        dealt.withColumn("_within", F.coalesce(F.sum(amount).over(within), F.lit(0)))
        .join(F.broadcast(offsets), "_range")
        .withColumn("before", F.col("_offset") + F.col("_within"))
        .drop("_range", "_within", "_offset")
    )


def exact_quantiles(df: DataFrame, value: str, fractions: list[float], ranges: int | None = None) -> DataFrame:
    """``(fraction, quantile)``, between two values in proportion.

    Equal to ``percentile``, whose last task holds every distinct value; here
    the values at the wanted ranks are picked by their running count. Nulls
    are ignored; without values each quantile is null.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
    totals = running_totals(counts, value, "_n", ranges)
    wanted = df.sparkSession.createDataFrame([(float(f),) for f in fractions], "fraction double")
    rank = F.col("fraction") * (F.col("total") - 1)
    # positions from 0 that this value fills: before <= position < before + _n
    here = totals.join(
        F.broadcast(wanted),
        (F.ceil(rank) >= F.col("before")) & (F.floor(rank) < F.col("before") + F.col("_n")),
    )
    share = F.when(F.floor(rank) >= F.col("before"), F.lit(1) - (rank - F.floor(rank))).otherwise(F.lit(0.0))
    upper = (F.ceil(rank) < F.col("before") + F.col("_n")) & (F.ceil(rank) > F.floor(rank))
    share = share + F.when(upper, rank - F.floor(rank)).otherwise(F.lit(0.0))
    found = here.groupBy("fraction").agg(F.sum(F.col(value) * share).alias("quantile"))
    return wanted.join(found, "fraction", "left")
