"""Table changes expressed as DataFrame-to-DataFrame operators on a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def one_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row of each key in the given order.

    Spark cuts each partition to one row per key before the shuffle (window
    group limit), so a key held by most rows costs no more than any other.
    Give an order without ties to get the same row on every run.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def upsert_rows(
    base: DataFrame, new: DataFrame, keys: list[str], order: list[str] | None = None
) -> DataFrame:
    """Whole-row replace: rows of ``new`` win over ``base``; within ``new`` the
    row with the highest ``order`` columns wins; ties go by content."""
    order = order or []
    both = base.withColumn("_new", F.lit(0)).unionByName(
        new.withColumn("_new", F.lit(1)), allowMissingColumns=True
    )
    ranking = [F.col("_new").desc(), *[F.col(c).desc_nulls_last() for c in order], F.xxhash64(*both.columns)]
    return one_per_key(both, keys, ranking).drop("_new")


def _one_result(new: DataFrame, keys: list[str], order: list[str] | None) -> DataFrame:
    """The row of each key that is highest in ``order``; ties go by content."""
    ranking = [F.col(c).desc_nulls_last() for c in order or []]
    return one_per_key(new, keys, [*ranking, F.xxhash64(*new.columns)])


def _overwrite(joined: DataFrame, base: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with a hit take the new value, null or not."""
    hit = F.col("_hit").isNotNull()
    values = {
        c: F.when(hit, F.col("_" + c)).otherwise(F.col(c)) if c in base.columns else F.col("_" + c)
        for c in columns
    }
    return joined.withColumns(values).drop("_hit", *["_" + c for c in columns])


def upsert_columns(
    base: DataFrame, new: DataFrame, keys: list[str], columns: list[str], order: list[str] | None = None
) -> DataFrame:
    """Column-wise update on conflict, insert otherwise. A null in ``new``
    overwrites; of several rows of a key the highest in ``order`` counts."""
    fresh = _one_result(new.select(*dict.fromkeys([*keys, *columns, *(order or [])])), keys, order)
    fresh = fresh.select(*keys, F.lit(True).alias("_hit"), *[F.col(c).alias("_" + c) for c in columns])
    return _overwrite(base.join(fresh, keys, "full_outer"), base, columns)


def fill_nulls(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Set columns only where they are null."""
    return df.withColumns({c: F.coalesce(F.col(c), v) for c, v in values.items()})


def apply_results(
    base: DataFrame, results: DataFrame, key: str, order: list[str] | None = None
) -> DataFrame:
    """One join in place of many single-row updates: where a key has a result,
    its columns replace the base's, nulls too; new columns are added. Of several
    results of a key the highest in ``order`` counts, so rows never multiply."""
    columns = [c for c in results.columns if c != key]
    fresh = _one_result(results, [key], order)
    fresh = fresh.select(key, F.lit(True).alias("_hit"), *[F.col(c).alias("_" + c) for c in columns])
    return _overwrite(base.join(fresh, key, "left"), base, columns)


def set_where_in(df: DataFrame, ids: DataFrame, key: str, column: str, value: object) -> DataFrame:
    """Set a constant on the rows whose key is listed."""
    flags = ids.select(key).distinct().withColumn("_hit", F.lit(True))
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    return (
        df.join(flags, key, "left")
        .withColumn(column, F.when(hit, F.lit(value)).otherwise(F.col(column)))
        .drop("_hit")
    )


def retain_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Delete every row whose key is not listed."""
    return df.join(ids.select(key), key, "left_semi")


def delete_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Delete every row whose key is listed."""
    return df.join(ids.select(key), key, "left_anti")


def exclude_null_aware(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """``NOT IN`` with its null rules: a null in a non-empty list, or a null
    key, excludes the row."""
    listed = ids.select(key)
    checked = delete_ids(df, listed.filter(F.col(key).isNotNull()), key)
    nulls = listed.agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col(key).isNull(), 1)).alias("nulls")
    )
    has_null = nulls.select(F.col("nulls") > 0).scalar()
    is_empty = nulls.select(F.col("n") == 0).scalar()
    return checked.filter(is_empty | (~has_null & F.col(key).isNotNull()))


def retain_pairs(pairs: DataFrame, ids: DataFrame, first: str, second: str) -> DataFrame:
    """Keep the pairs of which both ids are listed."""
    for side in (first, second):
        listed = ids.select(F.col(ids.columns[0]).alias(side))
        pairs = pairs.join(listed, side, "left_semi")
    return pairs


def uniqueness_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def live_rows(df: DataFrame) -> DataFrame:
    """Rows that are not soft-deleted."""
    return df.filter(~F.coalesce(F.col("soft_deleted"), F.lit(False)))


def soft_delete(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Mark the listed rows as deleted."""
    if "soft_deleted" not in df.columns:
        df = df.withColumn("soft_deleted", F.lit(False))
    return set_where_in(df, ids, key, "soft_deleted", True)


def step_metrics(steps: dict[str, DataFrame]) -> DataFrame:
    """Rows of each step's result as ``(step, rows)``."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(step).alias("step"), "rows")
        for step, df in steps.items()
    ]
    out = counted[0]
    for part in counted[1:]:
        out = out.unionByName(part)
    return out


def numbered_batches(
    df: DataFrame, partition: list[str], order: list[Column], bucket: Column, size: int = 100
) -> DataFrame:
    """Batch number of each row within its partition key.

    ``bucket`` splits a key along the order (an hour, a range of ids): rows
    are numbered within a bucket and shifted by the sizes of the earlier ones,
    so no task sorts all rows of a key.
    """
    rows = df.withColumn("_bucket", bucket)
    sizes = rows.groupBy(*partition, "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.partitionBy(*partition).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(
        *partition, "_bucket", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_shift")
    )
    inside = F.row_number().over(Window.partitionBy(*partition, "_bucket").orderBy(*order))
    numbered = rows.withColumn("_n", inside).join(shifts, [*partition, "_bucket"])
    batch = F.floor((F.col("_shift") + F.col("_n") - 1) / size).cast("long")
    return numbered.withColumn("batch", batch).drop("_bucket", "_n", "_shift")
