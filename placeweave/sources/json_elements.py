"""Objects of large JSON arrays and collections, read by many tasks.

A file that is one JSON value has no line breaks to split at. It is cut at every
closing brace instead, which Spark's text source does in parallel within one
file. Whether a cut lies in a string, and how deep, depends on all text before
it, but a split's effect on both is a small sum: quotes flip the state, brackets
move the depth, counted for either state at its start. The sums of all splits of
a file, one row each, give every split its start, and then each its own pieces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placeweave.session import settle

_SPLIT = (["file", "split"], "at")
_FILE = (["file"], "split")


def _before(amount: Column, place: tuple[list[str], str]) -> Column:
    """Sum of the rows before this one in its split or file."""
    keys, order = place
    rows = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(amount).over(rows), F.lit(0))


def _occurrences(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """Text between closing braces with its effect on state and depth, for a
    start outside (0) and inside (1) of a string."""
    pieces = spark.read.option("lineSep", "}").text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"),
    )
    # no escape in valid JSON ends with a brace, so none is cut
    plain = F.regexp_replace("value", r"(?s)\\.", "")
    quotes = _occurrences(plain, '"')
    strings = '"[^"]*("|$)'
    outside = {
        0: F.regexp_replace(plain, strings, ""),
        1: F.regexp_replace(F.regexp_replace(plain, '^[^"]*("|$)', ""), strings, ""),
    }
    effects = {"flips": quotes % 2}
    for start, text in outside.items():
        closes = F.when((quotes + start) % 2 == 0, 1).otherwise(0)
        effects[f"curly{start}"] = _occurrences(text, "{") - closes
        effects[f"square{start}"] = _occurrences(text, "[") - _occurrences(text, "]")
    return pieces.select("*", *[e.alias(n) for n, e in effects.items()])


def _chosen(name: str, state: Column) -> Column:
    return F.when(state == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))


def _split_starts(pieces: DataFrame) -> DataFrame:
    """State and depth at the start of each split."""
    relative = pieces.withColumn("flipped", _before(F.col("flips"), _SPLIT) % 2)
    same, other = F.col("flipped"), 1 - F.col("flipped")
    sums = relative.groupBy("file", "split").agg(
        F.sum("flips").alias("flips"),
        *[
            F.sum(_chosen(name, state)).alias(f"{name}{start}")
            for name in ("curly", "square")
            for start, state in ((0, same), (1, other))
        ],
    )
    inside = sums.withColumn("inside", _before(F.col("flips"), _FILE) % 2)
    return inside.select(
        "file",
        "split",
        "inside",
        *[_before(_chosen(n, F.col("inside")), _FILE).alias(f"{n}_start") for n in ("curly", "square")],
    )


def _with_ends(pieces: DataFrame, starts: DataFrame, level: int) -> DataFrame:
    """Pieces with the depth after them and whether an element ends there."""
    state = (F.col("inside") + _before(F.col("flips"), _SPLIT)) % 2
    placed = pieces.join(starts, ["file", "split"]).withColumn("state", state)
    for name in ("curly", "square"):
        change = _chosen(name, F.col("state"))
        total = F.col(f"{name}_start") + _before(change, _SPLIT) + change
        placed = placed.withColumn(f"{name}_after", total)
    outside = (F.col("state") + F.col("flips")) % 2 == 0
    end = outside & (F.col("curly_after") == level) & (F.col("square_after") == 1)
    return placed.withColumn("ends", end.cast("long"))


def read_elements(spark: SparkSession, path: str, member: str | None = None) -> DataFrame:
    """Objects of JSON arrays as ``(file, element, value)``.

    Without ``member`` a file holds an array of objects, or several one after
    the other; with it, objects whose member of that name is the array.
    ``element`` counts a file's objects from 0 and ``value`` is an object's
    text. Files of any size are read in splits of
    ``spark.sql.files.maxPartitionBytes``. Elements that are no objects are
    skipped (strings among them must not hold braces); of an object with a
    ``member``, objects in other arrays directly below it are returned too.
    Empty files and arrays give no rows. Files are UTF-8 and valid JSON. Two
    jobs over counts alone run first, one row a split is kept.
    """
    level = 0 if member is None else 1
    pieces = _pieces(spark, path)
    starts = settle(_split_starts(pieces.drop("value")), "split-starts")
    counts = _with_ends(pieces.drop("value"), starts, level).groupBy("file", "split").agg(F.sum("ends").alias("n"))
    numbers = settle(counts.select("file", "split", _before(F.col("n"), _FILE).alias("first")), "split-elements")
    placed = _with_ends(pieces, starts.join(numbers, ["file", "split"]), level)
    # pieces of a split are put together where they are, elements across splits afterwards
    fragments = (
        placed.withColumn("element", F.col("first") + _before(F.col("ends"), _SPLIT))
        .groupBy("file", "split", "element")
        .agg(
            F.array_sort(F.collect_list(F.struct("at", "value"))).alias("parts"),
            F.max("ends").alias("ends"),
            F.min("curly_after").alias("lowest"),
        )
        .withColumn("text", F.concat(F.array_join(F.col("parts.value"), "}"), F.lit("}")))
    )
    whole = (
        fragments.groupBy("file", "element")
        .agg(
            F.array_sort(F.collect_list(F.struct("split", "text"))).alias("parts"),
            F.max("ends").alias("ends"),
            F.min("lowest").alias("lowest"),
        )
        .filter("ends = 1")
        .withColumn("text", F.array_join(F.col("parts.text"), ""))
    )
    text = F.col("text")
    if member is not None:
        opening = F.regexp_replace(text, rf'(?s)^.*?"{member}"\s*:\s*\[', "")
        text = F.when((F.col("element") == 0) | (F.col("lowest") < level), opening).otherwise(text)
    return whole.select("file", "element", F.regexp_replace(text, r"^[^{]*", "").alias("value"))


def read_object_array(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Typed rows of large files that hold an array of objects each; an object
    that doesn't fit the schema gives nulls."""
    return read_elements(spark, path).select(F.from_json("value", schema).alias("e")).select("e.*")
