"""Column expressions and helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The white space of the word definition ``[^\x20\x09-\x0D]+``.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = "[\\x20\\x09-\\x0D]+"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` evaluated once, however often it is used."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Words of a text; null and blank texts have none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, SPACE_RUN)
    )


def fresh_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, lengthened until it clashes with no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted
