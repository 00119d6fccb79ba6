"""Vector functions on array columns and the text encoder hook."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeweave.functions.text import clean_text


def parse_vector(c: Column) -> Column:
    """Vector held as JSON text; '{}' and other non-lists give null."""
    return F.from_json(c, "array<float>")


def has_vector(c: Column) -> Column:
    return c.isNotNull() & (F.size(c) > 0)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + x)


def norm(c: Column) -> Column:
    """Euclidean length."""
    return F.sqrt(_sum(F.transform(c, lambda x: x.cast("double") * x.cast("double"))))


def dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def cosine(a: Column, b: Column, norm_a: Column | None = None, norm_b: Column | None = None) -> Column:
    """Cosine similarity: null for a null vector, 0 for an empty or zero one.

    Pass the norms when they were computed once per row.
    """
    lengths = (norm(a) if norm_a is None else norm_a) * (norm(b) if norm_b is None else norm_b)
    return F.when(
        a.isNotNull() & b.isNotNull(),
        F.when(lengths > 0, dot(a, b) / lengths).otherwise(F.lit(0.0)),
    )


# Fixed rule: one character per vector entry, starting at the first CJK ideograph.
_FIRST_SYMBOL = 0x4E00


def hashed_vector(c: Column, dimensions: int = 64) -> Column:
    """Bag-of-words vector by feature hashing, the built-in encoder.

    Words become one symbol each; an entry is the number of its symbols. The
    symbol text is bound once and counted by plain string operations.
    """
    symbols = "".join(chr(_FIRST_SYMBOL + i) for i in range(dimensions))
    words = F.filter(F.split(clean_text(c), " "), lambda w: w != "")
    text = F.array_join(
        F.transform(
            words,
            lambda w: F.substr(
                F.lit(symbols), (F.pmod(F.xxhash64(w), F.lit(dimensions)) + 1).cast("int"), F.lit(1)
            ),
        ),
        "",
    )
    alphabet = F.array(*[F.lit(s) for s in symbols])

    def counts(t: Column) -> Column:
        return F.transform(
            alphabet,
            lambda s: (F.length(t) - F.length(F.replace(t, s, F.lit("")))).cast("float"),
        )

    return F.transform(F.array(text), counts)[0]


def add_embeddings(
    df: DataFrame,
    text_col: str,
    out_col: str = "embedding",
    encoder: Callable[[Column], Column] = hashed_vector,
) -> DataFrame:
    """Encode rows that have no vector yet; ``encoder`` may be a pandas UDF."""
    encoded = encoder(clean_text(F.col(text_col)))
    if out_col not in df.columns:
        return df.withColumn(out_col, F.when(F.col(text_col).isNotNull(), encoded))
    return df.withColumn(
        out_col, F.coalesce(out_col, F.when(F.col(text_col).isNotNull(), encoded))
    )
