import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def documents(spark):
    """A documents table from (doc_id, text, lang, source) rows."""

    def make(rows, parts=3):
        full = [(*r, None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCUMENTS).repartition(parts)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, blanks, ties, repeats and a very long text."""
    long = " ".join(f"word{i % 977} abc." for i in range(6000))
    return [
        (1, None, "en", "s0"),
        (2, "", None, "s0"),
        (3, "  \t\n ", "en", None),
        (4, "one two three four five six seven eight nine ten eleven.", "en", "s0"),
        (4, "one two three four five six seven eight nine ten eleven.", "en", "s0"),
        (5, "one two three four five six seven eight nine ten eleven.", "de", "s1"),
        (None, "Stray row without an id. It has words, though not many of them.", None, None),
        (6, long, "en", "s1"),
        (7, "x" * 5000, "en", "s2"),
        (8, "Ünïcödé – “quotes” 漢字 \U0001f600 and more words to read here now", "de", "s2"),
    ]
