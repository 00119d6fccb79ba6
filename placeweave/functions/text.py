"""String functions: cleaning, labels, word counts, trigrams."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Named character references decoded by strip_html.
# The ampersand comes last so that doubly encoded text is decoded once.
NAMED_ENTITIES = [
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&apos;", "'"),
    ("&nbsp;", " "),
    ("&copy;", "©"),
    ("&reg;", "®"),
    ("&middot;", "·"),
    ("&hellip;", "…"),
    ("&ndash;", "–"),
    ("&mdash;", "—"),
    ("&amp;", "&"),
]

# Fixed value: anything that is neither letter, digit nor underscore.
NON_WORD = r"[^\p{L}\p{N}_]+"
NON_WORD_ASCII = r"[^A-Za-z0-9_]+"


def strip_html(c: Column) -> Column:
    """Visible text of a page: script, style, comments and tags removed."""
    for pattern in (
        r"(?is)<script\b.*?</script\s*>",
        r"(?is)<style\b.*?</style\s*>",
        r"(?s)<!--.*?-->",
        r"<[^>]+>",
    ):
        c = F.regexp_replace(c, pattern, "")
    for name, text in NAMED_ENTITIES:
        c = F.replace(c, F.lit(name), F.lit(text))
    return c


def clean_text(
    c: Column,
    ascii_only: bool = False,
    stop_words: Iterable[str] | None = None,
    html: bool = False,
) -> Column:
    """Non-word runs to one space, then lower case; null and '' pass through."""
    if html:
        c = strip_html(c)
    c = F.lower(F.regexp_replace(c, NON_WORD_ASCII if ascii_only else NON_WORD, " "))
    return c if stop_words is None else drop_words(c, stop_words)


def drop_words(c: Column, words: Iterable[str]) -> Column:
    """Remove the given words (and empty ones) from space-separated text."""
    unwanted = F.array(*[F.lit(w) for w in [*words, ""]])
    return F.array_join(F.filter(F.split(c, " "), lambda w: ~F.array_contains(unwanted, w)), " ")


def preview(c: Column, length: int = 20) -> Column:
    """First characters and three dots when longer; null becomes ''."""
    short = F.concat(F.substring(c, 1, length), F.lit("..."))
    return F.when(F.length(c) > length, short).otherwise(or_empty(c))


def or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def label(**parts: Column) -> Column:
    """``name: value`` parts joined by line breaks, missing values left out."""
    return F.concat_ws(
        "\n", *[F.concat(F.lit(f"{name}: "), value.cast("string")) for name, value in parts.items()]
    )


def pair_key(a: Column, b: Column) -> Column:
    """Null-skipping concatenation of two ids."""
    return F.concat_ws("", a.cast("string"), b.cast("string"))


def split_literal(c: Column, separator: str = ",") -> Column:
    """Split on a literal separator."""
    return F.split(c, r"\Q" + separator + r"\E")


def word_count(c: Column) -> Column:
    """Number of words; null counts as zero."""
    words = F.filter(F.split(or_empty(c), r"\s+"), lambda w: w != "")
    return F.size(words)


def join_array(c: Column, separator: str = ",") -> Column:
    return F.array_join(c, separator)


def trigrams(c: Column) -> Column:
    """Distinct trigrams of each lower-cased word, padded by two blanks in
    front and one behind."""
    words = F.filter(F.split(F.lower(c), NON_WORD), lambda w: w != "")
    padded = F.transform(words, lambda w: F.concat(F.lit("  "), w, F.lit(" ")))
    grams = F.transform(
        padded,
        lambda w: F.transform(
            F.sequence(F.lit(1), F.length(w) - 2), lambda i: F.substr(w, i, F.lit(3))
        ),
    )
    return F.array_distinct(F.flatten(grams))


def trigram_similarity(a: Column, b: Column) -> Column:
    """Shared trigrams over all trigrams; 0 when neither text has any."""
    ga, gb = trigrams(a), trigrams(b)
    total = F.size(F.array_union(ga, gb))
    return F.when(total == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(ga, gb)) / total)


def utf8_octets(value: Column) -> Column:
    """One character per byte of the UTF-8 form, for edit distances in bytes."""
    return F.decode(F.encode(value, "UTF-8"), "ISO-8859-1")
