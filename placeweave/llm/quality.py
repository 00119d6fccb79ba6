"""Quality rules: robust multivariate outliers per language and source.

Statistics of each text are turned into a vector of five nearly normal
coordinates. For every (language, source) the minimum-covariance-determinant
estimate of centre and scatter is found by concentration steps: keep the three
quarters of the rows with the smallest Mahalanobis distance, estimate again,
repeat; a last step reweights. Rows beyond the cut of their group are rejected:
``TAIL`` times the distance that nine tenths of the group's rows stay below,
within ``CUTS``, so a group with heavy tails is judged less strictly.

Everything is DataFrame aggregation. A step moves one partial aggregate per
task and group, so a source that holds a third of all rows is no special case;
the quantile that selects the three quarters comes from a histogram of
logarithmic distance bins and so counts every row.

Defined cases: null text counts as empty and fails the base rule (fewer than
ten words); null languages and sources are groups of their own; a pair with
fewer than ``MIN_GROUP`` sound rows is judged with the other small pairs of its language,
where these are still too few by the estimate of all rows of the language, and
where these are too by that of all rows; repeated rows are judged alike; an
empty table gives an empty table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from placeweave.llm.texts import bind, words
from placeweave.session import settle

WINDOW_WORDS = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SYMBOLS = "[#*$%&|<>]"

MIN_GROUP = 60
EVERYTHING = "a"
KEEP_SHARE = 0.75
STEPS = 4
BINS_PER_OCTAVE = 16
# Fixed values for five coordinates: scatter of the inner three quarters to the
# whole, and the 97.5 % point of chi-square.
CONSISTENCY = 1.41
REWEIGHT_BELOW = 12.83
# A group's cut, as a multiple of the squared distance at ``TAIL_SHARE`` of its
# rows (9.24 for normal rows), and its bounds. Clean texts have heavier tails than
# a normal law, so even the lower bound is beyond the chi-square points.
TAIL = 4.0
TAIL_SHARE = 0.9
CUTS = (30.0, 80.0)

# Coordinate name, smallest scale (standard deviation) it is measured with.
COORDINATES = {
    "word_length": 0.04,
    "symbol_share": 0.03,
    "dup_line_share": 0.05,
    "repeat_share": 0.05,
    "upper_share": 0.04,
}
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper")


def _repeat_words(w: Column) -> Column:
    """Words that lie in a window of five words found twice or more."""
    span = WINDOW_WORDS

    def covered(starts: Column) -> Column:
        last = F.size(starts) - 1
        steps = F.transform(
            starts,
            lambda q, k: F.when(k == last, F.lit(span)).otherwise(
                F.least(F.lit(span), starts[k + 1] - q)
            ),
        )
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    def among(sorted_pairs: Column) -> Column:
        last = F.size(sorted_pairs) - 1
        twice = F.filter(
            sorted_pairs,
            lambda e, k: ((k > 0) & (F.get(sorted_pairs, k - 1)["h"] == e["h"]))
            | ((k < last) & (F.get(sorted_pairs, k + 1)["h"] == e["h"])),
        )
        return bind(F.sort_array(F.transform(twice, lambda e: e["i"])), covered)

    def counted(hashes: Column) -> Column:
        pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
            bind(F.sort_array(pairs), among)
        )

    windows = F.transform(
        F.sequence(F.lit(1), F.size(w) - (span - 1)), lambda i: F.xxhash64(F.slice(w, i, span))
    )
    return F.when(F.size(w) <= span, F.lit(0)).otherwise(bind(windows, counted))


def _dup_lines(text: Column) -> Column:
    with_words = F.filter(
        F.split(F.coalesce(text, F.lit("")), "\n"), lambda s: F.btrim(s, F.lit(" \t\x0b\x0c\r")) != ""
    )
    return bind(with_words, lambda lines: F.size(lines) - F.size(F.array_distinct(lines)))


def text_stats(text: Column) -> Column:
    """Struct of the counts ``STATS`` of one text."""

    def counts(w: Column) -> Column:
        joined = F.array_join(w, "")
        return bind(
            joined,
            lambda j: F.struct(
                F.size(w).cast("long").alias("n_words"),
                F.char_length(j).cast("long").alias("word_chars"),
                F.regexp_count(j, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
                _dup_lines(text).cast("long").alias("n_dup_lines"),
                _repeat_words(w).cast("long").alias("n_repeat_words"),
                F.regexp_count(j, F.lit("[A-Z]")).cast("long").alias("n_upper"),
            ),
        )

    return bind(words(text), counts)


def base_failed(stats: Column) -> Column:
    return (stats["n_words"] < MIN_WORDS) | (
        100 * stats["n_repeat_words"] > MAX_REPEAT_PERCENT * stats["n_words"]
    )


def _vector(s: Column) -> list[Column]:
    """Coordinates; short texts are drawn towards the usual values, so that the
    noise of a few words doesn't look like an outlier."""
    n = s["n_words"].cast("double")
    chars = s["word_chars"].cast("double")
    return [
        F.log((chars + 250) / (n + 50)),
        F.sqrt(s["n_symbols"] / (chars + 100)),
        F.sqrt(s["n_dup_lines"] / (n + 50)),
        F.sqrt(s["n_repeat_words"] / (n + 50)),
        F.sqrt((s["n_upper"] + 3) / (chars + 100)),
    ]


def _cholesky(df: DataFrame, cov: list[list[str]]) -> DataFrame:
    """Adds columns ``l_i_j``, the lower factor of the covariance."""
    p = len(cov)
    for i in range(p):
        for j in range(i + 1):
            inner = [F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}") for k in range(j)]
            rest = reduce(lambda a, b: a - b, inner, F.col(cov[i][j]))
            value = F.sqrt(F.greatest(rest, F.lit(1e-12))) if i == j else rest / F.col(f"l_{j}_{j}")
            df = df.withColumn(f"l_{i}_{j}", value)
    return df


def _distance(x: Column, estimate: Column, p: int) -> Column:
    """Squared Mahalanobis distance by forward substitution."""

    def extend(y: Column, i: int) -> Column:
        inner = [estimate[f"l_{i}_{k}"] * y[k] for k in range(i)]
        rest = reduce(lambda a, b: a - b, inner, x[i] - estimate[f"m_{i}"])
        return F.concat(y, F.array(rest / estimate[f"l_{i}_{i}"]))

    def chain(y: Column, i: int) -> Column:
        if i == p:
            return F.aggregate(y, F.lit(0.0), lambda a, v: a + v * v)
        return bind(extend(y, i), lambda z: chain(z, i + 1))

    return chain(F.array().cast("array<double>"), 0)


def _estimate_columns(p: int) -> list[str]:
    return [f"m_{i}" for i in range(p)] + [f"l_{i}_{j}" for i in range(p) for j in range(i + 1)]


def _estimate(rows: DataFrame, scale: float) -> DataFrame:
    """Centre and factor of the scatter of ``rows`` (key, x) per key, settled."""
    p = len(COORDINATES)
    sums = [F.avg(F.col("x")[i]).alias(f"m_{i}") for i in range(p)]
    sums += [
        F.covar_pop(F.col("x")[i], F.col("x")[j]).alias(f"c_{i}_{j}")
        for i in range(p)
        for j in range(i + 1)
    ]
    found = rows.groupBy("key").agg(*sums)
    floors = list(COORDINATES.values())
    for i in range(p):
        for j in range(i + 1):
            floor = floors[i] ** 2 if i == j else 0.0
            found = found.withColumn(f"c_{i}_{j}", F.col(f"c_{i}_{j}") * scale + floor)
    found = _cholesky(found, [[f"c_{i}_{j}" for j in range(p)] for i in range(p)])
    return settle(found.select("key", F.struct(*_estimate_columns(p)).alias("estimate")), "mcd")


def _with_distance(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    far = _distance(F.col("x"), F.col("estimate"), len(COORDINATES))
    return rows.join(estimates, "key").select("key", "x", far.alias("d"))


def _limits(measured: DataFrame, share: float) -> DataFrame:
    """(key, top): the last of the lowest bins that make up ``share`` of a key."""
    counts = measured.groupBy("key", _bin().alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    upwards = Window.partitionBy("key").orderBy("bin")
    whole = Window.partitionBy("key")
    limits = (
        counts.withColumn("below", F.sum("n").over(upwards) - F.col("n"))
        .withColumn("total", F.sum("n").over(whole))
        .filter(F.col("below") < share * F.col("total"))
        .groupBy("key")
        .agg(F.max("bin").alias("top"))
    )
    return settle(limits, "mcd-limits")


def _bin() -> Column:
    return F.floor(BINS_PER_OCTAVE * F.log2(F.col("d") + 1e-9))


def _inner_share(measured: DataFrame) -> DataFrame:
    """Rows of ``measured`` in the bins that make up ``KEEP_SHARE`` of a key."""
    limits = _limits(measured, KEEP_SHARE)
    return measured.join(limits, "key").filter(_bin() <= F.col("top")).select("key", "x")


def _with_cut(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """Adds each key's ``cut`` to its estimate."""
    edge = F.pow(F.lit(2.0), (F.col("top") + 1) / F.lit(BINS_PER_OCTAVE))
    cut = F.greatest(F.lit(CUTS[0]), F.least(F.lit(CUTS[1]), TAIL * edge))
    limits = _limits(_with_distance(rows, estimates), TAIL_SHARE)
    return settle(estimates.join(limits.select("key", cut.alias("cut")), "key"), "mcd-cuts")


def mcd_estimates(rows: DataFrame) -> DataFrame:
    """(key, estimate, cut) of rows (key, x): reweighted MCD of every key."""
    p = len(COORDINATES)
    middle = settle(
        rows.groupBy("key").agg(
            *[F.percentile_approx(F.col("x")[i], 0.5, 2000).alias(f"m_{i}") for i in range(p)]
        ),
        "mcd-median",
    )
    apart = rows.join(middle, "key")
    spread = apart.groupBy("key").agg(
        *[F.first(f"m_{i}").alias(f"m_{i}") for i in range(p)],
        *[
            F.percentile_approx(F.abs(F.col("x")[i] - F.col(f"m_{i}")), 0.5, 2000).alias(f"s_{i}")
            for i in range(p)
        ],
    )
    floors = list(COORDINATES.values())
    factors = [
        (F.greatest(1.4826 * F.col(f"s_{i}"), F.lit(floors[i])) if i == j else F.lit(0.0)).alias(
            f"l_{i}_{j}"
        )
        for i in range(p)
        for j in range(i + 1)
    ]
    first = F.struct(*[F.col(f"m_{i}") for i in range(p)], *factors)
    estimates = settle(spread.select("key", first.alias("estimate")), "mcd")
    for _ in range(STEPS):
        estimates = _estimate(_inner_share(_with_distance(rows, estimates)), CONSISTENCY)
    near = _with_distance(rows, estimates).filter(F.col("d") < REWEIGHT_BELOW)
    return _with_cut(rows, _estimate(near.select("key", "x"), 1.0))


def _keyed(stats: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per (language, source) the ``key`` that judges it and the keys that its
    rows ``feed``, and the rows that estimates come from."""
    pair = [F.col("lang"), F.col("source")]
    sound = stats.filter(~base_failed(F.col("stats")))
    sizes = sound.groupBy(*pair).agg(F.count(F.lit(1)).alias("n"))
    small = F.col("n") < MIN_GROUP
    language = Window.partitionBy("lang")
    label = lambda c: F.coalesce(F.concat(F.lit("="), c), F.lit("-"))
    own = F.concat(F.lit("s"), F.length(label(F.col("lang"))), label(F.col("lang")), label(F.col("source")))
    shared = F.concat(F.lit("l"), label(F.col("lang")))
    whole = F.concat(F.lit("w"), label(F.col("lang")))
    sums = sizes.withColumn("pooled", F.sum(F.when(small, F.col("n"))).over(language))
    keys = sums.withColumn("total", F.sum("n").over(language)).select(
        *pair,
        F.when(~small, own)
        .when(F.col("pooled") >= MIN_GROUP, shared)
        .when(F.col("total") >= MIN_GROUP, whole)
        .otherwise(EVERYTHING)
        .alias("key"),
    )
    of_language = F.max(F.col("key") == whole).over(language)
    keys = settle(keys.withColumn("of_language", of_language), "mcd-keys")
    of_all = not keys.filter(F.col("key") == EVERYTHING).isEmpty()
    feeds = F.array(
        F.col("key"), F.when(F.col("of_language"), whole), F.lit(EVERYTHING if of_all else None).cast("string")
    )
    return (
        keys.select(
            F.col("lang").alias("k_lang"),
            F.col("source").alias("k_source"),
            "key",
            F.array_distinct(F.array_compact(feeds)).alias("feeds"),
        ),
        sound,
    )


def _add_key(df: DataFrame, keys: DataFrame) -> DataFrame:
    same = df["lang"].eqNullSafe(keys["k_lang"]) & df["source"].eqNullSafe(keys["k_source"])
    return df.join(keys, same, "left").drop("k_lang", "k_source")


def estimates_of(stats: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Keys of the (language, source) pairs and the estimate of every key, from
    settled rows (lang, source, stats)."""
    keys, sound = _keyed(stats)
    x = F.array(*_vector(F.col("stats")))
    rows = _add_key(sound.select("lang", "source", "stats"), keys).select(F.explode("feeds").alias("key"), x.alias("x"))
    return keys.drop("feeds"), mcd_estimates(settle(rows, "mcd-rows"))


def judge(rows: DataFrame, keys: DataFrame, estimates: DataFrame) -> DataFrame:
    """``rows`` (lang, source, stats and any others) with ``base_failed``,
    ``distance`` (null without an estimate) and ``kept``.

    Column names ``key``, ``k_lang``, ``k_source``, ``estimate``, ``cut``,
    ``base_failed``, ``distance`` and ``kept`` must be free."""
    x = F.array(*_vector(F.col("stats")))
    far = F.when(
        F.col("estimate").isNotNull(), _distance(x, F.col("estimate"), len(COORDINATES))
    )

    # in one expression: a filter on it isn't taken apart and pushed below the
    # joins, where it would count the texts again
    def verdict(stats: Column) -> Column:
        return ~base_failed(stats) & F.coalesce(F.col("distance") <= F.col("cut"), F.lit(True))

    return (
        _add_key(rows, keys)
        .join(estimates, "key", "left")
        .withColumn("base_failed", base_failed(F.col("stats")))
        .withColumn("distance", far)
        .withColumn("kept", bind(F.col("stats"), verdict))
        .drop("key", "estimate", "cut")
    )


def quality_report(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, the counts, base_failed, distance, kept."""
    stats = settle(
        docs.select("doc_id", "lang", "source", text_stats(F.col("text")).alias("stats")), "stats"
    )
    return judge(stats, *estimates_of(stats)).select(
        "doc_id", *[F.col("stats")[c].alias(c) for c in STATS], "base_failed", "distance", "kept"
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass, with their columns and nothing else. Texts are
    read twice, for the estimates and for the verdict, and never stored."""
    narrow = docs.select("lang", "source", text_stats(F.col("text")).alias("stats"))
    known = estimates_of(settle(narrow, "stats"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select("lang", "source", text_stats(F.col("text")).alias("stats"), row)
    return judge(rows, *known).filter("kept").select("row.*")
