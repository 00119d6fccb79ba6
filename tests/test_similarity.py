import math
import random

import duckdb
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from placeweave.functions import similarity as sim


def _jw(a, b):
    return sim.jaro_winkler.func(pd.Series([a]), pd.Series([b]))[0]


def _dl(a, b):
    return sim.damerau_levenshtein.func(pd.Series([a]), pd.Series([b]))[0]


@pytest.mark.parametrize(
    "a, b, score",
    [
        ("MARTHA", "MARHTA", 0.9611),
        ("abcdzzzzzz", "abcdyyyyyyyyy", 0.5692),
        ("café", "cafe", 0.8483),
        ("", "", 0.0),
        ("a", "a", 1.0),
    ],
)
def test_jaro_winkler_known_values(a, b, score):
    assert round(_jw(a, b), 4) == score


@pytest.mark.parametrize(
    "a, b, edits",
    [("ca", "abc", 2), ("ab", "ba", 1), ("café", "cafe", 2), ("", "abc", 3), ("same", "same", 0)],
)
def test_damerau_known_values(a, b, edits):
    assert _dl(a, b) == edits


def test_null_gives_null():
    assert math.isnan(_jw(None, "a")) and math.isnan(_dl("a", None))


def _both_engines(pairs):
    connection = duckdb.connect()
    connection.execute("CREATE TABLE t (i INT, a VARCHAR, b VARCHAR)")
    connection.executemany("INSERT INTO t VALUES (?, ?, ?)", [(i, a, b) for i, (a, b) in enumerate(pairs)])
    want = connection.execute(
        "SELECT jaro_winkler_similarity(a, b), damerau_levenshtein(a, b) FROM t ORDER BY i"
    ).fetchall()
    a, b = pd.Series([p[0] for p in pairs]), pd.Series([p[1] for p in pairs])
    got = list(zip(sim.jaro_winkler.func(a, b), sim.damerau_levenshtein.func(a, b)))
    return got, want


def test_random_strings_match_other_engine():
    rng = random.Random(7)
    pairs = []
    for _ in range(600):
        letters = rng.choice(["ab", "abcdef", "étaoin ü"])
        a = "".join(rng.choices(letters, k=rng.randint(0, 90)))
        cut = rng.randint(0, len(a))
        b = a[:cut] + "".join(rng.choices(letters, k=rng.randint(0, 9))) + a[cut + 2 :]
        pairs.append((a, b))
    got, want = _both_engines(pairs)
    for (jw, dl), (want_jw, want_dl) in zip(got, want):
        assert jw == pytest.approx(want_jw, abs=1e-12) and dl == want_dl


def test_swaps_over_gaps_and_long_strings_match_other_engine():
    rng = random.Random(8)
    pairs = [("", ""), ("a", ""), ("\0a", "a\0"), ("ab" * 29, "ba" * 29), ("ab" * 30, "ba" * 30)]
    for _ in range(1500):
        a = "".join(rng.choices("abcd", k=rng.choice([4, 12, 58, 64, 65, 140])))
        b = list(a)
        for _ in range(rng.randint(0, 6)):
            at, to = sorted(rng.choices(range(len(b)), k=2))
            b[at], b[to] = b[to], b[at]
            b[at + 1 : at + 1] = rng.choices("xyab", k=rng.randint(0, 2))
        pairs.append((a, "".join(b)))
    got, want = _both_engines(pairs)
    for (jw, dl), (want_jw, want_dl) in zip(got, want):
        assert jw == pytest.approx(want_jw, abs=1e-12) and dl == want_dl


def test_both_scores_read_a_batch_once(monkeypatch):
    a, b = pd.Series(["same title", None, "other", "same title"]), pd.Series(["same title", "x", "words", "some title"])
    seen, real = [], sim._byte_matrix
    monkeypatch.setattr(sim, "_byte_matrix", lambda texts: seen.append(len(texts)) or real(texts))
    got = sim.title_scores(0.7).func(a, b)
    assert seen == [2, 3]
    assert got["jw"].round(4).tolist()[::3] == [1.0, 0.94] and got["jw"][2] < 0.7
    assert got["edits"].tolist()[::3] == [0.0, 1.0] and got.isna().to_numpy().tolist()[1:3] == [[True, True], [False, True]]


@settings(max_examples=60, deadline=None)
@given(st.text("abcde é", max_size=70), st.text("abcde é", max_size=70))
def test_scores_are_symmetric_in_bounds(a, b):
    assert 0.0 <= _jw(a, b) <= 1.0
    assert _dl(a, b) == _dl(b, a) <= max(len(a.encode()), len(b.encode()))


def test_bound_never_drops_a_match(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(3000):
        letters = rng.choice(["abc", "etaoin shrdlu", "éèa b", "the a"])
        a = "".join(rng.choices(letters, k=rng.randint(0, 40)))
        b = "".join(rng.sample(a, len(a))) if rng.random() < 0.3 else a[: rng.randint(0, 9)] + "".join(
            rng.choices(letters, k=rng.randint(0, 30))
        )
        rows.append((a, b))
    df = spark.createDataFrame(rows, "a string, b string").withColumns(
        {"p": sim.title_profile(F.col("a")), "q": sim.title_profile(F.col("b")), "jw": sim.jaro_winkler("a", "b")}
    )
    for threshold in (0.6, 0.7, 0.85, 0.95):
        may = sim.title_may_exceed("p", "q", threshold)
        assert df.filter((F.col("jw") > threshold) & ~may).count() == 0
    assert df.filter(~sim.title_may_exceed("p", "q", 0.85)).count() > 0


def test_letter_counts_hide_no_near_title(spark):
    """Titles a few edits apart always pass, titles of other letters hardly ever."""
    draw = random.Random(11)
    letters = "etaoinsrhldu cmgpbfywvkxqjzéÿ,"
    rows = []
    for n in range(600):
        title = "".join(draw.choice(letters) for _ in range(draw.choice([0, 5, 30, 60, 126, 140])))
        other = list(title)
        for _ in range(draw.randrange(7)):
            at = draw.randrange(len(other) + 1)
            other[at : at + draw.randrange(2)] = draw.choice(["", "", letters[n % len(letters)]])
        rows.append((n, title, "".join(other)))
    one, two = ([f"{side}.{c}" for c in ("size", "low", "high")] for side in "pq")
    counted = spark.createDataFrame(rows, "n int, a string, b string").select(
        "*", F.struct(*sim.letter_counts(F.col("a"))).alias("p"), F.struct(*sim.letter_counts(F.col("b"))).alias("q")
    )
    near = counted.select(F.levenshtein("a", "b").alias("edits"), sim.edits_may_be(one, two, 6).alias("may")).collect()
    assert sum(r.edits <= 6 for r in near) > 400 and all(r.may for r in near if r.edits <= 6)
    long = counted.filter("p.size = 60")
    met = long.select("n", "p").crossJoin(long.select(F.col("n").alias("m"), F.col("p").alias("q"))).filter("n < m")
    assert met.filter(sim.edits_may_be(one, two, 6)).count() < met.count() / 20
