"""Running totals and quantiles against plain computations."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from placeweave.operators import order


@pytest.mark.parametrize("n, ranges, spread", [(1, 3, 5), (2, 1, 9), (101, 4, 7), (1000, 7, 10**9), (333, 50, 2)])
def test_quantiles_equal_percentile(spark, n, ranges, spread):
    rng = random.Random(n)
    values = [rng.randrange(-spread, spread) / 4 for _ in range(n)] + [0.25] * (n // 3)
    fractions = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    rows = spark.createDataFrame([(v,) for v in [*values, None]], "v double")
    got = {r.fraction: r.quantile for r in order.exact_quantiles(rows, "v", fractions, ranges).collect()}
    assert [got[f] for f in fractions] == pytest.approx(list(np.quantile(values, fractions)))
    said = rows.agg(F.percentile("v", F.array(*[F.lit(f) for f in fractions]))).first()[0]
    assert [got[f] for f in fractions] == pytest.approx(said)


def test_running_totals(spark):
    rng = random.Random(5)
    counts = {rng.randrange(10**6): rng.randrange(1, 9) for _ in range(500)}
    rows = spark.createDataFrame(list(counts.items()), "w long, n long")
    before, expected = 0, {}
    for value in sorted(counts):
        expected[value] = before
        before += counts[value]
    got = order.running_totals(rows, "w", "n", 6).collect()
    assert {r.w: r.before for r in got} == expected and {r.total for r in got} == {before}


def test_no_values(spark):
    empty = spark.createDataFrame([(None,)], "v long")
    assert order.exact_quantiles(empty, "v", [0.5]).first().quantile is None
    assert order.running_totals(empty.withColumn("n", F.lit(1)), "v", "n").count() == 0
