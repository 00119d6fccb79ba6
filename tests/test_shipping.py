"""Worker functions must run where the package is not installed."""

import subprocess
import sys

import pytest
from pyspark import cloudpickle

import __spark_entry__ as entry_points
from placeweave.functions import geo, similarity
from placeweave.operators import search, vector_join

_LOAD = "import sys, pickle; sys.path.append(sys.argv[1]); pickle.loads(sys.stdin.buffer.read())"


@pytest.mark.parametrize(
    "function",
    [
        similarity.jaro_winkler.func,
        similarity.damerau_levenshtein.func,
        geo.distance_geodesic.func,
        search._best_of_chunk(1),
        vector_join._similar("id", "v", 0.1, False, ["id1", "id2", "score"]),
    ],
)
def test_functions_travel_by_value(function):
    import pyspark

    place = pyspark.__path__[0].rsplit("/", 1)[0]
    run = subprocess.run(
        [sys.executable, "-c", _LOAD, place], input=cloudpickle.dumps(function), cwd="/", capture_output=True
    )
    assert run.returncode == 0, run.stderr.decode()


def test_titles_are_scored_once(spark, sf_dir):
    plan = entry_points.queries()["pair_title_scores"](spark, sf_dir)
    assert plan._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
