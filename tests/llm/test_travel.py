"""The operators' worker functions must run where the package isn't installed."""

import subprocess
import sys

import pytest
from pyspark import cloudpickle

from placeweave.llm import (
    embeddings,
    jaccard,
    langid,
    lexical_search,
    packing,
    pii,
    secret_scan,
    substring_dedup,
    token_alignment,
    token_trees,
)

_LOAD = """
import sys, pickle
sys.path.append(sys.argv[1])
pickle.loads(sys.stdin.buffer.read())
assert not any(m.startswith("placeweave") for m in sys.modules), "needs the package"
"""


def loads_alone(thing):
    import pyspark

    place = pyspark.__path__[0].rsplit("/", 1)[0]
    run = subprocess.run(
        [sys.executable, "-c", _LOAD, place], input=cloudpickle.dumps(thing), cwd="/", capture_output=True
    )
    assert run.returncode == 0, run.stderr.decode()


def _workers():
    rule = jaccard.RULE
    model = langid.fit([("aa", "ba bo ba bo"), ("bb", "ki ku ki ku")])
    yield "embeddings", [embeddings._places("float"), embeddings._tile("float")]
    yield "jaccard", [
        jaccard._sets(rule), jaccard._tile_rows(rule), jaccard._neighbours, jaccard._whole_sets(rule),
        jaccard._cross_pairs(rule), jaccard._keep(rule.may_link), jaccard._keep(rule.members_link),
    ]
    yield "langid", [langid._report(model)]
    yield "lexical_search", [
        lexical_search._sketches(8), lexical_search._holding([b"a"]),
        lexical_search._highest(lexical_search.Queries([], {}, 1, 1, 8), 3), lexical_search._exact(None, 3),
    ]
    yield "packing", [packing._tokenise("a", "<u2"), packing._pack("<u2")]
    yield "pii", [pii._report]
    yield "secret_scan", [secret_scan._scan]
    yield "substring_dedup", [
        substring_dedup._anchored(20, 8), substring_dedup._recorded(20), substring_dedup._repeats(20, 8),
        substring_dedup._named_windows(20), substring_dedup._reported(20), substring_dedup._without(20),
    ]
    yield "token_alignment", [
        token_alignment._blocks("a", "b", 1), token_alignment._scored, token_alignment._listed("a", "b", "group", []),
    ]
    yield "token_trees", [token_trees._build({}), token_trees._edit({})]


@pytest.mark.parametrize("functions", [pytest.param(f, id=n) for n, f in _workers()])
def test_worker_functions_of_each_operator(functions):
    loads_alone(functions)
