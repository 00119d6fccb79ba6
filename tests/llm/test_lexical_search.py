"""Ranked search against a plain computation over all documents."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import types as T

from placeweave.llm import lexical_search as ls

ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())])
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def plain_terms(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(lowered)


def plain_search(rows, items, top=10):
    counts = [(doc_id, Counter(plain_terms(text))) for doc_id, text in rows]
    counts = [(d, c) for d, c in counts if c]
    n_docs, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item_id, text in set(items):
        scores = []
        for doc_id, c in counts:
            m = 100 - 75 + (75 * sum(c.values()) * n_docs) // total
            score = 0
            for t in plain_terms(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id))
        for rank, (score, _, doc_id) in enumerate(sorted(scores)[:top], 1):
            out.append((item_id, rank, doc_id, -score))
    return sorted(out, key=str)


def got(frame):
    return sorted((tuple(r) for r in frame.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.mark.parametrize("width, first", [(1 << 16, 64), (16, 1), (1, 2)])
def test_odd_rows(spark, documents, odd_rows, width, first):
    rows = odd_rows + [(50 + i, f"word{i} Shared Ünïcödé term{i % 3} " * (i + 1), "en", "s") for i in range(40)]
    rows += [(90 + i, "copy of a text with word1 in it", "en", "s") for i in range(30)]
    rows += [(None, "copy of a text with word1 in it", "en", "s"), (200, "w " * 400, "en", "s")]
    items = [
        (1, "word1 shared Shared term1"),
        (2, None),
        (3, ""),
        (4, "... --"),
        (5, "nothing-here-matches zzz"),
        (6, "ÜNÏCÖDÉ ünïcödé Ünïcödé copy"),
        (6, "words read here"),
        (None, "eleven words, w W w"),
        (7, "abc " * 500),
        (7, "abc " * 500),
    ]
    docs = documents(rows).withColumnRenamed("lang", "bound").withColumnRenamed("source", "query")
    frame = ls.search(docs, spark.createDataFrame(items, ITEMS), 3, width, first)
    assert got(frame) == plain_search([r[:2] for r in rows], items, 3)


def test_blocks_of_queries(spark, documents, monkeypatch):
    monkeypatch.setattr(ls, "QUERIES_AT_ONCE", 3)
    rows = [(i, f"a{i % 5} b{i % 7} c{i % 11} common", "en", "s") for i in range(60)]
    items = [(i, f"a{i % 5} c{i}") for i in range(17)]
    frame = ls.search(documents(rows), spark.createDataFrame(items, ITEMS))
    assert got(frame) == plain_search([r[:2] for r in rows], items)


def test_empty_tables(spark, documents):
    some = documents([(1, "a b", "en", "s"), (2, "...", "en", "s")])
    items = spark.createDataFrame([(1, "a")], ITEMS)
    assert got(ls.search(some.limit(0), items)) == []
    assert got(ls.search(some, items.limit(0))) == []
    assert got(ls.search(some.filter("doc_id = 2"), items)) == []


def test_bounds_are_no_lower_than_scores(documents):
    counts = [Counter({b"t%d" % i: i % 300 + 1 for i in range(n)}) for n in (1, 20, 900)]
    df = {b"t%d" % i: 1 + i % 3 for i in range(900)}
    queries = ls.Queries([Counter({b"t3": 2, b"t299": 1}), Counter({b"t800": 1})], df, 3, 900, 64)
    import pyarrow as pa

    drawn = [ls.sketch(c, 64) for c in counts]
    part = pa.RecordBatch.from_pydict(
        {
            "n": [c.total() for c in counts],
            "places": pa.array([p for p, _ in drawn], pa.binary()),
            "most": pa.array([m for _, m in drawn], pa.binary()),
        }
    )
    bounds = queries.bounds(part)
    factors = queries.factors([c.total() for c in counts])
    for doc, c in enumerate(counts):
        for query in range(2):
            assert bounds[doc, query] >= queries.score(query, c, int(factors[doc]))
