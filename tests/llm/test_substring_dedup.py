"""Repeated windows against a plain scan over all of them."""

import hashlib
import random

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from placeweave.llm import substring_dedup as sd


def plain(rows, length=20):
    """Rows equal in id and text are one document."""
    order = sorted({(r[0] is None, r[0] or 0, r[1] or "") for r in rows}, key=lambda r: r)
    texts = [(none, doc_id, text, text.encode().split()) for none, doc_id, text in order]
    seen, gone = set(), {}
    for none, doc_id, text, words in texts:
        marks = [False] * len(words)
        for start in range(len(words) - length + 1):
            window = tuple(words[start : start + length])
            if window in seen:
                marks[start : start + length] = [True] * length
            seen.add(window)
        gone[none, doc_id, text] = words, marks
    out = []
    for doc_id, text in rows:
        words, marks = gone[doc_id is None, doc_id or 0, text or ""]
        kept = [w for w, m in zip(words, marks) if not m]
        out.append((doc_id, len(words), sum(marks), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=str)


def got(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def some_rows():
    draw = random.Random(5)
    word = lambda: f"w{draw.randrange(60)}"
    base = [word() for _ in range(200)]
    rows = []
    for i in range(60):
        low = draw.randrange(150)
        part = base[low : low + draw.randrange(10, 50)]
        text = [word() for _ in range(draw.randrange(30))] + part + [word() for _ in range(draw.randrange(30))]
        if draw.random() < 0.4 and text:
            text[draw.randrange(len(text))] = "changed"
        rows.append((i, draw.choice([" ", "\n", "  \t"]).join(text)))
    rows += [(100 + i, " ".join(base)) for i in range(40)]  # copies
    rows += [(200 + i, " ".join([*base, f"end{i}"])) for i in range(60)]  # near copies
    rows += [(300, "same " * 300), (301, "a b " * 100), (302, "same " * 21), (50, rows[50][1])]
    rows += [(None, " ".join(base)), (None, "only here " + " ".join(base[:25]))]
    return rows


@pytest.mark.parametrize("group", [sd.GROUP_SUFFIXES, 30, 1])
def test_rows_and_odd_rows(documents, odd_rows, group):
    rows = some_rows() + [r[:2] for r in odd_rows]
    docs = documents([(*r, "en", "s") for r in rows]).withColumnRenamed("lang", "key")
    assert got(sd.dedup_report(docs, group_suffixes=group)) == plain(rows)


def test_other_lengths(documents):
    rows = some_rows()[:40]
    docs = documents([(*r, "en", "s") for r in rows])
    assert got(sd.dedup_report(docs, length=6, prefix=2)) == plain(rows, 6)


def test_equals_sql(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with duckdb.connect() as base:
        base.execute(f"create view documents as select * from '{sf_dir}/documents.parquet'")
        rows = base.execute(sd.oracle_sql()).fetchall()
    assert got(sd.dedup_report(docs)) == sorted(rows, key=str)


def test_texts_and_passages(documents):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(1, f"first {passage} one"), (2, f"other\nwords {passage}  tail"), (3, None), (4, "short\n text")]
    docs = documents([(*r, "en", "s") for r in rows]).withColumnRenamed("lang", "id").withColumnRenamed("source", "row")
    out = sd.without_repeats(docs)
    assert out.columns == docs.columns
    assert {r.doc_id: r.text for r in out.collect()} == {
        1: f"first {passage} one", 2: "other words tail", 3: None, 4: "short\n text",
    }
    assert got(sd.repeated_passages(docs)) == [(2, 2, 60, passage)]


def test_empty_table(documents):
    docs = documents([(1, "a", "en", "s")])
    assert got(sd.dedup_report(docs.limit(0))) == []
    assert got(sd.without_repeats(docs.limit(0))) == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from("abc"), min_size=0, max_size=60))
def test_equal_windows_have_equal_anchors(letters):
    import numpy as np
    import pyarrow as pa

    words, starts = sd.word_hashes(pa.array([" ".join(letters)], pa.string()))
    at, _, low, high = sd.anchors(words, starts, 6, 3)
    found = {int(a - o): int(o) for a, l, h in zip(at, low, high) for o in range(l, h + 1)}
    assert sorted(found) == list(range(max(0, len(letters) - 5)))
    of_window = {}
    for start, o in found.items():
        assert of_window.setdefault(tuple(letters[start : start + 6]), o) == o
    assert np.all(np.diff(at) > 0)
