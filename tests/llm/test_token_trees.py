"""Counts after edits against counting the whole edited text."""

import random

import pytest
from pyspark.sql import functions as F

from placeweave.llm import token_trees

COUNTER = token_trees.Counter(token_trees.RANKS)


def whole(text):
    return len(COUNTER.encoding.encode_ordinary(text))


@pytest.mark.parametrize("seed", range(12))
def test_random_edits(seed, monkeypatch):
    monkeypatch.setattr(token_trees, "LEAF", 3)
    rng = random.Random(seed)
    alphabet = ["ab", "don't", " ", "  ", "\n", "é", "12", "!?", "'s", "\t \n", "\x1c", "\x85", "\u3000", "漢字", "😀", "x" * 9]
    for _ in range(60):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(60)))
        tree = token_trees.build(text, COUNTER)
        assert tree.total == whole(text)
        for _ in range(8):
            start = rng.randrange(-2, len(text) + 3)
            new = "".join(rng.choice(alphabet) for _ in range(rng.choice([0, 0, 1, 2, 30])))
            end = start + rng.choice([0, 0, 1, 5, 40])
            low = min(max(start, 0), len(text))
            wanted = text[:low] + new + text[max(low, min(end, len(text))) :]
            text, tree, _ = token_trees.edit(text, tree, start, end, new, COUNTER)
            assert text == wanted
            fresh = token_trees.build(text, COUNTER)
            assert tree.total == whole(text) == fresh.total and tree.chars[1] == len(text)
            size = tree.size
            for node in range(1, size):
                assert tree.chars[node] == tree.chars[2 * node] + tree.chars[2 * node + 1]
                assert tree.tokens[node] == tree.tokens[2 * node] + tree.tokens[2 * node + 1]


def test_edits_encode_little_of_a_long_text():
    text = " ".join(f"word{i}, and more." for i in range(20_000))
    tree = token_trees.build(text, COUNTER)
    out, tree, encoded = token_trees.edit(text, tree, len(text) // 2, len(text) // 2 + 30, "new words", COUNTER)
    assert tree.total == whole(out) and encoded <= 4 * token_trees.LEAF


def test_report(documents, odd_rows):
    docs = documents(odd_rows).withColumnRenamed("n_chars", "leaves")
    got = sorted(map(tuple, token_trees.edit_report(docs).collect()), key=str)
    want = []
    for doc, text, lang, source in odd_rows:
        text = text or ""
        low, high = max(len(text) // 2 - 20, 0), min(len(text) // 2 + 20, len(text))
        edited = (source or "") + text[:low] + (lang or "") + text[high:]
        want.append((doc, whole(text), whole(edited)))
    assert [g[:3] for g in got] == sorted(want, key=str)


def test_second_round_of_edits(spark, documents):
    docs = documents([(1, "some words here", "en", "s"), (2, None, "en", "s")])
    none = F.lit(None).cast(token_trees.EDITS)
    once = token_trees.apply_edits(token_trees.build_trees(docs.withColumn("edits", none)))
    more = F.array(
        F.struct(F.lit(4).cast("long").alias("start"), F.lit(10).cast("long").alias("end"), F.lit(" more").alias("text")),
        F.lit(None).cast("struct<start:long,end:long,text:string>"),
    )
    twice = {r.doc_id: r for r in token_trees.apply_edits(once.withColumn("edits", more)).collect()}
    assert twice[1].text == "some more here" and twice[1].n_tokens_edited == whole("some more here")
    assert twice[2].text == " more" and twice[2].n_tokens_edited == whole(" more")


def test_empty_table(documents):
    assert token_trees.edit_report(documents([])).collect() == []
