"""Targets against a plain loop, draws against what they must keep."""

import random
import re

from placeweave.llm import mixing

WORD = re.compile("[^\x20\x09-\x0d]+")


def targets(sizes):
    """Shares by weight, excess shared again until no source is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    rest, out, free = 1.5 * sum(sizes.values()), {}, set(names)
    while True:
        whole = sum(weight[s] for s in free)
        over = {s for s in free if rest * weight[s] / whole >= 2 * sizes[s]}
        if not over:
            return out | {s: rest * weight[s] / whole for s in free}
        for s in over:
            out[s] = 2.0 * sizes[s]
            rest -= out[s]
        free -= over
        if not free:
            return out


def check(rows, report):
    sizes = {}
    for doc, text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    want = targets(sizes)
    taken = {s: 0 for s in sizes}
    largest = {s: 0 for s in sizes}
    assert len(report) == len(rows)
    for r in report:
        assert r.source_size == sizes[r.source]
        assert abs(r.target - want[r.source]) <= 1e-6 * max(1, want[r.source])
        assert r.taken == r.copies * r.size and 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] + 1e-6
    key = lambda v: (v[0] is None, v[0] or 0, v[1])
    assert sorted(((r.doc_id, r.size) for r in report), key=key) == sorted(
        ((d, len(WORD.findall(t or ""))) for d, t, _, _ in rows), key=key
    )


def test_odd_rows(documents, odd_rows):
    check(odd_rows, mixing.mix_report(documents(odd_rows)).collect())


def test_empty_table(documents):
    assert mixing.mix_report(documents([])).collect() == []
    assert mixing.mixed(documents([])).collect() == []


def test_targets_are_kept_over_several_levels(documents, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET", 8)
    rng = random.Random(5)
    rows = [
        (i, " ".join("w" * rng.randint(1, 9) for _ in range(int(rng.lognormvariate(3, 1)))), "en", "s" + str(min(i % 9, 4)))
        for i in range(900)
    ]
    report = mixing.mix_report(documents(rows)).collect()
    check(rows, report)
    again = mixing.mix_report(documents(rows, 7)).collect()
    assert sorted(report) == sorted(again)
    by = {}
    for r in report:
        t, w = by.setdefault(r.source, [0, r.target])[:2]
        by[r.source][0] = t + r.taken
    assert all(abs(t - w) < 0.03 * w for t, w in by.values())


def test_hot_repeats_share_their_copies(documents):
    rows = [(7, "a b c d", "en", "s0")] * 40 + [(i, "a b c", "en", "s1") for i in range(60)]
    report = mixing.mix_report(documents(rows)).collect()
    check(rows, report)
    assert len({r.copies for r in report if r.source == "s0"}) <= 2


def test_mixed_documents_agree_with_the_report(documents, odd_rows):
    docs = documents(odd_rows)
    clash = docs.withColumnsRenamed({"lang": "mix_size", "n_chars": "mix_copies"})
    out = mixing.mixed(clash)
    assert out.columns == clash.columns
    counted = {}
    for r in out.collect():
        counted[r.doc_id] = counted.get(r.doc_id, 0) + 1
    want = {}
    for r in mixing.mix_report(docs).collect():
        if r.copies and r.size:
            want[r.doc_id] = want.get(r.doc_id, 0) + r.copies
    assert counted == want
