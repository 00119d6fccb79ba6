"""Base spans against the stated patterns; what the random field adds."""

import hashlib
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from placeweave.llm import pii

STATED = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(digits[::-1])]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def brute(text):
    out = []
    for kind, pattern in STATED.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True,
                "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                "card": 13 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def named(spans):
    return [f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in spans]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab.@+-() 0123456789%é", max_size=60))
def test_base_spans_are_the_stated_ones(text):
    assert named(pii.base_spans(text)) == brute(text)


TEXTS = [
    "Mail jo.ann25@mail4.example.com or call +1 (017) 555-7713 today.",
    "a@b.c@d.e a@b@c.de .@x.y-z.1. 1.2.3.4.5.6.7.8 300.1.1.1 0255.001.1.1",
    "card 4111 1111 1111 1111 and 4111-1111-1111-1112, 4111  1111 1111 1111",
    "+123456789 +1 2 +1-2-3-4-5-6-7-8-9-0-1-2-3-4-5-6 ++49 30 1234567.",
    "Call +1 (017) 555-7713 now. Later again 1 (017) 555-7713 or 4111111111111111 twice: 4111111111111111.",
]


def test_report(documents, odd_rows):
    rows = [*odd_rows, *((100 + i, t, "en", "s") for i, t in enumerate(TEXTS))]
    docs = documents(rows).withColumnRenamed("lang", "spans")
    got = pii.pii_report(docs).collect()
    key = lambda r: (r[0] is None, r[0] or 0)
    want = [
        (d, *(sum(s.startswith(k) for s in brute(t)) for k in pii.KINDS), hashlib.sha256(",".join(brute(t)).encode()).hexdigest())
        for d, t, _, _ in rows
    ]
    assert sorted((tuple(r)[:6] for r in got), key=key) == sorted(want, key=key)
    for r in got:
        text = next(t for d, t, _, _ in rows if d == r.doc_id)
        assert set(brute(text)) <= set(filter(None, r.spans.split(",")))


def test_repeats_of_observed_data_are_added():
    rng = random.Random(4)
    texts = []
    for _ in range(300):
        n = "".join(rng.choice("0123456789") for _ in range(7))
        texts.append(f"words here +1 (201) 555-{n[:4]} then more, number {n} and jo.x{n[:2]}@mail.example.com end")
    model = pii.fit(texts)
    text = "Write to mary.k77@mail.example.com soon. Signed, mary.k77 and order 20394857 as well. " + "la " * 40 + "mary.k77"
    (base, added), (_, none) = pii.read_texts([text, "order 20394857, also 99887766 and mary.k77"], model)
    assert named(base) == brute(text)
    assert {text[s:e] for k, s, e in added if k == 0} == {"mary.k77"} and len(added) == 2
    assert none == []


def test_every_repeat_of_an_observed_datum_is_found():
    rng = random.Random(4)
    texts = []
    for _ in range(300):
        n = "".join(rng.choice("0123456789") for _ in range(7))
        both = f"+1 (201) 555-{n[:4]} then more, number {n} and jo.x{n[:2]}@mail.example.com end"
        texts.append(f"words here {both}, once again {both}")
    model = pii.fit(texts)
    filler = "some words lie in between here and there " * 3
    cases = [
        ("+1 (201) 555-7788", "12015557788"),
        ("mary.k77@mail.example.com", "mary.k77"),
        ("jo1234567@mail.example.com", "jo1234567"),
    ]
    for whole, short in cases:
        for before, after in ((0, 1), (0, 50), (50, 0), (25, 25)):
            text = filler + f"{short} {filler}" * before + f"{whole} {filler}" + f"{short} {filler}" * after
            ((base, added),) = pii.read_texts([text], model)
            assert named(base) == brute(text)
            assert [text[s:e] for _, s, e in added] == [short] * (before + after), (whole, before, len(added))
    # linear in the text, and numbers that nothing observes stay out
    text = "order 20394857 " * 2000
    _, nodes, edges = pii.document_graph(text)
    assert len(nodes) == 2000 and len(edges) < 3 * 2000
    assert pii.read_texts([text], model)[0][1] == []


def test_messages_match_exact_marginals_on_a_tree():
    import itertools

    import numpy as np

    rng = np.random.default_rng(0)
    unary, psi = rng.normal(size=(4, 5)), rng.normal(size=(2, 5, 5))
    edges = np.array([(0, 1, 0), (1, 2, 1), (1, 3, 0)])
    exact = np.zeros((4, 5))
    for labels in itertools.product(range(5), repeat=4):
        score = sum(unary[i, l] for i, l in enumerate(labels))
        score += sum(psi[t, labels[u], labels[v]] for u, v, t in edges)
        for i, l in enumerate(labels):
            exact[i, l] += np.exp(score)
    exact /= exact.sum(1, keepdims=True)
    rounds, pii.ROUNDS = pii.ROUNDS, 60
    try:
        assert np.allclose(pii.beliefs(unary, edges, psi), exact, atol=1e-6)
    finally:
        pii.ROUNDS = rounds


def test_empty_table(documents):
    assert pii.pii_report(documents([])).collect() == []
