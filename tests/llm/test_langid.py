"""Language labels: inference against enumeration, held-out accuracy, switches."""

import itertools
import random
import zlib

import numpy as np

from placeweave.llm import langid

STEMS = {"aa": ["ba", "bo", "ka", "ki"], "bb": ["zu", "ri", "sh", "ti"], "cc": ["ém", "ön", "lü", "ka"]}


def text_of(rng, lang, n):
    words = ["".join(rng.choice(STEMS[lang]) for _ in range(rng.randint(2, 4))) for _ in range(n)]
    return " ".join(w.title() + "." if rng.random() < 0.1 else w for w in words)


def corpus(n, seed=1):
    rng = random.Random(seed)
    langs = [rng.choice(list(STEMS)) for _ in range(n)]
    return [(i, text_of(rng, lang, rng.randint(5, 80)), lang, "s") for i, lang in enumerate(langs)]


def test_forward_backward_against_enumeration():
    rng = np.random.default_rng(0)
    lengths = np.array([4, 3, 1])
    scores, transitions = rng.normal(size=(4, 3, 2)), rng.normal(size=(2, 2))
    got = langid.forward_backward(scores, transitions, lengths)[0]
    for s, n in enumerate(lengths):
        want = np.zeros((n, 2))
        for labels in itertools.product(range(2), repeat=int(n)):
            total = sum(scores[t, s, l] for t, l in enumerate(labels))
            total += sum(transitions[a, b] for a, b in zip(labels, labels[1:]))
            for t, l in enumerate(labels):
                want[t, l] += np.exp(total)
        assert np.allclose(got[:n, s], want / want.sum(1, keepdims=True))


def test_held_out_accuracy_and_odd_rows(documents, odd_rows):
    rows = corpus(400) + [(5000 + (d or 0), t, None, s) for d, t, _, s in odd_rows] + [(None, "ba bo", "aa", "s"), (6001, "½ ² ③ Ⅳ", "aa", "s"), (6002, "½ba bo²", "aa", "s")]
    got = {r.doc_id: r for r in langid.language_report(documents(rows).withColumnRenamed("source", "score")).collect()}
    assert len(got) == len({r[0] for r in rows})
    right = []
    for doc, text, lang, _ in rows:
        r = got[doc]
        assert r.held_out == (doc is not None and zlib.crc32(str(doc).encode()) % 3 == 1)
        assert 0 <= r.score <= 1
        if not any(c.isalpha() for c in text or ""):
            assert (r.lang_pred, r.score) == ("und", 0)
        else:
            assert r.lang_pred in STEMS
        if lang and r.held_out:
            right.append(r.lang_pred == lang)
    assert len(right) > 80 and np.mean(right) > 0.97


def test_words_of_mixed_text_are_told_apart():
    model = langid.fit([(lang, text) for _, text, lang, _ in corpus(300, 2)])
    rng = random.Random(9)
    a, b = text_of(rng, "aa", 30), text_of(rng, "bb", 30)
    labels = [l for _, l in langid.label_words(model, [a + " 123 " + b])[0]]
    assert np.mean([l == "aa" for l in labels[:30]]) > 0.9 and np.mean([l == "bb" for l in labels[-30:]]) > 0.9


def test_windows_change_nothing_of_note(monkeypatch):
    model = langid.fit([(lang, text) for _, text, lang, _ in corpus(300, 2)])
    rng = random.Random(3)
    words = [(text_of(rng, "aa", 200) + " " + text_of(rng, "cc", 150)).split()]
    whole = langid.Labeller(model).probabilities(words)[0][0]
    monkeypatch.setattr(langid, "WINDOW", 40)
    cut = langid.Labeller(model).probabilities(words)[0][0]
    assert np.abs(whole - cut).max() < 0.01


def test_long_runs_are_read_whole():
    rows = [(lang, text) for _, text, lang, _ in corpus(300, 2)]
    model = langid.fit(rows)
    rng = random.Random(5)
    ends, middle = text_of(rng, "bb", 4).replace(" ", ""), text_of(rng, "aa", 400).replace(" ", "")
    run = ends[:16] + middle + ends[-16:]
    assert "".join(langid.split_words(run)) == run and max(map(len, langid.split_words(run))) <= 32
    labels = [l for _, l in langid.label_words(model, [run])[0]]
    assert np.mean([l == "aa" for l in labels]) > 0.9
    assert langid.split_words(" a  bc\n") == ["a", "bc"]
    assert len(langid.plain("\u0130" * 32)) == 32


def test_languages_of_long_texts_only_are_learned(documents):
    rng = random.Random(8)
    rows = [(i, text_of(rng, "aa", 40), "aa", "s") for i in range(60)]
    rows += [(100 + i, text_of(rng, "bb", 3000), "bb", "s") for i in range(20)]
    assert all(len(t) > langid.SAMPLE_BYTES for _, t, lang, _ in rows if lang == "bb")
    docs = documents(rows)
    sample = langid.training_rows(docs)
    assert {lang for lang, _ in sample} == {"aa", "bb"}
    assert max(len(t) for _, t in sample) <= langid.SAMPLE_BYTES
    got = {r.doc_id: r.lang_pred for r in langid.language_report(docs).collect()}
    assert all(got[d] == lang for d, _, lang, _ in rows)


def test_nothing_to_learn_from(documents):
    assert langid.language_report(documents([])).collect() == []
    got = langid.language_report(documents([(1, "words here", None, "s"), (3, "more", None, "s")])).collect()
    assert {(r.lang_pred, r.score) for r in got} == {("und", 0.0)}
