"""Base counts and outlier verdicts against plain Python and NumPy."""

import random
import re

import numpy as np

from placeweave.llm import quality

WORD = re.compile("[^\x20\x09-\x0d]+")


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [s for s in text.split("\n") if WORD.search(s)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    inside = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            inside.update(range(i, i + 5))
    joined = "".join(words)
    return (
        len(words),
        len(joined),
        sum(c in "#*$%&|<>" for c in joined),
        len(lines) - len(set(lines)),
        len(inside),
        sum("A" <= c <= "Z" for c in joined),
    )


def vector(c):
    n, chars, symbols, dups, repeats, upper = map(float, c)
    return [
        np.log((chars + 250) / (n + 50)),
        np.sqrt(symbols / (chars + 100)),
        np.sqrt(dups / (n + 50)),
        np.sqrt(repeats / (n + 50)),
        np.sqrt((upper + 3) / (chars + 100)),
    ]


def robust(x):
    """Distance and cut by the same concentration steps, on arrays."""
    floors = np.array(list(quality.COORDINATES.values()))
    middle = np.sort(x, 0)[-(-len(x) // 2) - 1]
    spread = np.maximum(1.4826 * np.sort(abs(x - middle), 0)[-(-len(x) // 2) - 1], floors)
    centre, scatter = middle, np.diag(spread**2)

    def far(rows):
        d = rows - centre
        return np.einsum("ij,jk,ik->i", d, np.linalg.inv(scatter), d)

    def top(bins, share):
        values, n = np.unique(bins, return_counts=True)
        return values[(np.cumsum(n) - n) < share * len(x)].max()

    for _ in range(quality.STEPS):
        bins = np.floor(quality.BINS_PER_OCTAVE * np.log2(far(x) + 1e-9))
        inner = x[bins <= top(bins, quality.KEEP_SHARE)]
        centre, scatter = inner.mean(0), quality.CONSISTENCY * np.cov(inner.T, bias=True) + np.diag(floors**2)
    inner = x[far(x) < quality.REWEIGHT_BELOW]
    centre, scatter = inner.mean(0), np.cov(inner.T, bias=True) + np.diag(floors**2)
    bins = np.floor(quality.BINS_PER_OCTAVE * np.log2(far(x) + 1e-9))
    edge = 2 ** ((top(bins, quality.TAIL_SHARE) + 1) / quality.BINS_PER_OCTAVE)
    return far, min(max(quality.TAIL * edge, quality.CUTS[0]), quality.CUTS[1])


def corpus(seed=2):
    rng = random.Random(seed)
    rows = []
    for i in range(420):
        n = int(rng.lognormvariate(4, 0.8)) + 12
        words = ["".join(rng.choice("abcdeéfgh") for _ in range(rng.randint(2, 9))) for _ in range(n)]
        text = " ".join(w.title() + "." if rng.random() < 0.08 else w for w in words)
        kind = rng.random()
        if kind < 0.05:
            text = " ".join(w + "###" for w in words)
        elif kind < 0.08:
            text = text.upper()
        elif kind < 0.11:
            text = "\n".join([" ".join(words[:7])] * 6)
        elif kind < 0.2:
            text = text.replace(". ", ".\n")
        rows.append((i, text, "en" if i % 3 else None, "s" + str(i % 2)))
    return rows


def test_counts_and_base_rule(documents, odd_rows):
    rows = [
        *odd_rows,
        (20, "a b c d e a b c d e", "en", "s0"),
        (21, "a a a a a a", "en", "s0"),
        (22, "a b\na b\n \n \na b \n# $$ |x", "en", "s0"),
        (23, "x y z w v u x y z w v q x y z w v", "en", "s0"),
        (24, "one two three four five six seven eight nine", "en", "s0"),
    ]
    got = quality.quality_report(documents(rows).withColumnRenamed("n_chars", "key")).collect()
    key = lambda t: str(t)
    mine = sorted([(r.doc_id, *[r[c] for c in quality.STATS], r.base_failed) for r in got], key=key)
    want = []
    for doc, text, *_ in rows:
        c = counts(text)
        want.append((doc, *c, c[0] < 10 or 100 * c[4] > 20 * c[0]))
    assert mine == sorted(want, key=key)
    assert all(r.kept == (not r.base_failed) for r in got if r.distance is None)


def test_outliers_match_the_plain_computation(documents):
    rows = corpus()
    got = {r.doc_id: r for r in quality.quality_report(documents(rows)).collect()}
    rejected = 0
    for group in {(r[2], r[3]) for r in rows}:
        own = [r for r in rows if (r[2], r[3]) == group]
        sound = [r for r in own if not got[r[0]].base_failed]
        far, cut = robust(np.array([vector(counts(r[1])) for r in sound]))
        for r in own:
            want = float(far(np.array([vector(counts(r[1]))]))[0])
            assert abs(got[r[0]].distance - want) < 1e-6 * max(1, want)
            assert got[r[0]].kept == (not got[r[0]].base_failed and want <= cut)
            rejected += not got[r[0]].kept
    assert 20 < rejected < 120


def test_small_groups_are_judged_by_wider_ones(documents):
    rows = [(i, text, "en", "s0") for i, text, *_ in corpus(5)[:200]]
    junk = " ".join("###" + w for w in rows[0][1].split())
    rows += [(1000 + i, junk if i == 2 else rows[i][1], "en", "tiny") for i in range(6)]
    rows += [(2000 + i, junk if i == 1 else rows[20 + i][1], "xx", None) for i in range(4)]
    got = {r.doc_id: r for r in quality.quality_report(documents(rows)).collect()}
    sound = [r for r in rows if not got[r[0]].base_failed]
    for ids, pool in [
        (range(1000, 1006), [r for r in sound if r[2] == "en"]),
        (range(2000, 2004), sound),
    ]:
        far, cut = robust(np.array([vector(counts(r[1])) for r in pool]))
        for r in rows:
            if r[0] in ids:
                want = float(far(np.array([vector(counts(r[1]))]))[0])
                assert abs(got[r[0]].distance - want) < 1e-6 * max(1, want)
                assert got[r[0]].kept == (not got[r[0]].base_failed and want <= cut)
    assert not got[1002].kept and not got[2001].kept


def test_a_table_of_few_rows_is_judged(documents):
    rows = [(i, text, "en", "s" + str(i)) for i, text, *_ in corpus(6)[:5]]
    assert all(r.distance is not None for r in quality.quality_report(documents(rows)).collect())


def test_each_statistic_rejects_alone(documents):
    rng = random.Random(8)

    def prose(n, low=3, high=7):
        return ["".join(rng.choice("abcdeéfgh") for _ in range(rng.randint(low, high))) for _ in range(n)]

    def lines(words, size=10):
        return "\n".join(" ".join(words[i : i + size]) for i in range(0, len(words), size))

    rows = [(i, lines([w.title() if k % 12 == 0 else w for k, w in enumerate(prose(rng.randint(80, 400)))]), "en", "s")
            for i in range(300)]
    usual = prose(400)
    repeated = prose(400)
    for k in range(3):
        repeated[40 + 100 * k : 60 + 100 * k] = repeated[0:20]
    planted = {
        "word_length": lines([w.title() if k % 12 == 0 else w for k, w in enumerate(prose(400, 14, 18))]),
        "symbol_share": lines([w + "#" for w in usual]),
        "dup_line_share": lines(usual, 5).replace("\n", "\nab\n"),
        "repeat_share": " ".join(repeated),
        "upper_share": lines([w.upper() if k % 2 else w for k, w in enumerate(usual)]),
    }
    rows += [(1000 + k, text, "en", "s") for k, text in enumerate(planted.values())]
    got = {r.doc_id: r for r in quality.quality_report(documents(rows)).collect()}
    assert all(got[i].kept for i in range(300))
    for k, name in enumerate(planted):
        assert not got[1000 + k].base_failed and not got[1000 + k].kept, name


def test_filter_keeps_columns_and_rows(documents):
    rows = corpus(3)[:150] * 2
    docs = documents(rows).withColumnsRenamed({"n_chars": "stats", "doc_id": "kept"})
    out = quality.keep_good(docs)
    assert out.columns == docs.columns
    verdicts = quality.quality_report(documents(rows)).filter("kept").collect()
    assert sorted(r.kept for r in out.collect()) == sorted(r.doc_id for r in verdicts)


def test_empty_table(documents):
    assert quality.quality_report(documents([])).collect() == []
    assert quality.keep_good(documents([])).collect() == []
