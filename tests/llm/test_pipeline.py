"""The pipeline's stages on a small corpus, each against what it must do."""

import random

import corpus_pipeline
from placeweave.session import settle

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def corpus(seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(160):
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(15, 160))]
        if i % 10 == 3:
            words[3:3] = ["token", "=", f'"{rng.getrandbits(160):040x}"']
        if i % 20 == 5:
            words = words[:5]
        rows.append((i, " ".join(words), "en", f"s{min(i % 6, 3)}"))
    for i in range(30):
        base = rows[rng.choice([0, 1, 2, 3])][1].split()
        if i % 2:
            base[rng.randrange(len(base))] = f"edit{i}"
        rows.append((1000 + i, " ".join(base), "en", "s1"))
    return rows + [(2000, None, None, None), (2001, "", "en", "s0")]


def test_stages(spark, documents, tmp_path):
    docs = settle(documents(corpus()))
    texts = {r.doc_id: r.text for r in docs.collect()}
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(settle(stage(spark, seen[-1], "")))
    quality, unique, masked, mixed, pieces = seen[1:]
    assert all(df.columns == COLUMNS for df in seen[1:-1])

    kept = {r.doc_id for r in quality.collect()}
    assert kept == {d for d, t in texts.items() if t and len(t.split()) >= 10}

    left = {r.doc_id for r in unique.collect()}
    assert left < kept and {0, 1, 2, 3} <= left
    copies = [d for d in kept if d >= 1000 and texts[d] in {texts[k] for k in (0, 1, 2, 3)}]
    assert copies and not left & set(copies)

    shown = {r.doc_id: r for r in masked.collect()}
    assert set(shown) == left
    for d, r in shown.items():
        assert ("[SECRET]" in r.text) == ("token = " in texts[d]) and r.n_chars == len(r.text)
        assert "[SECRET]" in r.text or r.text == texts[d]

    taken = mixed.groupBy("doc_id").count().collect()
    assert {r.doc_id for r in taken} <= left and all(r["count"] <= 2 for r in taken)
    words = sum(len(r.text.split()) for r in masked.collect())
    assert abs(sum(len(r.text.split()) for r in mixed.collect()) - 1.5 * words) < 0.02 * words

    by_doc = {r.doc_id: (r["sum(length)"], r["max(doc_tokens)"]) for r in pieces.groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()}
    assert {r.doc_id for r in taken} == set(by_doc)
    assert all(by_doc[r.doc_id][0] == r["count"] * by_doc[r.doc_id][1] for r in taken)


def test_run_reads_the_documents_table(spark, documents, tmp_path):
    documents(corpus(6)).write.parquet(str(tmp_path / "documents.parquet"))
    assert "sequence_id" in corpus_pipeline.run(spark, str(tmp_path)).columns


def test_stage_list():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near duplicates", "secrets", "mixing", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None
