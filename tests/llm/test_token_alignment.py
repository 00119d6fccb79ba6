"""Token alignment against whole-text encodings and plain loops."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from placeweave.llm import token_alignment as ta

SAMPLES = [
    "",
    " ",
    "  two  blanks  ",
    "plain words, with marks. And numbers 12 345",
    "tab\tand\n newline \n\n  indented\r\n x",
    "café naïve 你好 世界 \U0001f600\U0001f1e9\U0001f1ea İstanbul ½ Ⅷ",
    "a▁b and ▁ alone",
    "no break  space　wide   em​ zero",
    "<|endoftext|> <s> </s> <unk> <0x41>",
    "x" * 3000,
    "\x00 nul \x1c fs \x1f us \x7f del \x85 nel",
    "it's they'll we've I'd 'quoted'",
    "é combining ﬁ ligature",
    "leading\n \nmix \x0b vt \x0c ff",
]


@pytest.fixture(scope="module")
def plain():
    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    exact.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    coder = ta.Encoders(ta.BYTE_TOKENIZER, ta.PIECE_MODEL)

    def encode(text):
        if not text:
            return [], []
        a = exact.encode(" " + text, add_special_tokens=False).ids
        b = pieces.encode(text)
        whole = (" " + text).encode()
        if b"".join(coder.a_bytes[i] for i in a) != whole or b"".join(coder.b_bytes[i] for i in b) != whole:
            return [], []
        ends = lambda ids, table: np.cumsum([len(table[i]) for i in ids]).tolist()
        return list(zip(a, ends(a, coder.a_bytes))), list(zip(b, ends(b, coder.b_bytes)))

    return encode


def links_of(a, b):
    at_end = {end: i for i, end in b}
    return [(i, at_end[end]) for i, end in a if end in at_end]


def digest_of(a, b):
    if not a:
        return ""
    shared = sorted({e for _, e in a} & {e for _, e in b})
    groups, low = [], 0
    for end in shared:
        side = lambda tokens: ",".join(str(i) for i, e in tokens if low < e <= end)  # noqa: B023, E731
        groups.append(f"{side(a)}|{side(b)}")
        low = end
    return hashlib.sha256(";".join(groups).encode()).hexdigest()


def expected(rows, encode):
    coded = [(doc_id, *encode(text)) for doc_id, text in rows]
    counts = Counter(pair for _, a, b in coded for pair in links_of(a, b))
    highest = Counter()
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    out = []
    for doc_id, a, b in coded:
        links = links_of(a, b)
        out.append(
            (
                doc_id, len(a), len(b), len(links), len(links),
                sum(counts[p] == highest[p[1]] for p in links), sum(counts[p] for p in links),
                digest_of(a, b),
            )
        )
    return sorted(out, key=str)


def got(frame):
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((tuple(r) for r in frame.select(names).collect()), key=str)


def test_samples_and_odd_rows(spark, documents, odd_rows, plain):
    rows = [(100 + i, t, "en", "s0") for i, t in enumerate(SAMPLES * 3)] + odd_rows
    docs = documents(rows).withColumnRenamed("lang", "block").withColumnRenamed("source", "pairs")
    report = ta.align_report(docs, block_bytes=2000)
    assert got(report) == expected([r[:2] for r in rows], plain)


def test_whole_table(spark, sf_dir, plain):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert got(ta.align_report(docs)) == expected(rows, plain)


def test_empty_table(documents):
    assert got(ta.align_report(documents([(1, "a", "en", "s")]).limit(0))) == []


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab Z9.,'\n\t ▁　​İé你\x1c\x85")), max_size=30))
def test_chunks_encode_like_whole_texts(plain, text):
    import pyarrow as pa

    coder = ta.encoders(ta.BYTE_TOKENIZER, ta.PIECE_MODEL)
    found = ta.align(pa.RecordBatch.from_pydict({"text": pa.array([text], pa.string())}), coder)
    a, b = plain(text)
    assert found.a_ids.tolist() == [i for i, _ in a]
    assert found.b_ids.tolist() == [i for i, _ in b]


def test_links_listed(documents, plain, monkeypatch):
    text = "café 你好 \U0001f600 plain words"
    a, b = plain(text)
    spans = lambda tokens: [(e0, e1) for e0, (_, e1) in zip([0, *[e for _, e in tokens]], tokens)]
    overlap = {
        (i, j): min(ea, eb) - max(sa, sb)
        for i, (sa, ea) in enumerate(spans(a))
        for j, (sb, eb) in enumerate(spans(b))
        if min(ea, eb) > max(sa, sb)
    }
    docs = documents([(1, text, "en", "s"), (2, None, "en", "s")])
    found = ta.token_links(docs)
    assert {(r.a_at, r.b_at): r.shared for r in found.collect()} == overlap
    shared = sorted({e for _, e in a} & {e for _, e in b})
    group = lambda end: int(np.searchsorted(shared, end))
    pairs = {(i, j) for i, (_, ea) in enumerate(a) for j, (_, eb) in enumerate(b) if group(ea) == group(eb)}
    assert {(r.a_at, r.b_at) for r in ta.token_links(docs, "group").collect()} == pairs


def test_row_product_is_a_matrix_product():
    rng = np.random.default_rng(3)
    left, right = rng.integers(0, 2, (7, 9)), rng.integers(0, 2, (9, 5))
    csr = lambda m: ta.Csr(np.concatenate([[0], m.sum(1).cumsum()]), np.nonzero(m)[1], m.shape[1])
    product = csr(left) @ csr(right)
    dense = np.zeros((7, 5), int)
    dense[product.row_of_each(), product.columns] = product.values
    assert (dense == left @ right).all()
    assert (csr(left).work(csr(right)) == left @ right.sum(1)).all()
