"""Packing: every id once, windows full, checksums of the public tokenizer."""

import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from placeweave.llm import packing
from placeweave.llm.tokenizing import END_ID

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def ids_of(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, END_ID]


def check(rows, pieces):
    windows, by_doc = {}, {}
    for p in pieces:
        windows.setdefault(p.sequence_id, []).append(p)
        by_doc.setdefault((p.doc_id, p.doc_tokens), []).append(p)
    for own in windows.values():
        own.sort(key=lambda p: p.offset)
        used = 0
        for p in own:
            assert p.offset == used and p.length > 0
            used += p.length
        assert used <= 2048 and used == own[0].tier
        assert used & (used - 1) == 0  # full: a power of two
    wanted = {}
    for doc, text, _, _ in rows:
        ids = ids_of(text)
        wanted.setdefault((doc, len(ids)), []).append(ids)
    assert set(wanted) == set(by_doc)
    for key, texts in wanted.items():
        own = sorted(by_doc[key], key=lambda p: (p.start, p.length))
        assert sum(p.length for p in own) == len(texts) * key[1]
        if len(set(map(tuple, texts))) == 1:
            ids = np.array(texts[0], "<u4")
            for p in own:
                assert p.ids_crc32 == zlib.crc32(ids[p.start : p.start + p.length].tobytes())
            if len(texts) == 1:
                at = 0
                for p in own:
                    assert p.start == at
                    at += p.length


def test_odd_rows(documents, odd_rows):
    rows = [*odd_rows, (50, "a <|endoftext|> b  c d e f́ g ́x " * 3, "en", "s")]
    check(rows, packing.pack(documents(rows)).collect())


def test_many_documents_fill_their_windows(documents, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_BYTES", 40_000)
    rng = np.random.default_rng(3)
    rows = [
        (i, " ".join(f"w{rng.integers(0, 500)}" for _ in range(int(rng.lognormal(4.5, 1.3)))), "en", "s0")
        for i in range(400)
    ]
    pieces = packing.pack(documents(rows)).collect()
    check(rows, pieces)
    assert {p.tier for p in pieces} >= {2048, 1024, 512, 256}
    again = packing.pack(documents(rows, 8)).collect()
    assert sorted(pieces) == sorted(again)
    steps = {}
    for p in pieces:
        steps[p.step_group] = steps.get(p.step_group, 0) + p.length
    assert max(steps.values()) <= packing.STEP_TOKENS + 2048


def test_windows_of_lengths_alone():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 50):
        lengths = [int(x) for x in rng.integers(1, 2047, n)]
        windows = packing.pack_windows(lengths)
        assert sum(size for size, _ in windows) == sum(lengths)
        seen = sorted((d, s, k) for _, own in windows for d, s, k in own)
        at = {}
        for d, s, k in seen:
            assert s == at.get(d, 0)
            at[d] = s + k
        assert at == dict(enumerate(lengths))


def test_empty_table(documents):
    assert packing.pack(documents([])).collect() == []
