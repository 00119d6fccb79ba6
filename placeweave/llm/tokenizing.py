"""Token ids of texts in Python workers.

The tokenizer splits at white space and never merges across it, so a text's ids
are those of its chunks between white space, one after another. Most chunks
return often: each worker keeps the ids of those it has met.
"""

from __future__ import annotations

import array
import os
import sys
import types

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from placeweave.functions.shipping import ship_by_value
from placeweave.llm.chunks import spread

ship_by_value(__name__)

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
ID_TYPE = "<u2"  # ids of the default vocabulary; "<u4" for vocabularies over 65,536
PARTS_KEPT = 400_000  # in each of two generations
LONGEST_KEPT = 64
MARKS = ".,;:!?"


def kept_by_worker(name: str, make):
    """An object that stays with a Python worker from task to task."""
    store = sys.modules.setdefault("_placeweave_worker", types.ModuleType("_placeweave_worker"))
    if not hasattr(store, name):
        setattr(store, name, make())
    return getattr(store, name)


def tokenizer_file(name: str) -> str:
    """A path as it is, or a file of the installed public vocabularies."""
    if os.path.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[int, str]:
    """The letters that stand for bytes in byte-level vocabularies: printable
    characters for themselves, the rest counted on from 256."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(hidden)}


def plain_letters(part: str) -> bool:
    """Letters of the Western alphabets alone (up to U+00FF), none composed."""
    return part.isalpha() and (part.isascii() or max(part) <= "\xff")


class ChunkEncoder:
    """Ids of texts as numbers of ``id_type``.

    Arrow finds the distinct chunks of a batch and cuts closing marks off those of
    letters, since the tokenizer never merges letters with marks (unless the last
    letter becomes more than letters in lower case, U+0130). Only distinct parts
    are seen one by one; those in use stay in the younger of two generations.
    NumPy lays the ids end to end.
    Western letters count in lower case, as they do for the tokenizer; a run of
    them is one pre-token that nothing else changes, so it goes to the merges at
    once."""

    def __init__(self, tokenizer: str = TOKENIZER, id_type: str = ID_TYPE):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file(tokenizer))
        self.model = self.tokenizer.model
        self.bytes = byte_letters()
        self.code, self.id_type = {"<u2": "H", "<u4": "I"}[id_type], id_type
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    @staticmethod
    def parts(chunk: str) -> tuple[str, str]:
        core = chunk.rstrip(MARKS)
        if not core.isalpha() or not core[-1].lower().isalpha():
            return chunk, ""
        return core.lower() if plain_letters(core) else core, chunk[len(core) :]

    def _encode_parts(self, wanted: list[str]) -> list[bytes]:
        """Ids of distinct parts."""
        if len(self.young) + len(wanted) > PARTS_KEPT:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        tokenize, code = self.model.tokenize, self.code
        out, missing, swap = [], [], sys.byteorder == "big"
        for part in wanted:
            ids = young.get(part)
            if ids is None:
                ids = old.get(part)
                if ids is None:
                    if not plain_letters(part):
                        missing.append(len(out))
                        out.append(part)
                        continue
                    seen = part if part.isascii() else part.encode().decode("latin-1").translate(self.bytes)
                    packed = array.array(code, [t.id for t in tokenize(seen)])
                    if swap:
                        packed.byteswap()
                    ids = packed.tobytes()
                if len(part) <= LONGEST_KEPT:
                    young[part] = ids
            out.append(ids)
        for low in range(0, len(missing), 4096):
            some = missing[low : low + 4096]
            texts = [out[at] for at in some]
            for at, part, e in zip(some, texts, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
                out[at] = np.array(e.ids, self.id_type).tobytes()
                if len(part) <= LONGEST_KEPT:
                    young[part] = out[at]
        return out

    def _cores_and_marks(self, chunks: pa.Array) -> tuple[pa.Array, pa.Array]:
        """Chunks without the marks that close them, and the marks."""
        simple = pc.match_substring_regex(chunks, f"^[a-z]+[{MARKS}]*$")
        cores = pc.if_else(simple, pc.ascii_rtrim(chunks, MARKS), chunks)
        marks = pc.if_else(simple, pc.replace_substring_regex(chunks, "^[a-z]+", ""), "")
        hard = pc.invert(simple)
        both = [self.parts(c) for c in chunks.filter(hard).to_pylist()]
        return (
            pc.replace_with_mask(cores, hard, pa.array([c for c, _ in both], pa.string())),
            pc.replace_with_mask(marks, hard, pa.array([m for _, m in both], pa.string())),
        )

    def _gathered(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct parts end to end; start and length for each part."""
        found = parts.dictionary_encode()
        index = found.indices.to_numpy(zero_copy_only=False)
        names = found.dictionary.to_pylist()
        ids = self._encode_parts(names)
        flat = np.frombuffer(b"".join(ids), self.id_type)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // flat.itemsize
        return flat, (np.cumsum(sizes) - sizes)[index], sizes[index]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts (no nulls) end to end, and where each text's begin, with
        the end. Plain capitals count as small letters to the tokenizer."""
        lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        offsets = lists.offsets.to_numpy().astype(np.int64)
        found = lists.flatten().dictionary_encode()
        index = found.indices.to_numpy(zero_copy_only=False)
        cores, marks = self._cores_and_marks(found.dictionary)
        a, a_starts, a_sizes = self._gathered(cores)
        b, b_starts, b_sizes = self._gathered(marks)
        # of each distinct chunk the core's ids, then those of its marks
        starts = np.column_stack([a_starts, b_starts + len(a)]).reshape(-1)
        sizes = np.column_stack([a_sizes, b_sizes]).reshape(-1)
        flat = np.concatenate([a, b])[spread(starts, sizes)]
        sizes = a_sizes + b_sizes
        starts = np.cumsum(sizes) - sizes
        total = np.concatenate([[0], np.cumsum(sizes[index])])
        return flat[spread(starts[index], sizes[index])], total[offsets - offsets[0]]


def chunk_encoder(tokenizer: str, id_type: str) -> ChunkEncoder:
    return kept_by_worker(f"chunks:{tokenizer}:{id_type}", lambda: ChunkEncoder(tokenizer, id_type))
