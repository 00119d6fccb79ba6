"""Texts as indices into the distinct blank-separated chunks of a batch.

Arrow cuts and counts the chunks of a whole batch; tokenizers then see each
distinct chunk once, and NumPy puts the texts together again from slices.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from placeweave.functions.shipping import ship_by_value

ship_by_value(__name__)

# What some tokenizer may merge with a blank: white space of any kind, the
# controls that some engines count to it, and the mark that stands for a blank.
NEAR_BLANK = "\\x00-\\x20\\x7f-\\xa0\\u1680\\u180e\\u2000-\\u200f\\u2028-\\u202f\\u205f-\\u2064\\u2581\\u3000\\ufeff"
_FAST = NEAR_BLANK.replace("\\u", "\\x").replace("\\x", "\\x{")
_FAST = re.sub(r"\\x\{([0-9a-f]{4}|[0-9a-f]{2})", r"\\x{\1}", _FAST)
LOOSE_BLANK = f"^ | $|[{_FAST}] | [{_FAST}]"
LONE_BLANK = re.compile(f"(?<=[^{NEAR_BLANK}]) (?=[^{NEAR_BLANK}])")


def slices(batch: pa.RecordBatch, column: str, most: int):
    """Parts of a batch with at most ``most`` bytes in ``column``, or one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    low, held = 0, 0
    for row, size in enumerate(sizes):
        if row > low and held + size > most:
            yield batch.slice(low, row - low)
            low, held = row, 0
        held += int(size)
    if low < batch.num_rows:
        yield batch.slice(low)


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of slices laid end to end."""
    if not len(lengths):
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


def coded(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Offsets of the lists, index of each item, distinct items."""
    offsets = lists.offsets.to_numpy().astype(np.int64)
    found = lists.flatten().dictionary_encode()
    return offsets - offsets[0], found.indices.to_numpy(zero_copy_only=False), found.dictionary.to_pylist()


def lone_blank_chunks(texts: pa.Array) -> tuple[np.ndarray, pa.ListArray]:
    """Texts (no nulls) cut at blanks with plain characters on both sides: the
    order in which the texts come back, and their chunks in that order."""
    loose = pc.match_substring_regex(texts, LOOSE_BLANK).to_numpy(zero_copy_only=False)
    order = np.argsort(loose, kind="stable")
    n_plain = int(len(texts) - loose.sum())
    plain = pc.split_pattern(texts.take(pa.array(order[:n_plain])), " ")
    rest = [LONE_BLANK.split(t) for t in texts.take(pa.array(order[n_plain:])).to_pylist()]
    if not rest:
        return order, plain
    return order, pa.concat_arrays([plain, pa.array(rest, plain.type)])
