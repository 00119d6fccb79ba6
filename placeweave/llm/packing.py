"""Hierarchical multi-length packing of documents into training windows.

Every document is tokenised, ended with ``END_ID`` and cut into full windows of
2048 tokens; the rest of it goes to the tier of the smallest window length that
holds it (256, 512, 1024, 2048). Each tier is packed from the longest down: a
document opens a window, the gap is filled with the longest documents of
shorter tiers that fit, and what is still open is closed with the head of one
short document, whose tail goes back to its tier. What cannot fill a window of
a tier goes to windows of the next shorter one, and the last few tokens to
windows of smaller powers of two. So every window is full and none is padded.

Documents meet in groups of about a mebibyte of text, dealt by a hash of id and
text, so a group is bounded and no source makes a large one; only the rests of
documents are shuffled, as two bytes per id, not the texts. Inside a group the
windows are dealt to steps of about equal numbers of tokens.

Defined cases: null text is empty and gives the end id alone; repeated rows are
packed each for itself; a null id is an id; an empty table gives an empty
table; a document of any length is cut before it meets others.
"""

from __future__ import annotations

import bisect
import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placeweave.functions.shipping import ship_by_value
from placeweave.llm.chunks import slices
from placeweave.llm.tokenizing import END_ID, ID_TYPE, TOKENIZER, chunk_encoder

ship_by_value(__name__)

WINDOW = 2048
TIERS = (2048, 1024, 512, 256)
GROUP_BYTES = 1 << 20
STEP_TOKENS = 32 * WINDOW
BYTES_AT_ONCE = 8 << 20


def piece_crc(ids: np.ndarray) -> int:
    """CRC-32 of ids as unsigned little-endian 32-bit numbers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


def _tokenise(tokenizer: str, id_type: str):
    def run(batches):
        encoder = chunk_encoder(tokenizer, id_type)
        end = np.array([END_ID], id_type)
        for batch in batches:
            for part in slices(batch, "text", BYTES_AT_ONCE):
                rows, starts, lengths, crcs, rests, totals = [], [], [], [], [], []
                flat, at = encoder.encode(part.column("text"))
                for row in range(part.num_rows):
                    ids = np.append(flat[at[row] : at[row + 1]], end)
                    cut = len(ids) - len(ids) % WINDOW
                    for start in range(0, cut, WINDOW):
                        rows.append(row)
                        starts.append(start)
                        lengths.append(WINDOW)
                        crcs.append(piece_crc(ids[start : start + WINDOW]))
                        rests.append(None)
                        totals.append(len(ids))
                    if cut < len(ids):
                        rows.append(row)
                        starts.append(cut)
                        lengths.append(len(ids) - cut)
                        crcs.append(0)
                        rests.append(ids[cut:].tobytes())
                        totals.append(len(ids))
                take = pa.array(rows, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("bin").take(take),
                        part.column("doc_id").take(take),
                        pa.array(starts, pa.int64()),
                        pa.array(lengths, pa.int64()),
                        pa.array(crcs, pa.int64()),
                        pa.array(rests, pa.binary()),
                        pa.array(totals, pa.int64()),
                    ],
                    names=["bin", "doc_id", "start", "length", "ids_crc32", "ids", "doc_tokens"],
                )

    return run


def pack_windows(lengths: list[int]) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """Windows (tier, pieces) of documents shorter than a long window; a piece
    is (document, start in it, length)."""
    pool = sorted((n, i, 0) for i, n in enumerate(lengths))  # length, document, start
    windows = []

    def fill(capacity: int):
        """A full window from the pool, or None and the pool as it was."""
        taken, room = [], capacity
        while room and pool:
            at = bisect.bisect_right(pool, (room, len(lengths), 0)) - 1
            if at >= 0:
                n, doc, start = pool.pop(at)
                taken.append((doc, start, n))
                room -= n
            else:
                # everything left is longer than the gap: cut the shortest
                n, doc, start = pool.pop(0)
                taken.append((doc, start, room))
                bisect.insort(pool, (n - room, doc, start + room))
                room = 0
        if room:
            for doc, start, n in taken:
                bisect.insort(pool, (n, doc, start))
            return None
        return taken

    for tier, shorter in zip(TIERS, (*TIERS[1:], 0)):
        # windows that a document of this tier opens
        while pool and pool[-1][0] > shorter:
            window = fill(tier)
            if window is None:
                break
            windows.append((tier, window))
    # what is left, in windows of smaller powers of two
    left = sum(n for n, _, _ in pool)
    while left:
        size = 1 << (min(left, WINDOW).bit_length() - 1)
        windows.append((size, fill(size)))
        left -= size
    return windows


def steps_of(sizes: list[int]) -> list[int]:
    """Step of each window: the longest first, to the step with least tokens."""
    loads = [(0, step) for step in range(max(1, -(-sum(sizes) // STEP_TOKENS)))]
    steps = [0] * len(sizes)
    for at in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        load, step = heapq.heappop(loads)
        steps[at] = step
        heapq.heappush(loads, (load + sizes[at], step))
    return steps


def _pack(id_type: str):
    def run(table: pa.Table) -> pa.Table:
        rests = table.column("ids").to_pylist()
        order = table.column("order").to_pylist()
        starts, lengths = table.column("start").to_pylist(), table.column("length").to_pylist()
        crcs = table.column("ids_crc32").to_pylist()
        group = table.column("bin")[0].as_py()
        # the same order in every run, however the rows came
        rows = sorted(range(len(rests)), key=lambda r: (order[r], starts[r], rests[r] or b""))
        open_rows = [r for r in rows if rests[r] is not None]
        windows = [(WINDOW, [(r, 0, WINDOW)]) for r in rows if rests[r] is None]
        windows += [
            (size, [(open_rows[doc], start, n) for doc, start, n in pieces])
            for size, pieces in pack_windows([lengths[r] for r in open_rows])
        ]
        steps = steps_of([size for size, _ in windows])
        out = {k: [] for k in ("row", "start", "length", "crc", "sequence", "offset", "tier", "step")}
        for number, (size, pieces) in enumerate(windows):
            offset = 0
            for row, start, n in pieces:
                whole = rests[row] is None
                ids = None if whole else np.frombuffer(rests[row], id_type)[start : start + n]
                out["row"].append(row)
                out["start"].append(starts[row] + start)
                out["length"].append(n)
                out["crc"].append(crcs[row] if whole else piece_crc(ids))
                out["sequence"].append((group << 24) + number)
                out["offset"].append(offset)
                out["tier"].append(size)
                out["step"].append((group << 24) + steps[number])
                offset += n
        take = pa.array(out["row"], pa.int32())
        return pa.table(
            {
                "doc_id": table.column("doc_id").take(take),
                **{
                    name: pa.array(out[key], pa.int64())
                    for name, key in (
                        ("start", "start"),
                        ("length", "length"),
                        ("ids_crc32", "crc"),
                    )
                },
                "doc_tokens": table.column("doc_tokens").take(take),
                **{
                    name: pa.array(out[key], pa.int64())
                    for name, key in (
                        ("sequence_id", "sequence"),
                        ("offset", "offset"),
                        ("tier", "tier"),
                        ("step_group", "step"),
                    )
                },
            }
        )

    return run


def pack(docs: DataFrame, tokenizer: str = TOKENIZER, id_type: str = ID_TYPE) -> DataFrame:
    """Pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    tier (tokens of the window), step_group."""
    text = F.coalesce(F.col("text"), F.lit(""))
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    groups = max(1, -(-total // GROUP_BYTES))
    key = F.pmod(F.xxhash64(F.col("doc_id"), text), F.lit(groups)).cast("long")
    docs = docs.select(key.alias("bin"), "doc_id", text.alias("text"))
    id_field = docs.schema["doc_id"]
    long = lambda name: T.StructField(name, T.LongType())
    tokens = docs.mapInArrow(
        _tokenise(tokenizer, id_type),
        T.StructType(
            [
                long("bin"),
                id_field,
                long("start"),
                long("length"),
                long("ids_crc32"),
                T.StructField("ids", T.BinaryType()),
                long("doc_tokens"),
            ]
        ),
    ).withColumn("order", F.xxhash64("doc_id", "doc_tokens"))
    names = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step_group")
    return tokens.groupBy("bin").applyInArrow(
        _pack(id_type), T.StructType([id_field, *map(long, names)])
    )
