"""Alignment of two tokenizers' tokens by sparse incidence products.

Both encodings of a text cover the same bytes. A (tokens x bytes) and B
likewise are incidence matrices in CSR, built here; Gustavson's row product
A.B' gives the overlap links: pairs of tokens with the number of bytes they
share. The last byte of a token is its end; where a pair of an overlap link ends
together, a group ends, and the product of the two (tokens x groups) incidences
gives the shared-group links.

For the corpus, documents are taken in blocks of a bounded number of bytes. A
block keeps the ids of its links once each, with its links as positions in that
list; ids are counted over all blocks and come back to each block as one value
per id pair, so what is shuffled are a block's distinct pairs, not its links.

Chunks between lone blanks are encoded once per batch: neither vocabulary has a
token that crosses a blank inside (checked when it is loaded).

Defined cases: texts that are null or empty, or whose tokens' bytes differ from
blank + text, have no tokens and give zeros and an empty digest; rows with equal
ids or texts count each for itself; a null id is an id; an empty table gives an
empty table; the links of a group of any size are counted from its two
incidences, and listed in bounded batches only by ``token_links``.
"""

from __future__ import annotations

import base64
import hashlib
import json
import os
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placeweave.functions.shipping import ship_by_value
from placeweave.llm.chunks import coded, lone_blank_chunks, slices, spread
from placeweave.llm.tokenizing import byte_letters, kept_by_worker, tokenizer_file
from placeweave.session import settle

ship_by_value(__name__)

BYTE_TOKENIZER = "byte_bpe_50k.json"
PIECE_MODEL = "piece_bpe_32k.model"
SLICE_BYTES = 1 << 21  # of one product
BLOCK_BYTES = 1 << 24  # that share a list of id pairs
CHUNKS_KEPT = 300_000
LONGEST_KEPT = 64
LINKS_AT_ONCE = 1 << 18
SHIFT = 32  # an id pair is a << SHIFT | b


class Csr:
    """Rows of column numbers, with a value each; columns ascend in a row."""

    def __init__(self, starts: np.ndarray, columns: np.ndarray, n_columns: int, values: np.ndarray | None = None):
        self.starts, self.columns, self.n_columns, self.values = starts, columns, n_columns, values

    @property
    def n_rows(self) -> int:
        return len(self.starts) - 1

    def row_of_each(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_rows), np.diff(self.starts))

    def transposed(self) -> Csr:
        """Rows and columns exchanged (of a matrix of ones)."""
        by_column = np.argsort(self.columns, kind="stable")
        starts = np.zeros(self.n_columns + 1, np.int64)
        np.cumsum(np.bincount(self.columns, minlength=self.n_columns), out=starts[1:])
        return Csr(starts, self.row_of_each()[by_column], self.n_rows)

    def rows(self, low: int, high: int) -> Csr:
        start, stop = self.starts[low], self.starts[high]
        return Csr(self.starts[low : high + 1] - start, self.columns[start:stop], self.n_columns)

    def work(self, other: Csr) -> np.ndarray:
        """Scalar products that each row of ``self @ other`` takes."""
        sizes = np.diff(other.starts)[self.columns]
        total = np.concatenate([[0], np.cumsum(sizes)])
        return total[self.starts[1:]] - total[self.starts[:-1]]

    def __matmul__(self, other: Csr) -> Csr:
        """Gustavson: row i is the sum of the other's rows that i names."""
        sizes = np.diff(other.starts)[self.columns]
        rows = np.repeat(self.row_of_each(), sizes)
        columns = other.columns[spread(other.starts[self.columns], sizes)]
        cells = rows * other.n_columns + columns
        if len(cells) and np.any(cells[1:] < cells[:-1]):
            cells.sort()
        first = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]])) if len(cells) else cells
        cells_left = cells[first]
        starts = np.searchsorted(cells_left, np.arange(self.n_rows + 1) * other.n_columns)
        return Csr(
            starts,
            cells_left % max(1, other.n_columns),
            other.n_columns,
            np.diff(np.append(first, len(cells))),
        )


def incidence(sizes: np.ndarray) -> Csr:
    """Rows that cover the columns one after another, ``sizes`` of them each."""
    starts = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    return Csr(starts, np.arange(starts[-1]), int(starts[-1]))


class Encoders:
    """Ids of both tokenizers by chunk, and the bytes that ids stand for."""

    def __init__(self, byte_tokenizer: str, piece_model: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        path = tokenizer_file(byte_tokenizer)
        self.exact = Tokenizer.from_file(path)
        self.exact.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        letter = {c: b for b, c in byte_letters().items()}
        size = max(vocabulary.values()) + 1
        self.a_bytes = [b""] * size
        special = {t.content for t in self.exact.get_added_tokens_decoder().values()}
        for token, number in vocabulary.items():
            if token not in special:
                self.a_bytes[number] = bytes(letter[c] for c in token)
        self.quick = None
        ranks_file = path.removesuffix(".json") + ".tiktoken"
        if os.path.exists(ranks_file):
            # the same vocabulary as ranks; its word pattern agrees on ASCII
            import public_tokenizers

            with open(ranks_file, "rb") as file:
                ranks = {base64.b64decode(t): int(n) for t, n in map(bytes.split, file)}
            self.quick = tiktoken.Encoding(
                "bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
            )
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file(piece_model))
        self.b_bytes = []
        for number in range(self.pieces.get_piece_size()):
            piece = self.pieces.id_to_piece(number)
            if self.pieces.is_byte(number):
                self.b_bytes.append(bytes([int(piece[3:5], 16)]))
            elif self.pieces.is_control(number) or self.pieces.is_unknown(number):
                self.b_bytes.append(b"")
            else:
                self.b_bytes.append(piece.replace("\u2581", " ").encode())
        crossing = [t for t in self.b_bytes if b" " in t.lstrip(b" ")]
        if crossing:
            raise ValueError(f"pieces cross a blank: {crossing[:3]}")
        self.a_sizes = np.array([len(t) for t in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(t) for t in self.b_bytes], np.int64)
        self.kept: dict[str, tuple[bytes, bytes]] = {}

    def _a_ids(self, chunks: list[str]) -> list[list[int]]:
        """Ids of blank + chunk."""
        out = [self.quick.encode_ordinary(" " + c) if self.quick and c.isascii() else None for c in chunks]
        hard = [at for at, ids in enumerate(out) if ids is None]
        for low in range(0, len(hard), 4096):
            some = hard[low : low + 4096]
            texts = [" " + chunks[at] for at in some]
            for at, e in zip(some, self.exact.encode_batch_fast(texts, add_special_tokens=False)):
                out[at] = e.ids
        return out

    def ids(self, chunks: list[str]) -> tuple[list[bytes], list[bytes]]:
        """Both encodings of each chunk as 32-bit ids; of a chunk whose bytes
        aren't those of blank + chunk the second is None."""
        known = self.kept
        fresh = [c for c in chunks if c not in known]
        found = {}
        for chunk, a, b in zip(fresh, self._a_ids(fresh), self.pieces.encode(fresh, num_threads=1)):
            whole = (" " + chunk).encode()
            right = (
                b"".join([self.b_bytes[i] for i in b]) == whole
                and b"".join([self.a_bytes[i] for i in a]) == whole
            )
            found[chunk] = (
                np.array(a, np.int32).tobytes(),
                np.array(b, np.int32).tobytes() if right else None,
            )
        pairs = [known[c] if c in known else found[c] for c in chunks]
        if len(known) + len(found) > CHUNKS_KEPT:
            known.clear()
        known.update((c, v) for c, v in found.items() if len(c) <= LONGEST_KEPT)
        return [a for a, _ in pairs], [b for _, b in pairs]


def encoders(byte_tokenizer: str, piece_model: str) -> Encoders:
    name = f"align:{byte_tokenizer}:{piece_model}"
    return kept_by_worker(name, lambda: Encoders(byte_tokenizer, piece_model))


def _gather(parts: list[bytes], index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the chunks of ``index`` end to end, and how many each has."""
    flat = np.frombuffer(b"".join(parts), np.int32)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
    starts = np.cumsum(sizes) - sizes
    lengths = sizes[index]
    return flat[spread(starts[index], lengths)], lengths


@dataclass
class Aligned:
    """Tokens of some documents, one after another, and their links."""

    rows: np.ndarray  # row of each document in the batch
    a_ids: np.ndarray
    b_ids: np.ndarray
    a_starts: np.ndarray  # of each document's tokens, and the end
    b_starts: np.ndarray
    overlap: Csr  # A tokens x B tokens: bytes in common
    ends: np.ndarray  # links of ``overlap`` whose tokens end together
    a_group: np.ndarray  # group of each A token
    b_group: np.ndarray

    @property
    def n_groups(self) -> int:
        return len(self.ends)


def _run_starts(counts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(counts)])
    return total[offsets]


def align(part: pa.RecordBatch, coder: Encoders) -> Aligned:
    """Tokens and links of the rows of ``part`` (text) that have tokens."""
    texts = part.column("text")
    used = np.flatnonzero(pc.greater(pc.fill_null(pc.binary_length(texts), 0), 0).to_numpy(zero_copy_only=False))
    order, lists = lone_blank_chunks(texts.take(pa.array(used)))
    used = used[order]
    offsets, index, distinct = coded(lists)
    a_parts, b_parts = coder.ids(distinct)
    wrong = np.fromiter((b is None for b in b_parts), bool, len(b_parts))
    if wrong.any():
        # whole documents go, those with one such chunk
        bad = np.add.reduceat(wrong[index].astype(np.int64), offsets[:-1]) > 0
        sizes = np.diff(offsets)[~bad]
        index = index[spread(offsets[:-1][~bad], sizes)]
        used, offsets = used[~bad], np.concatenate([[0], np.cumsum(sizes)])
        b_parts = [b or b"" for b in b_parts]
    a_ids, a_counts = _gather(a_parts, index)
    b_ids, b_counts = _gather(b_parts, index)
    a_bytes, b_bytes = incidence(coder.a_sizes[a_ids]), incidence(coder.b_sizes[b_ids])
    overlap = a_bytes @ b_bytes.transposed()
    a_of, b_of = overlap.row_of_each(), overlap.columns
    ends = np.flatnonzero(a_bytes.starts[a_of + 1] == b_bytes.starts[b_of + 1])
    # a group reaches to the end it has in common
    a_group = np.searchsorted(a_of[ends], np.arange(len(a_ids)))
    b_group = np.searchsorted(b_of[ends], np.arange(len(b_ids)))
    return Aligned(
        used, a_ids, b_ids, _run_starts(a_counts, offsets), _run_starts(b_counts, offsets),
        overlap, ends, a_group, b_group,
    )


def group_incidence(groups: np.ndarray, n_groups: int) -> Csr:
    """Tokens x groups: one group each."""
    return Csr(np.arange(len(groups) + 1), groups, n_groups)


class Digits:
    """Ids as text, each with what follows it."""

    def __init__(self, size: int):
        numbers = [str(n) for n in range(size)]
        self.size = size
        self.table = [n + mark for mark in ",|;" for n in numbers] + numbers

    def text(self, ids: np.ndarray, mark: np.ndarray) -> str:
        return "".join(map(self.table.__getitem__, (ids + mark * self.size).tolist()))


def _group_digests(found: Aligned, coder: Encoders) -> list[str]:
    """Per document the digest of its groups, ``a,a|b;a|b,b``."""
    size = max(len(coder.a_bytes), len(coder.b_bytes))
    digits = kept_by_worker(f"digits:{size}", lambda: Digits(size))
    a_sizes = np.bincount(found.a_group, minlength=found.n_groups)
    b_sizes = np.bincount(found.b_group, minlength=found.n_groups)
    # both sides' tokens in one row, group by group, A first
    first = np.cumsum(a_sizes + b_sizes) - a_sizes - b_sizes
    a_first, b_first = np.cumsum(a_sizes) - a_sizes, np.cumsum(b_sizes) - b_sizes
    ids = np.empty(len(found.a_ids) + len(found.b_ids), np.int64)
    mark = np.zeros(len(ids), np.int64)
    ids[(first - a_first)[found.a_group] + np.arange(len(found.a_ids))] = found.a_ids
    ids[(first + a_sizes - b_first)[found.b_group] + np.arange(len(found.b_ids))] = found.b_ids
    mark[first + a_sizes - 1] = 1
    mark[first + a_sizes + b_sizes - 1] = 2
    starts = found.a_starts + found.b_starts
    mark[starts[1:] - 1] = 3
    return [
        hashlib.sha256(digits.text(ids[low:high], mark[low:high]).encode()).hexdigest()
        for low, high in zip(starts[:-1], starts[1:])
    ]


REPORT = ("n_a", "n_b", "n_groups", "n_links", "n_overlaps", "n_group_links")


def _block_row(block: str, parts: list, ids: pa.Array) -> pa.RecordBatch:
    """One row: columns of the documents, distinct pairs, packed links."""
    pairs = np.concatenate([p[0] for p in parts])
    distinct, place, counts = np.unique(pairs, return_inverse=True, return_counts=True)
    # frequent pairs get small numbers, which pack well
    rank = np.argsort(-counts, kind="stable")
    number = np.empty(len(rank), np.uint32)
    number[rank] = np.arange(len(rank))
    links = number[place.reshape(-1)].astype("<u4").tobytes()
    columns = {n: pa.array(np.concatenate([p[1][n] for p in parts]), pa.int64()) for n in REPORT}
    digests = pa.array([d for p in parts for d in p[2]], pa.string())
    lists = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
    return pa.RecordBatch.from_pydict(
        {
            "block": pa.array([block]),
            "ids": lists(ids),
            **{n: lists(c) for n, c in columns.items()},
            "groups_sha256": lists(digests),
            "pairs": lists(pa.array(distinct[rank], pa.int64())),
            "times": lists(pa.array(counts[rank], pa.int64())),
            "links": pa.array([pa.compress(links, codec="zstd", asbytes=True)], pa.binary()),
            "links_size": pa.array([len(links)], pa.int64()),
        }
    )


def _spans(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between neighbouring starts."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[starts[1:]] - total[starts[:-1]]


def _measured(part: pa.RecordBatch, coder: Encoders):
    """Pairs of the links, the numbers per row, the digests per row."""
    found = align(part, coder)
    a_of, b_of = found.overlap.row_of_each(), found.overlap.columns
    a_end, b_end = a_of[found.ends], b_of[found.ends]
    pairs = (found.a_ids[a_end].astype(np.int64) << SHIFT) | found.b_ids[b_end]
    link_starts = np.searchsorted(a_end, found.a_starts)
    shared = group_incidence(found.a_group, found.n_groups).work(
        group_incidence(found.b_group, found.n_groups).transposed()
    )
    per_document = {
        "n_a": np.diff(found.a_starts),
        "n_b": np.diff(found.b_starts),
        "n_groups": np.diff(link_starts),
        "n_links": np.diff(link_starts),
        "n_overlaps": np.diff(found.overlap.starts[found.a_starts]),
        "n_group_links": _spans(shared, found.a_starts),
    }
    # back to the order of the rows, the links with them
    at = np.argsort(found.rows, kind="stable")
    sizes = np.diff(link_starts)[at]
    pairs = pairs[spread(link_starts[:-1][at], sizes)]
    numbers = {}
    for name, values in per_document.items():
        numbers[name] = np.zeros(part.num_rows, np.int64)
        numbers[name][found.rows] = values
    digests = [""] * part.num_rows
    for row, digest in zip(found.rows, _group_digests(found, coder)):
        digests[row] = digest
    return pairs, numbers, digests


def _blocks(byte_tokenizer: str, piece_model: str, block_bytes: int):
    def run(batches):
        coder = encoders(byte_tokenizer, piece_model)
        parts, ids, held = [], [], 0
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                parts.append(_measured(part, coder))
                ids.append(part.column("doc_id"))
                held += part.column("text").nbytes
                if held >= block_bytes:
                    yield _block_row(uuid.uuid4().hex, parts, pa.concat_arrays(ids))
                    parts, ids, held = [], [], 0
        if parts:
            yield _block_row(uuid.uuid4().hex, parts, pa.concat_arrays(ids))

    return run


def _scored(block: pa.Table, values: pa.Table) -> pa.Table:
    """A block's documents with the counts of their links' pairs."""
    row = {name: block.column(name)[0] for name in block.column_names}
    size = row["links_size"].as_py()
    links = np.frombuffer(pa.decompress(row["links"].as_buffer(), size, codec="zstd"), "<u4") if size else []
    at = values.column("at").to_numpy()
    count = np.zeros(len(at), np.int64)
    best = np.zeros(len(at), np.int64)
    count[at] = values.column("count").to_numpy()
    best[at] = values.column("best").to_numpy()
    links = np.asarray(links, np.int64)
    starts = np.concatenate([[0], np.cumsum(row["n_links"].values.to_numpy())])
    out = {"doc_id": row["ids"].values}
    out |= {n: row[n].values for n in REPORT[:4]}
    out["n_best"] = pa.array(_spans(best[links], starts))
    out["count_sum"] = pa.array(_spans(count[links], starts))
    out["groups_sha256"] = row["groups_sha256"].values
    return pa.table(out | {n: row[n].values for n in REPORT[4:]})


def align_report(
    docs: DataFrame,
    byte_tokenizer: str = BYTE_TOKENIZER,
    piece_model: str = PIECE_MODEL,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per row: doc_id, n_a, n_b (tokens), n_groups, n_links (pairs that end
    together), n_best, count_sum, groups_sha256, n_overlaps, n_group_links."""
    id_type = docs.schema["doc_id"].dataType
    long = T.LongType()
    stored = T.StructType(
        [
            T.StructField("block", T.StringType()),
            T.StructField("ids", T.ArrayType(id_type)),
            *(T.StructField(n, T.ArrayType(long)) for n in REPORT),
            T.StructField("groups_sha256", T.ArrayType(T.StringType())),
            T.StructField("pairs", T.ArrayType(long)),
            T.StructField("times", T.ArrayType(long)),
            T.StructField("links", T.BinaryType()),
            T.StructField("links_size", long),
        ]
    )
    rows = docs.select("doc_id", "text").mapInArrow(_blocks(byte_tokenizer, piece_model, block_bytes), stored)
    blocks = settle(rows, "blocks")
    # places in a block, one per distinct pair
    listed = blocks.select("block", F.posexplode(F.arrays_zip("pairs", "times")).alias("at", "z")).select(
        "block", "at", F.col("z.pairs").alias("pair"), F.col("z.times").alias("times")
    )
    counts = settle(listed.groupBy("pair").agg(F.sum("times").alias("count")), "pairs")
    b_id = F.col("pair").bitwiseAND((1 << SHIFT) - 1)
    highest = counts.groupBy(b_id.alias("b_id")).agg(F.max("count").alias("highest"))
    judged = counts.withColumn("b_id", b_id).join(highest, "b_id").select(
        "pair", "count", (F.col("count") == F.col("highest")).cast("long").alias("best")
    )
    values = listed.drop("times").join(judged, "pair").select("block", "at", "count", "best")
    result = T.StructType(
        [
            T.StructField("doc_id", id_type),
            *(T.StructField(n, long) for n in (*REPORT[:4], "n_best", "count_sum")),
            T.StructField("groups_sha256", T.StringType()),
            *(T.StructField(n, long) for n in REPORT[4:]),
        ]
    )
    kept = blocks.drop("pairs", "times").withColumnRenamed("block", "home")
    return kept.groupBy("home").cogroup(values.groupBy("block")).applyInArrow(_scored, result)


def _listed(byte_tokenizer: str, piece_model: str, kind: str, names: list[str]):
    def run(batches):
        coder = encoders(byte_tokenizer, piece_model)
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                found = align(part, coder)
                left, right = group_incidence(found.a_group, found.n_groups), None
                if kind == "group":
                    right = group_incidence(found.b_group, found.n_groups).transposed()
                    work = np.cumsum(left.work(right))
                else:
                    work = np.cumsum(np.diff(found.overlap.starts))
                low = 0
                while low < len(found.a_ids):
                    # rows of A with a bounded number of links, or one row
                    done = work[low - 1] if low else 0
                    high = max(low + 1, int(np.searchsorted(work, done + LINKS_AT_ONCE, "right")))
                    if kind == "group":
                        links = left.rows(low, high) @ right
                    else:
                        links = found.overlap.rows(low, high)
                        links.values = found.overlap.values[found.overlap.starts[low] : found.overlap.starts[high]]
                    a, b = links.row_of_each() + low, links.columns
                    doc = np.searchsorted(found.a_starts, a, "right") - 1
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column("doc_id").take(pa.array(found.rows[doc])),
                            pa.array(a - found.a_starts[doc]),
                            pa.array(b - found.b_starts[doc]),
                            pa.array(found.a_ids[a], pa.int64()),
                            pa.array(found.b_ids[b], pa.int64()),
                            pa.array(links.values.astype(np.int64)),
                        ],
                        names=names,
                    )
                    low = high

    return run


def token_links(
    docs: DataFrame,
    kind: str = "overlap",
    byte_tokenizer: str = BYTE_TOKENIZER,
    piece_model: str = PIECE_MODEL,
) -> DataFrame:
    """One row per link: doc_id, a_at, b_at (places of the tokens, from 0), a_id,
    b_id and shared: bytes in common (``overlap``) or groups in common, which is
    1 (``group``)."""
    if kind not in ("overlap", "group"):
        raise ValueError(f"unknown kind of link: {kind}")
    names = ["doc_id", "a_at", "b_at", "a_id", "b_id", "shared"]
    fields = [docs.schema["doc_id"], *(T.StructField(n, T.LongType()) for n in names[1:])]
    return docs.select("doc_id", "text").mapInArrow(
        _listed(byte_tokenizer, piece_model, kind, names), T.StructType(fields)
    )
