"""Repeated passages by prefix-partitioned sparse suffix trees over words.

A window is ``LENGTH`` consecutive words. Every window has an anchor: its first
smallest ``PREFIX``-word sequence by hash, so equal windows have equal anchors
at equal places. Only suffixes that start at anchors (about one in seven) enter
the trees, each with the few words on its left that its windows need.

1. Prefixes. Anchored suffixes are counted by their first ``PREFIX`` words; a
   suffix whose prefix occurs once has no internal node above it and goes.
2. Groups. Prefixes are dealt into groups of a bounded number of suffixes. One
   that exceeds a group is prolonged to the whole of each window: at that
   depth a node is a class of equal windows, whose first member is a minimum,
   taken with partial aggregation, so no task gets a hot prefix as a whole.
3. Trees. A group sorts its suffixes; neighbours' common prefixes give the
   internal nodes. Below a node of depth ``LENGTH - o`` lie the suffixes that
   agree to the end of a window starting ``o`` words before the anchor; split
   by those ``o`` words, they are the window's occurrences. All but the first
   are repeats, and neighbouring ones together are the maximal repeats.

Whole copies of a text are settled beforehand by its digest: in all but the
first every window is a repeat. Words are compared by 64-bit hashes, in whole
windows (1,280 bits).

Defined cases: null and empty texts have no words; texts shorter than a window
are left alone; documents are ordered by ``doc_id`` (an integer), null last,
then by a hash of the text; equal rows are one document and get equal results;
windows don't cross documents; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placeweave.functions.shipping import ship_by_value
from placeweave.llm.chunks import slices, spread
from placeweave.session import discard, settle

ship_by_value(__name__)

LENGTH = 20
PREFIX = 8
GROUP_SUFFIXES = 50_000
SLICE_BYTES = 1 << 22
FACTOR = np.uint64(0x9E3779B97F4A7C15)
LAST_ID = (1 << 63) - 1  # a null id comes last


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, text after text, and each text's start (and end)."""
    lists = pc.ascii_split_whitespace(texts)
    found = lists.flatten().dictionary_encode()
    words = found.dictionary.to_pylist()
    hashes = np.fromiter((xxhash.xxh64_intdigest(w.encode()) for w in words), np.uint64, len(words))
    index = found.indices.to_numpy(zero_copy_only=False)
    real = np.fromiter(map(bool, words), bool, len(words))[index]
    offsets = lists.offsets.to_numpy().astype(np.int64)
    offsets -= offsets[0]
    starts = np.concatenate([[0], np.cumsum(real)])[offsets]
    return hashes[index[real]], starts


def anchors(words: np.ndarray, starts: np.ndarray, length: int, prefix: int):
    """Anchors of all windows: places among ``words``, prefix hashes, and the
    least and greatest distance of a window's start before its anchor."""
    windows = np.maximum(np.diff(starts) - length + 1, 0)
    first = spread(starts[:-1], windows)
    if not len(first):
        none = np.zeros(0, np.int64)
        return none, none, none, none
    grams = np.zeros(len(words) - prefix + 1, np.uint64)
    for j in range(prefix):
        grams = grams * FACTOR + words[j : len(words) - prefix + 1 + j]
    grams ^= grams >> np.uint64(29)
    least = grams[first]
    shift = np.zeros(len(first), np.int64)
    for o in range(1, length - prefix + 1):
        other = grams[first + o]
        lower = other < least
        least[lower] = other[lower]
        shift[lower] = o
    at = first + shift
    new = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    last = np.append(new[1:], len(at)) - 1
    return at[new], grams[at[new]].view(np.int64), shift[last], shift[new]


def _lists(values: np.ndarray, starts: np.ndarray, kind) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(values, kind))


def _anchored(length: int, prefix: int):
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                words, starts = word_hashes(part.column("text"))
                at, hashes, low, high = anchors(words, starts, length, prefix)
                text = np.searchsorted(starts, at, "right") - 1
                bounds = np.searchsorted(at, starts)
                packed = ((at - starts[text]) << 16) | (high << 8) | low
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(n) for n in ("id", "key", "digest")),
                        _lists(hashes, bounds, pa.int64()),
                        _lists(packed, bounds, pa.int64()),
                    ],
                    names=["id", "key", "digest", "prefixes", "places"],
                )

    return run


def _recorded(length: int):
    """A record per anchor that is left: its words and those of its windows."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                words, starts = word_hashes(part.column("text"))
                places = part.column("places")
                counts = np.diff(places.offsets.to_numpy())
                row = np.repeat(np.arange(part.num_rows), counts)
                packed, prefix, hot = places.flatten().flatten()
                packed = packed.to_numpy()
                at, high, low = packed >> 16, (packed >> 8) & 255, packed & 255
                sizes = length + high - low
                flat = words[spread(starts[row] + at - high, sizes)]
                ends = np.concatenate([[0], np.cumsum(sizes * 8)]).astype(np.int32)
                content = pa.BinaryArray.from_buffers(
                    pa.binary(), len(at), [None, pa.py_buffer(ends), pa.py_buffer(flat.tobytes())]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc").take(pa.array(row)),
                        pa.array(packed),
                        prefix,
                        hot,
                        content,
                    ],
                    names=["doc", "place", "prefix", "hot", "words"],
                )

    return run


def _named_windows(length: int):
    """The windows of records, each by a digest of its words."""

    def run(batches):
        for batch in batches:
            docs, starts, names = [], [], []
            rows = zip(*(batch.column(n).to_pylist() for n in ("doc", "place", "words")))
            for doc, place, words in rows:
                at, high, low = place >> 16, (place >> 8) & 255, place & 255
                for n in range(high - low + 1):
                    docs.append(doc)
                    starts.append(at - high + n)
                    names.append(hashlib.blake2b(words[8 * n : 8 * (n + length)], digest_size=16).digest())
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), pa.array(starts, pa.int64()), pa.array(names, pa.binary())],
                names=["doc", "start", "name"],
            )

    return run


class SuffixTree:
    """Sorted suffixes of a group and the depths at which neighbours part."""

    def __init__(self, flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, length: int):
        """Suffix i: ``sizes[i]`` words of ``flat`` from ``starts[i]``."""
        column = np.arange(length)
        inside = column[None, :] < sizes[:, None]
        words = flat[np.minimum(starts[:, None] + column, len(flat) - 1)]
        words[~inside] = 0
        self.order = np.lexsort(words.T[::-1])
        words, sizes = words[self.order], sizes[self.order]
        equal = words[1:] == words[:-1]
        together = np.where(equal.all(1), length, equal.argmin(1))
        self.depth = np.minimum(together, np.minimum(sizes[1:], sizes[:-1]))

    def nodes(self, depth: int) -> np.ndarray:
        """For each suffix the node of at least ``depth`` that it lies below."""
        node = np.empty(len(self.order), np.int64)
        node[self.order] = np.concatenate([[0], np.cumsum(self.depth < depth)])
        return node


def _classes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Numbers of equal pairs."""
    _, right = np.unique(right, return_inverse=True)
    return np.unique(left * (right.max(initial=0) + 1) + right, return_inverse=True)[1]


def _repeats(length: int, prefix: int):
    def run(group: pa.Table) -> pa.Table:
        doc, place = group.column("doc").to_numpy(), group.column("place").to_numpy()
        at, high, low = place >> 16, (place >> 8) & 255, place & 255
        flat = np.frombuffer(b"".join(group.column("words").to_pylist()), np.uint64)
        sizes = length + high - low
        anchor = np.cumsum(sizes) - sizes + high
        tree = SuffixTree(flat, anchor, length - low, length)
        # one number per (document, place), in order
        by_place = np.lexsort((at, doc))
        new = np.concatenate([[0], (np.diff(doc[by_place]) != 0) | (np.diff(at[by_place]) != 0)])
        turn = np.empty(len(doc), np.int64)
        turn[by_place] = np.cumsum(new)
        repeated = np.zeros(len(doc), np.int64)
        left = np.zeros(len(doc), np.int64)
        for o in range(length - prefix + 1):
            if o:
                wide = np.flatnonzero(high >= o)
                left[wide] = _classes(left[wide], flat[anchor[wide] - o])
            rows = np.flatnonzero((low <= o) & (o <= high))
            if not len(rows):
                continue
            same = _classes(tree.nodes(length - o)[rows], left[rows])
            earliest = np.full(same.max() + 1, np.iinfo(np.int64).max)
            np.minimum.at(earliest, same, turn[rows])
            late = rows[turn[rows] > earliest[same]]
            repeated[late] |= 1 << o
        some = np.flatnonzero(repeated)
        return pa.table(
            {
                "doc": pa.array(doc[some]),
                "at": pa.array(at[some]),
                "before": pa.array(repeated[some]),
            }
        )

    return run


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumns(
        {
            "id": F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)),
            "key": F.xxhash64("text"),
        }
    )


def _verdicts(docs: DataFrame, length: int, prefix: int, group_suffixes: int) -> DataFrame:
    """(id, key, whole, starts) of documents with repeats: all of it, or the
    repeated windows as (place << 32 | distances before it). Settled."""
    texts = _keyed(docs.select("doc_id", "text")).filter("text is not null and text <> ''")
    found = texts.withColumn("digest", F.md5("text")).select("id", "key", "digest", "text").mapInArrow(
        _anchored(length, prefix),
        "id long, key long, digest string, prefixes array<long>, places array<long>",
    )
    found = settle(found.filter(F.size("places") > 0), "anchors")
    # of equal texts the first
    first = found.groupBy("digest").agg(F.min("id").alias("id"))
    single = found.join(first, ["digest", "id"]).dropDuplicates(["digest", "id"])
    # numbered in the order of documents
    single = single.orderBy("id", "key").withColumn("doc", F.monotonically_increasing_id())
    single = settle(single.drop("digest"), "suffixes")
    counted = single.select(F.explode("prefixes").alias("prefix")).groupBy("prefix").agg(
        F.count(F.lit(1)).alias("n")
    )
    counted = settle(counted.filter("n > 1"), "prefixes")
    total = counted.agg(F.sum("n")).first()[0] or 0
    groups = max(1, -(-total // group_suffixes))
    listed = single.select("doc", F.explode(F.arrays_zip("places", "prefixes")).alias("z")).select(
        "doc", F.col("z.places").alias("place"), F.col("z.prefixes").alias("prefix")
    )
    left = listed.join(counted, "prefix").groupBy("doc").agg(
        F.collect_list(F.struct("place", "prefix", (F.col("n") > group_suffixes).alias("hot"))).alias("places")
    )
    names = single.select("doc", "id", "key")
    wanted = left.join(names, "doc")
    records = texts.select("id", "key", "text").join(wanted, ["id", "key"]).select("doc", "text", "places")
    records = settle(
        records.mapInArrow(
            _recorded(length), "doc long, place long, prefix long, hot boolean, words binary"
        ),
        "records",
    )
    # trees of the groups
    grouped = records.filter("not hot").withColumn("group", F.pmod("prefix", F.lit(groups)))
    repeats = grouped.groupBy("group").applyInArrow(
        _repeats(length, prefix), "doc long, at long, before long"
    ).select("doc", F.shiftleft(F.col("at"), 32).bitwiseOR(F.col("before")).alias("start"))
    # prefixes over a group, prolonged to whole windows
    windows = records.filter("hot").mapInArrow(_named_windows(length), "doc long, start long, name binary")
    windows = settle(windows, "windows")
    earliest = windows.groupBy("name").agg(F.min(F.struct("doc", "start")).alias("earliest"))
    late = windows.join(earliest, "name").filter(F.struct("doc", "start") > F.col("earliest"))
    late = late.select("doc", F.shiftleft(F.col("start"), 32).bitwiseOR(F.lit(1)).alias("start"))
    starts = repeats.unionByName(late).groupBy("doc").agg(F.collect_set("start").alias("starts"))
    in_part = starts.join(names, "doc").select("id", "key", F.lit(False).alias("whole"), "starts")
    in_whole = found.select("digest", "id", "key").distinct().join(
        first.withColumnRenamed("id", "first_id"), "digest"
    )
    in_whole = in_whole.filter("id <> first_id").select(
        "id", "key", F.lit(True).alias("whole"), F.lit(None).cast("array<long>").alias("starts")
    )
    verdicts = settle(in_part.unionByName(in_whole), "verdicts")
    discard(found, single, counted, records, windows)
    return verdicts


def covered(n_words: int, starts: list[int], length: int) -> np.ndarray:
    """The words that repeated windows cover."""
    edges = np.zeros(n_words + 1, np.int64)
    packed = np.array(starts, np.int64)
    for o in range(length):
        at = (packed[(packed >> o) & 1 == 1] >> 32) - o
        np.add.at(edges, at, 1)
        np.add.at(edges, at + length, -1)
    return np.cumsum(edges[:-1]) > 0


def _judged(docs: DataFrame, length: int, prefix: int, group_suffixes: int) -> DataFrame:
    """The rows of ``docs`` with their verdict; all columns wait in ``row``."""
    verdicts = _verdicts(docs, length, prefix, group_suffixes)
    rows = _keyed(docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")))
    return rows.join(verdicts, ["id", "key"], "left").select("doc_id", "text", "whole", "starts", "row")


def _marked(batch: pa.RecordBatch, length: int):
    """Per row its words as bytes, and which of them go (None: none)."""
    wholes, starts = batch.column("whole").to_pylist(), batch.column("starts").to_pylist()
    for text, whole, some in zip(batch.column("text"), wholes, starts):
        words = (text.as_py() or "").encode().split()
        if whole:
            yield words, np.ones(len(words), bool)
        else:
            yield words, covered(len(words), some, length) if some else None


def _reported(length: int):
    def run(batches):
        for batch in batches:
            out = [], [], []
            for words, gone in _marked(batch, length):
                kept = words if gone is None else list(compress(words, ~gone))
                out[0].append(len(words))
                out[1].append(len(words) - len(kept))
                out[2].append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(out[0], pa.int64()),
                    pa.array(out[1], pa.int64()),
                    pa.array(out[2], pa.string()),
                ],
                names=["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    return run


def dedup_report(
    docs: DataFrame, length: int = LENGTH, prefix: int = PREFIX, group_suffixes: int = GROUP_SUFFIXES
) -> DataFrame:
    """Per row: doc_id, n_words, n_removed (covered by windows that also start
    earlier), kept_sha256 (of the rest, joined by one blank)."""
    judged = _judged(docs.select("doc_id", "text"), length, prefix, group_suffixes)
    fields = [
        docs.schema["doc_id"],
        T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("kept_sha256", T.StringType()),
    ]
    return judged.drop("row").mapInArrow(_reported(length), T.StructType(fields))


def _without(length: int):
    def run(batches):
        for batch in batches:
            texts = []
            for text, (words, gone) in zip(batch.column("text"), _marked(batch, length)):
                texts.append(text.as_py() if gone is None else b" ".join(compress(words, ~gone)).decode())
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()), batch.column("row")], names=["text", "row"]
            )

    return run


def without_repeats(
    docs: DataFrame, length: int = LENGTH, prefix: int = PREFIX, group_suffixes: int = GROUP_SUFFIXES
) -> DataFrame:
    """``docs`` with repeats taken out of ``text``; what is left of a touched
    text is joined by blanks, other texts stay as they are."""
    judged = _judged(docs, length, prefix, group_suffixes)
    fields = [T.StructField("text", T.StringType()), judged.schema["row"]]
    cleaned = judged.mapInArrow(_without(length), T.StructType(fields))
    return cleaned.select(*(F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns))


def _passages(length: int):
    def run(batches):
        for batch in batches:
            rows, starts, sizes, texts = [], [], [], []
            for row, (words, gone) in enumerate(_marked(batch, length)):
                if gone is None:
                    continue
                edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]])))
                for low, high in zip(edges[::2].tolist(), edges[1::2].tolist()):
                    rows.append(row)
                    starts.append(low)
                    sizes.append(high - low)
                    texts.append(b" ".join(words[low:high]).decode())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(rows, pa.int32())),
                    pa.array(starts, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(texts, pa.string()),
                ],
                names=["doc_id", "start", "n_words", "passage"],
            )

    return run


def repeated_passages(
    docs: DataFrame, length: int = LENGTH, prefix: int = PREFIX, group_suffixes: int = GROUP_SUFFIXES
) -> DataFrame:
    """The longest runs of words that repeat earlier ones: doc_id, start (word,
    from 0), n_words, passage."""
    judged = _judged(docs.select("doc_id", "text"), length, prefix, group_suffixes)
    fields = [
        docs.schema["doc_id"],
        T.StructField("start", T.LongType()),
        T.StructField("n_words", T.LongType()),
        T.StructField("passage", T.StringType()),
    ]
    return judged.drop("row").mapInArrow(_passages(length), T.StructType(fields))


def oracle_sql() -> str:
    return """
with docs as (
    select doc_id, regexp_extract_all(coalesce(text, ''), '[^ \\x09-\\x0D]+') as words
    from documents
),
windows as (
    select doc_id, start, array_to_string(words[start : start + 19], ' ') as span
    from (
        select doc_id, words, unnest(range(1, len(words) - 18)) as start from docs where len(words) >= 20
    )
),
late as (
    select doc_id, start
    from (select *, row_number() over (partition by span order by doc_id, start) as turn from windows)
    where turn > 1
),
gone as (select distinct doc_id, unnest(range(start, start + 20)) as spot from late),
every as (
    select doc_id, unnest(words) as word, unnest(range(1, len(words) + 1)) as spot from docs
),
kept as (
    select doc_id, string_agg(word, ' ' order by spot) as text, count(*) as n
    from every anti join gone using (doc_id, spot) group by doc_id
)
select doc_id, len(words)::bigint as n_words, (len(words) - coalesce(n, 0))::bigint as n_removed,
    sha256(coalesce(kept.text, '')) as kept_sha256
from docs left join kept using (doc_id)
"""
