"""N-gram Jaccard join: size-banded tiles, bitmap bounds, exact intersections.

A document's set holds 64-bit hashes of its shingles of ``words`` words. Two
sets link when their Jaccard similarity is at least ``percent`` percent (a
``Rule``; four words and 85 unless another is given). Sizes of linked sets
differ by less than one band, where a band's upper end is its lower end over the
similarity, so linked sets share one of the overlapping pairs of neighbouring
bands.

Inside a pair of bands the difference of two linked sets has at most H members.
The hash range is cut into more than H slices: linked sets agree in all of some
slice. A tile is therefore (pair of bands, slice, content of the slice), and the
similar sets of any passage, however common, fall into tiles of their own, since
a slice mixes the passage with the rest of the text.

1. Neighbours in every tile, by size, are compared: first the bitmap signatures,
   whose bit counts bound the overlap from above, then the sorted arrays.
2. Tiles whose members this joins to one component are done. In the others all
   pairs across components are compared where the tile is, large tiles cut into
   chunks whose pairs are tiles themselves: rows with a partner that short, then
   whole bitmaps allow stay in the tile, and the last to stay bring their sets.
   A tile gives one link per two components it joins, never its pairs, so copies
   never become all their pairs, and no link between sets of different
   components is missed.

Defined cases: null and blank texts have an empty set, link with nothing and
are their own component; fewer words than a shingle has make one of them all;
rows with equal sets are one node, whatever their ids; a null id stays null
unless a linked row has an id; an empty table gives an empty table. Two shingles
or sets count as equal when their 64-bit hashes are.
"""

from __future__ import annotations

import bisect
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placeweave.functions.shipping import ship_by_value
from placeweave.llm.components import connected
from placeweave.llm.tokenizing import kept_by_worker
from placeweave.session import Scratch, discard, settle

ship_by_value(__name__)

CHUNK = 512
CHUNK_MEMBERS = 1 << 20  # 8 MB of sets
PAIRS_KEPT = 200_000
ROWS_OUT = 10_000
FIRST_TILES = 12
WORDS_KEPT = 500_000
BROADCAST_ADDRESSES = 1_000_000  # longs: some 16 MB at most
WIDEST_BITMAP = 1 << 16

STEPS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64
)


class _Words(dict):
    def __missing__(self, word):
        import xxhash

        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass(frozen=True)
class Rule:
    """Words of a shingle, and the least similarity of linked sets in percent:
    100 * common >= percent * union."""

    words: int = 4
    percent: int = 85
    band_starts: list = field(default_factory=list, compare=False, repr=False)

    def __post_init__(self):
        self.band_starts.append(1)
        while self.band_starts[-1] < 1 << 40:
            self.band_starts.append(self.band_starts[-1] * 100 // self.percent + 1)

    def shingle_set(self, text: bytes, words: dict) -> np.ndarray:
        """Sorted distinct shingle hashes of a text in UTF-8. ``bytes`` lower-cases
        A-Z and splits at the six white-space characters, no others."""
        tokens = text.lower().split()
        if not tokens:
            return np.empty(0, np.uint64)
        codes = np.fromiter(map(words.__getitem__, tokens), np.uint64, len(tokens))
        width = min(self.words, len(codes))
        total = np.full(len(codes) - width + 1, np.uint64(width))
        for k in range(width):
            step = STEPS[k % len(STEPS)] + np.uint64(2 * (k // len(STEPS)))
            total += codes[k : len(codes) - width + 1 + k] * step
        return np.unique(_mix(total))

    def slices_of(self, band: int) -> tuple[int, int]:
        """Slices of the pair (band, band + 1), and how many may be empty in a set
        before empty slices count as content too. No slices: only equal sets link."""
        largest = self.band_starts[band + 1] - 1
        both = largest + largest * 100 // self.percent
        differing = both * (100 - self.percent) // (100 + self.percent)
        spare = 1 + differing // 12
        return (differing + 1 + spare, spare) if differing else (0, 0)

    def tile_keys(self, members: np.ndarray) -> np.ndarray:
        """Tiles of a set: at least one is common to two sets that link."""
        band = bisect.bisect_right(self.band_starts, len(members)) - 1
        mixed = _mix(members ^ np.uint64(0x5851F42D4C957F2D))
        out = []
        for first in (band, band - 1):
            count, spare = self.slices_of(first) if first >= 0 else (0, 0)
            if not count:
                continue
            part = ((members >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32)
            starts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
            sums = np.add.reduceat(mixed, starts)
            where = part[starts]
            if count - len(where) > spare:
                empty = np.setdiff1d(np.arange(count, dtype=np.uint64), where)
                where = np.concatenate((where, empty))
                sums = np.concatenate((sums, np.zeros(len(empty), np.uint64)))
            place = where * STEPS[0] + np.uint64(first * int(STEPS[1]) % (1 << 64))
            out.append(_mix(_mix(sums + place) + place))
        return np.concatenate(out).view(np.int64) if out else np.empty(0, np.int64)

    def sizes_fit(self, n_a: int, n_b: int) -> bool:
        return 100 * min(n_a, n_b) >= self.percent * max(n_a, n_b)

    def enough(self, common: int, n_a: int, n_b: int) -> bool:
        return (100 + self.percent) * common >= self.percent * (n_a + n_b)

    def may_link(self, n_a: int, bits_a: bytes, n_b: int, bits_b: bytes) -> bool:
        """Whether the bound on the overlap leaves a link possible."""
        return self.overlap_allows(n_a, _opened(bits_a), n_b, _opened(bits_b))

    def overlap_allows(self, n_a: int, bits_a: tuple[int, int], n_b: int, bits_b: tuple[int, int]) -> bool:
        """``may_link`` of bitmaps as numbers with their widths."""
        width = min(bits_a[1], bits_b[1])
        a, b = _folded(*bits_a, width), _folded(*bits_b, width)
        common = (a & b).bit_count()
        return self.enough(min(n_a - a.bit_count(), n_b - b.bit_count()) + common, n_a, n_b)

    def links(self, a: np.ndarray, b: np.ndarray) -> bool:
        return self.enough(len(np.intersect1d(a, b, assume_unique=True)), len(a), len(b))

    def members_link(self, a: bytes, b: bytes) -> bool:
        return self.links(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64))


RULE = Rule()


def node_of(members: np.ndarray) -> int:
    """Address of a set (signed, as Spark's longs are)."""
    return int(_mix(np.array([_mix(members).sum() + np.uint64(len(members))], np.uint64)).view(np.int64)[0])


def bitmap(members: np.ndarray, per_member: int = 4) -> bytes:
    """One bit per member, ``per_member`` to twice that many bits a member."""
    width = min(WIDEST_BITMAP, max(64, 1 << int(per_member * len(members) - 1).bit_length()))
    bits = np.zeros(width, np.uint8)
    bits[(members & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def _opened(bits: bytes) -> tuple[int, int]:
    return int.from_bytes(bits, "little"), 8 * len(bits)


def _folded(bits: int, width: int, to: int) -> int:
    while width > to:
        width //= 2
        bits = (bits >> width) | (bits & ((1 << width) - 1))
    return bits


def _texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.encode(text, "utf-8").alias("text"), F.xxhash64(text).alias("address"))


def _known_words() -> dict:
    words = kept_by_worker("shingle_words", _Words)
    if len(words) > WORDS_KEPT:
        words.clear()
    return words


def _batch(columns: dict, kinds: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[c], kinds[c]) for c in kinds], names=list(kinds)
    )


def _sets(rule: Rule):
    def run(batches):
        for batch in batches:
            sizes, nodes = [], []
            for text in batch.column("text").to_pylist():
                members = rule.shingle_set(text, _known_words())
                sizes.append(len(members))
                nodes.append(node_of(members) if len(members) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("address"),
                    pa.array(sizes, pa.int64()),
                    pa.array(nodes, pa.int64()),
                ],
                names=["doc_id", "address", "n_shingles", "node"],
            )

    return run


def _tile_rows(rule: Rule):
    def run(batches):
        for batch in batches:
            keys, nodes, sizes = [], [], []
            for text in batch.column("text").to_pylist():
                members = rule.shingle_set(text, _known_words())
                if not len(members):
                    continue
                own = rule.tile_keys(members)
                keys.append(own)
                nodes.append(np.full(len(own), node_of(members)))
                sizes.append(np.full(len(own), len(members), np.int32))
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(v)) for v in (keys, sizes, nodes)], names=["key", "n", "node"]
                )

    return run


def _neighbours(batches):
    """Pairs of different nodes that follow each other in a tile; rows come
    sorted by key, size and node."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key, n, node = (batch.column(c).to_numpy() for c in ("key", "n", "node"))
        if last is not None:
            key, n, node = (np.concatenate(([x], y)) for x, y in zip(last, (key, n, node)))
        last = key[-1], n[-1], node[-1]
        hit = np.flatnonzero((key[1:] == key[:-1]) & (node[1:] != node[:-1]))
        if len(hit):
            yield pa.RecordBatch.from_arrays(
                [pa.array(v) for v in (key[hit], node[hit], node[hit + 1])], names=["key", "a", "b"]
            )


def _whole_sets(rule: Rule):
    def run(batches):
        for batch in batches:
            rows = {"node": [], "n": [], "brief": [], "bits": [], "members": []}
            for text in batch.column("text").to_pylist():
                members = rule.shingle_set(text, _known_words())
                if len(members):
                    rows["node"].append(node_of(members))
                    rows["n"].append(len(members))
                    rows["brief"].append(bitmap(members, 1))
                    rows["bits"].append(bitmap(members))
                    rows["members"].append(members.tobytes())
            kinds = {"node": pa.int64(), "n": pa.int64()}
            yield _batch(rows, kinds | {c: pa.binary() for c in ("brief", "bits", "members")})

    return run


def _listed(rows: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """``rows`` whose ``column`` is in ``wanted`` (settled, distinct): a short
    list is broadcast, so that only what it names is shuffled later, a long one
    joined."""
    if wanted.limit(BROADCAST_ADDRESSES + 1).count() <= BROADCAST_ADDRESSES:
        wanted = F.broadcast(wanted)
    return rows.join(wanted, column, "left_semi")


def _sets_of(docs: DataFrame, base: DataFrame, nodes: DataFrame, rule: Rule, held: Scratch) -> DataFrame:
    """(node, n, brief, bits, members), one row each, of ``nodes``; brief: short
    bitmaps, which travel with tiles. One row of ``docs`` is found for each node
    before texts are read, so that no texts or sets are shuffled but those of
    rows that repeat an id with its text."""
    place = F.xxhash64("doc_id", "address").alias("place")
    rows = base.join(nodes, "node", "left_semi").groupBy("node", place).agg(F.count(F.lit(1)).alias("rows"))
    chosen = held.settle(
        rows.groupBy("node").agg(F.min(F.struct("rows", "place")).alias("at")).select("at.*").distinct(), "places"
    )
    texts = _texts(docs).select(place, "text")
    found = _listed(texts, "place", chosen.filter("rows = 1").select("place"))
    repeated = chosen.filter("rows > 1").select("place")
    if not repeated.isEmpty():
        found = found.unionByName(_listed(texts, "place", repeated).dropDuplicates(["place"]))
    schema = "node long, n long, brief binary, bits binary, members binary"
    return held.settle(found.select("text").mapInArrow(_whole_sets(rule), schema), "sets")


def _keep(test):
    """Pairs (a, b) of a batch that pass ``test`` of their other columns."""

    def run(batches):
        for batch in batches:
            columns = [c for c in batch.schema.names if c not in ("a", "b")]
            rows = zip(*(batch.column(c).to_pylist() for c in columns))
            passed = pa.array([test(*row) for row in rows], pa.bool_())
            yield batch.select(["a", "b"]).filter(passed)

    return run


def _verified(pairs: DataFrame, sets: DataFrame, rule: Rule, held: Scratch) -> DataFrame:
    """The linked ones of ``pairs`` (a, b), settled: bitmaps first."""
    kind = "a long, b long"

    def with_columns(rows: DataFrame, sets: DataFrame, *columns: str) -> DataFrame:
        for end in ("a", "b"):
            side = sets.select(F.col("node").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in columns])
            rows = rows.join(side, end)
        return rows.select("a", "b", *[f"{c}_{end}" for end in ("a", "b") for c in columns])

    possible = with_columns(pairs, sets, "n", "bits").mapInArrow(_keep(rule.may_link), kind)
    possible = held.settle(possible, "possible")
    ends = held.settle(possible.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "ends")
    sets = _listed(sets.select("node", "members"), "node", ends)
    return held.settle(with_columns(possible, sets, "members").mapInArrow(_keep(rule.members_link), kind), "links")


TILE_COLUMNS = {
    "key": pa.int64(),
    "tile": pa.string(),
    "side": pa.int32(),
    "across": pa.bool_(),
    "node": pa.int64(),
    "n": pa.int64(),
    "component": pa.int64(),
    "firsts": pa.list_(pa.int64()),
}
TILE_ROW = (
    "key long, tile string, side int, across boolean, node long, n long, component long, firsts array<long>"
)


def _tile_by_tile(batches):
    """Lists of the rows of each tile; rows come sorted by key and tile."""
    held: list[dict] = []
    at = None
    for batch in batches:
        for row in batch.to_pylist():
            here = row["key"], row["tile"]
            if here != at:
                if held:
                    yield held
                held, at = [], here
            held.append(row)
    if held:
        yield held


def _possible_pairs(rule: Rule, rows: list[dict], wanted):
    """Pairs (i, j) of rows of a tile, of different components, whose bitmaps
    leave a link possible; ``wanted`` (i, j) is asked before the bitmaps are.
    A tile of two chunks has rows of side 0 and 1, met across. A pair is left to
    an earlier tile where the nodes' lists of their first tiles show one; in the
    first tile that they share they never do, so every pair is looked at."""
    earlier = [{k for k in x["firsts"] if k < x["key"]} for x in rows]
    bits = [_opened(x["bits"]) for x in rows]
    for i, x in enumerate(rows):
        for j in range(i + 1, len(rows)):
            y = rows[j]
            if x["component"] == y["component"] or x["across"] and x["side"] == y["side"]:
                continue
            if not wanted(i, j):
                continue
            # both are in an earlier tile, where they are looked at
            if not earlier[i].isdisjoint(earlier[j]):
                continue
            if rule.sizes_fit(x["n"], y["n"]) and rule.overlap_allows(x["n"], bits[i], y["n"], bits[j]):
                yield i, j


def _possible_rows(rule: Rule):
    """Rows of tiles that have a possible pair in their tile, without bitmaps. A
    pair that is possible keeps both its rows in the tile that looks at it."""

    def run(batches):
        out: list[dict] = []
        for rows in _tile_by_tile(batches):
            stays = [False] * len(rows)
            for i, j in _possible_pairs(rule, rows, lambda i, j: not (stays[i] and stays[j])):
                stays[i] = stays[j] = True
            out += [x for x, stay in zip(rows, stays) if stay]
            if len(out) >= ROWS_OUT:
                yield _batch({c: [x[c] for x in out] for c in TILE_COLUMNS}, TILE_COLUMNS)
                out = []
        yield _batch({c: [x[c] for x in out] for c in TILE_COLUMNS}, TILE_COLUMNS)

    return run


def _cross_pairs(rule: Rule):
    """Pairs of nodes of different components in each tile. Rows with members
    give links only, and none between components that the task's links have
    joined already; rows without give all pairs that the bitmaps leave possible."""

    def run(batches):
        seen: set = set()
        owner: dict = {}
        out: list = []

        def root(component):
            while (above := owner.get(component, component)) != component:
                owner[component] = owner.get(above, above)
                component = above
            return component

        def flush():
            return pa.RecordBatch.from_arrays(
                [pa.array([p[i] for p in out], pa.int64()) for i in (0, 1)], names=["a", "b"]
            )

        for rows in _tile_by_tile(batches):
            exact = "members" in rows[0]

            def fresh(i, j):
                x, y = rows[i], rows[j]
                if exact and root(x["component"]) == root(y["component"]):
                    return False
                return (min(x["node"], y["node"]), max(x["node"], y["node"])) not in seen

            for i, j in _possible_pairs(rule, rows, fresh):
                x, y = rows[i], rows[j]
                pair = min(x["node"], y["node"]), max(x["node"], y["node"])
                seen.add(pair)
                if exact:
                    if not rule.members_link(x["members"], y["members"]):
                        continue
                    owner[root(x["component"])] = root(y["component"])
                out.append(pair)
            if len(seen) > PAIRS_KEPT:
                yield flush()
                out.clear()
                seen.clear()
                owner.clear()
        yield flush()

    return run


def _unlike_tiles(members: DataFrame) -> DataFrame:
    """(key, size, widest) of one tile of each set of nodes: sets that have much in
    common share hundreds of tiles, which all hold the same pairs."""
    whole = members.groupBy("key").agg(
        F.count(F.lit(1)).alias("size"),
        F.max("n").alias("widest"),
        F.bit_xor(F.xxhash64("node")).alias("print"),
        F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("print2"),
    )
    return whole.groupBy("size", "widest", "print", "print2").agg(F.min("key").alias("key")).select(
        "key", "size", "widest"
    )


def _tiles(members: DataFrame, sets: DataFrame, held: Scratch) -> DataFrame:
    """Rows of unlike tiles with their short bitmaps and their first tiles, large
    tiles as pairs of chunks. ``members`` has a node once per tile."""
    sizes = held.settle(_unlike_tiles(members), "tile-sizes")
    members = held.settle(members.join(sizes, "key"), "tile-members")
    firsts = members.groupBy("node").agg(
        F.slice(F.sort_array(F.collect_list("key")), 1, FIRST_TILES).alias("firsts")
    )
    about = held.settle(sets.select("node", F.col("brief").alias("bits")).join(firsts, "node"), "tile-nodes")
    chunk = F.least(F.lit(CHUNK), F.greatest(F.lit(1), F.floor(CHUNK_MEMBERS / F.col("widest"))))
    chunks = F.ceil(F.col("size") / chunk).cast("int")
    return (
        members
        .withColumn("chunk", F.pmod(F.xxhash64("node"), chunks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1)))
        .join(about, "node")
        .select(
            "key",
            F.concat_ws("-", F.least("chunk", "other"), F.greatest("chunk", "other")).alias("tile"),
            (F.col("chunk") > F.col("other")).cast("int").alias("side"),
            (F.col("chunk") != F.col("other")).alias("across"),
            "node",
            "n",
            "component",
            "bits",
            "firsts",
        )
    )


def _crossing(tiles: DataFrame, sets: DataFrame, rule: Rule, held: Scratch) -> DataFrame:
    """Links (a, b) that join the components in tiles, settled. Rows stay while a
    pair of theirs is possible, first by short, then by whole bitmaps."""

    def by_tile(rows: DataFrame) -> DataFrame:
        return rows.repartition("key", "tile").sortWithinPartitions("key", "tile")

    def brought(rows: DataFrame, *columns: str) -> DataFrame:
        nodes = held.settle(rows.select("node").distinct(), "tile-ends")
        return rows.join(_listed(sets.select("node", *columns), "node", nodes), "node")

    rows = held.settle(by_tile(tiles).mapInArrow(_possible_rows(rule), TILE_ROW), "possible-rows")
    rows = held.settle(by_tile(brought(rows, "bits")).mapInArrow(_possible_rows(rule), TILE_ROW), "likely-rows")
    links = by_tile(brought(rows, "bits", "members")).mapInArrow(_cross_pairs(rule), "a long, b long")
    return held.settle(links, "crossing")


def _owned(docs: DataFrame, rule: Rule) -> DataFrame:
    """(doc_id, address, n_shingles, component) per row; component: a node, null
    without words. Settled, everything on the way to it deleted."""
    held = Scratch()
    base = held.settle(
        _texts(docs).mapInArrow(
            _sets(rule),
            T.StructType(
                [docs.schema["doc_id"], *[T.StructField(c, T.LongType()) for c in ("address", "n_shingles", "node")]]
            ),
        ),
        "nodes",
    )
    rows = _texts(docs).select("text").mapInArrow(_tile_rows(rule), "key long, n int, node long")
    chain = held.settle(
        rows.repartition("key").sortWithinPartitions("key", "n", "node").mapInArrow(
            _neighbours, "key long, a long, b long"
        ),
        "neighbours",
    )
    nodes = held.settle(
        chain.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "wanted-nodes"
    )
    sets = _sets_of(docs, base, nodes, rule, held)
    near = held.settle(
        chain.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "near"
    )
    first = _verified(near, sets, rule, held)
    labels = connected(first)
    held.held.append(labels)

    known = held.settle(
        sets.select("node", "n").join(labels, "node", "left").select(
            "node", "n", F.coalesce("component", "node").alias("component")
        ),
        "known",
    )
    a = known.select(F.col("node").alias("a"), F.col("component").alias("c_a"))
    b = known.select(F.col("node").alias("b"), F.col("component").alias("c_b"))
    split = chain.join(a, "a").join(b, "b").filter("c_a <> c_b").select("key").distinct()
    members = (
        chain.join(held.settle(split, "split-tiles"), "key", "left_semi")
        .select("key", F.explode(F.array("a", "b")).alias("node"))
        .distinct()
        .join(known, "node")
    )
    tiles = _tiles(held.settle(members, "members"), sets, held)
    second = _crossing(tiles, sets, rule, held)
    labels = connected(first.unionByName(second))
    held.held.append(labels)
    owned = settle(
        base.join(labels, "node", "left").select(
            "doc_id", "address", "n_shingles", F.coalesce("component", "node").alias("component")
        ),
        "owned",
    )
    held.clear()
    return owned


def shingle_components(docs: DataFrame, rule: Rule = RULE) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (smallest doc_id)."""
    owned = _owned(docs, rule)
    least = settle(
        owned.filter("component is not null").groupBy("component").agg(F.min("doc_id").alias("least")),
        "least",
    )
    return owned.join(least, "component", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"),
    )


def _row_key(docs: DataFrame) -> list[Column]:
    """A row by its id and text, without nulls."""
    return [
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("k0"),
        F.col("doc_id").isNull().alias("k1"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("k2"),
    ]


def keep_one_each(docs: DataFrame, rule: Rule = RULE) -> DataFrame:
    """One row of each group, with its columns: that of the smallest id (null
    last), then of the smallest text hash; of rows equal in both any one.
    Rows without words all stay."""
    found = _owned(docs, rule)
    owned = found.filter("component is not null")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "address")
    kept = owned.groupBy("component").agg(F.min(place).alias("kept"))
    verdict = owned.withColumn("place", place).groupBy("component", "place").agg(F.count(F.lit(1)).alias("rows"))
    verdict = verdict.join(kept, "component").select(
        F.coalesce(F.col("place.doc_id").cast("string"), F.lit("")).alias("k0"),
        F.col("place.none").alias("k1"),
        F.col("place.address").alias("k2"),
        (F.col("place") != F.col("kept")).alias("lost"),
        "rows",
    )
    verdict = settle(verdict.filter("lost or rows > 1"), "verdict")
    discard(found)
    keys = ["k0", "k1", "k2"]
    rows = docs.select(*_row_key(docs), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    left = rows.join(verdict.filter("lost").select(*keys), keys, "left_anti")
    repeated = verdict.filter("not lost").select(*keys)
    if not repeated.isEmpty():
        once = left.join(repeated, keys, "left_semi").dropDuplicates(keys)
        left = left.join(repeated, keys, "left_anti").unionByName(once)
    return left.select("row.*")
