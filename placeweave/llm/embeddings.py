"""Embedding near-duplicates by a subspace pigeonhole join.

Vectors of one label and length are scaled to length 1 and turned by a fixed
random rotation, which spreads their energy evenly, then split into blocks of
eight coordinates. Cosine c means a squared distance of 2 - 2c; if every block
exceeded its proportional share of that budget, so would the whole. So linked
vectors lie within the share of some block, and each block is a range join: a
grid over its first coordinates, where a vector has a home cell and visits those
later neighbour cells that its range touches. A pair is decided in the first
block that finds it, exactly, by its cosine in double precision.

Equal vectors are joined once and counted with their number of copies. A cell
holds no vectors, only their block's coordinates, rounded to ``UNIT``, many in
one row. Cells are cut into tiles of bounded size. A tile first names the
vectors that may be within the block's range of another one; only those are
fetched whole. Then it sends back, per vector, its number of links and the
smallest vector of its tile it is connected to: never pairs. So a crowd of near
copies costs its comparisons, but no rows for them.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components and vectors without a label link with nothing and are their own
component; vectors of different lengths don't link; repeated rows are vectors of
their own; a null id is counted as a vector, but is no component's name; an
empty table gives an empty table. Equal 64-bit hashes of label and components
count as equal vectors.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placeweave.functions.shipping import ship_by_value
from placeweave.llm.components import connected
from placeweave.session import discard, settle

ship_by_value(__name__)

MIN_COSINE = 0.98
BLOCK = 8
GRID = 3  # coordinates of a block that its grid is over
CELL = 3.0  # width of a cell in ranges
TILE = 1 << 12  # vectors of a side of a tile, fewer where they are long
TILE_COORDINATES = 1 << 20
MEMBERS = 256  # of a cell, at most, in one row
SEED = 77
PAIRS_AT_ONCE = 1 << 15
SCORES_AT_ONCE = 1 << 22
DISTANCES_PER_TASK = 1 << 30
MEMBERS_PER_TASK = 1_000_000
# Rotated coordinates are rounded to this step, so that every tile has the same
# ones and their block distances are whole numbers.
STEP = 2.0**-20
# Coordinates of a cell's members are rounded to this, so that they fit 16 bits.
UNIT = 2.0**-14
MEMBER = np.dtype([("node", "<i8"), ("at", "<i2", (BLOCK,))])
# More than the distance of members is off in 32-bit floats, squared, in units.
SLACK = 4096.0


# Plain dictionaries: they travel to workers with the functions that use them.
_ROTATIONS: dict[int, np.ndarray] = {}


def rotation(width: int) -> np.ndarray:
    if width not in _ROTATIONS:
        q, r = np.linalg.qr(np.random.default_rng(SEED).normal(size=(width, width)))
        _ROTATIONS[width] = q * np.sign(np.diag(r))
    return _ROTATIONS[width]


def blocks(width: int) -> list[tuple[int, int, float, int]]:
    """(start, end, range, largest whole squared distance) of each block."""
    out = []
    for start in range(0, width, BLOCK):
        end = min(start + BLOCK, width)
        share = (2 - 2 * MIN_COSINE + 1e-9) * (end - start) / width
        reach = np.sqrt(share) + np.sqrt(end - start) * STEP
        out.append((start, end, float(reach), int(np.ceil((reach / STEP) ** 2))))
    return out


def turned(vectors: np.ndarray) -> np.ndarray:
    """Rotated unit vectors as whole steps."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.rint(unit @ rotation(vectors.shape[1]) / STEP).astype(np.int64)


def cells(turned_: np.ndarray):
    """(row, block, cell, is home) of all vectors of one length."""
    rows, numbers, keys, homes = [], [], [], []
    for number, (start, end, reach, _) in enumerate(blocks(turned_.shape[1])):
        used = min(GRID, end - start)
        at = turned_[:, start : start + used] * STEP
        width = CELL * reach
        cell = np.floor(at / width).astype(np.int64)
        inside = at - cell * width
        near = {-1: inside <= reach, 0: np.ones_like(inside, bool), 1: width - inside <= reach}
        for shift in product((-1, 0, 1), repeat=used):
            if shift < (0,) * used:
                continue  # the vector of the earlier cell visits the later one
            hit = np.flatnonzero(np.logical_and.reduce([near[d][:, k] for k, d in enumerate(shift)]))
            rows.append(hit)
            numbers.append(np.full(len(hit), number))
            code = np.full(len(hit), 17, np.int64)
            for k, d in enumerate(shift):
                code = code * 1_000_003 + cell[hit, k] + d
            keys.append(code)
            homes.append(np.full(len(hit), not any(shift)))
    return tuple(map(np.concatenate, (rows, numbers, keys, homes)))


def _members(turned_: np.ndarray, nodes: np.ndarray, rows: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    out = np.zeros(len(rows), MEMBER)
    out["node"] = nodes[rows]
    rounded = np.clip(np.rint(turned_ * (STEP / UNIT)), -32767, 32767).astype(np.int16)
    for number, (start, end, *_) in enumerate(blocks(turned_.shape[1])):
        own = np.flatnonzero(numbers == number)
        out["at"][own, : end - start] = rounded[rows[own], start:end]
    return out


def _by_width(raw: pa.Array, kind: str):
    """(width, rows, vectors) of lists of numbers of this kind."""
    lists = raw.combine_chunks() if isinstance(raw, pa.ChunkedArray) else raw
    widths = np.diff(lists.offsets.to_numpy())
    starts = lists.offsets.to_numpy()[:-1]
    values = lists.values.to_numpy(zero_copy_only=False)
    for width in np.unique(widths):
        rows = np.flatnonzero(widths == width)
        yield int(width), rows, values[starts[rows][:, None] + np.arange(width)].astype(kind).astype(float)


def _places(kind: str):
    def run(batches):
        for batch in batches:
            label = batch.column("label").dictionary_encode()
            codes, every = label.indices.to_numpy(), batch.column("node").to_numpy()
            for width, own, vectors in _by_width(batch.column("embedding"), kind):
                whole = turned(vectors)
                row, number, key, home = cells(whole)
                order = np.lexsort((home, key, number, codes[own][row]))
                row, number, key, home = row[order], number[order], key[order], home[order]
                code = codes[own][row]
                change = np.ones(len(row), bool)
                change[1:] = (np.diff(code) != 0) | (np.diff(number) != 0) | (np.diff(key) != 0) | (home[1:] != home[:-1])
                first = np.flatnonzero(change)
                since = np.arange(len(row)) - np.repeat(first, np.diff(np.append(first, len(row))))
                first = np.flatnonzero(since % MEMBERS == 0)
                ends = np.append(first, len(row)).astype(np.int32)
                data = _members(whole, every[own], row, number)
                offsets = pa.py_buffer((ends * MEMBER.itemsize).astype(np.int32).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        label.dictionary.take(pa.array(code[first])),
                        pa.array(np.full(len(first), width, np.int32)),
                        pa.array(number[first].astype(np.int32)),
                        pa.array(key[first]),
                        pa.array(home[first]),
                        pa.array(np.diff(ends).astype(np.int64)),
                        pa.Array.from_buffers(pa.binary(), len(first), [None, offsets, pa.py_buffer(data.tobytes())]),
                    ],
                    names=["label", "width", "block", "cell", "home", "members", "data"],
                )

    return run


def hopeful(at: np.ndarray, width: int, number: int, left: np.ndarray, right: np.ndarray, same: bool):
    """Which rows of left, and which of right, may be within the range of block
    ``number`` of one of the others, by rounded coordinates ``at``."""
    start, end, _, most = blocks(width)[number]
    limit = np.float32((np.sqrt(most) * STEP / UNIT + np.sqrt(end - start)) ** 2 + SLACK)
    a, b = at[left], at[right]
    norm_a, norm_b, turned_b = (a * a).sum(1), (b * b).sum(1), -2 * b.T
    hit_a, hit_b = np.zeros(len(left), bool), np.zeros(len(right), bool)
    step = max(1, SCORES_AT_ONCE // max(len(right), 1))
    for low in range(0, len(left), step):
        part, after = slice(low, low + step), low if same else 0
        apart = a[part] @ turned_b[:, after:]
        apart += norm_a[part, None]
        apart += norm_b[None, after:]
        near = apart <= limit
        if same:
            near = np.triu(near, 1)
        hit_a[part] |= near.any(1)
        hit_b[after:] |= near.any(0)
    return hit_a, hit_b


def _hopeful(table: pa.Table) -> pa.Table:
    data = table.column("data").to_pylist()
    role = np.repeat(table.column("role").to_numpy(), [len(d) // MEMBER.itemsize for d in data])
    members = np.frombuffer(b"".join(data), MEMBER)
    at = members["at"].astype(np.float32)
    at -= np.rint(at.mean(0))
    width, number = table.column("width")[0].as_py(), table.column("block")[0].as_py()
    own, left, right = (np.flatnonzero(role == r) for r in (0, 1, 2))
    others = np.concatenate([own, right])
    hit = np.zeros(len(members), bool)
    for one, two, same in ((own, own, True), (left, others, False)):
        hit_one, hit_two = hopeful(at, width, number, one, two, same)
        hit[one] |= hit_one
        hit[two] |= hit_two
    hit = np.flatnonzero(hit)
    key = [table.column(c).combine_chunks().take(pa.array(np.zeros(len(hit), np.int64))) for c in TILE_KEY]
    found = [pa.array(role[hit]), pa.array(np.ascontiguousarray(members["node"][hit]))]
    return pa.table([*key, *found], names=[*TILE_KEY, "role", "node"])


def linked_pairs(vectors: np.ndarray, whole: np.ndarray, number: int, left: np.ndarray, right: np.ndarray, same: bool):
    """Pairs (of left, of right) that block ``number`` is the first to find and
    whose cosine is high enough, some at a time. ``whole``: the vectors turned;
    ``same``: left is right, each pair once."""
    every = blocks(vectors.shape[1])
    norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
    start, end, _, most = every[number]
    a, b = (whole[i, start:end] * STEP for i in (left, right))
    norm_a, norm_b = (a * a).sum(1), (b * b).sum(1)
    starts = [s for s, *_ in every]
    limits = np.array([m for *_, m in every])
    step = max(1, SCORES_AT_ONCE // max(len(right), 1))
    for from_ in range(0, len(left), step):
        part = slice(from_, from_ + step)
        apart = norm_a[part, None] + norm_b[None, :] - 2 * a[part] @ b.T
        near = apart <= most * STEP * STEP + 1e-9
        if same:
            near = np.triu(near, from_ + 1)
        i, j = np.nonzero(near)
        i, j = left[part][i], right[j]
        for low in range(0, len(i), PAIRS_AT_ONCE):
            x, y = i[low : low + PAIRS_AT_ONCE], j[low : low + PAIRS_AT_ONCE]
            found = np.add.reduceat((whole[x] - whole[y]) ** 2, starts, axis=1) <= limits
            first = found[:, number] & ~found[:, :number].any(1)
            x, y = x[first], y[first]
            cosine = np.einsum("ij,ij->i", vectors[x], vectors[y]) / (norms[x] * norms[y])
            yield x[cosine >= MIN_COSINE], y[cosine >= MIN_COSINE]


def connect(roots: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Let ``roots``, a smallest known row for each row, follow the links (i, j)."""
    while True:
        a, b = roots[i], roots[j]
        if (a == b).all():
            return
        np.minimum.at(roots, np.maximum(a, b), np.minimum(a, b))
        while (roots != roots[roots]).any():
            roots[:] = roots[roots]


TILE_KEY = ["label", "width", "block", "cell", "tile"]
TILE_OUT = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])


def _tile(kind: str):
    def run(table: pa.Table) -> pa.Table:
        role = table.column("role").to_numpy()
        nodes = table.column("node").to_numpy()
        copies = table.column("copies").to_numpy()
        number = table.column("block")[0].as_py()
        ((_, _, vectors),) = _by_width(table.column("embedding"), kind)
        whole = turned(vectors)
        own, left, right = (np.flatnonzero(role == r) for r in (0, 1, 2))
        links, roots = np.zeros(len(nodes), np.int64), np.arange(len(nodes))
        for one, two, same in ((own, own, True), (left, np.concatenate([own, right]), False)):
            for i, j in linked_pairs(vectors, whole, number, one, two, same):
                np.add.at(links, i, copies[j])
                np.add.at(links, j, copies[i])
                connect(roots, i, j)
        names = nodes.copy()
        np.minimum.at(names, roots, nodes)
        hit = np.flatnonzero(links)
        return pa.table([pa.array(nodes[hit]), pa.array(links[hit]), pa.array(names[roots][hit])], schema=TILE_OUT)

    return run


def _sizes(placed: DataFrame) -> DataFrame:
    """Members of the cells in which some vector can meet another one."""
    homes = F.sum(F.when(F.col("home"), F.col("members")).otherwise(0))
    return (
        placed.groupBy("label", "width", "block", "cell")
        .agg(homes.alias("homes"), (F.sum("members") - homes).alias("visits"))
        .filter("homes > 0 and homes + visits > 1")
    )


def _tiles(placed: DataFrame, sizes: DataFrame) -> DataFrame:
    """Rows of tiles with their role: 0 meets its like and is met by 1; 1 also
    meets 2. A cell with few members is one tile, others are cut into chunks."""
    cell = ["label", "width", "block", "cell"]
    long = F.greatest(F.lit(512), F.floor(F.lit(TILE_COORDINATES) / F.col("width")))
    tile = F.least(F.lit(TILE), long)
    h = F.ceil(F.col("homes") / tile).cast("int")
    p = F.greatest(F.ceil(F.col("visits") / tile), F.lit(1)).cast("int")
    chunk = F.pmod(F.xxhash64("data"), F.when(F.col("home"), F.col("h")).otherwise(F.col("p"))).cast("int")

    def spot(name, role):
        return F.struct(name.alias("tile"), role.cast("int").alias("role"))

    def others(count):
        return F.sequence(F.lit(0), count - 1)

    c = F.col("chunk")
    at_home = F.concat(
        F.transform(
            others(F.col("h")),
            lambda j: F.when(j == c, spot(F.concat_ws("-", F.lit("d"), c), F.lit(0))).otherwise(
                spot(
                    F.concat_ws("-", F.lit("h"), F.least(c, j), F.greatest(c, j)),
                    F.when(c < j, 1).otherwise(2),
                )
            ),
        ),
        F.transform(
            F.filter(others(F.col("p")), lambda k: k > 0),
            lambda k: spot(F.concat_ws("-", F.lit("p"), k, c), F.lit(2)),
        ),
    )
    visiting = F.transform(
        others(F.col("h")),
        lambda j: F.when(c == 0, spot(F.concat_ws("-", F.lit("d"), j), F.lit(1))).otherwise(
            spot(F.concat_ws("-", F.lit("p"), c, j), F.lit(1))
        ),
    )
    return (
        placed.join(sizes, cell)
        .withColumn("h", h)
        .withColumn("p", p)
        .withColumn("chunk", chunk)
        .withColumn("spot", F.explode(F.when(F.col("home"), at_home).otherwise(visiting)))
        .select(*cell, "spot.tile", "spot.role", "data")
    )


def _tile_links(groups: DataFrame, label: T.StructField, kind: str) -> DataFrame:
    """Per tile and vector its links and the smallest vector connected to it."""
    placed_type = T.StructType(
        [
            label,
            T.StructField("width", T.IntegerType()),
            T.StructField("block", T.IntegerType()),
            T.StructField("cell", T.LongType()),
            T.StructField("home", T.BooleanType()),
            T.StructField("members", T.LongType()),
            T.StructField("data", T.BinaryType()),
        ]
    )
    # placed twice, as writing what it gives would take more than the vectors
    placed = groups.select("label", "node", "embedding").mapInArrow(_places(kind), placed_type)
    sizes = settle(_sizes(placed), "cell-sizes")
    homes, all_ = F.col("homes").cast("double"), F.col("homes") + F.col("visits")
    work = sizes.agg(F.sum(homes * all_).alias("distances"), F.sum(all_).alias("members")).first()
    floor = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    partitions = max(
        floor, int((work.distances or 0) // DISTANCES_PER_TASK) + 1, (work.members or 0) // MEMBERS_PER_TASK + 1
    )
    hopeful_type = T.StructType(
        [
            *placed_type.fields[:4],
            T.StructField("tile", T.StringType()),
            T.StructField("role", T.IntegerType()),
            T.StructField("node", T.LongType()),
        ]
    )
    named = settle(
        _tiles(placed, sizes).repartition(partitions, *TILE_KEY).groupBy(*TILE_KEY).applyInArrow(_hopeful, hopeful_type),
        "hopeful",
    )
    found = settle(
        named.join(groups.select("node", "copies", "embedding"), "node")
        .groupBy(*TILE_KEY)
        .applyInArrow(_tile(kind), "node long, links long, root long"),
        "tile-links",
    )
    discard(sizes, named)
    return found


def near_vectors(vectors: DataFrame) -> DataFrame:
    """Per row of (vec_id, embedding, label): vec_id, n_links, component_id, kept."""
    element = vectors.schema["embedding"].dataType.elementType
    kind = "<f4" if isinstance(element, T.FloatType) else "<f8"
    e = F.col("embedding")
    finite = F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    sound = F.col("label").isNotNull() & (F.size(e) > 0) & finite & F.exists(e, lambda v: v != 0)
    node = F.when(F.coalesce(sound, F.lit(False)), F.xxhash64("label", "embedding"))
    rows = vectors.select("vec_id", "label", "embedding", node.alias("node"))
    base = settle(rows.select("vec_id", "node"), "vectors")
    groups = settle(
        rows.filter("node is not null")
        .groupBy("node")
        .agg(
            F.count(F.lit(1)).alias("copies"),
            F.first("label").alias("label"),
            F.first("embedding").alias("embedding"),
        ),
        "groups",
    )
    found = _tile_links(groups, vectors.schema["label"], kind)
    labels = connected(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    known = settle(
        groups.select("node", "copies")
        .join(links, "node", "left")
        .join(labels, "node", "left")
        .select(
            "node",
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "node").alias("component"),
        ),
        "known",
    )
    discard(groups, found, labels)
    owned = settle(base.join(known, "node", "left"), "owned")
    discard(base, known)
    least = settle(
        owned.filter("component is not null").groupBy("component").agg(F.min("vec_id").alias("least")),
        "least",
    )
    component = F.when(F.col("component").isNull(), F.col("vec_id")).otherwise(F.col("least"))
    return (
        owned.join(least, "component", "left")
        .withColumn("component_id", component)
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            "component_id",
            F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"),
        )
    )
