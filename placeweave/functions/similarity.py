"""Jaro-Winkler similarity and Damerau-Levenshtein distance.

Spark has neither, so both are Arrow-batched UDFs over NumPy arrays. Strings
are compared as UTF-8 bytes. ``title_bound`` is a native upper bound on
Jaro-Winkler, used in join conditions so that hopeless pairs never reach
Python.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType, StructField, StructType

from placeweave.functions.shipping import ship_by_value

ship_by_value(__name__)

# Prefix weight, longest prefix and the Jaro value above which
# the prefix counts.
PREFIX_WEIGHT = 0.1
PREFIX_LENGTH = 4
BOOST_ABOVE = 0.7

# Pairs scored together and bytes of one of their matrices: working arrays stay
# inside the caches.
_STEP_PAIRS = 4096
_STEP_BYTES = 1 << 18


class Titles:
    """Strings as rows of bytes, scored pair by pair of their numbers."""

    def __init__(self, texts: list[str]) -> None:
        self.matrix, self.sizes = _byte_matrix([t.encode("utf-8") for t in texts])


def _byte_matrix(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
    width = max(int(lengths.max(initial=0)), 1)
    matrix = np.zeros((len(texts), width), dtype=np.uint8)
    matrix[np.arange(width) < lengths[:, None]] = np.frombuffer(b"".join(texts), dtype=np.uint8)
    return matrix, lengths


def _common_prefix(a: np.ndarray, b: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    head = min(PREFIX_LENGTH, a.shape[1], b.shape[1])
    inside = np.arange(head) < shorter[:, None]
    return np.cumprod((a[:, :head] == b[:, :head]) & inside, axis=1).sum(axis=1)


_ONE, _EVERY = np.uint64(1), ~np.uint64(0)
# Bits at most ``reach`` away from position i, by reach and i.
_WINDOWS = np.array(
    [
        [sum(1 << p for p in range(max(0, i - reach), min(63, i + reach) + 1)) for i in range(64)]
        for reach in range(33)
    ],
    dtype=np.uint64,
)


def _places(matrix: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code of each byte, and per string and code the positions that hold it as
    bits; the last code, of absent bytes, has none."""
    inside = np.arange(matrix.shape[1]) < lengths[:, None]
    known = np.unique(matrix[inside])
    code = np.full(256, len(known), dtype=np.int64)
    code[known] = np.arange(len(known))
    table = np.zeros((len(matrix), len(known) + 1), dtype=np.uint64)
    for at in range(min(matrix.shape[1], 64)):
        rows = np.flatnonzero(inside[:, at])
        table[rows, code[matrix[rows, at]]] |= _ONE << np.uint64(at)
    return code, table


def _jaro_counts_words(a, la, lb, code, table, which) -> tuple[np.ndarray, np.ndarray]:
    """Common bytes and out-of-order bytes for strings of at most 64 bytes.

    One machine word per string marks the positions of the second that are
    still free, so that each byte of ``a`` costs a few word operations per pair.
    ``which``: rows of the second strings in ``table``.
    """
    n, none = len(la), table.shape[1] - 1
    reach = np.maximum(np.maximum(la, lb) // 2 - 1, 0)
    inside = np.where(lb == 0, np.uint64(0), _EVERY >> (64 - np.maximum(lb, 1)).astype(np.uint64))
    free = inside.copy()
    codes = np.where(np.arange(a.shape[1]) < la[:, None], code[a], none).T + which * (none + 1)
    same = table.ravel().take(codes)
    taken = np.empty((a.shape[1], n), dtype=np.uint64)
    for i in range(a.shape[1]):
        hit = same[i] & free
        hit &= _WINDOWS[:, i].take(reach)
        hit &= np.negative(hit)
        free ^= hit
        np.minimum(hit, _ONE, out=taken[i])
    common = taken.sum(axis=0).astype(np.int64)
    left = inside & ~free
    moved = np.zeros(n, dtype=np.uint64)
    for i in range(a.shape[1]):
        first = left & np.negative(left)
        first *= taken[i]
        left ^= first
        first &= ~same[i]
        moved += np.minimum(first, _ONE, out=first)
    return common, moved.astype(np.int64) // 2


def _packed(matrix: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Move the chosen bytes of each row to its front, in order."""
    order = np.argsort(~chosen, axis=1, kind="stable")
    return np.take_along_axis(matrix, order, axis=1)


def _jaro_counts_long(a, la, b, lb) -> tuple[np.ndarray, np.ndarray]:
    """The same counts for strings of any length."""
    rows = np.arange(len(la))
    reach = np.maximum(np.maximum(la, lb) // 2 - 1, 0)[:, None]
    position = np.arange(b.shape[1])[None, :]
    free = position < lb[:, None]
    taken_a = np.zeros(a.shape, dtype=bool)
    for i in range(a.shape[1]):
        hit = free & (b == a[:, i : i + 1]) & (np.abs(position - i) <= reach)
        hit[i >= la] = False
        first = hit.argmax(axis=1)
        found = hit[rows, first]
        taken_a[:, i] = found
        free[rows[found], first[found]] = False
    taken_b = ~free & (position < lb[:, None])
    common = taken_a.sum(axis=1)
    width = min(a.shape[1], b.shape[1])
    differ = _packed(a, taken_a)[:, :width] != _packed(b, taken_b)[:, :width]
    return common, (differ & (np.arange(width) < common[:, None])).sum(axis=1) // 2


def _steps(longest: np.ndarray):
    """Numbers of pairs to score together, short ones first."""
    order = np.argsort(longest, kind="stable")
    start = 0
    while start < len(order):
        least = max(int(longest[order[start]]), 1)
        size = max(1, min(len(order) - start, _STEP_PAIRS, _STEP_BYTES // least))
        while size > 1 and longest[order[start + size - 1]] > least + 8 + least // 8:
            size = max(1, size // 2)
        yield order[start : start + size]
        start += size


def jaro_winkler_at(left: Titles, i: np.ndarray, right: Titles, j: np.ndarray) -> np.ndarray:
    """Scores of the pairs (row i of ``left``, row j of ``right``)."""
    out = np.empty(len(i))
    longest = np.maximum(left.sizes[i], right.sizes[j])
    known = None
    for part in _steps(longest):
        p, q = i[part], j[part]
        la, lb = left.sizes[p], right.sizes[q]
        a = left.matrix[p, : max(int(la.max()), 1)]
        b = right.matrix[q, : max(int(lb.max()), 1)]
        if int(longest[part[-1]]) <= 64:
            known = known or _places(right.matrix, right.sizes)
            common, moved = _jaro_counts_words(a, la, lb, *known, q)
        else:
            common, moved = _jaro_counts_long(a, la, b, lb)
        with np.errstate(divide="ignore", invalid="ignore"):
            jaro = (common / la + common / lb + (common - moved) / common) / 3.0
        jaro = np.where(common == 0, 0.0, jaro)
        boosted = jaro + _common_prefix(a, b, np.minimum(la, lb)) * PREFIX_WEIGHT * (1.0 - jaro)
        out[part] = np.where(jaro > BOOST_ABOVE, boosted, jaro)
    return out


def _running_least(rows: np.ndarray) -> None:
    """Each row becomes the least of itself and those before."""
    for k in range(1, len(rows)):
        np.minimum(rows[k], rows[k - 1], out=rows[k])


def _damerau_rows(a, la, b, lb) -> np.ndarray:
    """Unrestricted Damerau distance, one row of the table at a time.

    A swap over gaps on both sides never beats other edits, so one of its ends
    is a neighbour: swaps with the neighbour in ``b`` remember their best start
    per column, those with the neighbour in ``a`` have it two rows up. Along a
    row, insertions and the second kind are running minima.
    """
    n, wa, wb = len(la), a.shape[1], b.shape[1]
    widest = max(wa, wb)
    kind = np.int8 if widest <= 58 else np.int16 if widest <= 16000 else np.int32
    far = kind(widest + 4)
    at, bt = np.ascontiguousarray(a.T), np.ascontiguousarray(b.T)
    step = np.arange(wb + 1, dtype=kind)[:, None]
    columns = step[1:]
    above, row = None, np.repeat(step, n, axis=1)
    starts = np.full((wb, n), far)
    out = lb.copy()
    lane = np.arange(n)
    for i in range(1, wa + 1):
        differ = (bt != at[i - 1]).view(np.int8).astype(kind, copy=False)
        # the greater of a value and ``barred`` is far where bytes differ
        barred = differ * kind(2 * far)
        barred -= far
        best = row[:-1] + differ
        np.minimum(best, row[1:] + kind(1), out=best)
        if wb > 1:
            swapped = starts[1:] + kind(i)
            np.maximum(swapped, barred[:-1], out=swapped)
            np.minimum(best[1:], swapped, out=best[1:])
            begun = row[:-2] - kind(i)
            np.maximum(begun, barred[1:], out=begun)
            np.minimum(starts[1:], begun, out=starts[1:])
            if above is not None:
                since = above[:-2] - columns[:-1]
                np.maximum(since, barred[:-1], out=since)
                _running_least(since)
                since += columns[1:]
                np.maximum(since, barred_above[1:], out=since)
                np.minimum(best[1:], since, out=best[1:])
        line = np.empty((wb + 1, n), dtype=kind)
        line[0] = i
        np.subtract(best, columns, out=line[1:])
        _running_least(line)
        line += step
        ends = np.flatnonzero(la == i)
        out[ends] = line[lb[ends], lane[ends]]
        above, row, barred_above = row, line, barred
    return out.astype(np.float64)


def damerau_at(left: Titles, i: np.ndarray, right: Titles, j: np.ndarray) -> np.ndarray:
    """Distances of the pairs (row i of ``left``, row j of ``right``)."""
    out = np.empty(len(i))
    for part in _steps(np.maximum(left.sizes[i], right.sizes[j])):
        p, q = i[part], j[part]
        la, lb = left.sizes[p], right.sizes[q]
        a = left.matrix[p, : max(int(la.max()), 1)]
        b = right.matrix[q, : max(int(lb.max()), 1)]
        out[part] = _damerau_rows(a, la, b, lb)
    return out


def _distinct_pairs(a: pd.Series, b: pd.Series):
    """Where both strings are present, the distinct pairs there as numbers of
    two lists of titles, and the pair of each such place."""
    present = (a.notna() & b.notna()).to_numpy()
    # Arrow's encoding, as that of pandas ends strings at a NUL
    one, two = (pa.array(x[present], pa.string()).dictionary_encode() for x in (a, b))
    number = max(len(two.dictionary), 1)
    codes = one.indices.to_numpy().astype(np.int64) * number + two.indices.to_numpy()
    codes, back = np.unique(codes, return_inverse=True)
    i, j = np.divmod(codes, number)
    return present, (Titles(one.dictionary.to_pylist()), i, Titles(two.dictionary.to_pylist()), j), back


def _over_pairs(a: pd.Series, b: pd.Series, scores) -> pd.Series:
    """Apply ``scores`` once per distinct pair of a batch, short pairs together."""
    out = np.full(len(a), np.nan)
    present, pairs, back = _distinct_pairs(a, b)
    out[present] = scores(*pairs)[back]
    return pd.Series(out)


@pandas_udf(DoubleType())
def jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    return _over_pairs(a, b, jaro_winkler_at)


@pandas_udf(DoubleType())
def damerau_levenshtein(a: pd.Series, b: pd.Series) -> pd.Series:
    return _over_pairs(a, b, damerau_at)


# Declared non-deterministic only to keep the optimizer from running a score
# again for each filter and column that uses it.
jaro_winkler = jaro_winkler.asNondeterministic()
damerau_levenshtein = damerau_levenshtein.asNondeterministic()


def title_scores(min_score: float | None = None):
    """Both scores in one pass as a struct ``(jw, edits)``; edits are counted
    only for pairs above ``min_score`` and null for the others."""

    @pandas_udf(StructType([StructField("jw", DoubleType()), StructField("edits", DoubleType())]))
    def scores(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        present, (left, i, right, j), back = _distinct_pairs(a, b)
        jw = jaro_winkler_at(left, i, right, j)
        above = np.full(len(jw), True) if min_score is None else jw > min_score
        edits = np.full(len(jw), np.nan)
        edits[above] = damerau_at(left, i[above], right, j[above])
        out = np.full((2, len(a)), np.nan)
        out[:, present] = np.stack([jw, edits])[:, back]
        return pd.DataFrame({"jw": out[0], "edits": out[1]})

    return scores.asNondeterministic()


# --- native bound ----------------------------------------------------------

# Bytes counted together; everything else falls in a last group.
BYTE_GROUPS = ["e", "t", "a", "o", "i", "n", "s", "r", "h", "l", "du", "cm", "gpbfywvk"]
# Seven counters of eight bits share a long; a counter holds up to 127.
_LANES = 7
_LONGEST_COUNTED = 127
_HIGH_BITS = sum(0x80 << (8 * lane) for lane in range(_LANES))


def _counters(c: Column, size: Column) -> tuple[Column, Column]:
    """Characters of each group, the last one up to ``size``, in two longs."""
    groups = F.array(*[F.lit(g) for g in BYTE_GROUPS])
    counted = F.transform(
        groups, lambda g: F.length(c) - F.length(F.call_function("translate", c, g, F.lit("")))
    )
    others = size - F.aggregate(counted, F.lit(0), lambda total, n: total + n)
    counts = F.concat(counted, F.array(others))

    def packed(start: int) -> Column:
        return F.aggregate(
            F.slice(counts, start, _LANES),
            F.lit(0).cast("long"),
            lambda word, n: F.shiftleft(word, 8) + F.least(n, F.lit(_LONGEST_COUNTED)),
        )

    return packed(1), packed(1 + _LANES)


def _surplus(p: str, q: str) -> str:
    """SQL: by how much the counters of ``p`` exceed those of ``q``, added up."""
    lanes = f"(({p} | {_HIGH_BITS}L) - {q})"
    return f"(({lanes} & (shiftrightunsigned({lanes} & {_HIGH_BITS}L, 7) * 127L)) % 255L)"


def letter_counts(c: Column) -> list[Column]:
    """Columns that ``edits_may_be`` needs: characters, and their number per group."""
    low, high = _counters(c, F.length(c))
    return [F.length(c).alias("size"), low.alias("low"), high.alias("high")]


def edits_may_be(p: list[str], q: list[str], most: int) -> Column:
    """False only for counted strings more than ``most`` edits apart: an edit
    takes away or adds at most one character of a group. Takes the names of the
    columns of ``letter_counts``."""
    one, two = (f"{_surplus(a[1], b[1])} + {_surplus(a[2], b[2])} <= {most}" for a, b in ((p, q), (q, p)))
    return F.expr(f"greatest({p[0]}, {q[0]}) > {_LONGEST_COUNTED} OR ({one} AND {two})")


def title_profile(c: Column) -> Column:
    """Struct that ``title_may_exceed`` needs: byte length, the first four
    bytes as a number and the number of bytes per group, packed into two longs."""
    size = F.octet_length(c)
    low, high = _counters(c, size)
    first = F.rpad(F.hex(F.substring(F.encode(c, "UTF-8"), 1, PREFIX_LENGTH)), 2 * PREFIX_LENGTH, "0")
    return F.struct(
        size.alias("size"),
        F.conv(first, 16, 10).cast("long").alias("head"),
        low.alias("low"),
        high.alias("high"),
    )


def _overlap_needed(p: str, q: str, threshold: float) -> str:
    """Least value of common/size1 + common/size2 for a score above the
    threshold, by the length of the common prefix."""

    def needed(prefix: int) -> str:
        if threshold <= BOOST_ABOVE:
            jaro = threshold
        else:
            weight = prefix * PREFIX_WEIGHT
            jaro = max(BOOST_ABOVE, (threshold - weight) / (1 - weight))
        return f"{3 * jaro - 1!r}D"

    if threshold <= BOOST_ABOVE:
        return needed(0)
    differ = f"({p}.head ^ {q}.head)"
    cases = [f"WHEN {differ} >= {256 ** (3 - n)} THEN {needed(n)}" for n in range(PREFIX_LENGTH)]
    return f"CASE {' '.join(cases)} ELSE {needed(PREFIX_LENGTH)} END"


def title_may_exceed(
    p: str, q: str, threshold: float, looser: float | None = None, when: str | None = None
) -> Column:
    """False only for profiled titles whose Jaro-Winkler score cannot exceed
    the threshold (``looser`` where the condition ``when`` holds).

    No more bytes can match than the two titles share, group by group. All
    counters of a long are subtracted at once; those that went below zero lost
    their high bit and are masked out, the others add up by a remainder.
    Takes the names of the profile columns, because the expression is SQL
    text. It is kept short, as the JVM does not compile very long methods.
    """
    needed = _overlap_needed(p, q, threshold)
    if looser is not None:
        needed = f"CASE WHEN {when} THEN {_overlap_needed(p, q, looser)} ELSE {needed} END"

    shared = f"({p}.size - {_surplus(p + '.low', q + '.low')} - {_surplus(p + '.high', q + '.high')})"
    return F.expr(
        f"greatest({p}.size, {q}.size) > {_LONGEST_COUNTED} OR {shared} * ({p}.size + {q}.size) "
        f"> ({needed}) * {p}.size * {q}.size - 1e-3D"
    )
