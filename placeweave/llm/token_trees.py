"""Edit-aware token counts: a segment tree of pre-tokens per document.

The tokenizer's pattern cuts a text into pre-tokens, each of which is encoded on
its own. A document's tree has leaves of some ``LEAF`` pre-tokens; every node
knows the characters and tokens below it. An edit goes down the tree to the leaf
of the last character before it that isn't white space, cuts the text into
pre-tokens again from there, and stops at the first leaf boundary behind the edit
that the new cut hits: from there on the old pre-tokens stand, since the pattern
never looks back. Only
these pre-tokens are encoded; sums are updated on the paths to the root, or
added up again from the leaves where the number of leaves changes.

Trees are columns next to the text. Building and editing are each one pass
without a shuffle, document by document, so no group of documents matters.

Defined cases: null text counts as empty, has an empty tree and can be edited;
edits are cut to the text's bounds, applied in the order given, each with
offsets into the text that the ones before it left; a null list of edits is
empty, a null edit none, a null bound 0 and a null replacement empty; repeated
rows are edited each for itself; an empty table gives an empty table.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placeweave.functions.shipping import ship_by_value
from placeweave.llm.tokenizing import kept_by_worker, tokenizer_file

ship_by_value(__name__)

RANKS = "byte_bpe_50k.tiktoken"
LEAF = 32
PIECES_KEPT = 500_000
LONGEST_KEPT = 48
EDITS = "array<struct<start:long,end:long,text:string>>"


class Counter:
    """Tokens of pre-tokens."""

    def __init__(self, ranks: str):
        import public_tokenizers
        import regex
        import tiktoken

        with open(tokenizer_file(ranks), "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        pattern = public_tokenizers.PATTERN
        # the library's white space is Unicode's property, Python's is a little wider
        unicode = pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
        self.pattern = regex.compile(unicode)
        self.encoding = tiktoken.Encoding(
            "trees", pat_str=pattern, mergeable_ranks=table, special_tokens={}
        )
        self.known: dict[str, int] = {}

    def count(self, piece: str) -> int:
        n = self.known.get(piece)
        if n is None:
            n = len(self.encoding.encode_ordinary(piece))
            if len(piece) <= LONGEST_KEPT:
                if len(self.known) >= PIECES_KEPT:
                    self.known.clear()
                self.known[piece] = n
        return n

    def counts(self, pieces: list[str]) -> list[int]:
        get = self.known.get
        found = list(map(get, pieces))
        if None in found:
            found = [self.count(p) if n is None else n for p, n in zip(pieces, found)]
        return found


def _counter(ranks: str) -> Counter:
    return kept_by_worker(f"pieces:{ranks}", lambda: Counter(ranks))


class Tree:
    """Sums of characters and tokens over leaves, in heap order: the children of
    node i are 2i and 2i + 1, leaf k is node size + k."""

    def __init__(self, leaves: int, chars, tokens):
        self.leaves, self.chars, self.tokens = leaves, chars, tokens

    @classmethod
    def of_leaves(cls, chars: list[int], tokens: list[int]) -> Tree:
        size = 1 << max(0, len(chars) - 1).bit_length()
        sums = np.zeros((2, 2 * size), np.int64)
        sums[0, size : size + len(chars)] = chars
        sums[1, size : size + len(tokens)] = tokens
        while size > 1:
            sums[:, size // 2 : size] = sums[:, size : 2 * size : 2] + sums[:, size + 1 : 2 * size : 2]
            size //= 2
        return cls(len(chars), sums[0], sums[1])

    @property
    def size(self) -> int:
        return len(self.chars) // 2

    @property
    def total(self) -> int:
        return int(self.tokens[1])

    def leaf_at(self, offset: int) -> tuple[int, int]:
        """Leaf that holds the character ``offset``, and its first character."""
        node, start = 1, 0
        while node < self.size:
            node *= 2
            if offset - start >= self.chars[node] and self.chars[node + 1]:
                start += int(self.chars[node])
                node += 1
        return node - self.size, start

    def replace(self, low: int, high: int, chars: list[int], tokens: list[int]) -> Tree:
        """The tree with leaves low..high-1 replaced."""
        if len(chars) == high - low:
            for k, (c, t) in enumerate(zip(chars, tokens)):
                node = self.size + low + k
                more = c - self.chars[node], t - self.tokens[node]
                while node:
                    self.chars[node] += more[0]
                    self.tokens[node] += more[1]
                    node //= 2
            return self
        own = slice(self.size, self.size + self.leaves)
        old_chars, old_tokens = self.chars[own].tolist(), self.tokens[own].tolist()
        return Tree.of_leaves(
            old_chars[:low] + chars + old_chars[high:], old_tokens[:low] + tokens + old_tokens[high:]
        )


def _leaves(pieces: list[str], counts: list[int], number: int) -> tuple[list[int], list[int]]:
    """Pre-tokens dealt to ``number`` leaves."""
    chars, tokens = [], []
    for k in range(number):
        own = slice(k * len(pieces) // number, (k + 1) * len(pieces) // number)
        chars.append(sum(map(len, pieces[own])))
        tokens.append(sum(counts[own]))
    return chars, tokens


def build(text: str, counter: Counter) -> Tree:
    pieces = counter.pattern.findall(text)
    return Tree.of_leaves(*_leaves(pieces, counter.counts(pieces), -(-len(pieces) // LEAF)))


def edit(text: str, tree: Tree, start: int, end: int, new: str, counter: Counter):
    """Text and tree after characters start..end-1 became ``new``, and how many
    pre-tokens were encoded for it."""
    start = min(max(start, 0), len(text))
    end = min(max(end, start), len(text))
    out = text[:start] + new + text[end:]
    if not tree.leaves:
        fresh = build(out, counter)
        return out, fresh, len(counter.pattern.findall(out))
    # how white space is cut depends on what follows it, so the last character
    # in front of it is the first that can be relied on
    sure = start
    while sure and text[sure - 1].isspace():
        sure -= 1
    low, at = tree.leaf_at(max(sure - 1, 0))
    shift = len(out) - len(text)
    high, bound = low, at  # old leaf boundary, to be met at bound + shift
    pieces = []
    here = at
    for found in counter.pattern.finditer(out, at):
        pieces.append(found[0])
        here = found.end()
        while high < tree.leaves and (bound < end or bound + shift < here):
            bound += int(tree.chars[tree.size + high])
            high += 1
        if bound >= end and bound + shift == here:
            break
    if here == len(out):
        high = tree.leaves
    old = high - low
    # the same leaves where they stay of reasonable size
    number = old if old and old * LEAF // 4 <= len(pieces) <= 2 * old * LEAF else -(-len(pieces) // LEAF)
    return out, tree.replace(low, high, *_leaves(pieces, counter.counts(pieces), number)), len(pieces)


def _build(ranks: str):
    def run(batches):
        counter = _counter(ranks)
        for batch in batches:
            trees = [build(t or "", counter) for t in batch.column("text").to_pylist()]
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array([t.leaves for t in trees], pa.int64()),
                    pa.array([t.chars for t in trees], longs),
                    pa.array([t.tokens for t in trees], longs),
                ],
                names=[*batch.schema.names, "leaves", "node_chars", "node_tokens"],
            )

    return run


def build_trees(docs: DataFrame, ranks: str = RANKS) -> DataFrame:
    """``docs`` (doc_id, text, edits) with the tree: leaves, node_chars,
    node_tokens. The number of tokens is node_tokens[1]."""
    kept = docs.select("doc_id", "text", "edits")
    longs = T.ArrayType(T.LongType())
    out = T.StructType(
        [
            *kept.schema.fields,
            T.StructField("leaves", T.LongType()),
            T.StructField("node_chars", longs),
            T.StructField("node_tokens", longs),
        ]
    )
    return kept.mapInArrow(_build(ranks), out)


def _edit(ranks: str):
    def run(batches):
        counter = _counter(ranks)
        for batch in batches:
            columns = ("text", "edits", "leaves", "node_chars", "node_tokens")
            before, after, touched, texts, trees = [], [], [], [], []
            for text, edits, leaves, chars, tokens in zip(*(batch.column(c).to_pylist() for c in columns)):
                text, tree = text or "", Tree(leaves, np.array(chars), np.array(tokens))
                before.append(tree.total)
                encoded = 0
                for e in edits or ():
                    if e is not None:
                        text, tree, n = edit(
                            text, tree, e["start"] or 0, e["end"] or 0, e["text"] or "", counter
                        )
                        encoded += n
                after.append(tree.total)
                touched.append(encoded)
                texts.append(text)
                trees.append(tree)
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(texts, pa.string()),
                    pa.array(before, pa.int64()),
                    pa.array(after, pa.int64()),
                    pa.array(touched, pa.int64()),
                    pa.array([t.leaves for t in trees], pa.int64()),
                    pa.array([t.chars for t in trees], longs),
                    pa.array([t.tokens for t in trees], longs),
                ],
                names=[
                    "doc_id", "text", "n_tokens", "n_tokens_edited", "n_encoded",
                    "leaves", "node_chars", "node_tokens",
                ],
            )

    return run


def apply_edits(trees: DataFrame, ranks: str = RANKS) -> DataFrame:
    """Rows of ``build_trees`` (or of this function, with new edits) after their
    edits: doc_id, text, n_tokens (before), n_tokens_edited, n_encoded
    (pre-tokens that the edits had encoded) and the tree."""
    longs = T.ArrayType(T.LongType())
    out = T.StructType(
        [
            trees.schema["doc_id"],
            T.StructField("text", T.StringType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("n_tokens_edited", T.LongType()),
            T.StructField("n_encoded", T.LongType()),
            T.StructField("leaves", T.LongType()),
            T.StructField("node_chars", longs),
            T.StructField("node_tokens", longs),
        ]
    )
    columns = ("doc_id", "text", "edits", "leaves", "node_chars", "node_tokens")
    return trees.select(*columns).mapInArrow(_edit(ranks), out)


def revised(docs: DataFrame) -> DataFrame:
    """``docs`` with the revision that the query counts: the source's name goes
    before the text, the middle forty characters go, and the language's name
    comes where they were."""
    middle = F.floor(F.coalesce(F.char_length("text"), F.lit(0)) / 2).cast("long")
    name = F.coalesce(F.col("source"), F.lit(""))

    def change(start, end, text):
        return F.struct(start.alias("start"), end.alias("end"), text.alias("text"))

    edits = F.array(
        change(middle - 20, middle + 20, F.coalesce(F.col("lang"), F.lit(""))),
        change(F.lit(0).cast("long"), F.lit(0).cast("long"), name),
    )
    return docs.withColumn("edits", edits)


def edit_report(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_tokens, n_tokens_edited, n_encoded."""
    return apply_edits(build_trees(revised(docs))).select(
        "doc_id", "n_tokens", "n_tokens_edited", "n_encoded"
    )
