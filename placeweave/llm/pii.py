"""Personal data by patterns and a skip-chain conditional random field.

Patterns give the base spans of each text. A random field over the document then
decides about words that no pattern matches: its nodes are the base spans, whose
labels are observed, and candidate words (with digits or an at sign, or equal to
the local part of an address of the text). Neighbouring nodes share a chain
potential; distant nodes with the same key (the same digits, or the same local
part) share a skip potential, so that a number that is an observed phone number
elsewhere in the text is one here too. A word is linked to the observed nodes of
its key next to it on both sides, whatever stands between, or to the first node
of its key where none is observed: evidence is one or two steps from every
repeat, unobserved repeats don't outvote it, and the graph grows with the text
and not with the square of its repeats. Loopy message passing runs over all
documents of a batch at once.

Shape and context weights, chain and skip potentials are fitted on the driver on
about ``SAMPLE_DOCS`` texts of at most ``SAMPLE_BYTES`` bytes, taken by hash.
Every text is then read whole, in one pass without a shuffle.

Defined cases: null text counts as empty; texts without candidates have no
spans; repeated rows are read alike; an empty table gives an empty table (and an
unfitted model); added spans never touch base spans and base spans always stay.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placeweave.functions.shipping import ship_by_value

ship_by_value(__name__)

KINDS = ("email", "ip", "card", "phone")
LABELS = ("other", *KINDS)

# The base patterns. An address is found from its at sign, so that
# long runs of letters are read once; the other patterns start where a run does.
AT_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

SPACE = "\x20\x09-\x0d"
WORD = re.compile(f"[^{SPACE}]+")
MARK = re.compile(f"[0-9@][^{SPACE}]*")
NOT_DIGIT = re.compile("[^0-9]+")
TRIMMED = "\"'()[]{}<>,;:!?*#$%&|."
BLANKS = frozenset(" \t\n\x0b\x0c\r")

SAMPLE_DOCS = 3000
SAMPLE_BYTES = 20_000
LEAST_KEY = 5
ROUNDS = 8
DAMPING = 0.5
CHAIN_REACH = 60  # characters between neighbours that share a potential
ALTERED_WEIGHT = 0.15
OBSERVED = -1e9  # of the labels that an observed node has not: no number of repeats outweighs it
CONTEXTS = 32
FEATURES = 22 + 2 * CONTEXTS


def emails(text: str) -> list[tuple[int, int]]:
    spans, last = [], 0
    for m in AT_DOMAIN.finditer(text):
        start = m.start()
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        if start < m.start():
            spans.append((start, m.end()))
            last = m.end()
    return spans


def _byte(part: str) -> bool:
    short = part.lstrip("0")
    return len(short) <= 3 and int(short or 0) <= 255


def _luhn(digits: str) -> bool:
    total = 0
    for at, d in enumerate(reversed(digits)):
        n = int(d) * (2 if at % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) in the order of kinds, then starts."""
    found = [(0, s, e) for s, e in emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(map(_byte, m[0].split("."))):
            found.append((1, *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = NOT_DIGIT.sub("", m[0])
            if 13 <= len(digits) <= 19 and _luhn(digits):
                found.append((2, *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(map(str.isdigit, m[0])) <= 15:
                found.append((3, *m.span()))
    return found


def _key(piece: str, kind: int | None) -> str:
    """What a repeat of the same datum has in common with it."""
    if kind == 0 or "@" in piece:
        return "a" + piece.split("@")[0].lower()
    digits = NOT_DIGIT.sub("", piece)
    return "d" + digits if len(digits) >= LEAST_KEY else ""


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Spans of words outside the base spans that may be personal data."""
    locals_ = {text[s:e].split("@")[0].lower() for k, s, e in base if k == 0}
    locals_ = {p for p in locals_ if len(p) >= LEAST_KEY}
    words = []
    if locals_:
        words = [m.span() for m in WORD.finditer(text)]
    else:
        for m in MARK.finditer(text):
            start = m.start()
            while start > 0 and text[start - 1] not in BLANKS:
                start -= 1
            words.append((start, m.end()))
    taken = sorted((s, e) for _, s, e in base)
    out, at = [], 0
    for start, end in words:
        while at < len(taken) and taken[at][1] <= start:
            at += 1
        if at < len(taken) and taken[at][0] < end:
            continue
        raw = text[start:end]
        piece = raw.lstrip(TRIMMED)
        start = end - len(piece)
        piece = piece.rstrip(TRIMMED)
        if not piece:
            continue
        numeric = sum(c in "0123456789" for c in piece) >= LEAST_KEY or "@" in piece
        if numeric or piece.lower() in locals_:
            out.append((start, start + len(piece)))
    return out


def features(text: str, start: int, end: int, piece: str | None = None) -> np.ndarray:
    """Shape of a word and the words around it."""
    piece = text[start:end] if piece is None else piece
    x = np.zeros(FEATURES)
    digits = sum(c in "0123456789" for c in piece)
    letters = sum(c.isalpha() for c in piece)
    x[0] = 1
    x[1 + int(np.searchsorted([1, 4, 7, 9, 12, 13, 20], digits, "right"))] = 1
    x[9] = "@" in piece
    x[10] = letters > 0
    x[11] = letters > digits
    x[12 + min(piece.count("."), 4)] = 1
    x[17] = "-" in piece
    x[18] = piece[:1] == "+"
    x[19] = "(" in piece or ")" in piece
    x[20] = len(piece) > 24
    x[21] = piece.isdigit()
    before = text[max(0, start - 32) : start].split()
    after = text[end : end + 32].split()
    if before:
        x[22 + zlib.crc32(before[-1].lower().encode()) % CONTEXTS] = 1
    if after:
        x[22 + CONTEXTS + zlib.crc32(after[0].lower().encode()) % CONTEXTS] = 1
    return x


def _keys_of(text: str, nodes) -> list[str]:
    """Key of every node. A word with digits is a repeat of an address where its
    letters are the local part of one, wherever that stands."""
    keys = [_key(text[s:e], None if label is None else label - 1) for s, e, label in nodes]
    for at, (s, e, label) in enumerate(nodes):
        if not keys[at] and label is None:
            keys[at] = "a" + text[s:e].lower()
    known = {k for k in keys if k[:1] == "a"}
    for at, (s, e, label) in enumerate(nodes):
        if label is None and keys[at][:1] == "d" and not text[s:e].isdigit():
            as_local = "a" + text[s:e].lower()
            keys[at] = as_local if as_local in known else keys[at]
    return keys


def document_graph(text: str):
    """Base spans and, where the text has candidates, nodes and edges: nodes are
    (start, end, label or None), edges (earlier, later, is skip)."""
    base = base_spans(text)
    words = candidates(text, base)
    if not words:
        return base, [], []
    nodes = sorted([(s, e, k + 1) for k, s, e in base] + [(s, e, None) for s, e in words], key=lambda n: n[:2])
    keys = _keys_of(text, nodes)
    edges, after, first, following = [], {}, {}, []
    for at in range(len(nodes) - 1, -1, -1):
        following.append(after.get(keys[at]))
        first[keys[at]] = at
        if nodes[at][2] is not None:
            after[keys[at]] = at
    following.reverse()
    before = {}
    for at, (start, _, label) in enumerate(nodes):
        if at and start - nodes[at - 1][1] <= CHAIN_REACH:
            edges.append((at - 1, at, 0))
        key = keys[at]
        if not key:
            continue
        if key in before:
            edges.append((before[key], at, 1))
        if label is not None:
            before[key] = at
        elif following[at] is not None:
            edges.append((at, following[at], 1))
        elif key not in before and first[key] != at:
            edges.append((first[key], at, 1))
    return base, nodes, edges


def _altered(piece: str, kind: int) -> str:
    """A base span as it looks when the pattern misses it."""
    if kind == 0:
        return piece.split("@")[0]
    if kind == 3:
        return max(piece.lstrip("+").split(" "), key=len)
    return piece.replace(" ", "")


def fit(texts: list[str], steps: int = 200) -> dict[str, np.ndarray]:
    """Weights (features x labels) and potentials (chain, skip: labels x labels)
    from the base spans of ``texts`` and the words that no pattern matches."""
    n = len(LABELS)
    rows, labels, weights = [], [], []
    chain, skip = np.zeros((n, n)), np.ones(2)
    for text in texts:
        base, nodes, edges = document_graph(text)
        for kind, s, e in base:
            rows.append(features(text, s, e, _altered(text[s:e], kind)))
            labels.append(kind + 1)
            weights.append(ALTERED_WEIGHT)
        for s, e, label in nodes:
            if label is None:
                rows.append(features(text, s, e))
                labels.append(0)
                weights.append(1.0)
        for u, v, is_skip in edges:
            a, b = nodes[u][2], nodes[v][2]
            if is_skip and a is not None and b is not None:
                skip[int(a == b)] += 1
            elif not is_skip and a is not None and b is not None:
                chain[a, b] += 1  # a word without a match says nothing about its neighbours
    w = np.zeros((FEATURES, n))
    if rows:
        x, y, c = np.array(rows), np.array(labels), np.array(weights)
        onehot = np.eye(n)[y]
        for _ in range(steps):
            z = x @ w
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            w -= 2.0 * (x.T @ ((p - onehot) * c[:, None]) / c.sum() + 1e-3 * w)
    # how much oftener two labels meet than by chance, drawn towards chance
    chance = chain.sum(1, keepdims=True) * chain.sum(0, keepdims=True) / max(chain.sum(), 1.0) ** 2
    oftener = (chain + 20 * chance + 1e-12) / (chance * (chain.sum() + 20) + 1e-12)
    agree = float(np.clip(np.log(skip[1] / skip[0]), 2.0, 5.0))
    return {
        "weights": w,
        "chain": np.clip(np.log(oftener), -1.0, 1.0),
        "skip": agree * np.eye(n),
    }


def beliefs(unary: np.ndarray, edges: np.ndarray, potentials: np.ndarray) -> np.ndarray:
    """Label probabilities by loopy message passing. edges: (from, to, type),
    potentials: type x labels x labels, all logarithms."""
    count, n = unary.shape
    total = unary.copy()
    if len(edges):
        source = np.concatenate([edges[:, 0], edges[:, 1]])
        target = np.concatenate([edges[:, 1], edges[:, 0]])
        half = len(edges)
        back = np.concatenate([np.arange(half, 2 * half), np.arange(half)])
        psi = np.concatenate([potentials[edges[:, 2]], potentials[edges[:, 2]].transpose(0, 2, 1)])
        messages = np.zeros((2 * half, n))
        for _ in range(ROUNDS):
            out = (total[source] - messages[back])[:, :, None] + psi
            top = out.max(1)
            new = top + np.log(np.exp(out - top[:, None, :]).sum(1))
            new -= new.max(1, keepdims=True)
            messages = DAMPING * messages + (1 - DAMPING) * new
            total = unary.copy()
            np.add.at(total, target, messages)
    p = np.exp(total - total.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def read_texts(texts: list[str], model: dict[str, np.ndarray]):
    """Per text: base spans and added spans, both (kind, start, end)."""
    bases, unary, edges, owners = [], [], [], []
    for number, text in enumerate(texts):
        base, nodes, links = document_graph(text)
        bases.append(base)
        first = len(owners)
        for s, e, label in nodes:
            owners.append((number, s, e, label))
            if label is None:
                unary.append(features(text, s, e) @ model["weights"])
            else:
                unary.append(np.where(np.arange(len(LABELS)) == label, 0.0, OBSERVED))
        edges += [(first + u, first + v, t) for u, v, t in links]
    added = [[] for _ in texts]
    if owners:
        p = beliefs(
            np.array(unary),
            np.array(edges, int).reshape(-1, 3),
            np.stack([model["chain"], model["skip"]]),
        )
        for (number, s, e, label), row in zip(owners, p):
            best = int(row.argmax())
            if label is None and best and row[best] > 0.5:
                added[number].append((best - 1, s, e))
    return list(zip(bases, added))


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


def _report(model):
    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            counts = [[] for _ in KINDS]
            digests, spans = [], []
            for base, added in read_texts(texts, model):
                for k in range(len(KINDS)):
                    counts[k].append(sum(b[0] == k for b in base))
                digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                spans.append(_joined([*base, *added]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *[pa.array(c, pa.int64()) for c in counts],
                    pa.array(digests, pa.string()),
                    pa.array(spans, pa.string()),
                ],
                names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"],
            )

    return run


def sample_texts(docs: DataFrame) -> list[str]:
    """About ``SAMPLE_DOCS`` texts: those with the lowest hashes, by a limit that
    follows from the number of rows."""
    share = SAMPLE_DOCS / max(1, docs.count())
    luck = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40)) / float(1 << 40)
    short = docs.filter((F.octet_length("text") <= SAMPLE_BYTES) & (luck < share))
    # equal rows fall together; the bound holds whatever their number
    return sorted(r.text for r in short.select("text").limit(2 * SAMPLE_DOCS).collect())


def pii_report(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, base findings of each kind, digest, all spans."""
    model = fit(sample_texts(docs))
    out = T.StructType(
        [
            docs.schema["doc_id"],
            *[T.StructField(f"n_{k}", T.LongType()) for k in KINDS],
            T.StructField("base_sha256", T.StringType()),
            T.StructField("spans", T.StringType()),
        ]
    )
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(_report(model), out)
