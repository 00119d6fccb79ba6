"""Ranked lexical search over hashed max-sketches of documents.

A term's impact in a document grows with how often it occurs there, so a sketch
keeps, per hashed coordinate, the most occurrences of any term that falls on it:
at query time its impact is at least that of each such term. Sketches are
``WIDTH`` coordinates wide and stored without the empty ones, counts over 254 as
"any number". Queries go in blocks of a bounded size; one pass over the sketches
looks all terms of a block up and adds weights into an upper bound per query
and document. The best ``FIRST`` bounds of each query are rescored exactly from
the texts; their k-th score is a threshold, and every further document whose
bound reaches it is rescored too. No other document can enter the result.

Documents are rescored where their texts lie: the few first candidates are
broadcast (their number is bounded by queries x ``FIRST``), the rest are joined.

Defined cases: null and empty texts have no terms, are never found, and count
neither in N nor in L; a query without terms has no results; a query given
several times (same id and text) counts once; repeated documents are ranked each
for itself; a null document id ranks after the others among equal scores; empty
tables give an empty table.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placeweave.functions.shipping import ship_by_value
from placeweave.llm.chunks import spread
from placeweave.session import discard, settle

ship_by_value(__name__)

WIDTH = 1 << 16
TOP = 10
FIRST = 64  # bounds of a query that are rescored for its threshold
QUERIES_AT_ONCE = 2000
QUERY_BYTES = 4 << 20  # texts of a block of queries
MOST = 255  # a count that stands for any number
CELLS_AT_ONCE = 1 << 21

# ASCII that belongs to no term becomes a blank, capitals become small.
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def terms(text: str | None) -> list[bytes]:
    """Terms of a text in order, as UTF-8."""
    return text.encode().translate(_TABLE).split(b" ") if text else []


def term_counts(text: str | None) -> Counter:
    counts = Counter(terms(text))
    counts.pop(b"", None)
    return counts


def impact(count: int, m: int) -> int:
    return 1_000_000_000 * count // (1000 * count + 8 * m)


def length_factor(n: int, documents: int, total: int) -> int:
    return 100 - 75 + 75 * n * documents // total


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def sketch(counts: Counter, width: int) -> tuple[bytes, bytes]:
    """Coordinates in order and the most occurrences of a term on each."""
    places = np.fromiter(map(zlib.crc32, counts), np.uint32, len(counts)) % np.uint32(width)
    most = np.minimum(np.fromiter(counts.values(), np.int64, len(counts)), MOST).astype(np.uint8)
    order = np.lexsort((most, places))
    places, most = places[order], most[order]
    last = np.append(places[1:] != places[:-1], True)
    return places[last].astype("<u4").tobytes(), most[last].tobytes()


def _sketches(width: int):
    def run(batches):
        for batch in batches:
            kept, sizes, places, most = [], [], [], []
            for row, text in enumerate(batch.column("text")):
                counts = term_counts(text.as_py())
                if counts:
                    where, tops = sketch(counts, width)
                    kept.append(row)
                    sizes.append(counts.total())
                    places.append(where)
                    most.append(tops)
            take = pa.array(kept, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(take),
                    batch.column("text_key").take(take),
                    pa.array(sizes, pa.int64()),
                    pa.array(places, pa.binary()),
                    pa.array(most, pa.binary()),
                ],
                names=["doc_id", "text_key", "n", "places", "most"],
            )

    return run


def sketches(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Documents with terms: doc_id, text_key, n (terms with repeats), places,
    most (the sketch)."""
    fields = [
        docs.schema["doc_id"],
        T.StructField("text_key", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("places", T.BinaryType()),
        T.StructField("most", T.BinaryType()),
    ]
    return _keyed(docs).mapInArrow(_sketches(width), T.StructType(fields))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")


def _holding(vocabulary: list[bytes]):
    def run(batches):
        number = {term: n for n, term in enumerate(vocabulary)}
        wanted = frozenset(vocabulary)
        counts = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            for text in batch.column("text"):
                met = wanted.intersection(terms(text.as_py()))
                counts[[number[t] for t in met]] += 1
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["term", "df"])

    return run


def holding_documents(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """(term, df): documents that hold each term of a bounded vocabulary, by its
    number; tasks count, so a row a task and term is shuffled."""
    counted = docs.select("text").mapInArrow(_holding(vocabulary), "term long, df long")
    return counted.groupBy("term").agg(F.sum("df").alias("df"))


class Queries:
    """A block of queries with the weights of their terms."""

    def __init__(self, counts: list[Counter], df: dict[bytes, int], documents: int, total: int, width: int):
        self.documents, self.total, self.width = documents, total, width
        # weight in the query's score, repeats included
        self.weights = [
            {t: n * weight(documents, df[t]) for t, n in c.items() if df.get(t)} for c in counts
        ]
        cells = Counter()
        for query, some in enumerate(self.weights):
            for term, value in some.items():
                cells[zlib.crc32(term) % width, query] += value
        keys = sorted(cells)
        self.starts = np.searchsorted([k for k, _ in keys], np.arange(width + 1)) if keys else np.zeros(width + 1, int)
        self.query = np.array([q for _, q in keys], np.int64)
        self.value = np.array([cells[k] for k in keys], np.float64)

    def factors(self, sizes: list[int]) -> np.ndarray:
        return np.array([length_factor(n, self.documents, self.total) for n in sizes], np.int64)

    def bounds(self, part: pa.RecordBatch) -> np.ndarray:
        """Documents x queries: no score is higher."""
        n_docs, n_queries = part.num_rows, len(self.weights)
        m = self.factors(part.column("n").to_pylist())
        tops = part.column("most").to_pylist()
        places = np.frombuffer(b"".join(part.column("places").to_pylist()), "<u4").astype(np.int64)
        most = np.frombuffer(b"".join(tops), np.uint8)
        doc = np.repeat(np.arange(n_docs), np.fromiter(map(len, tops), np.int64, n_docs))
        asked = np.diff(self.starts)[places]
        hit = np.flatnonzero(asked)
        places, doc, asked = places[hit], doc[hit], asked[hit]
        count = most[hit].astype(np.int64)
        best = 1_000_000_000 * count // (1000 * count + 8 * m[doc])
        best[count == MOST] = 1_000_000
        at = spread(self.starts[places], asked)
        cells = np.repeat(doc, asked) * n_queries + self.query[at]
        sums = np.bincount(cells, self.value[at] * np.repeat(best, asked), n_docs * n_queries)
        # sums of doubles: rounded up past any error
        return np.ceil(sums * (1 + 1e-9)).astype(np.int64).reshape(n_docs, n_queries)

    def score(self, query: int, counts: Counter, m: int) -> int:
        return sum(w * impact(counts[t], m) for t, w in self.weights[query].items() if t in counts)


def _parts(batches, n_queries: int) -> Iterator[pa.RecordBatch]:
    step = max(1, CELLS_AT_ONCE // max(1, n_queries))
    for batch in batches:
        for low in range(0, batch.num_rows, step):
            yield batch.slice(low, step)


_BOUNDS = ["query", "doc_id", "text_key", "bound"]


def _highest(queries: Queries, first: int):
    """The ``first`` highest bounds of each query in a task."""

    def run(batches):
        held = None
        for part in _parts(batches, len(queries.weights)):
            bounds = queries.bounds(part)
            doc, query = np.nonzero(bounds)
            found = pa.table(
                {
                    "query": pa.array(query),
                    "doc_id": part.column("doc_id").take(pa.array(doc)),
                    "text_key": part.column("text_key").take(pa.array(doc)),
                    "bound": pa.array(bounds[doc, query]),
                }
            )
            held = found if held is None else pa.concat_tables([held, found])
            query, bound = held.column("query").to_numpy(), held.column("bound").to_numpy()
            order = np.lexsort((-bound, query))
            starts = np.searchsorted(query[order], np.arange(len(queries.weights)))
            rank = np.arange(len(order)) - starts[query[order]]
            held = held.take(pa.array(order[rank < first]))
        if held is not None:
            yield from held.to_batches()

    return run


def _reaching(queries: Queries, limits: np.ndarray):
    """All pairs whose bound reaches the query's limit."""

    def run(batches):
        for part in _parts(batches, len(queries.weights)):
            bounds = queries.bounds(part)
            doc, query = np.nonzero(bounds >= limits[None, :])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(query),
                    part.column("doc_id").take(pa.array(doc)),
                    part.column("text_key").take(pa.array(doc)),
                    pa.array(bounds[doc, query]),
                ],
                names=_BOUNDS,
            )

    return run


def _exact(queries: Queries, top: int):
    """Exact scores of documents for the queries that each may answer; of a
    task's no more than ``top`` scores and their ties for a query."""

    def run(batches):
        best: dict[int, list[int]] = {}
        for batch in batches:
            rows, asked, scores = [], [], []
            texts, wanted = batch.column("text"), batch.column("queries").to_pylist()
            for row in range(batch.num_rows):
                counts = term_counts(texts[row].as_py())
                m = length_factor(counts.total(), queries.documents, queries.total)
                for query in wanted[row]:
                    score = queries.score(query, counts, m)
                    heap = best.setdefault(query, [])
                    if score <= 0 or (len(heap) == top and score < heap[0]):
                        continue
                    (heapq.heappush if len(heap) < top else heapq.heappushpop)(heap, score)
                    rows.append(row)
                    asked.append(query)
                    scores.append(score)
            take = pa.array(rows, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(asked, pa.int64()),
                    batch.column("doc_id").take(take),
                    batch.column("text_key").take(take),
                    pa.array(scores, pa.int64()),
                ],
                names=["query", "doc_id", "text_key", "score"],
            )

    return run


def _rescored(docs: DataFrame, pairs: DataFrame, queries: Queries, top: int, bounded: bool) -> DataFrame:
    """(query, doc_id, text_key, score) of candidate pairs, the best ``top`` of
    each query."""
    asked = pairs.groupBy(F.col("doc_id").alias("id"), F.col("text_key").alias("key")).agg(
        F.collect_set("query").alias("queries")
    )
    if bounded:
        asked = F.broadcast(asked)
    texts = _keyed(docs).join(asked, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("key")))
    fields = [
        T.StructField("query", T.LongType()),
        docs.schema["doc_id"],
        T.StructField("text_key", T.LongType()),
        T.StructField("score", T.LongType()),
    ]
    scored = texts.select("doc_id", "text_key", "text", "queries").mapInArrow(
        _exact(queries, top), T.StructType(fields)
    )
    by_score = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "text_key")
    return scored.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= top)


def _blocks_of_queries(items: DataFrame) -> Iterator[list]:
    """Distinct queries (id, text) in blocks of a bounded size."""
    given = items.select("item_id", "text").filter("text is not null").distinct()
    size = given.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("b")).first()
    blocks = max(-(-size.n // QUERIES_AT_ONCE), -(-(size.b or 0) // QUERY_BYTES))
    for block in range(blocks):
        yield given.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()


def search(
    docs: DataFrame, items: DataFrame, top: int = TOP, width: int = WIDTH, first: int = FIRST
) -> DataFrame:
    """The ``top`` documents of each query: item_id, rank, doc_id, score."""
    spark: SparkSession = docs.sparkSession
    first = max(first, top)
    kept = settle(sketches(docs, width), "sketches")
    size = kept.agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("total")).first()
    bounds_type = T.StructType(
        [
            T.StructField("query", T.LongType()),
            docs.schema["doc_id"],
            T.StructField("text_key", T.LongType()),
            T.StructField("bound", T.LongType()),
        ]
    )
    long = T.LongType()
    empty = T.StructType(
        [
            items.schema["item_id"],
            T.StructField("rank", T.IntegerType()),
            docs.schema["doc_id"],
            T.StructField("score", long),
        ]
    )
    results = spark.createDataFrame([], empty)
    for block in _blocks_of_queries(items) if size.n else ():
        counts = [term_counts(item.text) for item in block]
        vocabulary = sorted(set().union(*counts))
        df = {vocabulary[r.term]: r.df for r in holding_documents(docs, vocabulary).collect()}
        queries = Queries(counts, df, size.n, size.total, width)
        # the highest bounds give each query a threshold
        by_bound = Window.partitionBy("query").orderBy(F.desc("bound"))
        leading = kept.mapInArrow(_highest(queries, first), bounds_type)
        leading = leading.withColumn("r", F.row_number().over(by_bound)).filter(F.col("r") <= first)
        known = _rescored(docs, leading, queries, top, True).filter(F.col("rank") == top)
        limits = np.ones(len(block), np.int64)
        for row in known.select("query", "score").collect():
            limits[row.query] = row.score
        # whatever may still reach it
        pairs = settle(kept.mapInArrow(_reaching(queries, limits), bounds_type), "candidates")
        best = settle(_rescored(docs, pairs, queries, top, False), "ranked")
        discard(pairs)
        names = spark.createDataFrame(
            [(n, item.item_id) for n, item in enumerate(block)],
            T.StructType([T.StructField("query", long), items.schema["item_id"]]),
        )
        found = best.join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score")
        results = results.unionByName(found)
    discard(kept)
    return results


def oracle_sql() -> str:
    return """
with words as (
    select doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[0-9A-Za-z\\x{80}-\\x{10FFFF}]+')) as term
    from documents
),
tf as (select doc_id, term, count(*)::bigint as tf from words group by all),
sizes as (select doc_id, sum(tf)::bigint as n from tf group by all),
corpus as (select count(*)::bigint as docs, sum(n)::bigint as total from sizes),
df as (select term, count(*)::bigint as df from tf group by all),
asked as (
    select item_id, term, count(*)::bigint as times
    from (
        select item_id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[0-9A-Za-z\\x{80}-\\x{10FFFF}]+')) as term
        from benchmark
    )
    group by all
),
scores as (
    select item_id, doc_id,
        sum(times * floor(1000 * ln((2 * docs + 2)::double / (2 * df + 1)))::bigint
            * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // total))))::bigint as score
    from asked join df using (term) join tf using (term) join sizes using (doc_id), corpus
    group by all
),
ranked as (
    select *, row_number() over (partition by item_id order by score desc, doc_id) as rank
    from scores where score > 0
)
select item_id, rank::int as rank, doc_id, score from ranked where rank <= 10
"""
