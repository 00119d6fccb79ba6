"""Mixing sources to target weights by pivotal dependent rounding.

A source's target is a share of the mix; its documents get the same expected
number of copies, target / source size. Whole copies are given outright. The
fractional rests are settled in pairs: words move at random from one document
of the pair to the other until one of the two has a whole number of copies, so
that the words taken stay what they were and every document's expectation
holds. The other one meets the next document.

Pairs are met inside buckets of about ``BUCKET`` documents; each bucket leaves
at most one undecided document. Those meet in the buckets of the next level,
and so on: a reduction tree whose nodes are bounded, whatever share of the rows
a source has. Larger documents come first in a bucket, so the last one, which
is rounded alone, tends to be small; what its rounding adds or takes is balanced
by turning over drawn documents of the source's first bucket.

Random numbers are hashes of document ids: reruns agree.

Defined cases: null text has size 0; documents of size 0 take no words and are
not drawn; the null source is a source and comes last; rows that repeat id,
source and size share their copies as evenly as whole numbers allow; a null id
is an id; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from placeweave.llm.texts import bind, words
from placeweave.session import discard, settle

MIX_PERCENT = 150
WEIGHTS = (5, 2, 1)
MAX_COPIES = 2
BUCKET = 512
SEED = 9_001
EDGE = 1e-9


def source_targets(sized: DataFrame) -> DataFrame:
    """(source, source_size, n, target) of rows (source, size).

    Targets fill up like connected vessels: every source below its limit stands
    at the same level per weight. One row per source goes through one task."""
    sources = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n")
    )
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weights = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    ranked = sources.withColumn("weight", F.get(weights, rank % len(WEIGHTS))).withColumn(
        "limit", F.lit(float(MAX_COPIES)) * F.col("source_size")
    )
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    left = F.sum("source_size").over(everything) * (MIX_PERCENT / 100) - F.coalesce(
        F.sum("limit").over(before), F.lit(0.0)
    )
    level = left / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    free = F.col("limit") / F.col("weight") > F.col("level")
    return (
        ranked.withColumn("level", level)
        .withColumn("stand", F.max(F.when(free, F.col("level"))).over(everything))
        .select(
            "source",
            "source_size",
            "n",
            F.when(free, F.col("weight") * F.col("stand")).otherwise(F.col("limit")).alias("target"),
        )
    )


def _uniform(*parts: Column) -> Column:
    return F.pmod(F.xxhash64(*parts, F.lit(SEED)), F.lit(1 << 40)) / float(1 << 40)


def _open(item: Column) -> Column:
    return (item["p"] > EDGE) & (item["p"] < 1 - EDGE)


def _transfer(a: Column, b: Column) -> Column:
    """The pair after words went from one to the other until one is whole."""

    def moved(most: Column) -> Column:
        to_a = _uniform(a["doc_id"], b["doc_id"], a["size"], b["size"]) * (
            most["to_a"] + most["to_b"]
        ) < most["to_b"]
        flow = F.when(to_a, most["to_a"]).otherwise(-most["to_b"])
        return F.array(
            a.withField("p", a["p"] + flow / a["size"]), b.withField("p", b["p"] - flow / b["size"])
        )

    return bind(
        F.struct(
            F.least((1 - a["p"]) * a["size"], b["p"] * b["size"]).alias("to_a"),
            F.least((1 - b["p"]) * b["size"], a["p"] * a["size"]).alias("to_b"),
        ),
        moved,
    )


def _settled(item: Column) -> Column:
    return item.withField("p", F.round(item["p"]))


def _fold(items: Column, kind: str) -> Column:
    """Struct of the decided items and the undecided one, if any, of a bucket."""
    none = F.array().cast(f"array<{kind}>")

    def step(state: Column, item: Column) -> Column:
        def divide(pair: Column) -> Column:
            return F.struct(
                F.filter(pair, _open).alias("open"),
                F.concat(
                    state["done"], F.transform(F.filter(pair, lambda i: ~_open(i)), _settled)
                ).alias("done"),
            )

        first = F.struct(F.array(item).alias("open"), state["done"].alias("done"))
        return F.when(F.size(state["open"]) == 0, first).otherwise(
            bind(_transfer(state["open"][0], item), divide)
        )

    return F.aggregate(items, F.struct(none.alias("open"), none.alias("done")), step)


def _round_level(nodes: DataFrame, kind: str) -> DataFrame:
    """(source, bucket, result) of rows (source, bucket, item)."""
    ordered = F.transform(
        F.sort_array(
            F.collect_list(
                F.struct(
                    (-F.col("item.size")).alias("first"),
                    F.xxhash64("item.doc_id", "item.size").alias("second"),
                    F.col("item"),
                )
            )
        ),
        lambda e: e["item"],
    )
    grouped = nodes.groupBy("source", "bucket").agg(ordered.alias("items"))
    return settle(
        grouped.select("source", "bucket", _fold(F.col("items"), kind).alias("result")), "pivotal"
    )


def _parts(level: DataFrame, field: str) -> DataFrame:
    return level.select("source", "bucket", F.explode(f"result.{field}").alias("item"))


def _balanced(items: Column, error: Column, kind: str) -> Column:
    """Drawn items, each turned over where that brings the error nearer to 0."""
    none = F.array().cast(f"array<{kind}>")

    def step(state: Column, item: Column) -> Column:
        change = F.when(item["p"] > 0.5, -item["size"]).otherwise(item["size"]).cast("double")
        turn = F.abs(state["error"] + change) < F.abs(state["error"])
        return F.struct(
            F.when(turn, state["error"] + change).otherwise(state["error"]).alias("error"),
            F.concat(
                state["done"], F.array(F.when(turn, item.withField("p", 1 - item["p"])).otherwise(item))
            ).alias("done"),
        )

    largest_first = F.transform(
        F.sort_array(
            F.transform(items, lambda i: F.struct((-i["size"]).alias("first"), i.alias("item")))
        ),
        lambda e: e["item"],
    )
    return F.aggregate(
        largest_first, F.struct(error.cast("double").alias("error"), none.alias("done")), step
    )["done"]


def draw_copies(sized: DataFrame) -> DataFrame:
    """(source, source_size, target, doc_id, size, m, copies) of rows (doc_id,
    source, size): copies for the m rows that agree in all three together.
    ``sized`` is read repeatedly and should be settled."""
    sources = settle(source_targets(sized), "sources")
    rows = sized.groupBy("source", "doc_id", "size").agg(F.count(F.lit(1)).alias("m"))
    known = sources.withColumnRenamed("source", "k_source")
    met = rows.join(known, rows["source"].eqNullSafe(known["k_source"])).drop("k_source")
    rate = F.when(F.col("size") > 0, F.col("m") * F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(F.col("rate") + EDGE).cast("long")
    items = met.withColumn("rate", rate).select(
        "source",
        F.pmod(
            F.xxhash64("doc_id", "size"), F.greatest(F.ceil(F.col("n") / BUCKET), F.lit(1)).cast("long")
        ).alias("bucket"),
        F.struct(
            "doc_id",
            "size",
            "m",
            whole.alias("whole"),
            F.greatest(F.col("rate") - whole, F.lit(0.0)).alias("p"),
        ).alias("item"),
    )
    kind = items.schema["item"].dataType.simpleString()
    drawn = _open(F.col("item"))
    decided = items.filter(~drawn).withColumn("item", _settled(F.col("item")))
    lowest = level = _round_level(items.filter(drawn), kind)
    widest = sources.agg(F.max("n")).first()[0] or 0
    buckets = -(-widest // BUCKET)
    while buckets > 1:
        up = _parts(level, "open").withColumn("bucket", F.floor(F.col("bucket") / BUCKET).cast("long"))
        level = _round_level(up, kind)
        decided = decided.unionByName(_parts(level, "done"))
        buckets = -(-buckets // BUCKET)
    luck = _uniform(F.col("item.doc_id"), F.col("item.size")) < F.col("item.p")
    last = settle(
        _parts(level, "open").select(
            F.col("source").alias("k_source"),
            F.col("item").withField("p", luck.cast("double")).alias("item"),
            ((luck.cast("double") - F.col("item.p")) * F.col("item.size")).alias("error"),
        ),
        "last",
    )
    decided = decided.unionByName(_parts(lowest.filter("bucket > 0"), "done"))
    errors = last.select("k_source", "error")
    first = lowest.filter("bucket = 0").join(
        errors, F.col("source").eqNullSafe(F.col("k_source")), "left"
    )
    done = _balanced(F.col("result.done"), F.coalesce("error", F.lit(0.0)), kind)
    decided = decided.unionByName(first.select("source", "bucket", F.explode(done).alias("item")))
    last = last.select(F.col("k_source").alias("source"), F.lit(0).cast("long").alias("bucket"), "item")
    per_row = decided.unionByName(last).select("source", "item.*")
    return per_row.join(known, per_row["source"].eqNullSafe(known["k_source"])).select(
        "source", "source_size", "target", "doc_id", "size", "m", (F.col("whole") + F.col("p").cast("long")).alias("copies")
    )


def _share(copies: Column, m: Column, number: Column) -> Column:
    """Copies of the row with this number (from 0) among m equal ones."""
    return F.floor(copies / m).cast("long") + (number < copies % m).cast("long")


def mix_report(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, taken, copies."""
    sized = settle(
        docs.select("doc_id", "source", F.size(words(F.col("text"))).cast("long").alias("size")), "sizes"
    )
    rows = draw_copies(sized).select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1)).alias("number")
    )
    copies = _share(F.col("copies"), F.col("m"), F.col("number"))
    return rows.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (copies * F.col("size")).alias("taken"),
        copies.alias("copies"),
    )


def _key(doc_id: Column, source: Column, size: Column) -> list[Column]:
    """What equal rows have in common, without nulls, so that plain joins and
    windows on it share an exchange."""
    return [
        F.coalesce(doc_id.cast("string"), F.lit("")).alias("k0"),
        doc_id.isNull().alias("k1"),
        F.coalesce(source, F.lit("")).alias("k2"),
        source.isNull().alias("k3"),
        size.alias("k4"),
    ]


def mixed(docs: DataFrame) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with their
    columns and nothing else. Documents without words are not in a mix."""
    size = F.size(words(F.col("text"))).cast("long")
    sized = settle(docs.select("doc_id", "source", size.alias("size")), "sizes")
    keys = ["k0", "k1", "k2", "k3", "k4"]
    drawn = draw_copies(sized).filter("copies > 0")
    drawn = settle(drawn.select(*_key(F.col("doc_id"), F.col("source"), F.col("size")), "m", "copies"), "drawn")
    discard(sized)
    # rows that agree in id, source and size are numbered; an id is one document
    # as a rule, so such a group is a row or two
    rows = docs.select(
        *_key(F.col("doc_id"), F.col("source"), size),
        F.xxhash64("text").alias("at"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
    )
    numbered = rows.withColumn("number", F.row_number().over(Window.partitionBy(*keys).orderBy("at")) - 1)
    times = _share(F.col("copies"), F.col("m"), F.col("number"))
    return (
        numbered.join(drawn, keys)
        .withColumn("times", times)
        .filter("times > 0")
        .withColumn("times", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
        .select("row.*")
    )
