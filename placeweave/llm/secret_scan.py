"""Secret scans over an incremental ledger of blobs.

Every version of every document is addressed by the SHA-256 of its text. The
ledger holds a row for each (blob, rule version) that was scanned, findings or
none. A scan adds rows only for pairs that the ledger lacks: a text that
returns, in another document or at another time, isn't scanned again, and a new
rule version scans what the old one has seen without repeating the other
rules. Findings are joined back to all documents that hold the blob.

Copies collapse before the shuffle (one text per blob and task), so a text that
a third of all documents share is no special case; the join back to the paths
is left to adaptive execution to split, as both sides are plain scans.

Defined cases: null text counts as empty and has no findings; repeated rows and
null ids are paths like others; an empty table adds nothing to the ledger and
gives an empty table; a missing ledger is an empty one; a ledger that two runs wrote at once may hold a pair
twice, which is read once.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placeweave.functions.shipping import ship_by_value
from placeweave.llm.texts import fresh_name
from placeweave.session import scratch_path, settle

ship_by_value(__name__)

# The three base kinds, in the order of equal starts, then more.
KINDS = ("assign", "access", "hex", "pem", "prefixed")
ASSIGN = re.compile(
    r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_LEAST = 6
# A run that is long enough from its start is a run's first match, so the
# least lengths can stand in the patterns.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
PEM = re.compile(r"-----(BEGIN|END) [A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?-----")
# Lines of a key without an END: what may stand before one (also as ``\\n`` in a
# quoted string), header lines, and base64 of a line's usual length or less.
PEM_LEAD = re.compile(r"""(?:\\[nrt]|[\s>#*;|"',+]|(?:--+|//+)(?=[\x20\t]))*+""")
PEM_HEADER = re.compile(r"(?:Proc-Type|DEK-Info|Version|Comment|Hash|Charset|MessageID):[^\n\\]*+")
PEM_LINE = re.compile(r"[A-Za-z0-9+/]++={0,2}|=[A-Za-z0-9+/]{4}(?![A-Za-z0-9+/])")
PEM_LINE_END = re.compile(r"""["',+;]*+[\x20\t]*+(?:\\[nr]|[\r\n]|\Z)""")
PEM_LEAST = 16
PREFIXED = re.compile(r"gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}")

# Rule version to the kinds it finds. keys@1 found the BEGIN line of a key only.
RULES = {"base@1": ("assign", "access", "hex"), "keys@1.1": ("pem", "prefixed")}

LEDGER_SCHEMA = "blob binary, rule_version string, findings array<struct<start:int,rank:int,end:int>>"


def _key_end(text: str, at: int) -> int:
    """End of the key material from ``at`` on, where no END line shows it: lines
    of base64, of which a short one is the last."""
    end, material = at, False
    while True:
        start = PEM_LEAD.match(text, end).end()
        header = None if material else PEM_HEADER.match(text, start)
        if header:
            end = header.end()
            continue
        line = PEM_LINE.match(text, start)
        if not line:
            return end
        whole = PEM_LINE_END.match(text, line.end())
        size = line.end() - start
        if size >= PEM_LEAST:
            end, material = line.end(), True
        elif whole or material and (size % 4 == 0 or line[0][0] == "="):
            # OpenPGP has a checksum after the short line
            checksum = PEM_LINE.match(text, PEM_LEAD.match(text, line.end()).end())
            return checksum.end() if checksum and checksum[0][0] == "=" else line.end()
        else:
            return end


def private_keys(text: str) -> list[tuple[int, int]]:
    """Spans of private keys: from BEGIN to END, or to the end of the material
    where the text or the next BEGIN comes before an END."""
    spans = []
    marks = list(PEM.finditer(text)) if "PRIVATE KEY" in text else []
    for at, mark in enumerate(marks):
        if mark[1] == "BEGIN":
            closed = at + 1 < len(marks) and marks[at + 1][1] == "END"
            spans.append((mark.start(), marks[at + 1].end() if closed else _key_end(text, mark.end())))
    return spans


def find(text: str, kind: str) -> list[tuple[int, int]]:
    """Spans of a kind, leftmost and non-overlapping."""
    if kind == "assign":
        return [m.span() for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if kind == "pem":
        return private_keys(text)
    pattern = {"access": ACCESS, "hex": HEX, "prefixed": PREFIXED}[kind]
    return [m.span() for m in pattern.finditer(text)]


def _findings(text: str, rule: str) -> list[dict[str, int]]:
    return [
        {"start": s, "rank": KINDS.index(kind), "end": e}
        for kind in RULES[rule]
        for s, e in find(text, kind)
    ]


_LEDGER_ARROW = pa.schema(
    [
        ("blob", pa.binary()),
        ("rule_version", pa.string()),
        (
            "findings",
            pa.list_(pa.struct([("start", pa.int32()), ("rank", pa.int32()), ("end", pa.int32())])),
        ),
    ]
)


def _scan(batches):
    for batch in batches:
        blobs, rules, found = [], [], []
        columns = zip(*(batch.column(c).to_pylist() for c in ("blob", "text", "missing")))
        for blob, text, missing in columns:
            for rule in missing:
                blobs.append(blob)
                rules.append(rule)
                found.append(_findings(text, rule))
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, f.type) for v, f in zip((blobs, rules, found), _LEDGER_ARROW)],
            schema=_LEDGER_ARROW,
        )


def blob_of(text: Column) -> Column:
    """Address of a text: SHA-256, with null as the empty text."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def update_ledger(docs: DataFrame, ledger: str, first: bool = False, rules: Iterable[str] | None = None) -> None:
    """Scan the texts of ``docs`` under ``rules`` (all, unless some are given)
    for the pairs that ``ledger`` (a path) lacks and append them. ``first``:
    there is no ledger yet, so nothing is looked up."""
    spark = docs.sparkSession
    texts = docs.select(blob_of(F.col("text")).alias("blob"), F.coalesce("text", F.lit("")).alias("text"))
    wanted = F.array(*[F.lit(r) for r in (RULES if rules is None else rules)])
    if first:
        todo = texts.dropDuplicates(["blob"]).withColumn("missing", wanted)
    else:
        seen = read_ledger(spark, ledger).groupBy("blob").agg(F.collect_set("rule_version").alias("seen"))
        missing = F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>")))
        todo = (
            texts.dropDuplicates(["blob"])
            .join(seen, "blob", "left")
            .withColumn("missing", missing)
            .filter(F.size("missing") > 0)
            .drop("seen")
        )
    todo.mapInArrow(_scan, LEDGER_SCHEMA).write.mode("append").parquet(ledger)


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """Rows of a ledger; one that doesn't exist yet has none."""
    place = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    if not place.getFileSystem(spark._jsc.sc().hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(ledger)


def findings_of(docs: DataFrame, ledger: str) -> DataFrame:
    """(blob, found) of the blobs with findings under the present rules; found:
    start, rank of the kind and end, in that order."""
    rows = read_ledger(docs.sparkSession, ledger).filter(
        F.col("rule_version").isin(*RULES) & (F.size("findings") > 0)
    )
    return settle(
        rows.dropDuplicates(["blob", "rule_version"])
        .groupBy("blob")
        .agg(F.sort_array(F.flatten(F.collect_list("findings"))).alias("found")),
        "findings",
    )


def _joined(found: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(found, lambda f: F.concat_ws(":", F.get(names, f["rank"]), f["start"], f["end"])), ","
    )


def secret_report(docs: DataFrame, ledger: str | None = None) -> DataFrame:
    """Per document: doc_id, findings of each base kind, digest, all spans."""
    first = ledger is None
    ledger = ledger or scratch_path(docs.sparkSession, "ledger")
    update_ledger(docs, ledger, first)
    paths = docs.select("doc_id", blob_of(F.col("text")).alias("blob"))
    found = F.coalesce("found", F.array().cast("array<struct<start:int,rank:int,end:int>>"))

    def count(rank: int) -> Column:
        return F.size(F.filter("found", lambda f: f["rank"] == rank)).cast("long")

    counts = [count(rank).alias(f"n_{kind}") for rank, kind in enumerate(KINDS[:3])]
    base = F.filter("found", lambda f: f["rank"] < 3)
    return (
        paths.join(findings_of(docs, ledger), "blob", "left")
        .withColumn("found", found)
        .select(
            "doc_id",
            *counts,
            F.sha2(_joined(base), 256).alias("base_sha256"),
            _joined(F.col("found")).alias("spans"),
        )
    )


def _merged(found: Column) -> Column:
    """Spans in order, overlapping and touching ones as one."""
    kind = "array<struct<start:int,end:int>>"

    def add(done: Column, f: Column) -> Column:
        last = F.element_at(done, -1)
        span = F.struct(f["start"].alias("start"), f["end"].alias("end"))
        wider = F.struct(last["start"].alias("start"), F.greatest(last["end"], f["end"]).alias("end"))
        return (
            F.when(F.size(done) == 0, F.array(span))
            .when(f["start"] <= last["end"], F.concat(F.slice(done, 1, F.size(done) - 1), F.array(wider)))
            .otherwise(F.concat(done, F.array(span)))
        )

    return F.aggregate(found, F.array().cast(kind), add)


def redact(docs: DataFrame, mask: str = "[SECRET]", ledger: str | None = None) -> DataFrame:
    """The documents with every finding replaced by ``mask``; ``n_chars``, where
    it is a column, follows the text."""
    first = ledger is None
    ledger = ledger or scratch_path(docs.sparkSession, "ledger")
    update_ledger(docs, ledger, first)
    blob, found = fresh_name(docs, "blob"), fresh_name(docs, "found")
    known = findings_of(docs, ledger).toDF(blob, found)
    met = docs.withColumn(blob, blob_of(F.col("text"))).join(known, blob, "left")
    cut = F.aggregate(
        F.reverse(_merged(F.col(found))),
        F.col("text"),
        lambda t, f: F.concat(F.substring(t, F.lit(1), f["start"]), F.lit(mask), F.substr(t, f["end"] + 1)),
    )
    hit = F.col(found).isNotNull()
    columns = []
    met = met.withColumn("text", F.when(hit, cut).otherwise(F.col("text")))
    for name in docs.columns:
        if name == "n_chars":
            kept = F.col("n_chars")
            columns.append(
                F.when(hit, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(kept).alias(name)
            )
        else:
            columns.append(F.col(f"`{name}`"))
    return met.select(*columns)
