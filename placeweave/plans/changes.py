"""Table changes by key: upserts, updates, deletes, retention, constraints."""

from __future__ import annotations

from pyspark.sql import functions as F

from placeweave.operators import keyed, tiers
from placeweave.plans.matching import _SCORED_SQL, place_tags
from placeweave.plans.places import PLACES_SQL, places
from placeweave.plans.registry import query, table
from placeweave.schemas import DEFAULT_TAG, ensure_columns


@query(
    "upsert_latest",
    sql="""SELECT user_id, event_id, event_type, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    WHERE rn = 1""",
)
def upsert_latest(spark, sf_dir):
    """Latest event per user: a table of first events takes in all events."""
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    first = keyed.one_per_key(events, ["user_id"], [F.col("ts"), F.col("event_id")])
    return keyed.upsert_rows(first, events, ["user_id"], ["ts", "event_id"]).drop("ts")


@query(
    "upsert_with_nulls",
    sql="""WITH spent AS (SELECT o_custkey, CASE WHEN count(*) > 3 THEN max(o_orderpriority) END AS seg FROM orders GROUP BY o_custkey)
    SELECT coalesce(c_custkey, o_custkey) AS c_custkey, c_name,
           CASE WHEN o_custkey IS NULL THEN c_mktsegment ELSE seg END AS c_mktsegment
    FROM customer FULL OUTER JOIN spent ON c_custkey = o_custkey""",
)
def upsert_with_nulls(spark, sf_dir):
    """A null in the new row overwrites the stored value."""
    many = F.count(F.lit(1)) > 3
    new = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.when(many, F.max("o_orderpriority")).alias("c_mktsegment")
    )
    base = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return keyed.upsert_columns(base, new, ["c_custkey"], ["c_mktsegment"])


@query(
    "apply_results_duplicates",
    sql="""WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_extendedprice DESC, l_linestatus DESC) AS rn FROM lineitem)
    SELECT o_orderkey, CASE WHEN l_orderkey IS NULL THEN o_orderstatus ELSE l_linestatus END AS o_orderstatus, l_linenumber
    FROM orders LEFT JOIN r ON o_orderkey = l_orderkey AND rn = 1""",
)
def apply_results_duplicates(spark, sf_dir):
    """Several results of a key: the last one counts, rows stay single."""
    results = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_linestatus").alias("o_orderstatus"), "l_linenumber",
        "l_extendedprice",
    )
    base = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return keyed.apply_results(base, results, "o_orderkey", ["l_linenumber", "l_extendedprice", "o_orderstatus"]).drop("l_extendedprice")


@query(
    "upsert_columns",
    sql="""WITH spent AS (SELECT o_custkey, sum(o_totalprice) AS total, max(o_orderpriority) AS seg
                          FROM orders GROUP BY o_custkey)
    SELECT coalesce(c_custkey, o_custkey) AS c_custkey, c_name, coalesce(seg, c_mktsegment) AS c_mktsegment,
           round(total, 2) AS total
    FROM customer FULL OUTER JOIN spent ON c_custkey = o_custkey""",
)
def upsert_columns(spark, sf_dir):
    """Customers updated, or inserted, from their orders, column by column."""
    orders = table(spark, sf_dir, "orders")
    new = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("total"), F.max("o_orderpriority").alias("c_mktsegment")
    )
    base = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return keyed.upsert_columns(base, new, ["c_custkey"], ["c_mktsegment", "total"])


@query(
    "fill_nulls_update",
    sql="""SELECT doc_id, coalesce(quality, -1) AS quality, coalesce(toxic, -1) AS toxic
    FROM documents LEFT JOIN labels USING (doc_id)""",
)
def fill_nulls_update(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    labelled = docs.join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return keyed.fill_nulls(labelled, {"quality": F.lit(-1), "toxic": F.lit(-1)})


@query(
    "flag_ids_update",
    sql="""SELECT c_custkey, CASE WHEN n_nationkey IS NOT NULL THEN 'NY' ELSE c_mktsegment END AS c_mktsegment
    FROM customer LEFT JOIN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1) ON c_nationkey = n_nationkey""",
)
def flag_ids_update(spark, sf_dir):
    """Set a constant on the customers of listed nations."""
    listed = table(spark, sf_dir, "nation").filter("n_regionkey = 1").select(
        F.col("n_nationkey").alias("c_nationkey")
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return keyed.set_where_in(customers, listed, "c_nationkey", "c_mktsegment", "NY").drop("c_nationkey")


@query(
    "apply_results",
    sql="""WITH r AS (SELECT l_orderkey, count(*) AS lines, round(sum(l_extendedprice), 2) AS o_totalprice
                      FROM lineitem GROUP BY l_orderkey)
    SELECT o_orderkey, coalesce(r.o_totalprice, orders.o_totalprice) AS o_totalprice, lines
    FROM orders LEFT JOIN r ON o_orderkey = l_orderkey""",
)
def apply_results(spark, sf_dir):
    """A batch of keyed results merged into the base with one join."""
    results = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("lines"), F.round(F.sum("l_extendedprice"), 2).alias("o_totalprice")
    )
    base = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return keyed.apply_results(base, results, "o_orderkey")


@query(
    "retain_ids",
    sql="""SELECT o_orderkey, o_custkey, round(o_totalprice, 2) AS o_totalprice FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
)
def retain_ids(spark, sf_dir):
    ids = table(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'").select(
        F.col("c_custkey").alias("o_custkey")
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.round("o_totalprice", 2).alias("o_totalprice"))
    return keyed.retain_ids(orders, ids, "o_custkey")


@query(
    "delete_ids",
    sql="""SELECT c_custkey, c_name FROM customer
    WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')""",
)
def delete_ids(spark, sf_dir):
    gone = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return keyed.delete_ids(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), gone, "c_custkey")


@query(
    "retain_pairs",
    sql="""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
    WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 25)
      AND l_suppkey IN (SELECT p_partkey FROM part WHERE p_size > 25)""",
)
def retain_pairs(spark, sf_dir):
    """Pairs of ids of which both are listed."""
    ids = table(spark, sf_dir, "part").filter("p_size > 25").select("p_partkey")
    pairs = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return keyed.retain_pairs(pairs, ids, "l_partkey", "l_suppkey")


@query(
    "exclude_null_aware",
    sql="""SELECT doc_id, n_chars FROM documents
    WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)""",
)
def exclude_null_aware(spark, sf_dir):
    listed = table(spark, sf_dir, "labels").filter("toxic = 1").select("doc_id")
    return keyed.exclude_null_aware(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), listed, "doc_id")


@query(
    "uniqueness_report",
    sql="SELECT md5(text) AS text_md5, count(*) AS rows FROM documents GROUP BY md5(text) HAVING count(*) > 1",
)
def uniqueness_report(spark, sf_dir):
    """Texts that occur more than once."""
    hashed = table(spark, sf_dir, "documents").select(F.md5(F.col("text").cast("binary")).alias("text_md5"))
    return keyed.uniqueness_violations(hashed, ["text_md5"])


@query(
    "uniqueness_report_pairs",
    sql="""SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def uniqueness_report_pairs(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return keyed.uniqueness_violations(lines, ["l_orderkey", "l_linenumber"])


@query(
    "soft_delete_live",
    sql="""SELECT o_orderkey, o_orderstatus FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""",
)
def soft_delete_live(spark, sf_dir):
    gone = table(spark, sf_dir, "customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return keyed.live_rows(keyed.soft_delete(orders, gone, "o_custkey")).select("o_orderkey", "o_orderstatus")


@query(
    "add_columns_defaults",
    sql="SELECT s_suppkey, s_name, 'blue' AS tag, false AS soft_deleted, CAST(NULL AS BIGINT) AS cell FROM supplier",
)
def add_columns_defaults(spark, sf_dir):
    base = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return ensure_columns(
        base,
        {"s_name": ("string", None), "tag": ("string", DEFAULT_TAG),
         "soft_deleted": ("boolean", False), "cell": ("long", None)},
    )


@query(
    "numbered_batches",
    sql="""SELECT event_id, user_id, CAST((row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) // 100 AS BIGINT) AS batch
    FROM events""",
)
def numbered_batches(spark, sf_dir):
    """Batches of 100 calls per user."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    order = [F.col("ts"), F.col("event_id")]
    return keyed.numbered_batches(events, ["user_id"], order, F.date_trunc("hour", "ts")).drop("ts")


@query(
    "step_metrics",
    sql=f"""{_SCORED_SQL}
    SELECT 'places' AS step, count(*) AS rows FROM poi
    UNION ALL SELECT 'tagged', count(*) FROM tags
    UNION ALL SELECT 'survivors', count(*) FROM poi WHERE contentid NOT IN (SELECT contentid FROM tags)""",
)
def step_metrics(spark, sf_dir):
    pois = places(spark, sf_dir)
    tags = place_tags(spark, sf_dir, pois)
    return keyed.step_metrics({"places": pois, "tagged": tags, "survivors": tiers.survivors(pois, tags)})


@query(
    "survivors_blue_union",
    sql=f"""{_SCORED_SQL}
    SELECT poi.contentid, title, coalesce(t.tag, 'blue') AS tag
    FROM poi LEFT JOIN (SELECT contentid, min(tag) AS tag FROM tags GROUP BY contentid) t ON t.contentid = poi.contentid""",
)
def survivors_blue_union(spark, sf_dir):
    pois = places(spark, sf_dir).select("contentid", "title", "latitude", "longitude", "cell")
    tags = place_tags(spark, sf_dir, pois)
    return tiers.one_tag_per_row(pois, tags).select("contentid", "title", "tag")


@query(
    "archive_duplicates",
    sql=f"""{_SCORED_SQL}
    SELECT poi.contentid, title, source, 0 AS word_count, tag FROM poi JOIN tags ON tags.contentid = poi.contentid""",
)
def archive_duplicates(spark, sf_dir):
    pois = places(spark, sf_dir)
    tags = place_tags(spark, sf_dir, pois)
    base = pois.select("contentid", "title", "source", F.lit(None).cast("int").alias("word_count"))
    return tiers.archive_duplicates(base, tags)


@query(
    "one_per_key",
    sql=f"""WITH {PLACES_SQL}
    SELECT cell, contentid, title FROM (
      SELECT *, row_number() OVER (PARTITION BY cell ORDER BY contentid) AS rn FROM poi) WHERE rn = 1""",
)
def one_per_key(spark, sf_dir):
    pois = places(spark, sf_dir).select("cell", "contentid", "title")
    return keyed.one_per_key(pois, ["cell"], [F.col("contentid")])
