"""Counts, distributions, profiles and top rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from placeweave.functions import text
from placeweave.operators import reports
from placeweave.plans.places import PLACES_SQL, places
from placeweave.plans.registry import query, table
from placeweave.sources import readers

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

_WORDS_SQL = r"""
words AS (SELECT len(list_filter(regexp_split_to_array(coalesce(text, ''), '\s+'), lambda w: w <> '')) AS word_count FROM documents),
counts AS (SELECT word_count, count(*) AS frequency FROM words GROUP BY word_count)"""


def _word_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    counted = docs.select(text.word_count(F.col("text")).cast("long").alias("word_count"))
    return counted.groupBy("word_count").agg(F.count(F.lit(1)).alias("frequency"))


@query("word_histogram", sql=f"WITH {_WORDS_SQL} SELECT word_count, frequency FROM counts ORDER BY word_count")
def word_histogram(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    counted = docs.select(text.word_count(F.col("text")).cast("long").alias("word_count"))
    return reports.histogram(counted, "word_count")


@query(
    "word_cdf",
    sql=f"""WITH {_WORDS_SQL}
    SELECT word_count, round(sum(frequency) OVER (ORDER BY word_count) / sum(frequency) OVER (), 9) AS cumulative FROM counts""",
)
def word_cdf(spark, sf_dir):
    shares = reports.cumulative_share(_word_counts(spark, sf_dir), "word_count")
    return shares.select("word_count", F.round("cumulative", 9).alias("cumulative"))


@query(
    "word_boxplot",
    sql=f"""WITH {_WORDS_SQL},
    q AS (SELECT quantile_cont(frequency, 0.25) AS q1, quantile_cont(frequency, 0.5) AS median, quantile_cont(frequency, 0.75) AS q3 FROM counts)
    SELECT q1, median, q3, min(CASE WHEN inside THEN frequency END) AS whisker_low,
      max(CASE WHEN inside THEN frequency END) AS whisker_high, count(CASE WHEN NOT inside THEN 1 END) AS outliers
    FROM (SELECT *, frequency BETWEEN q1 - 1.5e0*(q3-q1) AND q3 + 1.5e0*(q3-q1) AS inside FROM counts, q)
    GROUP BY q1, median, q3""",
)
def word_boxplot(spark, sf_dir):
    """Box plot of the frequencies."""
    return reports.box_plot(_word_counts(spark, sf_dir), "frequency")


@query(
    "word_kde",
    sql=f"""WITH {_WORDS_SQL},
    s AS (SELECT count(*) AS n, stddev_samp(word_count)*pow(count(*), -0.2e0) AS h, min(word_count) AS lo, max(word_count) AS hi FROM counts),
    grid AS (SELECT CAST(p AS INTEGER) AS point, lo - 3*h + p*((hi - lo + 6*h)/199) AS x, h, n FROM s, range(0, 200) r(p))
    SELECT point, round(x, 4) AS x, round(sum(exp(-pow((x - word_count)/h, 2)/2))/(n*h*sqrt(2*pi())), 10) AS density
    FROM grid, counts GROUP BY point, x, n, h""",
)
def word_kde(spark, sf_dir):
    """Density of the distinct word counts at 200 points."""
    density = reports.kernel_density(_word_counts(spark, sf_dir), "word_count")
    return density.select("point", F.round("x", 4).alias("x"), F.round("density", 10).alias("density"))


@query(
    "block_occupancy",
    sql=f"WITH {PLACES_SQL} SELECT cell, count(cell) AS count FROM poi GROUP BY cell HAVING count(cell) > 1",
)
def block_occupancy(spark, sf_dir):
    return reports.block_occupancy(places(spark, sf_dir))


@query(
    "multi_occupancy_members",
    sql=f"""WITH {PLACES_SQL}
    SELECT contentid, title, cell FROM poi WHERE cell IN (SELECT cell FROM poi GROUP BY cell HAVING count(*) > 1)""",
)
def multi_occupancy_members(spark, sf_dir):
    return reports.multi_occupancy_members(places(spark, sf_dir).select("contentid", "title", "cell"))


@query(
    "count_distinct",
    sql="SELECT count(*) AS rows, count(DISTINCT user_id) AS users, count(DISTINCT event_type) AS types FROM events",
)
def count_distinct(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct("user_id").alias("users"),
        F.countDistinct("event_type").alias("types"),
    )


@query(
    "tag_domain_counts",
    sql="""SELECT c_mktsegment, coalesce(n, 0) AS rows
    FROM (VALUES ('BUILDING'), ('MACHINERY'), ('HOUSEHOLD'), ('AVIATION')) d(c_mktsegment)
    LEFT JOIN (SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY c_mktsegment) c USING (c_mktsegment)""",
)
def tag_domain_counts(spark, sf_dir):
    """Counts over a fixed list, absent values included."""
    domain = ["BUILDING", "MACHINERY", "HOUSEHOLD", "AVIATION"]
    return reports.tag_domain_counts(table(spark, sf_dir, "customer"), "c_mktsegment", domain)


@query(
    "cluster_bbox",
    sql=f"""WITH {PLACES_SQL}
    SELECT label AS cluster_label, round(min(latitude), 6) AS min_lat, round(max(latitude), 6) AS max_lat,
      round(min(longitude), 6) AS min_lon, round(max(longitude), 6) AS max_lon
    FROM poi JOIN embeddings ON vec_id = contentid GROUP BY label""",
)
def cluster_bbox(spark, sf_dir):
    clusters = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("contentid"), F.col("label").alias("cluster_label")
    )
    boxes = reports.cluster_bbox(places(spark, sf_dir).join(clusters, "contentid"), "cluster_label")
    return boxes.select("cluster_label", *[F.round(c, 6).alias(c) for c in boxes.columns[1:]])


@query(
    "table_profile",
    sql=" UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS rows,
        (SELECT string_agg(column_name, ', ' ORDER BY ordinal_position) FROM information_schema.columns WHERE table_name = '{t}') AS columns"""
        for t in TABLES
    ),
)
def table_profile(spark, sf_dir):
    return reports.table_profile({t: table(spark, sf_dir, t) for t in TABLES})


@query(
    "describe_columns",
    sql="""SELECT column_name, position, n FROM (
      SELECT column_name, CAST(ordinal_position - 1 AS INTEGER) AS position FROM information_schema.columns WHERE table_name = 'orders'),
      (SELECT count(*) AS n FROM orders)""",
)
def describe_columns(spark, sf_dir):
    """Column list of a table beside its number of rows."""
    orders = table(spark, sf_dir, "orders")
    rows = reports.count_rows(orders).select("rows").scalar()
    return readers.describe(orders).select("column_name", "position", rows.alias("n"))


@query(
    "first_rows",
    sql="SELECT o_orderkey, round(o_totalprice, 2) AS o_totalprice FROM orders ORDER BY orders.o_totalprice DESC, o_orderkey LIMIT 10",
)
def first_rows(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    top = reports.first_rows(orders, [F.col("o_totalprice").desc(), F.col("o_orderkey")])
    return top.select("o_orderkey", F.round("o_totalprice", 2).alias("o_totalprice"))


@query(
    "map_ready",
    sql=f"""WITH {PLACES_SQL}
    SELECT contentid, 'blue' AS color, concat('Title: ', title, chr(10), 'Description: ',
      CASE WHEN length(description) > 20 THEN concat(substr(description, 1, 20), '...') ELSE coalesce(description, '') END,
      chr(10), 'Source: ', source, chr(10), 'Id: ', contentid) AS popup FROM poi""",
)
def map_ready(spark, sf_dir):
    """Colour and popup text of each place (position line left out here)."""
    pois = places(spark, sf_dir).withColumns(
        {"tag": F.lit("blue"), "source_url": F.col("source"), "is_title_duplicate": F.lit(None).cast("boolean")}
    )
    ready = reports.map_ready(pois)
    return ready.select("contentid", "color", F.regexp_replace("popup", "\nPoint: [^\n]*$", "").alias("popup"))
