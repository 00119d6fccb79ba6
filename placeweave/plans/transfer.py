"""Sources and sinks: each query writes to the shared folder and reads back."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placeweave import schemas
from placeweave.operators import ingest, keyed, reports
from placeweave.plans.geography import CUSTOMER_AREAS_SQL, customer_areas
from placeweave.plans.places import PLACES_SQL, places
from placeweave.plans.registry import query, table
from placeweave.session import scratch_path, settle
from placeweave.sources import json_elements, keyed_table, readers, writers


@query(
    "csv_jsonl_roundtrip",
    sql="SELECT CAST(conv_id AS VARCHAR) AS conv_id, CAST(turn AS VARCHAR) AS turn, role, md5(text) AS text_md5 FROM conversations",
)
def csv_jsonl_roundtrip(spark, sf_dir):
    """Table to CSV, CSV to JSON lines, everything a string. Texts with line
    breaks travel as JSON strings, so that CSV files stay splittable."""
    csv, jsonl = scratch_path(spark, "csv"), scratch_path(spark, "jsonl")
    talk = table(spark, sf_dir, "conversations")
    writers.export_csv(talk.withColumn("text", F.array("text")), csv)
    writers.csv_to_jsonl(spark, csv, jsonl)
    back = readers.read_jsonl(spark, jsonl, "conv_id string, turn string, role string, text string", "fail")
    text = F.from_json("text", "array<string>")[0]
    return back.select("conv_id", "turn", "role", F.md5(text.cast("binary")).alias("text_md5"))


@query(
    "csv_typed_append",
    sql="SELECT o_orderkey, o_custkey, count(*) AS copies FROM (SELECT * FROM orders UNION ALL SELECT * FROM orders) GROUP BY o_orderkey, o_custkey",
)
def csv_typed_append(spark, sf_dir):
    """Two appends to a CSV folder, read with a schema; no header in between."""
    path = scratch_path(spark, "csv")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    writers.export_csv(orders, path, "overwrite")
    writers.export_csv(orders, path, "append")
    back = readers.read_csv(spark, path, "o_orderkey long, o_custkey long")
    return back.groupBy("o_orderkey", "o_custkey").agg(F.count(F.lit(1)).alias("copies"))


@query(
    "malformed_json_scan",
    sql="SELECT event_id, user_id, round(value, 2) AS value FROM events WHERE event_type <> 'error'",
)
def malformed_json_scan(spark, sf_dir):
    """JSON lines of which some are cut off; those are dropped."""
    path = scratch_path(spark, "jsonl")
    events = table(spark, sf_dir, "events")
    line = F.to_json(F.struct("event_id", "user_id", "value"))
    broken = F.concat(F.lit("{"), F.col("event_id").cast("string"))
    events.select(F.when(F.col("event_type") == "error", broken).otherwise(line).alias("value")).write.text(path)
    back = readers.read_jsonl(spark, path, "event_id long, user_id long, value double", "drop")
    return back.select("event_id", "user_id", F.round("value", 2).alias("value"))


@query(
    "ingest_places",
    sql=f"""WITH {PLACES_SQL}
    SELECT contentid, title, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude, 2 AS images, 'blue' AS tag,
      CAST(floor((CAST(CAST(latitude AS FLOAT) AS DOUBLE)+90)/(180/pow(2e0,14))) AS BIGINT)*4294967296
      + CAST(floor((CAST(CAST(longitude AS FLOAT) AS DOUBLE)+180)/(180/pow(2e0,14))) AS BIGINT) AS cell_coarse
    FROM (SELECT CAST(contentid AS VARCHAR) AS contentid, title, latitude, longitude FROM poi)""",
)
def ingest_places(spark, sf_dir):
    """Raw JSON lines, loaded twice, to the typed place table."""
    path = scratch_path(spark, "raw")
    pois = places(spark, sf_dir)
    raw = pois.select(
        F.col("contentid").cast("string"), "title", "source",
        F.col("latitude").cast("string"), F.col("longitude").cast("string"),
        F.lit("a.jpg,b.jpg").alias("image_urls"),
    )
    writers.export_jsonl(raw.withColumnRenamed("source", "source_url"), path)
    first = ingest.ingest(spark, path)
    again = ingest.ingest(spark, path, existing=first)
    return again.select(
        "contentid", "title", F.round("latitude", 6).alias("latitude"), F.round("longitude", 6).alias("longitude"),
        F.size("image_urls").alias("images"), "tag", "cell_coarse",
    )


@query(
    "export_by_cell",
    sql=f"WITH {PLACES_SQL} SELECT contentid, title, cell AS cell_coarse, round(latitude, 6) AS latitude FROM poi",
)
def export_by_cell(spark, sf_dir):
    """The narrow export, cells descending, read back."""
    path = scratch_path(spark, "export")
    pois = places(spark, sf_dir).withColumns(
        {"cell_coarse": F.col("cell"), "cell_fine": F.lit(None).cast("long"), "city": F.lit(None).cast("string")}
    )
    writers.export_by_cell(pois, path)
    back = readers.read_jsonl(spark, path, "contentid long, title string, cell_coarse long, latitude double")
    return back.withColumn("latitude", F.round("latitude", 6))


@query(
    "geojson_roundtrip",
    sql=f"WITH {CUSTOMER_AREAS_SQL} SELECT n_name, 1 AS rings, 5 AS corners, round(lon, 6) AS x, round(lat - 6e-2, 6) AS y FROM areas",
)
def geojson_roundtrip(spark, sf_dir):
    """Polygon features written one per line and read back as rings."""
    path = scratch_path(spark, "geojson")
    rings = F.transform("rings", lambda r: F.transform(r, lambda p: F.array(p["x"], p["y"])))
    features = customer_areas(spark, sf_dir).select(
        F.lit("Feature").alias("type"),
        F.struct(F.lit("Polygon").alias("type"), rings.alias("coordinates")).alias("geometry"),
        F.struct("n_name").alias("properties"),
    )
    writers.export_geojson(features, path)
    back = readers.read_geojson(spark, path, lines=True)
    ring = F.col("rings")[0]
    return back.select(
        F.get_json_object("properties", "$.n_name").alias("n_name"),
        F.size("rings").alias("rings"), F.size(ring).alias("corners"),
        F.round(ring[0]["x"], 6).alias("x"), F.round(ring[0]["y"], 6).alias("y"),
    )


@query(
    "json_array_counts",
    sql="SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY c_mktsegment",
)
def json_array_counts(spark, sf_dir):
    """An aggregate as one JSON array in part files, read back."""
    path = scratch_path(spark, "array")
    counts = table(spark, sf_dir, "customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    writers.export_json_array(counts, path)
    return readers.read_array_parts(spark, path, "c_mktsegment string, n long")


@query(
    "object_arrays",
    sql="SELECT doc_id, lang, md5(text) AS text_md5, CAST(n_chars AS BIGINT) AS n_chars FROM documents",
)
def object_arrays(spark, sf_dir):
    """Foreign files of one long JSON array each, cut at braces wherever they
    lie; texts hold quotes, backslashes and braces."""
    path = scratch_path(spark, "arrays")
    docs = table(spark, sf_dir, "documents")
    tricky = F.concat(F.lit('{"}\\'), F.coalesce("text", F.lit("")), F.lit('\\"}{['))
    body = F.struct("lang", F.when(F.col("text").isNotNull(), tricky).alias("text"), F.array("n_chars").alias("sizes"))
    element = F.to_json(F.struct("doc_id", body.alias("body")))
    arrays = docs.groupBy(F.floor(F.col("doc_id") / 200).alias("part")).agg(F.collect_list(element).alias("e"))
    arrays.select(F.concat(F.lit("["), F.array_join("e", ",\n"), F.lit("]"))).write.text(path)
    back = json_elements.read_object_array(
        spark, path, "doc_id long, body struct<lang: string, text: string, sizes: array<long>>"
    )
    text = F.expr("substring(body.text, 5, length(body.text) - 9)")
    return back.select(
        "doc_id", "body.lang", F.md5(text.cast("binary")).alias("text_md5"), F.col("body.sizes")[0].alias("n_chars")
    )


@query(
    "geojson_collection",
    sql="""SELECT c_name, CASE WHEN c_custkey % 10 <> 0 THEN 1 END AS rings, CASE WHEN c_custkey % 10 <> 0 THEN c_custkey % 170 + 1e0 END AS x,
      CASE WHEN c_custkey % 10 <> 0 THEN c_custkey % 80 + 0e0 END AS y FROM customer""",
)
def geojson_collection(spark, sf_dir):
    """Feature collections of a thousand polygons, some without a geometry,
    written in the foreign form and read by many tasks."""
    path = scratch_path(spark, "collection")
    customers = table(spark, sf_dir, "customer")
    x, y = F.col("c_custkey") % 170 + F.lit(0.0), F.col("c_custkey") % 80 + F.lit(0.0)
    corners = [(x, y), (x + 1, y), (x + 1, y + 1), (x, y)]
    shape = F.struct(
        F.lit("Polygon").alias("type"), F.array(F.array(*[F.array(*c) for c in corners])).alias("coordinates")
    )
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct("c_name").alias("properties"),
        F.when(F.col("c_custkey") % 10 != 0, shape).alias("geometry"),
    )
    written = F.to_json(feature, {"ignoreNullFields": "false"})
    parts = customers.groupBy(F.floor(F.col("c_custkey") / 1000).alias("part")).agg(F.collect_list(written).alias("e"))
    opening = '{"type":"FeatureCollection","crs":{"type":"name","properties":{"name":"CRS84"}},"features":['
    parts.select(F.concat(F.lit(opening), F.array_join("e", ","), F.lit("]}"))).write.text(path)
    ring = F.col("rings")[0]
    return readers.read_geojson(spark, path).select(
        F.get_json_object("properties", "$.c_name").alias("c_name"),
        F.size("rings").alias("rings"), ring[1]["x"].alias("x"), ring[1]["y"].alias("y"),
    )


@query(
    "upsert_table",
    sql="SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'REPLACED' ELSE c_name END AS c_name FROM customer",
)
def upsert_table(spark, sf_dir):
    """Keyed replace of a stored table."""
    path = scratch_path(spark, "table")
    customers = table(spark, sf_dir, "customer")
    writers.replace_table(customers.select("c_custkey", "c_name"), path)
    new = customers.filter("c_mktsegment = 'BUILDING'").select("c_custkey", F.lit("REPLACED").alias("c_name"))
    writers.upsert_table(spark, path, new, ["c_custkey"])
    return readers.read_table(spark, path)


@query(
    "keyed_table_versions",
    sql="""SELECT c_custkey, c_name, 1 AS version FROM customer
    UNION ALL SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'REPLACED' ELSE c_name END, 2 FROM customer
    UNION ALL SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'REPLACED' ELSE c_name END, 3 FROM customer
      WHERE c_nationkey <> 7""",
)
def keyed_table_versions(spark, sf_dir):
    """Three versions of a keyed table: created, rows replaced, rows deleted."""
    customers = table(spark, sf_dir, "customer")
    stored = keyed_table.KeyedTable.create(
        customers.select("c_custkey", "c_name"), scratch_path(spark, "keyed"), ["c_custkey"], buckets=16
    )
    stored.upsert(customers.filter("c_mktsegment = 'BUILDING'").select("c_custkey", F.lit("REPLACED").alias("c_name")))
    stored.delete(customers.filter("c_nationkey = 7").select("c_custkey"))
    out = None
    for version in stored.versions():
        rows = stored.read(version).withColumn("version", F.lit(version))
        out = rows if out is None else out.unionByName(rows)
    return out


@query(
    "clustered_export",
    sql=f"WITH {PLACES_SQL} SELECT cell, count(*) AS count FROM poi GROUP BY cell HAVING count(*) >= 3",
)
def clustered_export(spark, sf_dir):
    """Table sorted by cell in its files, then grouped."""
    path = scratch_path(spark, "clustered")
    writers.export_clustered(places(spark, sf_dir).select("contentid", "cell"), path)
    return reports.block_occupancy(readers.read_table(spark, path), min_count=3)


@query(
    "review_append",
    sql=f"""WITH {PLACES_SQL}
    SELECT title, count(*) AS rows FROM (SELECT title FROM poi UNION ALL SELECT title FROM poi) GROUP BY title""",
)
def review_append(spark, sf_dir):
    """The review projection appended twice."""
    path = scratch_path(spark, "review")
    pois = places(spark, sf_dir).withColumn("is_title_duplicate", F.lit(False))
    writers.export_review(pois, path)
    writers.export_review(pois, path)
    back = readers.read_jsonl(spark, path, "title string, description string")
    return back.groupBy("title").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "coordinates_present",
    sql="""SELECT vec_id IS NOT NULL AS present, count(*) AS rows FROM documents LEFT JOIN embeddings ON vec_id = doc_id GROUP BY 1""",
)
def coordinates_present(spark, sf_dir):
    """Rows with and without a position, here the first two vector entries."""
    vecs = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("doc_id"), F.col("embedding")[0].alias("latitude"), F.col("embedding")[1].alias("longitude")
    )
    rows = keyed.apply_results(table(spark, sf_dir, "documents").select("doc_id"), vecs, "doc_id")
    present = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    return rows.groupBy(present.alias("present")).agg(F.count(F.lit(1)).alias("rows"))


@query(
    "multi_occupancy_export",
    sql=f"""WITH {PLACES_SQL}
    SELECT contentid, title, cell FROM poi WHERE cell IN (SELECT cell FROM poi GROUP BY cell HAVING count(*) > 1)""",
)
def multi_occupancy_export(spark, sf_dir):
    """Places of shared cells as JSON lines, read back."""
    path = scratch_path(spark, "shared-cells")
    members = reports.multi_occupancy_members(places(spark, sf_dir).select("contentid", "title", "cell"))
    writers.export_jsonl(members, path)
    return readers.read_jsonl(spark, path, "contentid long, title string, cell long", "fail")


@query(
    "saved_grouped_table",
    sql=f"WITH {PLACES_SQL} SELECT cell, count(*) AS count FROM poi GROUP BY cell HAVING count(*) > 1",
)
def saved_grouped_table(spark, sf_dir):
    """A grouped query kept as a catalogue table, read back by its name."""
    name = f"shared_cells_{uuid.uuid4().hex}"
    writers.save_as_table(reports.block_occupancy(places(spark, sf_dir).select("contentid", "cell"), min_count=2), name)
    kept = settle(readers.read_table(spark, name))
    spark.sql(f"DROP TABLE {name}")
    return kept


@query(
    "catalogue_listing",
    sql="""SELECT 'listed_nation' AS table_name, count(*) AS rows FROM nation
    UNION ALL SELECT 'listed_orders', count(*) FROM orders UNION ALL SELECT 'listed_supplier', count(*) FROM supplier""",
)
def catalogue_listing(spark, sf_dir):
    """Names from the catalogue, each with the rows of its table."""
    for name in ("nation", "orders", "supplier"):
        table(spark, sf_dir, name).createOrReplaceTempView(f"listed_{name}")
    counts = [
        spark.table(f"listed_{name}").agg(F.lit(f"listed_{name}").alias("table_name"), F.count(F.lit(1)).alias("rows"))
        for name in ("nation", "orders", "supplier")
    ]
    return readers.list_tables(spark).join(reduce(DataFrame.unionByName, counts), "table_name")


@query(
    "table_from_schema",
    sql=f"""WITH {PLACES_SQL}
    SELECT contentid, title, cell, CAST(NULL AS VARCHAR) AS tag, 'first' AS batch FROM poi WHERE contentid % 2 = 0
    UNION ALL SELECT contentid, title, cell, CAST(NULL AS VARCHAR), 'clone' FROM poi WHERE contentid % 2 = 1""",
)
def table_from_schema(spark, sf_dir):
    """A table made from a schema and one made like it, both filled."""
    kind = T.StructType.fromDDL("contentid long, title string, cell long, tag string, batch string")
    first, clone = scratch_path(spark, "made"), scratch_path(spark, "cloned")
    schemas.empty_table(spark, kind).write.parquet(first)
    schemas.empty_like(readers.read_table(spark, first)).write.parquet(clone)
    pois = places(spark, sf_dir)
    for path, odd, batch in ((first, 0, "first"), (clone, 1, "clone")):
        rows = pois.filter(F.pmod("contentid", F.lit(2)) == odd).withColumn("batch", F.lit(batch))
        schemas.conform(rows, readers.read_table(spark, path).schema).write.mode("append").parquet(path)
    return readers.read_table(spark, first).unionByName(readers.read_table(spark, clone))
