"""JSON documents: flattening, reconciliation, fallback, membership.

The documents are built from the tables as JSON text first, so every parser
reads what a service would have stored.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from placeweave.functions import vectors
from placeweave.operators import documents as docs
from placeweave.operators import ingest
from placeweave.plans.places import PLACES_SQL, places
from placeweave.plans.registry import query, table


def _component(long_, short, *types):
    return F.struct(
        long_.cast("string").alias("longText"),
        short.cast("string").alias("shortText"),
        F.array(*[F.lit(t) for t in types]).alias("types"),
    )


def _customers(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))


@query(
    "address_pivot",
    sql="""SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS street_number, r_name AS neighborhood, n_name AS administrative_area_level_1,
      concat('N', n_nationkey) AS state, r_name AS country, r_name AS city, c_mktsegment AS sublocality,
      c_mktsegment AS sublocality_level_1,
      concat(c_custkey, ', ', r_name, ', ', c_mktsegment, ', ', c_mktsegment, ', ', n_name, ', ', r_name, ', ', r_name) AS formatted_address
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def address_pivot(spark, sf_dir):
    """Components to columns: two neighbourhoods (last value, first place),
    components with two types, a state that the joined text leaves out."""
    blank = F.lit("")
    components = F.array(
        _component(F.col("c_custkey"), blank, "street_number"),
        _component(F.col("c_name"), blank, "neighborhood", "political"),
        _component(F.col("c_mktsegment"), blank, "sublocality_level_1", "sublocality", "political"),
        _component(F.col("n_name"), F.concat(F.lit("N"), F.col("n_nationkey")), "administrative_area_level_1"),
        _component(F.col("r_name"), blank, "country", "locality"),
        _component(F.col("r_name"), blank, "neighborhood"),
    )
    rows = _customers(spark, sf_dir).select("c_custkey", F.to_json(components).alias("components"))
    return docs.pivot_address_components(rows, "components").select(
        "c_custkey", "street_number", "neighborhood", "administrative_area_level_1", "state", "country",
        "city", "sublocality", "sublocality_level_1", "formatted_address",
    )


@query(
    "first_component",
    sql="""SELECT c_custkey, CASE WHEN ok THEN n_name END AS city, CASE WHEN ok THEN r_name END AS country,
      CAST(NULL AS VARCHAR) AS postcode, CASE WHEN ok THEN c_acctbal END AS latitude,
      CASE WHEN ok THEN '' END AS plus_code, CASE WHEN ok THEN c_name END AS formatted_address
    FROM (SELECT *, c_acctbal >= 0 AS ok FROM customer) JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def first_component(spark, sf_dir):
    """Geocoding results: first of two localities; failed lookups stay."""

    def part(name, kind):
        return F.struct(name.alias("long_name"), F.array(F.lit(kind), F.lit("political")).alias("types"))

    result = F.struct(
        F.array(
            part(F.col("n_name"), "locality"),
            part(F.col("c_mktsegment"), "locality"),
            part(F.col("r_name"), "country"),
        ).alias("address_components"),
        F.col("c_name").alias("formatted_address"),
        F.struct(F.struct(F.col("c_acctbal").alias("lat"), F.lit(1.5).alias("lng")).alias("location")).alias("geometry"),
    )
    rows = _customers(spark, sf_dir).select("c_custkey", F.when(F.col("c_acctbal") >= 0, F.to_json(result)).alias("result"))
    return docs.flatten_geocode(rows, "result").select(
        "c_custkey", "city", "country", "postcode", "latitude", "plus_code", "formatted_address"
    )


@query(
    "alt_geocoder_map",
    sql="""SELECT s_suppkey, s_name AS formatted_address, 'city' AS city, n_name AS state, coalesce(CASE WHEN s_acctbal > 0 THEN r_name END, 'N/A') AS sublocality,
      'N/A' AS postcode, CAST(s_nationkey AS VARCHAR) AS place_id, 'N/A' AS plus_code, true AS is_geo_coded
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'ASIA'""",
)
def alt_geocoder_map(spark, sf_dir):
    """The alternate geocoder's fields renamed; errors change nothing."""
    suppliers = (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    answer = F.struct(
        F.when(F.col("r_name") == "ASIA", "not found").alias("error"),
        F.col("s_name").alias("display_name"),
        F.lit("city").alias("type"),
        F.col("s_nationkey").cast("string").alias("place_id"),
        F.struct(
            F.col("n_name").alias("state"), F.when(F.col("s_acctbal") > 0, F.col("r_name")).alias("suburb")
        ).alias("address"),
    )
    rows = suppliers.select("s_suppkey", F.to_json(answer).alias("answer"))
    return docs.flatten_alt_geocode(rows, "answer").select(
        "s_suppkey", "formatted_address", "city", "state", "sublocality", "postcode", "place_id",
        "plus_code", "is_geo_coded",
    )


@query(
    "doc_flatten",
    sql="""SELECT p_partkey, p_name AS place_name, CASE WHEN p_size > 10 THEN CAST(p_retailprice AS VARCHAR) ELSE 'N/A' END AS place_rating,
      CAST(p_size AS VARCHAR) AS user_rating_count, p_type AS primary_type, 'N/A' AS website_uri, '[]' AS reviews, '{"low":{},"high":{}}' AS viewport,
      p_brand AS display_text, 'N/A' AS display_language, 1 AS landmarks, p_brand AS landmark_name, 'N/A' AS landmark_relation, 0 AS areas
    FROM part""",
)
def doc_flatten(spark, sf_dir):
    """Place documents with absent keys."""
    document = F.struct(
        F.col("p_name").alias("name"),
        F.when(F.col("p_size") > 10, F.col("p_retailprice")).alias("rating"),
        F.col("p_size").alias("userRatingCount"),
        F.col("p_type").alias("primaryType"),
        F.struct(F.col("p_brand").alias("text")).alias("displayName"),
        F.struct(
            F.array(F.struct(F.col("p_brand").alias("name"), F.array(F.col("p_type")).alias("types"))).alias("landmarks")
        ).alias("addressDescriptor"),
    )
    rows = table(spark, sf_dir, "part").select("p_partkey", F.to_json(document).alias("doc"))
    landmarks = F.col("address_descriptor.landmarks")
    return docs.flatten_place_details(rows, "doc", missing="N/A").select(
        "p_partkey", "place_name", "place_rating", "user_rating_count", "primary_type", "website_uri",
        "reviews", "viewport",
        F.col("display_name.text").alias("display_text"),
        F.col("display_name.languageCode").alias("display_language"),
        F.size(landmarks).alias("landmarks"),
        landmarks[0]["name"].alias("landmark_name"),
        landmarks[0]["spatialRelationship"].alias("landmark_relation"),
        F.size("address_descriptor.areas").alias("areas"),
    )


@query(
    "poi_flatten",
    sql=f"""WITH {PLACES_SQL}
    SELECT contentid, title AS name, concat('p', contentid) AS place_id, round(latitude, 6) AS lat, round(longitude, 6) AS lon FROM poi""",
)
def poi_flatten(spark, sf_dir):
    """Stored search results to name, position and place id."""
    result = F.struct(
        F.col("title").alias("name"),
        F.concat(F.lit("p"), F.col("contentid")).alias("place_id"),
        F.struct(F.struct(F.col("latitude").alias("lat"), F.col("longitude").alias("lng")).alias("location")).alias("geometry"),
    )
    rows = places(spark, sf_dir).select("contentid", F.to_json(result).alias("json_data"))
    return docs.flatten_poi(rows, "json_data").select(
        "contentid", "name", "place_id", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon")
    )


@query(
    "nearby_flatten",
    sql="""SELECT p_partkey, p_name AS name, p_brand AS address, p_size/2e0 AS rating, CAST(p_partkey AS VARCHAR) AS place_id, 2 AS n_types FROM part
    UNION ALL SELECT p_partkey, p_type, NULL, NULL, concat('t', p_partkey), 1 FROM part""",
)
def nearby_flatten(spark, sf_dir):
    """Pages of two results each, some values absent."""
    full = F.struct(
        F.col("p_name").alias("name"), F.col("p_brand").alias("vicinity"),
        (F.col("p_size") / F.lit(2.0)).alias("rating"), F.col("p_partkey").cast("string").alias("place_id"),
        F.array("p_type", "p_brand").alias("types"),
    )
    bare = F.struct(
        F.col("p_type").alias("name"), F.lit(None).cast("string").alias("vicinity"),
        F.lit(None).cast("double").alias("rating"), F.concat(F.lit("t"), F.col("p_partkey")).alias("place_id"),
        F.array("p_type").alias("types"),
    )
    page = F.struct(F.array(full, bare).alias("results"))
    rows = table(spark, sf_dir, "part").select("p_partkey", F.to_json(page).alias("page"))
    return docs.flatten_nearby(rows, "page").select(
        "p_partkey", "name", "address", "rating", "place_id", F.size("types").alias("n_types")
    )


@query(
    "json_field_extract",
    sql="SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
)
def json_field_extract(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query(
    "dedup_places",
    sql="""SELECT user_id AS place_id, event_id FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1""",
)
def dedup_places(spark, sf_dir):
    """First arrival of each place id."""
    events = table(spark, sf_dir, "events").select(F.col("user_id").alias("place_id"), "ts", "event_id")
    return docs.dedup_places(events, "place_id", [F.col("ts"), F.col("event_id")]).select("place_id", "event_id")


@query(
    "id_reconcile",
    sql="""WITH c AS (SELECT documents.doc_id, CAST(documents.doc_id % 7 AS VARCHAR) AS place_id,
        CASE WHEN quality = 1 THEN CAST(documents.doc_id % 5 AS VARCHAR) END AS candidate
      FROM documents LEFT JOIN labels USING (doc_id))
    SELECT doc_id AS contentid, CASE WHEN candidate <> place_id THEN candidate END AS alt_place_id,
      CASE WHEN candidate = place_id THEN true END AS is_place_id_same FROM c""",
)
def id_reconcile(spark, sf_dir):
    """Looked-up place ids against stored ones; empty candidate lists and
    missing lookups change nothing."""
    base = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("contentid"), (F.col("doc_id") % 7).cast("string").alias("place_id")
    )
    found = F.struct((F.col("doc_id") % 5).cast("string").alias("place_id"))
    hits = F.when(F.col("quality") == 1, F.array(found)).otherwise(F.filter(F.array(found), lambda x: F.lit(False)))
    lookups = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("contentid"), F.to_json(F.struct(hits.alias("candidates"))).alias("answer")
    )
    candidates = lookups.select("contentid", docs.first_candidate(F.col("answer")).alias("candidate_id"))
    return docs.reconcile_ids(base, candidates).drop("place_id")


@query(
    "alternate_details",
    sql="""WITH c AS (SELECT e.event_id AS contentid, CAST(e.user_id AS VARCHAR) AS place_id,
        CASE WHEN e.value > 0 THEN CAST(e.user_id % 200 AS VARCHAR) END AS candidate FROM events e),
      d AS (SELECT CAST(c_custkey AS VARCHAR) AS place_id, c_name, c_acctbal FROM customer WHERE c_acctbal > 0)
    SELECT contentid, CASE WHEN candidate <> c.place_id THEN candidate END AS alt_place_id,
      CASE WHEN candidate = c.place_id THEN true END AS is_place_id_same,
      CASE WHEN candidate <> c.place_id THEN c_name END AS alt_name,
      CASE WHEN candidate <> c.place_id THEN c_acctbal END AS alt_rating
    FROM c LEFT JOIN d ON d.place_id = candidate""",
)
def alternate_details(spark, sf_dir):
    """The documents of alternate places next to the ids; ids without a
    document and equal ids get none."""
    events = table(spark, sf_dir, "events")
    base = events.select(F.col("event_id").alias("contentid"), F.col("user_id").cast("string").alias("place_id"))
    candidates = events.filter("value > 0").select(
        F.col("event_id").alias("contentid"), (F.col("user_id") % 200).cast("string").alias("candidate_id")
    )
    document = F.struct(F.col("c_name").alias("name"), F.col("c_acctbal").alias("rating"))
    details = table(spark, sf_dir, "customer").filter("c_acctbal > 0").select(
        F.col("c_custkey").cast("string").alias("place_id"), F.to_json(document).alias("place_details")
    )
    found = docs.alternate_details(docs.reconcile_ids(base, candidates), details)
    return found.select(
        "contentid", "alt_place_id", "is_place_id_same",
        F.get_json_object("alt_place_details", "$.name").alias("alt_name"),
        F.get_json_object("alt_place_details", "$.rating").cast("double").alias("alt_rating"),
    )


@query(
    "stored_place_details",
    sql="""SELECT p_partkey AS contentid, p_name AS place_name,
      CASE WHEN p_size > 10 THEN concat(p_brand, ', ', p_type) ELSE CASE WHEN p_size <= 5 THEN 'old' ELSE 'N/A' END END AS place_formatted_address,
      CASE WHEN p_size > 10 THEN concat('["', p_type, '","', p_brand, '"]') ELSE CASE WHEN p_size <= 5 THEN 'old' ELSE '[]' END END AS place_types,
      CASE WHEN p_size > 10 THEN p_brand ELSE NULL END AS component_name,
      CASE WHEN p_size > 5 THEN concat('{"low":', CASE WHEN p_size > 10 THEN concat('{"latitude":', p_size, '}') ELSE '{}' END, ',"high":{}}') ELSE 'old' END AS viewport
    FROM part""",
)
def stored_place_details(spark, sf_dir):
    """Documents upserted into the stored details: address, types, components
    and viewport; parts without a document keep what is stored."""
    part = table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "contentid")
    full = F.col("p_size") > 10
    component = F.struct(F.col("p_brand").alias("longText"), F.array(F.lit("route")).alias("types"))
    document = F.struct(
        F.col("p_name").alias("name"),
        F.when(full, F.concat_ws(", ", "p_brand", "p_type")).alias("formattedAddress"),
        F.when(full, F.array("p_type", "p_brand")).alias("types"),
        F.when(full, F.array(component)).alias("addressComponents"),
        F.when(full, F.struct(F.struct(F.col("p_size").alias("latitude")).alias("low"))).alias("viewport"),
    )
    fresh = part.filter("p_size > 5").select("contentid", F.to_json(document).alias("doc"))
    names = ["contentid", "place_name", "place_formatted_address", "place_types", "place_address_components", "viewport"]
    details = docs.flatten_place_details(fresh, "doc", missing="N/A").select(*names)
    stored = part.select(
        "contentid", F.col("p_name").alias("place_name"), *[F.lit("old").alias(c) for c in names[2:4]],
        F.lit("[]").alias(names[4]), F.lit("old").alias("viewport"),
    )
    return docs.upsert_details(stored, details).select(
        *names[:4], F.get_json_object(names[4], "$[0].longText").alias("component_name"), "viewport"
    )


@query(
    "fallback_enrich",
    sql="""SELECT o_orderkey, coalesce(c_name, p_name) AS name, coalesce(c_acctbal, p_retailprice) AS amount, c_custkey IS NOT NULL AS meta_present
    FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 5000) c ON c_custkey = o_orderkey LEFT JOIN part ON p_partkey = o_orderkey""",
)
def fallback_enrich(spark, sf_dir):
    """Stored metadata where present, the second source otherwise."""
    key = "o_orderkey"
    stored = table(spark, sf_dir, "customer").filter("c_acctbal > 5000").select(
        F.col("c_custkey").alias(key), F.col("c_name").alias("name"), F.col("c_acctbal").alias("amount")
    )
    live = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias(key), F.col("p_name").alias("name"), F.col("p_retailprice").alias("amount")
    )
    return docs.fallback_enrich(table(spark, sf_dir, "orders").select(key), stored, live, key, ["name", "amount"])


@query(
    "type_category_counts",
    sql="""WITH types AS (SELECT DISTINCT p_partkey, unnest([lower(p_type), lower(split_part(p_name, ' ', 2))]) AS type FROM part),
    categories(category, type) AS (VALUES ('hardware', 'bolt'), ('hardware', 'gear'), ('hardware', 'anvil'), ('jewelry', 'ring'), ('budget', 'economy'), ('budget', 'promo'))
    SELECT category, count(*) AS places, count(DISTINCT type) AS types FROM types JOIN categories USING (type) GROUP BY category""",
)
def type_category_counts(spark, sf_dir):
    """Places per category of any of their types."""
    kinds = F.array(F.lower("p_type"), F.lower(F.split_part("p_name", F.lit(" "), F.lit(2))))
    categories = docs.category_table(
        spark, {"hardware": ["bolt", "gear", "anvil"], "jewelry": ["ring"], "budget": ["economy", "promo"]}
    )
    placed = docs.categorize(table(spark, sf_dir, "part").select("p_partkey", kinds.alias("types")), "types", categories)
    return placed.groupBy("category").agg(
        F.count(F.lit(1)).alias("places"), F.countDistinct("type").alias("types")
    )


@query(
    "membership_unnest",
    sql="""SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (
      SELECT n_nationkey + 25 * i FROM nation, range(0, 60) r(i) WHERE n_name = 'NATION_3')""",
)
def membership_unnest(spark, sf_dir):
    """Rows listed in the membership array of a named boundary."""
    nation = table(spark, sf_dir, "nation")
    boundaries = nation.select(F.col("n_nationkey").alias("id"), F.struct(F.col("n_name").alias("primary")).alias("names"))
    membership = nation.select(
        F.col("n_nationkey").alias("boundary_id"),
        F.transform(F.sequence(F.lit(0), F.lit(59)), lambda i: (i * 25 + F.col("n_nationkey")).cast("long")).alias("contentids"),
    )
    base = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return docs.members_of(boundaries, membership, base, "NATION_3", "c_custkey")


@query(
    "classifier_filter",
    sql="SELECT doc_id AS contentid, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND toxic = 0)",
)
def classifier_filter(spark, sf_dir):
    """Rows a classifier is confident about."""
    predictions = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("contentid"),
        F.when(F.col("quality") == 1, "good").otherwise("poor").alias("label"),
        (F.lit(0.9) - F.col("toxic") * F.lit(0.4)).alias("score"),
    )
    base = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("contentid"), "lang")
    return docs.filter_by_label(base, predictions, "good")


@query(
    "enrich_documents",
    sql="""SELECT s_suppkey AS contentid, s_name, CASE WHEN s_acctbal > 0 THEN 'OPEN' ELSE s_name END AS business_status,
      CASE WHEN s_acctbal > 0 THEN s_nationkey / 5e0 END AS place_rating FROM supplier""",
)
def enrich_documents(spark, sf_dir):
    """Flattened documents merged into the base; rows without keep theirs."""
    suppliers = table(spark, sf_dir, "supplier").withColumnRenamed("s_suppkey", "contentid")
    document = F.struct(F.lit("OPEN").alias("businessStatus"), (F.col("s_nationkey") / F.lit(5.0)).alias("rating"))
    details = suppliers.select("contentid", F.when(F.col("s_acctbal") > 0, F.to_json(document)).alias("place_details"))
    base = suppliers.select("contentid", "s_name", F.col("s_name").alias("business_status"))
    return docs.enrich(base, details).select("contentid", "s_name", "business_status", "place_rating")


@query(
    "coordinate_cast",
    sql=r"""SELECT page_id, TRY_CAST(regexp_extract(url, '\d+') AS DOUBLE) AS latitude,
      TRY_CAST(regexp_extract(url, '[a-z]+$') AS DOUBLE) IS NOT NULL AS has_longitude FROM pages""",
)
def coordinate_cast(spark, sf_dir):
    """Text to coordinates, unreadable ones null."""
    return table(spark, sf_dir, "pages").select(
        "page_id",
        ingest.coordinate(F.regexp_extract("url", r"\d+", 0)).alias("latitude"),
        ingest.coordinate(F.regexp_extract("url", "[a-z]+$", 0)).isNotNull().alias("has_longitude"),
    )


@query(
    "vector_text_parse",
    sql="""SELECT vec_id, len(embedding) AS dimensions,
      round(sqrt(list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * x))), 5) AS norm FROM embeddings""",
)
def vector_text_parse(spark, sf_dir):
    """Vectors stored as JSON text and read back."""
    stored = table(spark, sf_dir, "embeddings").select("vec_id", F.to_json("embedding").alias("json"))
    vec = vectors.parse_vector(F.col("json"))
    return stored.select("vec_id", F.size(vec).cast("long").alias("dimensions"), F.round(vectors.norm(vec), 5).alias("norm"))


@query(
    "enrichment_gate",
    sql="""SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000""",
)
def enrichment_gate(spark, sf_dir):
    """Rows that were geocoded and have a place id."""
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderstatus") == "F").otherwise(
            F.when(F.col("o_orderstatus") == "F", F.lit(True))
        ).alias("is_geo_coded"),
        F.when(F.col("o_totalprice") > 100000, F.col("o_custkey").cast("string")).alias("place_id"),
    )
    return docs.ready_for_details(rows).select("o_orderkey")
