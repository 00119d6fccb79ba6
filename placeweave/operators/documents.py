"""JSON documents of place and address services as typed columns.

Every parser is a projection over a JSON text column: one pass, no shuffle.
Absent values are null; ``missing`` substitutes a text where a consumer
expects one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placeweave.operators.keyed import apply_results, one_per_key, upsert_columns

# Output column, key in the place document, type. Nested values
# stay JSON text; "{}" or "[]" stands for an absent one.
PLACE_FIELDS = [
    ("place_name", "name", "string"),
    ("location", "location", "{}"),
    ("viewport", "viewport", "{}"),
    ("google_maps_uri", "googleMapsUri", "string"),
    ("google_maps_links", "googleMapsLinks", "{}"),
    ("website_uri", "websiteUri", "string"),
    ("place_rating", "rating", "double"),
    ("user_rating_count", "userRatingCount", "long"),
    ("business_status", "businessStatus", "string"),
    ("phone_number", "nationalPhoneNumber", "string"),
    ("primary_type", "primaryType", "string"),
    ("current_opening_hours", "currentOpeningHours", "{}"),
    ("reviews", "reviews", "[]"),
    ("photos", "photos", "[]"),
    ("good_for_children", "goodForChildren", "boolean"),
    ("accessibility_options", "accessibilityOptions", "{}"),
    ("generative_summary", "generativeSummary", "{}"),
    ("utc_offset_minutes", "utcOffsetMinutes", "long"),
    ("adr_format_address", "adrFormatAddress", "string"),
    ("icon_mask_base_uri", "iconMaskBaseUri", "string"),
    ("icon_background_color", "iconBackgroundColor", "string"),
    ("short_formatted_address", "shortFormattedAddress", "string"),
    ("pure_service_area_business", "pureServiceAreaBusiness", "boolean"),
    ("place_formatted_address", "formattedAddress", "string"),
    ("place_types", "types", "[]"),
    ("place_address_components", "addressComponents", "[]"),
]

_NAME = "struct<text:string,languageCode:string>"
_LANDMARK = (
    "struct<name:string,displayName:" + _NAME + ",types:array<string>,spatialRelationship:string,"
    "straightLineDistanceMeters:double,travelDistanceMeters:double>"
)
_AREA = "struct<name:string,displayName:" + _NAME + ",containment:string>"
_DESCRIPTOR = f"struct<landmarks:array<{_LANDMARK}>,areas:array<{_AREA}>>"

# Component types in the order in which a component fills its
# columns; the column is the type unless a name is given.
ADDRESS_TYPES = [
    "street_number", "route", "neighborhood", "sublocality_level_1", "administrative_area_level_2",
    "administrative_area_level_1", "colloquial_area", "sublocality", "natural_feature", "airport",
    "park", "premise", "subpremise", "landmark", "postal_town", "administrative_area_level_3",
    "administrative_area_level_4", "administrative_area_level_5", "administrative_area_level_6",
    "room", "floor", "street_address", "intersection", "bus_station", "train_station",
    "transit_station", "country", "postal_code", "locality", "point_of_interest",
]
ADDRESS_COLUMN_NAMES = {"locality": "city"}
STATE_TYPE = "administrative_area_level_1"

# Output column and component type of a geocoding result.
GEOCODE_FIELDS = [
    ("city", "locality"),
    ("state", "administrative_area_level_1"),
    ("country", "country"),
    ("postcode", "postal_code"),
    ("neighborhood", "neighborhood"),
    ("sublocality", "sublocality"),
]

# Output column and path in the alternate geocoder's document.
ALT_GEOCODE_FIELDS = [
    ("formatted_address", "display_name"),
    ("city", "type"),
    ("state", "address.state"),
    ("country", "address.country"),
    ("postcode", "address.postcode"),
    ("neighborhood", "address.neighbourhood"),
    ("sublocality", "address.suburb"),
    ("place_id", "place_id"),
]


def _text(c: Column, missing: str | None) -> Column:
    return c if missing is None else F.coalesce(c.cast("string"), F.lit(missing))


def flatten_place_details(df: DataFrame, json_col: str, missing: str | None = None) -> DataFrame:
    """Place documents to 31 columns; the source column is dropped. The
    viewport has both corners, ``{}`` for an absent one. Text that is not JSON
    counts as a document without any key."""
    fields = ",".join(
        f"{key}:{'string' if kind in ('{}', '[]') else kind}" for _, key, kind in PLACE_FIELDS
    )
    point = "struct<latitude:double,longitude:double>"
    doc = F.from_json(
        json_col,
        f"struct<{fields},displayName:{_NAME},primaryTypeDisplayName:{_NAME},addressDescriptor:{_DESCRIPTOR}>",
    )
    rows = df.withColumn("_doc", doc)
    spot = F.from_json(F.col("_doc.location"), point)
    out = {}
    for name, key, kind in PLACE_FIELDS:
        value = F.col(f"_doc.{key}")
        out[name] = F.coalesce(value, F.lit(kind)) if kind in ("{}", "[]") else _text(value, missing)
    corner = lambda name: F.coalesce(
        F.get_json_object(F.col("_doc.viewport"), f"$.{name}"), F.lit("{}")
    )
    out["viewport"] = F.concat(F.lit('{"low":'), corner("low"), F.lit(',"high":'), corner("high"), F.lit("}"))
    out["latitude"] = _text(spot["latitude"], missing)
    out["longitude"] = _text(spot["longitude"], missing)
    for name, key in (("display_name", "displayName"), ("primary_type_display_name", "primaryTypeDisplayName")):
        out[name] = F.struct(
            _text(F.col(f"_doc.{key}.text"), missing).alias("text"),
            _text(F.col(f"_doc.{key}.languageCode"), missing).alias("languageCode"),
        )
    out["address_descriptor"] = F.struct(
        reshape_landmarks(F.col("_doc.addressDescriptor.landmarks"), missing).alias("landmarks"),
        reshape_areas(F.col("_doc.addressDescriptor.areas"), missing).alias("areas"),
    )
    return rows.withColumns(out).drop("_doc", json_col)


def _or_empty_list(c: Column) -> Column:
    return F.coalesce(c, F.array().cast("array<string>"))


def reshape_landmarks(landmarks: Column, missing: str | None = None) -> Column:
    shaped = F.transform(
        landmarks,
        lambda x: F.struct(
            _text(x["name"], missing).alias("name"),
            x["displayName"].alias("displayName"),
            _or_empty_list(x["types"]).alias("types"),
            _text(x["spatialRelationship"], missing).alias("spatialRelationship"),
            _text(x["straightLineDistanceMeters"], missing).alias("straightLineDistanceMeters"),
            _text(x["travelDistanceMeters"], missing).alias("travelDistanceMeters"),
        ),
    )
    return F.coalesce(shaped, F.array())


def reshape_areas(areas: Column, missing: str | None = None) -> Column:
    shaped = F.transform(
        areas,
        lambda x: F.struct(
            _text(x["name"], missing).alias("name"),
            x["displayName"].alias("displayName"),
            _text(x["containment"], missing).alias("containment"),
        ),
    )
    return F.coalesce(shaped, F.array())


def pivot_address_components(df: DataFrame, json_col: str) -> DataFrame:
    """Address components to one column per type.

    A component fills the column of each of its types; the last component of
    a type gives the value. ``formatted_address`` joins the values in the
    order in which their columns were first filled, without the state.
    """
    parts = F.from_json(
        json_col, "array<struct<longText:string,shortText:string,types:array<string>>>"
    )
    rows = df.withColumn("_parts", parts).withColumn("_kinds", _first_and_last(F.col("_parts")))
    filled = F.array_sort(
        F.transform("_kinds", lambda k: F.struct(k["first"], k["order"], k["long"]))
    )
    rows = rows.withColumns(
        {
            "_filled": F.array_join(F.transform(filled, lambda f: f["long"]), ", "),
            "_kinds": F.map_from_entries(F.transform("_kinds", lambda k: F.struct(k["kind"], k))),
        }
    )
    out = {}
    for kind in ADDRESS_TYPES:
        of_kind = F.try_element_at("_kinds", F.lit(kind))
        out[ADDRESS_COLUMN_NAMES.get(kind, kind)] = of_kind["long"]
        if kind == STATE_TYPE:
            out["state"] = of_kind["short"]
    out["formatted_address"] = F.col("_filled")
    return rows.withColumns(out).drop("_parts", "_kinds", "_filled", json_col)


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` evaluated once, however often it is used."""
    return F.transform(F.array(value), body)[0]


def _first_and_last(parts: Column) -> Column:
    """One entry per known type that occurs: its number in ``ADDRESS_TYPES``,
    the place of its first component, the texts of its last one."""
    known = F.array(*[F.lit(kind) for kind in ADDRESS_TYPES])
    blank = F.lit("")
    entries = F.flatten(
        F.transform(
            parts,
            lambda c, at: F.transform(
                F.coalesce(c["types"], F.array().cast("array<string>")),
                lambda kind: F.struct(
                    kind.alias("kind"),
                    at.alias("first"),
                    F.coalesce(c["longText"], blank).alias("long"),
                    F.coalesce(c["shortText"], blank).alias("short"),
                ),
            ),
        )
    )

    def summed(kind: Column, own: Column) -> Column:
        last = F.try_element_at(own, F.lit(-1))
        return F.struct(
            kind.alias("kind"),
            F.array_position(known, kind).alias("order"),
            own[0]["first"].alias("first"),
            last["long"].alias("long"),
            last["short"].alias("short"),
        )

    def of(all_entries: Column) -> Column:
        kinds = F.array_intersect(F.transform(all_entries, lambda e: e["kind"]), known)
        return F.transform(
            kinds, lambda kind: bind(F.filter(all_entries, lambda e: e["kind"] == kind), lambda own: summed(kind, own))
        )

    return bind(entries, of)


def first_component(components: Column, kind: str) -> Column:
    """Long name of the first component that has the type."""
    hit = F.filter(components, lambda c: F.array_contains(c["types"], kind))
    return F.try_element_at(hit, F.lit(1))["long_name"]


def flatten_geocode(df: DataFrame, json_col: str) -> DataFrame:
    """Geocoding results to columns; a failed lookup (null) keeps its row."""
    doc = F.from_json(
        json_col,
        "struct<address_components:array<struct<long_name:string,types:array<string>>>,"
        "formatted_address:string,geometry:struct<location:struct<lat:double,lng:double>>,"
        "place_id:string,plus_code:struct<global_code:string>>",
    )
    rows = df.withColumn("_doc", doc)
    known = F.col("_doc").isNotNull()

    def text(path: str) -> Column:
        return F.when(known, F.coalesce(F.col(f"_doc.{path}"), F.lit("")))

    return rows.withColumns(
        {
            "latitude": F.col("_doc.geometry.location.lat"),
            "longitude": F.col("_doc.geometry.location.lng"),
            "formatted_address": text("formatted_address"),
            **{n: first_component(F.col("_doc.address_components"), kind) for n, kind in GEOCODE_FIELDS},
            "place_id": text("place_id"),
            "plus_code": text("plus_code.global_code"),
            "complete_result": F.col(json_col),
        }
    ).drop("_doc", json_col)


def flatten_alt_geocode(df: DataFrame, json_col: str, missing: str = "N/A") -> DataFrame:
    """The alternate geocoder's documents in the same columns. Documents with
    an error are dropped, as they change nothing."""
    doc = F.from_json(
        json_col,
        "struct<error:string,display_name:string,type:string,place_id:string,address:struct<"
        "state:string,country:string,postcode:string,neighbourhood:string,suburb:string>>",
    )
    rows = df.withColumn("_doc", doc).filter(F.col("_doc").isNotNull() & F.col("_doc.error").isNull())
    out = {}
    for name, path in ALT_GEOCODE_FIELDS:
        value = F.col(f"_doc.{path}")
        out[name] = F.coalesce(value, F.lit(missing)) if path.startswith("address.") else value
    out |= {"plus_code": F.lit(missing), "is_geo_coded": F.lit(True), "complete_result": F.col(json_col)}
    return rows.withColumns(out).drop("_doc", json_col)


def flatten_poi(df: DataFrame, json_col: str) -> DataFrame:
    """Name, position and place id of stored search results."""
    doc = F.from_json(
        json_col,
        "struct<name:string,place_id:string,geometry:struct<location:struct<lat:double,lng:double>>>",
    )
    return (
        df.withColumn("_doc", doc)
        .withColumns(
            {
                "name": F.col("_doc.name"),
                "lat": F.col("_doc.geometry.location.lat"),
                "lon": F.col("_doc.geometry.location.lng"),
                "place_id": F.col("_doc.place_id"),
            }
        )
        .drop("_doc", json_col)
    )


def flatten_nearby(df: DataFrame, json_col: str) -> DataFrame:
    """One row per place of each nearby-search page."""
    doc = F.from_json(
        json_col,
        "struct<results:array<struct<name:string,vicinity:string,place_id:string,rating:double,"
        "user_ratings_total:long,types:array<string>,"
        "geometry:struct<location:struct<lat:double,lng:double>>>>>",
    )
    places = df.withColumn("_place", F.explode(doc["results"]))
    return places.withColumns(
        {
            "name": F.col("_place.name"),
            "address": F.col("_place.vicinity"),
            "latitude": F.col("_place.geometry.location.lat"),
            "longitude": F.col("_place.geometry.location.lng"),
            "rating": F.col("_place.rating"),
            "user_ratings_total": F.col("_place.user_ratings_total"),
            "types": F.col("_place.types"),
            "place_id": F.col("_place.place_id"),
        }
    ).drop("_place", json_col)


def dedup_places(df: DataFrame, key: str = "place_id", order: list[Column] | None = None) -> DataFrame:
    """First arrival of each place; rows without an id are dropped."""
    present = df.filter(F.col(key).isNotNull())
    return one_per_key(present, [key], order or [F.col(c) for c in df.columns if c != key])


def first_candidate(json_col: Column) -> Column:
    """Place id of the first candidate; null when there is none."""
    doc = F.from_json(json_col, "struct<candidates:array<struct<place_id:string,name:string>>>")
    return F.try_element_at(doc["candidates"], F.lit(1))["place_id"]


def reconcile_ids(base: DataFrame, candidates: DataFrame, key: str = "contentid", place: str = "place_id") -> DataFrame:
    """Compare stored place ids with looked-up ones (``candidate_id``): a
    different one goes to ``alt_place_id``, an equal one sets the flag."""
    found = base.join(candidates.select(key, "candidate_id"), key, "left")
    candidate, stored = F.col("candidate_id"), F.col(place)
    return found.withColumns(
        {
            "alt_place_id": F.when(candidate.isNotNull() & ~candidate.eqNullSafe(stored), candidate),
            "is_place_id_same": F.when(candidate == stored, True),
        }
    ).drop("candidate_id")


def alternate_details(
    reconciled: DataFrame, details: DataFrame, place: str = "place_id", json_col: str = "place_details"
) -> DataFrame:
    """Adds ``alt_place_details``, the stored document of the alternate place;
    null where there is no alternate id or no document. ``details`` has one
    document per place id; of several, the greatest text counts."""
    known = details.filter(F.col(place).isNotNull() & F.col(json_col).isNotNull())
    known = known.groupBy(F.col(place).alias("_place")).agg(F.max(json_col).alias("alt_place_details"))
    rows = reconciled.drop("alt_place_details")
    return rows.join(known, F.col("alt_place_id") == F.col("_place"), "left").drop("_place")


def fallback_enrich(
    base: DataFrame, primary: DataFrame, secondary: DataFrame, key: str, columns: list[str]
) -> DataFrame:
    """Stored metadata where present, the second source otherwise;
    ``meta_present`` tells which."""

    def named(df: DataFrame, mark: str) -> DataFrame:
        return df.select(key, *[F.col(c).alias(mark + c) for c in columns], F.lit(True).alias(mark))

    joined = base.join(named(primary, "_p"), key, "left").join(named(secondary, "_s"), key, "left")
    present = F.coalesce(F.col("_p"), F.lit(False))
    picked = {c: F.coalesce(F.col("_p" + c), F.col("_s" + c)) for c in columns}
    extra = ["_p", "_s", *["_p" + c for c in columns], *["_s" + c for c in columns]]
    return joined.withColumns({**picked, "meta_present": present}).drop(*extra)


def category_table(spark: SparkSession, categories: dict[str, list[str]]) -> DataFrame:
    """``(category, type)`` rows from the caller's lists."""
    rows = [(category, kind) for category, kinds in categories.items() for kind in kinds]
    return spark.createDataFrame(rows, "category string, type string")


def categorize(df: DataFrame, types: str, categories: DataFrame) -> DataFrame:
    """One row per place and category of any of its types.

    ``categories`` is a ``(category, type)`` table from the caller.
    """
    kinds = df.withColumn("type", F.explode(F.array_distinct(F.col(types))))
    return kinds.join(categories, "type")


def members_of(
    boundaries: DataFrame, membership: DataFrame, base: DataFrame, name: str, key: str = "contentid"
) -> DataFrame:
    """Base rows listed in the membership of boundaries of that name."""
    ids = boundaries.filter(F.col("names.primary") == name).select(F.col("id").alias("boundary_id"))
    listed = membership.join(ids, "boundary_id", "left_semi").select(
        F.explode("contentids").alias(key)
    )
    return base.join(listed, key, "left_semi")


def filter_by_label(
    df: DataFrame, predictions: DataFrame, label: str, min_score: float = 0.8, key: str = "contentid"
) -> DataFrame:
    """Rows a classifier gave the label with more than ``min_score``;
    ``predictions`` is ``(key, label, score)``."""
    hits = predictions.filter((F.col("label") == label) & (F.col("score") > min_score))
    return df.join(hits.select(key), key, "left_semi")


def ready_for_details(df: DataFrame) -> DataFrame:
    """Rows that were geocoded and have a place id."""
    return df.filter(F.col("is_geo_coded") & F.col("place_id").isNotNull())


def enrich(base: DataFrame, documents: DataFrame, key: str = "contentid", json_col: str = "place_details") -> DataFrame:
    """Flatten each row's place document and merge the columns into the base."""
    details = flatten_place_details(documents.select(key, json_col).filter(F.col(json_col).isNotNull()), json_col)
    return apply_results(base, details, key)


def upsert_details(table: DataFrame, details: DataFrame, key: str = "contentid") -> DataFrame:
    """Insert or update flattened documents, column by column."""
    return upsert_columns(table, details, [key], [c for c in details.columns if c != key])
