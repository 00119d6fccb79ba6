"""Keyed changes, documents, search, reports."""

import json
import random

import pytest
from pyspark.sql import functions as F

from placeweave import schemas
from placeweave.functions import text, vectors
from placeweave.operators import documents, keyed, reports, search


def _rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_upsert_rows_new_wins_highest_order_first(spark):
    base = spark.createDataFrame([(1, "old", 9), (2, "keep", 1)], "id int, v string, o int")
    new = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (3, "c", 1)], "id int, v string, o int")
    assert _rows(keyed.upsert_rows(base, new, ["id"], ["o"])) == [(1, "b", 2), (2, "keep", 1), (3, "c", 1)]


def test_one_per_key_limits_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 as k", "id")
    plan = keyed.one_per_key(df, ["k"], [F.col("id")])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.rindex("WindowGroupLimit") > plan.index("Exchange")


def test_upsert_columns_overwrites_with_null(spark):
    base = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "id int, x string, y int")
    new = spark.createDataFrame([(1, None, 7), (3, "c", None)], "id int, x string, y int")
    assert _rows(keyed.upsert_columns(base, new, ["id"], ["x", "y"]), "id") == [(1, None, 7), (2, "b", 2), (3, "c", None)]


@pytest.mark.parametrize("ids, kept", [([1], [2, 3]), ([1, None], []), ([], [1, 2, 3, None])])
def test_null_aware_exclusion(spark, ids, kept):
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "id int")
    listed = spark.createDataFrame([(i,) for i in ids], "id int")
    df.createOrReplaceTempView("t_rows")
    listed.createOrReplaceTempView("t_ids")
    got = [r.id for r in keyed.exclude_null_aware(df, listed, "id").collect()]
    want = [r.id for r in spark.sql("SELECT id FROM t_rows WHERE id NOT IN (SELECT id FROM t_ids)").collect()]
    assert sorted(got, key=str) == sorted(want, key=str) == sorted(kept, key=str)


def test_numbered_batches_follow_the_order(spark):
    df = spark.range(1050).selectExpr("id", "id % 2 as k")
    out = keyed.numbered_batches(df, ["k"], [F.col("id")], F.floor(F.col("id") / 100), size=100)
    assert [r.batch for r in out.filter("k = 0").orderBy("id").collect()] == [i // 100 for i in range(525)]


def test_soft_delete(spark):
    df = spark.createDataFrame([(1,), (2,)], "id int")
    gone = spark.createDataFrame([(2,), (2,)], "id int")
    marked = keyed.soft_delete(df, gone, "id")
    assert _rows(marked) == [(1, False), (2, True)] and _rows(keyed.live_rows(marked)) == [(1, False)]


def test_schema_helpers(spark):
    empty = schemas.empty_table(spark, schemas.PLACE_SCHEMA)
    assert empty.count() == 0 and len(empty.columns) == 31
    assert schemas.empty_like(empty).schema == empty.schema
    df = schemas.ensure_columns(spark.range(1), {"id": ("int", 5), "tag": ("string", "blue")})
    assert _rows(df) == [(0, "blue")]
    holes = spark.createDataFrame([(None, 1)], "tag string, n int")
    assert _rows(schemas.with_defaults(holes, {"tag": "blue"})) == [("blue", 1)]


COMPONENTS = [
    {"longText": "52-11", "shortText": "52-11", "types": ["street_number"]},
    {"longText": "First", "shortText": "F", "types": ["neighborhood", "political"]},
    {"longText": "Queens", "shortText": "Q", "types": ["sublocality_level_1", "sublocality", "political"]},
    {"longText": "New York", "shortText": "NY", "types": ["administrative_area_level_1", "political"]},
    {"longText": "Second", "shortText": "S", "types": ["neighborhood"]},
    {"longText": "Town", "shortText": "T", "types": ["locality"]},
]


def test_address_components(spark):
    df = spark.createDataFrame([(1, json.dumps(COMPONENTS)), (2, "[]"), (3, None)], "id int, j string")
    rows = {r.id: r for r in documents.pivot_address_components(df, "j").collect()}
    one = rows[1]
    assert (one.neighborhood, one.state, one.city, one.sublocality) == ("Second", "NY", "Town", "Queens")
    assert one.formatted_address == "52-11, Second, Queens, Queens, New York, Town"
    assert rows[2].formatted_address == "" and rows[3].formatted_address is None and one.route is None


def test_address_components_odd_shapes(spark):
    odd = [
        None,
        {"longText": None, "shortText": None, "types": ["country", "country"]},
        {"longText": "x", "types": None},
        {"longText": "y", "types": [None, "unheard_of"]},
        {"longText": "Z", "types": ["locality", "route"]},
    ]
    df = spark.createDataFrame([(1, json.dumps(odd)), (2, "no json")], "id int, j string")
    rows = {r.id: r for r in documents.pivot_address_components(df, "j").collect()}
    assert (rows[1].country, rows[1].route, rows[1].city, rows[1].state) == ("", "Z", "Z", None)
    assert rows[1].formatted_address == ", Z, Z" and rows[2].city is None


def test_alternate_details(spark):
    base = spark.createDataFrame(
        [("a", "1", "2"), ("b", "1", "1"), ("c", "1", None), ("d", None, "7"), ("e", "1", "2")],
        "contentid string, place_id string, candidate_id string")
    found = documents.reconcile_ids(base.drop("candidate_id"), base)
    details = spark.createDataFrame(
        [("2", "{1}"), ("2", "{2}"), ("1", "{3}"), (None, "{4}"), ("7", None)], "place_id string, place_details string")
    out = documents.alternate_details(found, details)
    assert sorted((r.contentid, r.alt_place_details) for r in out.collect()) == [
        ("a", "{2}"), ("b", None), ("c", None), ("d", None), ("e", "{2}")]
    assert documents.alternate_details(found.limit(0), details.limit(0)).count() == 0


def test_geocode_first_component_and_failed_lookup(spark):
    result = {
        "address_components": [
            {"long_name": "A", "types": ["locality"]}, {"long_name": "B", "types": ["locality", "political"]}
        ],
        "geometry": {"location": {"lat": 1.5, "lng": 2.5}},
        "place_id": "p",
    }
    df = spark.createDataFrame([(1, json.dumps(result)), (2, None)], "id int, j string")
    rows = {r.id: r for r in documents.flatten_geocode(df, "j").collect()}
    assert (rows[1].city, rows[1].latitude, rows[1].plus_code, rows[1].state) == ("A", 1.5, "", None)
    assert rows[2].city is None and rows[2].place_id is None


def test_place_details_defaults(spark):
    doc = {"name": "x", "location": {"latitude": 1.0}, "viewport": {"low": {"latitude": 3}},
           "addressDescriptor": {"areas": [{"name": "a", "containment": "WITHIN"}]}}
    df = spark.createDataFrame([(1, json.dumps(doc)), (2, "not json")], "id int, j string")
    row = documents.flatten_place_details(df, "j", missing="N/A").filter("id = 1").first()
    assert (row.place_name, row.latitude, row.longitude, row.place_rating) == ("x", "1.0", "N/A", "N/A")
    assert row.reviews == "[]" and json.loads(row.viewport) == {"low": {"latitude": 3}, "high": {}}
    assert row.address_descriptor.areas[0].containment == "WITHIN" and row.address_descriptor.landmarks == []
    typed = documents.flatten_place_details(df, "j").filter("id = 1").first()
    assert typed.latitude == 1.0 and typed.place_rating is None


def test_alternate_geocoder_errors_are_dropped(spark):
    df = spark.createDataFrame(
        [(1, json.dumps({"display_name": "d", "type": "t", "place_id": 5, "address": {"suburb": "s"}})),
         (2, json.dumps({"error": "no"}))], "id int, j string")
    rows = documents.flatten_alt_geocode(df, "j").collect()
    assert [(r.id, r.sublocality, r.state, r.place_id) for r in rows] == [(1, "s", "N/A", "5")]


def test_candidates_and_reconciliation(spark):
    df = spark.createDataFrame(
        [("a", '{"candidates":[{"place_id":"1"},{"place_id":"2"}]}'), ("b", '{"candidates":[]}'), ("c", "{}"), ("d", '{"candidates":[{"place_id":"9"}]}')],
        "contentid string, j string")
    found = df.select("contentid", documents.first_candidate(F.col("j")).alias("candidate_id"))
    base = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", None), ("d", None)], "contentid string, place_id string")
    assert _rows(documents.reconcile_ids(base, found)) == [
        ("a", "1", None, True), ("b", "1", None, None), ("c", None, None, None), ("d", None, "9", None)
    ]


def test_text_helpers(spark):
    df = spark.createDataFrame([("Café  du-Monde!",), ("",), (None,), ("a" * 25,)], "t string")
    t = F.col("t")
    rows = df.select(
        text.clean_text(t), text.preview(t), text.word_count(t), text.drop_words(F.lower(t), ["du"]),
        text.trigram_similarity(t, F.lit("cafe")),
    ).collect()
    assert rows[0][0] == "café du monde " and rows[0][2] == 2
    assert (rows[1][0], rows[1][1], rows[1][2]) == ("", "", 0)
    assert (rows[2][0], rows[2][1], rows[2][2]) == (None, "", 0)
    assert rows[3][1] == "a" * 20 + "..."
    html = "<p>a &amp;lt; b</p><script>x<1</script><!-- c --><b>d</b>"
    assert df.select(text.strip_html(F.lit(html))).first()[0] == "a &lt; bd"


def test_trigram_pairs_equal_brute_force(spark):
    rng = random.Random(5)
    words = ["bridge", "bridges", "brooklyn", "park", "parks", "central", "cafe", "café"]
    titles = [" ".join(rng.choices(words, k=rng.randint(1, 3))) for _ in range(150)]
    df = spark.createDataFrame(list(enumerate(titles)), "id long, title string")
    distinct = df.groupBy("title").agg(F.min("id").alias("id"))
    a, b = distinct.alias("a"), distinct.alias("b")
    every = a.join(b, F.col("a.id") < F.col("b.id")).select(
        F.col("a.id").alias("id1"), F.col("b.id").alias("id2"),
        text.trigram_similarity(F.col("a.title"), F.col("b.title")).alias("s"),
    ).cache()
    for threshold in (0.2, 0.5, 0.8, 1.0):
        for tile_rows in (5, 4096):
            got = search.trigram_pairs(df, "id", "title", threshold, tile_rows)
            assert _rows(got) == _rows(every.filter(F.col("s") >= threshold - 1e-12))


def test_duplicate_results_leave_one_row(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "id int, x string")
    results = spark.createDataFrame([(1, "old", 1), (1, None, 2), (1, "older", 0)], "id int, x string, n int")
    assert _rows(keyed.apply_results(base, results, "id", ["n"]), "id") == [(1, None, 2), (2, "b", None)]
    assert keyed.upsert_columns(base, results, ["id"], ["x"]).count() == 2


def test_top_k_of_copies_and_mixed_lengths(spark):
    items = spark.range(3000).selectExpr("id", "if(id % 3 = 0, array(1F, 0F), array(1F, 0F, 0F)) as vec")
    queries = spark.createDataFrame([("q", [1.0, 1.0])], "query_id string, vec array<float>")
    got = search.search_top_k(items, queries, 5, item_id="id", vec="vec")
    assert [r.id for r in got.orderBy("rank").collect()] == [0, 3, 6, 9, 12]


@pytest.mark.parametrize("items_at_once, queries_at_once", [(8192, 512), (7, 2)])
def test_top_k_equals_brute_force(spark, monkeypatch, items_at_once, queries_at_once):
    monkeypatch.setattr(search, "ITEM_CHUNK", items_at_once)
    monkeypatch.setattr(search, "QUERY_CHUNK", queries_at_once)
    rng = random.Random(9)
    rows = [(i, [rng.choice([0.0, 1.0, 2.0]) for _ in range(4)], i % 7, i % 3) for i in range(200)]
    items = spark.createDataFrame(rows, "contentid long, embedding array<float>, popular int, city int").repartition(5)
    queries = spark.createDataFrame([(f"q{i}", rows[i][1], i % 3) for i in (3, 50, 77, 120, 7)],
                                    "query_id string, embedding array<float>, city int")
    score = vectors.cosine(F.col("i.embedding"), F.col("q.embedding"))
    for filters in (None, ["city"]):
        join = F.col("i.city") == F.col("q.city") if filters else F.lit(True)
        every = items.alias("i").filter(vectors.norm(F.col("embedding")) >= 0).join(queries.alias("q"), join)
        want = {}
        for r in every.select("query_id", "contentid", score.alias("s"), "i.popular").collect():
            want.setdefault(r.query_id, []).append((-round(r.s, 9), -r.popular, r.contentid))
        got = search.search_top_k(items, queries, 6, filters=filters, popularity="popular")
        for q, hits in want.items():
            mine = [r for r in got.filter(F.col("query_id") == q).orderBy("rank").collect()]
            assert [round(r.score, 6) for r in mine] == [round(-h[0], 6) for h in sorted(hits)[:6]]


def test_place_search(spark):
    items = spark.createDataFrame(
        [("a", [1.0, 0.0], 40.7, -74.0), ("b", [0.9, 0.1], 40.7001, -74.0), ("c", [0.0, 1.0], 41.0, -74.0)],
        "contentid string, embedding array<float>, latitude double, longitude double")
    queries = spark.createDataFrame([("q", [1.0, 0.0])], "query_id string, embedding array<float>")
    stored = spark.createDataFrame([("a", "9-5")], "contentid string, hours string")
    live = spark.createDataFrame([("a", "x"), ("b", "24h")], "contentid string, hours string")
    out = search.place_search(items, queries, 2, stored, live, ["hours"], radius_m=100)
    assert _rows(out["hits"].select("contentid", "hours", "meta_present")) == [("a", "9-5", True), ("b", "24h", False)]
    assert _rows(out["around"].select("hit_id", "contentid")) == [("a", "b"), ("b", "a")]


def test_cumulative_share_across_buckets(spark):
    counts = spark.createDataFrame([(v, 1) for v in (1, 2, 1500, 9000)], "w long, frequency long")
    assert [r.cumulative for r in reports.cumulative_share(counts, "w").orderBy("w").collect()] == [0.25, 0.5, 0.75, 1.0]


def test_tag_counts_keep_zeros_and_ignore_strangers(spark):
    df = spark.createDataFrame([("red",), ("red",), ("green",), (None,)], "tag string")
    assert dict(_rows(reports.tag_domain_counts(df))) == {
        "red": 2, "lightred": 0, "darkred": 0, "pink": 0, "purple": 0, "blue": 0
    }


def test_distribution_report(spark):
    df = spark.createDataFrame([("one two",), ("one",), ("a b c",), (None,), ("x y",)], "description string")
    report = reports.distribution_report(df)
    assert _rows(report["histogram"]) == [(0, 1), (1, 1), (2, 2), (3, 1)]
    assert report["density"].count() == 200 and report["box_plot"].first().median == 1.0


def test_map_ready(spark):
    df = spark.createDataFrame(
        [("i", "t", "a long description of it", None, None, "red", 1.0, 2.0)],
        "contentid string, title string, description string, source_url string, is_title_duplicate boolean, tag string, latitude double, longitude double")
    row = reports.map_ready(df).first()
    assert row.color == "red" and "Description: a long description o..." in row.popup and "Point: 1.0,2.0" in row.popup
