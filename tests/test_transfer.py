"""Readers, writers and streaming jobs."""

import json
import re

import pytest
from pyspark.sql import functions as F

from placeweave.operators import blocking, copies, ingest
from placeweave.plans import streams
from placeweave.plans.places import places
from placeweave.session import scratch_path, settle, shared_dir
from placeweave.sources import readers, writers
from placeweave.streaming import jobs


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def lines(tmp_path):
    path = tmp_path / "in.jsonl"
    path.write_text('{"contentid":"a","title":"x","latitude":"1.5"}\n{"contentid":"b",\n\n{"contentid":"c","latitude":"?","image_urls":"1,2,,3"}\n')
    return str(path)


def test_bad_lines_dropped_or_fatal(spark, lines):
    assert readers.read_places_json(spark, lines).count() == 2
    with pytest.raises(Exception):
        readers.read_places_json(spark, lines, "fail").collect()


def test_ingest_types_and_defaults(spark, lines):
    rows = {r.contentid: r for r in ingest.ingest(spark, lines).collect()}
    assert rows["a"].latitude == 1.5 and rows["c"].latitude is None and rows["a"].tag == "blue"
    assert rows["c"].image_urls == ["1", "2", "", "3"] and rows["a"].image_urls is None and rows["a"].cell_coarse is None
    again = ingest.ingest(spark, lines, existing=ingest.ingest(spark, lines))
    assert again.count() == 2


def test_json_array_and_csv(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"n": 1}, {"n": 2}]))
    assert _rows(readers.read_json_array(spark, str(tmp_path / "a.json"), "n int")) == [(1,), (2,)]
    df = spark.createDataFrame([("a,\"q\"", 1, ["x", "y"])], "s string, n int, l array<string>")
    path = scratch_path(spark, "csv")
    writers.export_csv(df, path)
    assert _rows(readers.read_csv(spark, path)) == [('a,"q"', "1", '["x","y"]')]
    out = scratch_path(spark, "jsonl")
    writers.csv_to_jsonl(spark, path, out)
    assert _rows(readers.read_jsonl(spark, out, "s string, n string")) == [('a,"q"', "1")]


def test_geojson_collection_both_kinds(spark, tmp_path):
    ring = [[0, 0], [1, 0], [1, 1], [0, 0]]
    doc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"n": 1}, "geometry": {"type": "Polygon", "coordinates": [ring]}},
        {"type": "Feature", "properties": {}, "geometry": {"type": "MultiPolygon", "coordinates": [[ring], [ring, ring]]}},
        {"type": "Feature", "properties": {}, "geometry": None},
    ]}
    (tmp_path / "b.geojson").write_text(json.dumps(doc, indent=1))
    features = readers.read_geojson(spark, str(tmp_path / "b.geojson"))
    sizes = [(r.feature, r.n) for r in features.select("feature", F.size("rings").alias("n")).orderBy("feature").collect()]
    assert sizes == [(0, 1), (1, 3), (2, None)]
    assert readers.first_boundary(features).count() == 1


def test_features_collection_and_styled_append(spark):
    df = spark.createDataFrame([("t", 1.0, 2.0, 5, "c")], "title string, latitude double, longitude double, cell_coarse long, city string")
    features = writers.to_geojson_features(df)
    whole = scratch_path(spark, "collection")
    writers.export_feature_collection(features, whole)
    doc = json.loads(_document(spark, whole))
    assert doc["features"][0]["geometry"] == {"type": "Point", "coordinates": [2.0, 1.0]}
    both = writers.append_features(features, df)
    path = scratch_path(spark, "geojson")
    writers.export_geojson(both, path)
    styles = [json.loads(r.value)["properties"].get("marker-color") for r in spark.read.text(path).collect()]
    assert sorted(styles, key=str) == sorted([None, "#FFC0CB"], key=str)


def _document(spark, path):
    parts = spark.read.text(path).select("value", "_metadata.file_name", "_metadata.file_block_start", F.monotonically_increasing_id().alias("at"))
    return "\n".join(r.value for r in parts.orderBy("file_name", "at").collect())


@pytest.mark.parametrize("rows, tasks", [(0, 1), (1, 3), (20, 5), (1000, 4)])
def test_json_array_in_part_files(spark, rows, tasks):
    path = scratch_path(spark, "a")
    writers.export_json_array(spark.range(rows).repartition(tasks), path)
    assert sorted(e["id"] for e in json.loads(_document(spark, path))) == list(range(rows))
    assert readers.read_array_parts(spark, path, "id long").count() == rows


def test_export_order(spark):
    df = spark.range(100).selectExpr("id as contentid", "'t' as title", "id % 10 as cell_coarse", "0L as cell_fine", "'c' as city", "1.0 as latitude", "2.0 as longitude")
    path = scratch_path(spark, "sorted")
    writers.export_by_cell(df, path)
    cells = [json.loads(r.value)["cell_coarse"] for r in spark.read.text(path).select("value", "_metadata.file_name").orderBy("file_name").collect()]
    assert len(cells) == 100


def test_catalogue_and_description(spark):
    spark.range(1).createOrReplaceTempView("some_view")
    assert "some_view" in {r.table_name for r in readers.list_tables(spark).collect()}
    described = readers.describe(spark.createDataFrame([], "a int, b array<string>"))
    assert _rows(described) == [(0, "a", "int", True), (1, "b", "array<string>", True)]


def test_jdbc_options_come_from_the_caller(spark):
    with pytest.raises(Exception):
        readers.read_jdbc(spark, "t", url="jdbc:none:").count()


def test_settle_keeps_schema_and_rows(spark):
    df = spark.createDataFrame([(1, ["a"]), (2, None)], "id int, l array<string>")
    assert settle(df).schema == df.schema and _rows(settle(df).select("id")) == [(1,), (2,)]
    assert scratch_path(spark, "x").startswith(shared_dir(spark))


def test_settle_leaves_no_shuffle_files(spark):
    def shuffled():
        blocks = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().toString()
        return set(re.findall(r"shuffle_\d+_\d+", blocks))

    before = shuffled()
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    stored = settle(df)
    left = shuffled() - before
    assert not left and spark.conf.get(setting) == "false"
    assert _rows(stored) == _rows(df)


def test_upsert_table(spark):
    path = scratch_path(spark, "table")
    writers.replace_table(spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string"), path)
    writers.upsert_table(spark, path, spark.createDataFrame([(2, "B"), (3, "c")], "id int, v string"), ["id"])
    assert _rows(spark.read.parquet(path)) == [(1, "a"), (2, "B"), (3, "c")]


def _stream(spark, frames):
    path = scratch_path(spark, "arrivals")
    for frame in frames:
        frame.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(frames[0].schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_incremental_compare_equals_one_batch(spark):
    df = spark.range(90).selectExpr("id as contentid", "40.7 + (id % 9) / 1e4 as latitude", "-74 + (id % 7) / 1e4 as longitude", "id % 2 as cell")

    def near(new, old=None):
        spot = "contentid", "latitude", "longitude", 50
        found = blocking.near_pairs(new, *spot, block="cell").select("contentid1", "contentid2")
        if old is None:
            return found
        across = blocking.near_pairs(new, *spot, block="cell", against=old)
        return found.unionByName(across.select(F.least("contentid1", "contentid2").alias("contentid1"), F.greatest("contentid1", "contentid2").alias("contentid2")))

    pairs = scratch_path(spark, "pairs")
    frames = [df.filter("contentid < 30"), df.filter("contentid between 30 and 59"), df.filter("contentid >= 55")]
    jobs.incremental_compare(_stream(spark, frames), scratch_path(spark, "base"), pairs, scratch_path(spark, "p"), near).awaitTermination()
    got = _rows(spark.read.parquet(pairs).select("contentid1", "contentid2"))
    assert got == _rows(near(df)) and len(got) == len(set(got))


def test_stream_stores_points_not_pairs_of_copies(spark, tmp_path, monkeypatch):
    rows = [(16 * i, "One title for a crowd", "en", "s") for i in range(300)] + [(None, "One title for a crowd", "en", "s")]
    rows += [(16 * i + 1 + i % 3, "One title for a crowd", "en", "s") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(copies, "CHUNK_ROWS", 100)
    stored, real = [], jobs._store
    monkeypatch.setattr(jobs, "_store", lambda df, path, *at: (real(df, path, *at), stored.append(path)))
    pairs = streams.stream_incremental_pairs(spark, str(tmp_path))
    near = blocking.near_pairs(places(spark, str(tmp_path)), "contentid", "latitude", "longitude", 50, block="cell")
    want = near.select("contentid1", "contentid2", F.round("distance_m", 2).alias("distance_m"))
    assert _rows(pairs) == _rows(want) and pairs.count() > 44850
    assert spark.read.parquet(next(p for p in stored if "/pairs-" in p)).count() < 500


def test_stream_upsert_late_arrival_loses(spark):
    first = spark.createDataFrame([(1, 5, "new"), (2, 1, "only")], "k int, o int, v string")
    late = spark.createDataFrame([(1, 3, "late")], "k int, o int, v string")
    path = scratch_path(spark, "latest")
    jobs.stream_upsert(_stream(spark, [first, late]), path, scratch_path(spark, "p"), ["k"], ["o"]).awaitTermination()
    assert _rows(jobs.latest_versions(spark.read.parquet(path), ["k"], ["o"])) == [(1, 5, "new"), (2, 1, "only")]
    # a second run with a checkpoint of its own adds to the first one's output
    newer = spark.createDataFrame([(1, 9, "newest")], "k int, o int, v string")
    jobs.stream_upsert(_stream(spark, [newer]), path, scratch_path(spark, "p"), ["k"], ["o"]).awaitTermination()
    small = scratch_path(spark, "compacted")
    jobs.compact(spark.read.parquet(path), small, ["k"], ["o"])
    assert _rows(jobs.latest_versions(spark.read.parquet(small), ["k"], ["o"])) == [(1, 9, "newest"), (2, 1, "only")]
    assert spark.read.parquet(small).count() == 2


def test_first_seen_ever(spark):
    frames = [spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "id string, n int"), spark.createDataFrame([("a", 4), ("b", 5)], "id string, n int")]
    path = scratch_path(spark, "seen")
    jobs.first_seen_ever(_stream(spark, frames), path, scratch_path(spark, "p"), "id", ["n"]).awaitTermination()
    assert [r[0] for r in _rows(spark.read.parquet(path).select("id"))] == ["a", "b"]


def test_first_seen_ever_over_restarts_and_runs(spark):
    kind = "id string, n int, extra map<string,int>"
    path, progress, arrivals = (scratch_path(spark, x) for x in ("seen", "p", "arrivals"))

    def arrive(rows, checkpoint):
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(arrivals)
        stream = spark.readStream.schema(kind).parquet(arrivals)
        query = jobs.first_seen_ever(stream, path, checkpoint, "id", ["n"])
        query.awaitTermination()
        return sorted((r.id, r.n) for r in spark.read.parquet(path).collect())

    assert arrive([("a", 2, {"x": 1}), ("a", 1, None)] * 50, progress) == [("a", 1)]
    assert arrive([("a", 0, None), ("b", None, None)], progress) == [("a", 1), ("b", None)]
    # another checkpoint reads all arrivals again, and stores the new id only
    other = scratch_path(spark, "p")
    assert arrive([("c", 7, None)], other) == [("a", 1), ("b", None), ("c", 7)]
    assert arrive([("c", 1, None), ("d", 1, None)], other) == [("a", 1), ("b", None), ("c", 7), ("d", 1)]
    assert all(spark.conf.get(name, None) != value for name, value in jobs.STATE_SETTINGS.items())
