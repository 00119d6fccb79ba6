"""Large JSON arrays and collections, cut at every possible place."""

import json
import random

import pytest
from pyspark.sql import functions as F

from placeweave.sources import json_elements, readers

TEXTS = ["", "plain", '"', "\\", '\\"', "}", "{", '"}{"', "[{]}", "\\\\}", "\u00e9}\u4e2d{", 'a "features":[{ b', "x" * 300]


@pytest.fixture
def tiny_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda size: spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def _value(rng, depth=0):
    kind = rng.randrange(6 if depth < 3 else 4)
    if kind == 4:
        return [_value(rng, depth + 1) for _ in range(rng.randrange(3))]
    if kind == 5:
        return {rng.choice(TEXTS): _value(rng, depth + 1) for _ in range(rng.randrange(3))}
    return [rng.choice(TEXTS), rng.randrange(100), None, True][kind]


@pytest.mark.parametrize("size, seed, indent", [(97, 1, None), (300, 2, 1), (1 << 20, 5, None)])
def test_array_of_objects_in_splits(spark, tmp_path, tiny_splits, size, seed, indent):
    rng = random.Random(seed)
    files = {f"f{n}.json": [{"id": i, "v": _value(rng)} for i in range(n)] for n in (0, 1, 7, 25)}
    for name, rows in files.items():
        (tmp_path / name).write_text(json.dumps(rows, indent=indent, ensure_ascii=seed % 2 == 0))
    (tmp_path / "empty.json").write_text("")
    tiny_splits(size)
    got = json_elements.read_elements(spark, str(tmp_path)).collect()
    found = {(r.file.rsplit("/", 1)[1], r.element): json.loads(r.value) for r in got}
    assert len(found) == len(got)
    assert found == {(name, i): row for name, rows in files.items() for i, row in enumerate(rows)}


@pytest.mark.parametrize("size", [150])
def test_collection_in_splits(spark, tmp_path, tiny_splits, size):
    rng = random.Random(size)
    features = [
        {"type": "Feature", "properties": {"i": i, "t": rng.choice(TEXTS)}, "geometry": rng.choice([None, {"type": "Polygon", "coordinates": [[[0, 1], [2, 3], [0, 1]]]}])}
        for i in range(30)
    ]
    doc = {
        "type": "FeatureCollection", "name": 'a } "features":[', "crs": {"properties": {"name": "x"}},
        "features": features, "after": {"deep": {"er": 1}}, "bbox": [0, 0, 1, 1], "others": [{"type": "Other"}],
    }
    (tmp_path / "c.geojson").write_text(json.dumps(doc))
    tiny_splits(size)
    rows = readers.read_geojson(spark, str(tmp_path / "c.geojson")).orderBy("feature").collect()
    assert [json.loads(r.properties) for r in rows] == [f["properties"] for f in features]
    assert [r.kind for r in rows] == [f["geometry"] and "Polygon" for f in features]
    assert [r.feature for r in rows] == list(range(30))


def test_one_file_is_read_by_several_tasks(spark, tmp_path, tiny_splits):
    (tmp_path / "a.json").write_text(json.dumps([{"n": i} for i in range(5000)]))
    tiny_splits(8192)
    assert json_elements._pieces(spark, str(tmp_path / "a.json")).rdd.getNumPartitions() > 3
    rows = json_elements.read_object_array(spark, str(tmp_path / "a.json"), "n long")
    assert rows.agg(F.sum("n"), F.count("n")).first() == (4999 * 2500, 5000)


def test_arrays_one_after_the_other(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"n":1},null,{"n":2}]\n[]\n[{"n":3}]\n')
    rows = json_elements.read_object_array(spark, str(tmp_path / "a.json"), "n long")
    assert sorted(r.n for r in rows.collect()) == [1, 2, 3]
