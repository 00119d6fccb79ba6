"""Versions and buckets of keyed tables."""

import pytest

from placeweave.session import scratch_path
from placeweave.sources.keyed_table import Files, KeyedTable


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, name string, at int")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def table(spark):
    rows = [(i, f"n{i}", 0) for i in range(200)] + [(None, "none", 0), (7, "twice", 0)]
    return KeyedTable.create(frame(spark, rows), scratch_path(spark, "keyed"), ["id"], buckets=8)


def test_upserts_make_versions(spark, table):
    before = {r.id: (r.name, r["at"]) for r in table.read().collect()}
    assert len(before) == 201
    new = frame(spark, [(3, "old", 1), (3, "new", 2), (500, "added", 1), (None, None, 5)])
    assert table.upsert(new, ["at"]) == 2
    after = {r.id: (r.name, r["at"]) for r in table.read().collect()}
    assert after == {**before, 3: ("new", 2), 500: ("added", 1), None: (None, 5)}
    assert {r.id: (r.name, r["at"]) for r in table.read(1).collect()} == before
    assert table.delete(frame(spark, [(3, "", 0), (None, "", 0), (999, "", 0)]).select("id")) == 3
    gone = {k: v for k, v in after.items() if k not in (3, None)}
    assert {r.id: (r.name, r["at"]) for r in table.read().collect()} == gone
    assert table.upsert(new.limit(0)) == 3
    table.vacuum()
    assert table.versions() == [3]
    assert {r.id: (r.name, r["at"]) for r in table.read().collect()} == gone
    with pytest.raises(LookupError):
        table.read(1)


def test_only_touched_buckets_are_written(spark, table):
    table.upsert(frame(spark, [(1, "x", 1)]))
    written = [n for n in table.files.names("data/v00000002") if n.startswith("bucket=")]
    assert len(written) == 1
    first, second = table.manifest(1)["places"], table.manifest(2)["places"]
    assert {b for b in second if second[b] != first[b]} == {written[0].removeprefix("bucket=")}


@pytest.mark.parametrize("step", ["write", "rename"])
def test_a_failure_leaves_the_version_before(spark, table, monkeypatch, step):
    before = rows_of(table.read())
    with monkeypatch.context() as patch:
        if step == "write":
            patch.setattr(KeyedTable, "_bucket", lambda self, m: 1 / 0)
        else:
            patch.setattr(Files, "publish", lambda self, name, content: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            table.upsert(frame(spark, [(1, "x", 1)]))
    again = KeyedTable(spark, table.path)
    assert again.versions() == [1] and rows_of(again.read()) == before
    assert again.upsert(frame(spark, [(1, "x", 1)])) == 2
    assert (1, "x", 1) in rows_of(again.read()) and len(rows_of(again.read())) == len(before)


def test_two_writers_and_two_tables(spark, table):
    other = KeyedTable(spark, table.path)
    manifest = other.manifest()
    table.upsert(frame(spark, [(1, "x", 1)]))
    with pytest.raises(FileExistsError):
        other.files.publish(f"versions/{manifest['version'] + 1:08d}", "{}")
    with pytest.raises(FileExistsError):
        KeyedTable.create(table.read(), table.path, ["id"])


def test_empty_table(spark):
    empty = KeyedTable.create(frame(spark, []), scratch_path(spark, "keyed"), ["id"])
    assert empty.read().count() == 0
    empty.upsert(frame(spark, [(1, "x", 1)]))
    assert rows_of(empty.read()) == [(1, "x", 1)]
