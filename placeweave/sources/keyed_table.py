"""Keyed tables in hash buckets, with versions.

    table/data/v00000002/bucket=7/part-...parquet
    table/versions/00000002                         where each bucket's rows are

A row's bucket follows from its key. An upsert reads and writes the buckets that
its keys touch and nothing else; the new version's manifest names the new
folders for these and the old ones for the rest. A version exists from the
moment its manifest is renamed into ``versions``, one step that either happens
or doesn't: until then, and after any failure before, readers see the version
before. Earlier versions stay readable until ``vacuum``. One writer at a time.

Null keys are keys; of several new rows of a key the highest in ``order`` wins.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placeweave.operators.keyed import one_per_key, upsert_rows

BUCKETS = 64


class Files:
    """The few file operations needed, on whatever store the path is in."""

    def __init__(self, spark: SparkSession, root: str):
        self.java, self.root = spark._jvm.org.apache.hadoop.fs, root.rstrip("/")
        self.store = self.path("").getFileSystem(spark._jsc.sc().hadoopConfiguration())
        self.io = spark._jvm.org.apache.commons.io.IOUtils

    def path(self, name: str):
        return self.java.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str) -> list[str]:
        place = self.path(folder)
        return [s.getPath().getName() for s in self.store.listStatus(place)] if self.store.exists(place) else []

    def read(self, name: str) -> str:
        stream = self.store.open(self.path(name))
        try:
            return self.io.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, name: str, content: str) -> None:
        """Write beside the target, then rename: readers see all or nothing."""
        draft = self.path(f"{name}.draft")
        stream = self.store.create(draft, True)
        stream.write(bytearray(content.encode()))
        stream.close()
        if self.store.exists(self.path(name)) or not self.store.rename(draft, self.path(name)):
            raise FileExistsError(f"another writer was first: {self.root}/{name}")

    def delete(self, name: str) -> None:
        self.store.delete(self.path(name), True)


class KeyedTable:
    """A table at ``path``; ``create`` makes one, the constructor opens one."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.files = spark, path.rstrip("/"), Files(spark, path)

    @classmethod
    def create(cls, df: DataFrame, path: str, keys: list[str], buckets: int = BUCKETS) -> KeyedTable:
        """A new table of the rows of ``df``, one row per key. Take so many
        buckets that one fits a task; their number stays."""
        table = cls(df.sparkSession, path)
        if table.versions():
            raise FileExistsError(f"there is a table at {path}")
        manifest = {"keys": keys, "buckets": buckets, "schema": df.schema.jsonValue(), "places": {}}
        ranking = [F.xxhash64(*df.columns)]
        table._write(one_per_key(df, keys, ranking), manifest, 1)
        return table

    def versions(self) -> list[int]:
        return sorted(int(n) for n in self.files.names("versions") if n.isdigit())

    def manifest(self, version: int | None = None) -> dict:
        known = self.versions()
        version = known[-1] if version is None else version
        if version not in known:
            raise LookupError(f"no version {version} of {self.path}")
        return {**json.loads(self.files.read(f"versions/{version:08d}")), "version": version}

    def _bucket(self, manifest: dict) -> Column:
        return F.pmod(F.xxhash64(*manifest["keys"]), F.lit(manifest["buckets"])).cast("int")

    def _read(self, manifest: dict, buckets=None) -> DataFrame:
        schema = T.StructType.fromJson(manifest["schema"])
        places = manifest["places"]
        wanted = [f"{self.path}/{p}" for b, p in places.items() if buckets is None or int(b) in buckets]
        if not wanted:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*wanted)

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the newest unless one is given."""
        return self._read(self.manifest(version))

    def _write(self, rows: DataFrame, manifest: dict, version: int, touched=()) -> None:
        folder = f"data/v{version:08d}"
        self.files.delete(folder)  # of an attempt that never became a version
        placed = rows.withColumn("bucket", self._bucket(manifest))
        placed.repartition(manifest["buckets"], "bucket").write.partitionBy("bucket").parquet(f"{self.path}/{folder}")
        places = {b: p for b, p in manifest["places"].items() if int(b) not in touched}
        for name in self.files.names(folder):
            if name.startswith("bucket="):
                places[name.removeprefix("bucket=")] = f"{folder}/{name}"
        kept = {k: manifest[k] for k in ("keys", "buckets", "schema")}
        self.files.publish(f"versions/{version:08d}", json.dumps({**kept, "places": places}))

    def _touched(self, new: DataFrame, manifest: dict) -> set[int]:
        return {r.b for r in new.select(self._bucket(manifest).alias("b")).distinct().collect()}

    def upsert(self, new: DataFrame, order: list[str] | None = None) -> int:
        """Rows of ``new`` replace those of their key or are added; the number of
        the version that holds them."""
        manifest = self.manifest()
        touched = self._touched(new, manifest)
        if not touched:
            return manifest["version"]
        merged = upsert_rows(self._read(manifest, touched), new, manifest["keys"], order)
        names = T.StructType.fromJson(manifest["schema"]).names
        self._write(merged.select(*names), manifest, manifest["version"] + 1, touched)
        return manifest["version"] + 1

    def delete(self, keys: DataFrame) -> int:
        """Rows whose key is listed go."""
        manifest = self.manifest()
        touched = self._touched(keys, manifest)
        if not touched:
            return manifest["version"]
        listed = keys.select(*[F.col(k).alias(f"_{k}") for k in manifest["keys"]]).distinct()
        rows = self._read(manifest, touched)
        same = [rows[k].eqNullSafe(listed[f"_{k}"]) for k in manifest["keys"]]
        self._write(rows.join(listed, same, "left_anti"), manifest, manifest["version"] + 1, touched)
        return manifest["version"] + 1

    def vacuum(self, keep: int = 1) -> None:
        """Forget all but the last ``keep`` versions and the folders that only
        these used."""
        known = self.versions()
        kept = known[-keep:]
        used = {p for v in kept for p in self.manifest(v)["places"].values()}
        for version in known[:-keep]:
            self.files.delete(f"versions/{version:08d}")
        for folder in self.files.names("data"):
            for name in self.files.names(f"data/{folder}"):
                if name.startswith("bucket=") and f"data/{folder}/{name}" not in used:
                    self.files.delete(f"data/{folder}/{name}")
