"""Versioned tables: a table that can be filled in place while others read it.

A table is a folder of data files and a folder of numbered manifests.  Its rows lie in a
fixed number of buckets; a manifest names the files of each bucket.  A change writes new
files for the buckets it touches only and then commits a manifest, by creating the next
number without overwriting.  So

* readers see a whole version, the newest that is committed, or an older one by number;
* a crash before the commit leaves the table as it was (its files are never named);
* of two writers that start from the same version one fails with ``VersionConflict``.

The file system must refuse to create a file that exists (HDFS, local disks and object
stores with conditional writes do).  A manifest cut short by a crash is not a version.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET = "__bucket"
DEFAULT_BUCKETS = 32


class VersionConflict(RuntimeError):
    """Another writer committed this version first."""


@dataclass(frozen=True)
class Version:
    number: int
    schema: str  # of the rows, as JSON
    files: dict[int, list[str]]  # bucket -> folders of its rows

    @property
    def buckets(self) -> int:
        return len(self.files)

    def struct(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))


def _fs(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    where, fs = _fs(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(where)) if fs.exists(where) else []


def _manifest(root: str, number: int) -> str:
    return f"{root}/_versions/v{number:012d}.json"


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of all manifests, oldest first, whole or not."""
    return [int(n[1:-5]) for n in _names(spark, f"{root}/_versions") if n.startswith("v") and n.endswith(".json")]


def load(spark: SparkSession, root: str, number: int) -> Version | None:
    """A version by number; None where its manifest was cut short."""
    text = "\n".join(r[0] for r in spark.read.text(_manifest(root, number)).collect())
    try:
        found = json.loads(text)
        return Version(found["number"], found["schema"], {int(k): v for k, v in found["files"].items()})
    except (ValueError, KeyError):
        return None


def current(spark: SparkSession, root: str) -> Version:
    """The newest whole version."""
    for number in reversed(versions(spark, root)):
        if found := load(spark, root, number):
            return found
    raise FileNotFoundError(f"{root} holds no version of a table")


def commit(spark: SparkSession, root: str, version: Version) -> Version:
    """Make the version current, unless its number is taken."""
    where, fs = _fs(spark, _manifest(root, version.number))
    body = json.dumps({"number": version.number, "schema": version.schema, "files": version.files})
    try:
        out = fs.create(where, False)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            raise VersionConflict(f"version {version.number} of {root} is there already") from e
        raise
    out.write(bytearray(body, "utf-8"))
    out.close()
    return version


def create(rows: DataFrame, root: str, bucket: Column, buckets: int = DEFAULT_BUCKETS) -> Version:
    """Write a new table; ``bucket`` gives each row a whole number, taken modulo ``buckets``."""
    folder = f"{root}/data/{uuid.uuid4().hex}"
    rows.withColumn(BUCKET, F.coalesce(F.pmod(bucket, F.lit(buckets)), F.lit(0)).cast("int")).write.partitionBy(BUCKET).parquet(folder)
    there = set(_names(rows.sparkSession, folder))
    files = {b: [f"{folder}/{BUCKET}={b}"] if f"{BUCKET}={b}" in there else [] for b in range(buckets)}
    return commit(rows.sparkSession, root, Version(0, rows.schema.json(), files))


def read(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """The rows of the current version, or of the one with the number."""
    version = current(spark, root) if number is None else load(spark, root, number)
    if version is None:
        raise FileNotFoundError(f"{root} has no whole version {number}")
    return read_buckets(spark, version, range(version.buckets))


def read_buckets(spark: SparkSession, version: Version, buckets) -> DataFrame:
    paths = [p for b in buckets for p in version.files[b]]
    return spark.read.schema(version.struct()).parquet(*paths) if paths else spark.createDataFrame([], version.struct())


def rewrite(spark: SparkSession, root: str, base: Version, bucket: int, change: Callable[[DataFrame], DataFrame], before_commit: Callable[[], None] | None = None) -> Version:
    """A new version in which one bucket is what ``change`` makes of its rows; all other
    buckets keep their files."""
    rows = change(read_buckets(spark, base, [bucket]))
    folder = f"{root}/data/{uuid.uuid4().hex}"
    rows.select(*base.struct().names).write.parquet(folder)
    if before_commit:
        before_commit()
    return commit(spark, root, Version(base.number + 1, base.schema, {**base.files, bucket: [folder]}))
