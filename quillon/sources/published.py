"""Tables that appear as a whole: data goes to a folder of its own, then one small file names the new version.

``path/_versions/<number>.json`` lists the folders that make the version, ``path/data`` has them.  Readers
take the highest number, so a write that fails leaves the version before it as it was, and a reader sees one
version or the next, never a mixture.  The version file is written under another name and renamed, which is
atomic where the file system renames atomically; one writer at a time is assumed, and a second one that meets a
version of its own number fails.

A table with keys is dealt into buckets by a hash of them.  ``upsert`` rewrites the buckets that have new
rows; the files of all others stay what they were.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Rows of a bucket are dealt to so many tasks, so that a large bucket isn't written by one of them.
SALT = 4
BUCKET = "_bucket"


class _Folder:
    """The few file operations that Spark's API lacks, on the file system of a path."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.root = spark._jvm, path.rstrip("/")
        self.fs = self.path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, name: str) -> list[str]:
        where = self.path(name)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(where)) if self.fs.exists(where) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, name: str, text: str) -> None:
        """A file that is there with all of ``text`` or not at all; it must be new."""
        staged = self.path(f"{name}.{uuid.uuid4().hex}.tmp")
        stream = self.fs.create(staged, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if self.fs.exists(self.path(name)) or not self.fs.rename(staged, self.path(name)):
            self.fs.delete(staged, False)
            raise ValueError(f"{self.root}: version {name} is there already")

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


def _versions(folder: _Folder) -> list[str]:
    return [x for x in folder.names("_versions") if x.endswith(".json")]


def current(spark: SparkSession, path: str) -> dict | None:
    """The newest version: its number, schema, keys, buckets, parts (folder of each bucket) and note."""
    folder = _Folder(spark, path)
    names = _versions(folder)
    return json.loads(folder.read(f"_versions/{names[-1]}")) if names else None


def _announce(spark: SparkSession, path: str, version: dict) -> None:
    _Folder(spark, path).put(f"_versions/{version['number']:012d}.json", json.dumps(version, sort_keys=True))


def _bucket(keys: Sequence[str], buckets: int):
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _write(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> dict[str, str]:
    """Write ``df`` and return the folder of each bucket that has rows; what a failed write leaves is deleted."""
    place, folder = f"data/{uuid.uuid4().hex}", _Folder(df.sparkSession, path)
    try:
        if not keys:
            df.write.option("compression", "zstd").parquet(f"{path}/{place}")
            return {"": place}
        dealt = df.withColumn(BUCKET, _bucket(keys, buckets))
        dealt = dealt.repartition(F.col(BUCKET), F.pmod(F.xxhash64(*keys, F.lit(1)), F.lit(SALT)))
        dealt.write.option("compression", "zstd").partitionBy(BUCKET).parquet(f"{path}/{place}")
    except Exception:
        folder.delete(place)
        raise
    return {x.partition("=")[2]: f"{place}/{x}" for x in folder.names(place) if x.startswith(f"{BUCKET}=")}


def publish(
    df: DataFrame, path: str, *, keys: Sequence[str] = (), buckets: int = 32, note: str = "", rules: Mapping[str, Column] | None = None, counts: Mapping[str, Column] | None = None
) -> int:
    """Make ``df`` the whole table; returns the version's number.

    ``rules`` has conditions that hold for each row; rows for which one is not true are counted in what was
    written (its columns that the rules name, not the plan that made it), and where there are any, the version
    isn't announced and the counts are an error.  ``counts`` has further conditions whose rows are counted.  The
    version keeps the number of rows and all counts as ``seen``.  If the write fails, readers keep the version
    before.  ``df`` may read the table itself.
    """
    spark = df.sparkSession
    before = current(spark, path)
    parts = _write(df, path, keys, buckets)
    broken = [F.count_if(~F.coalesce(c, F.lit(False))).alias(name) for name, c in (rules or {}).items()]
    others = [F.count_if(c).alias(name) for name, c in (counts or {}).items()]
    staged = _read(spark, path, {"schema": df.schema.json(), "parts": parts})
    seen = staged.agg(F.count(F.lit(1)).alias("n_rows"), *broken, *others).first().asDict() if broken or others else {}
    bad = {name: seen[name] for name in rules or {} if seen[name]}
    if bad:
        _Folder(spark, path).delete("/".join(next(iter(parts.values())).split("/")[:2]))
        raise ValueError(f"{path}: " + ", ".join(f"{n} rows break {name}" for name, n in bad.items()))
    number = before["number"] + 1 if before else 0
    _announce(spark, path, {"number": number, "schema": df.schema.json(), "keys": list(keys), "buckets": buckets if keys else 0, "parts": parts, "note": note, "seen": seen})
    return number


def _read(spark: SparkSession, path: str, version: dict, only: Sequence[str] | None = None) -> DataFrame:
    schema = StructType.fromJson(json.loads(version["schema"]))
    parts = [p for b, p in sorted(version["parts"].items()) if only is None or b in only]
    return spark.read.schema(schema).parquet(*[f"{path}/{p}" for p in parts]) if parts else spark.createDataFrame([], schema)


def read(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The newest version, or version ``number``."""
    if number is None:
        version = current(spark, path)
    else:
        version = json.loads(_Folder(spark, path).read(f"_versions/{number:012d}.json"))
    if version is None:
        raise ValueError(f"no table at {path}")
    return _read(spark, path, version)


def upsert(changes: DataFrame, path: str, *, keys: Sequence[str] = (), buckets: int = 32, note: str = "") -> list[int]:
    """Rows of ``changes`` replace those with the same keys, or are new; returns the buckets written.

    Keys are unique in ``changes`` and never null.  The first call makes the table, with these keys and buckets; later
    ones use the table's own.  A call without rows makes no version.
    """
    spark = changes.sparkSession
    version = current(spark, path)
    if version is None:
        publish(changes, path, keys=keys, buckets=buckets, note=note)
        return sorted(map(int, current(spark, path)["parts"]))
    keys, buckets = version["keys"], version["buckets"]
    schema = StructType.fromJson(json.loads(version["schema"]))
    changes = changes.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in schema])
    staged = _write(changes, path, keys, buckets)
    if not staged:
        return []
    new = spark.read.schema(schema).parquet(*[f"{path}/{p}" for p in staged.values()])
    old = _read(spark, path, version, list(staged))
    merged = old.join(new, list(keys), "left_anti").unionByName(new)
    parts = version["parts"] | _write(merged, path, keys, buckets)
    _announce(spark, path, {k: v for k, v in version.items() if k != "seen"} | {"number": version["number"] + 1, "parts": parts, "note": note})
    _Folder(spark, path).delete(next(iter(staged.values())).rpartition("/")[0])
    return sorted(map(int, staged))


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete all but the last ``keep`` versions, and data that none of those has; returns the folders deleted."""
    folder = _Folder(spark, path)
    names = _versions(folder)
    kept = [json.loads(folder.read(f"_versions/{n}")) for n in names[-keep:]]
    used = {p for v in kept for p in v["parts"].values()}
    for n in names[:-keep]:
        folder.delete(f"_versions/{n}")
    gone = 0
    for place in folder.names("data"):
        inside = [f"data/{place}/{x}" for x in folder.names(f"data/{place}") if x.startswith(f"{BUCKET}=")]
        if f"data/{place}" in used:
            continue
        idle = [x for x in inside if x not in used]
        if len(idle) == len(inside):
            folder.delete(f"data/{place}")
            gone += 1
        else:
            for x in idle:
                folder.delete(x)
                gone += 1
    return gone
