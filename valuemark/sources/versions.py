"""Tables of versions: a write is a folder of its own, and one small file that appears whole makes it the table.

A table's folder holds data folders, one a write, and a log of numbered files. A log file names the data folders that
make up the table; the one with the highest number counts. It is written aside and renamed to its number, which fails
if another writer has taken that number. So a reader sees the old table or the new one, whatever dies in between, and
two writers cannot both win. Tables with a partition column replace the partitions at hand and name the folders of the
others again.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG, PART = "_log", "_part"
#: Versions that stay when old ones are cleared, so that whoever reads the last but one may finish.
KEPT_VERSIONS = 2


class Conflict(RuntimeError):
    """Another writer was first."""


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark._jvm
        self._path = lambda tail: jvm.org.apache.hadoop.fs.Path(f"{self.path}/{tail}")
        self._store = jvm.org.apache.hadoop.fs.Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _names(self, tail: str) -> list[str]:
        where = self._path(tail)
        return sorted(f.getPath().getName() for f in self._store.listStatus(where)) if self._store.exists(where) else []

    def versions(self) -> list[int]:
        return [int(n.split(".")[0]) for n in self._names(LOG) if n[0].isdigit()]

    def parts(self, version: int | None = None) -> list[dict]:
        """The data folders of a version (the last), each with its partition's value."""
        known = self.versions()
        if not known:
            return []
        stream = self._store.open(self._path(f"{LOG}/{(known[-1] if version is None else version):012d}.json"))
        try:
            return json.loads(bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())["parts"]
        finally:
            stream.close()

    def exists(self) -> bool:
        return bool(self.versions())

    def read(self, version: int | None = None) -> DataFrame:
        parts = self.parts(version)
        if not parts:
            raise FileNotFoundError(f"no version of {self.path}")
        return self.spark.read.schema(parts[0]["schema"]).parquet(*[f"{self.path}/{p['folder']}" for p in parts])

    def stage(self, df: DataFrame, partition: str | None = None) -> list[dict]:
        """Write the data of a version that nobody sees yet."""
        folder = f"data-{uuid.uuid4().hex}"
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        if partition is None:
            df.write.parquet(f"{self.path}/{folder}")
            return [{"folder": folder, "value": None, "schema": schema}]
        df.withColumn(PART, F.coalesce(F.col(partition).cast("string"), F.lit(""))).write.partitionBy(PART).parquet(f"{self.path}/{folder}")
        return [{"folder": f"{folder}/{n}", "value": n.split("=", 1)[1], "schema": schema} for n in self._names(folder) if n.startswith(f"{PART}=")]

    def commit(self, parts: list[dict], replaced: list[dict] | None = None, after: int | None = None) -> int:
        """Make staged data the table; ``replaced`` stay beside it. ``after`` is the version that the writer saw."""
        known = self.versions()
        last = known[-1] if known else 0
        if after is not None and last != after:
            raise Conflict(f"{self.path} is at version {last}, not {after}")
        number, aside = last + 1, self._path(f"{LOG}/_aside-{uuid.uuid4().hex}")
        out = self._store.create(aside, False)
        try:
            out.write(bytearray(json.dumps({"parts": [*(replaced or []), *parts]}).encode()))
        finally:
            out.close()
        if not self._store.rename(aside, self._path(f"{LOG}/{number:012d}.json")):
            self._store.delete(aside, False)
            raise Conflict(f"version {number} of {self.path} is taken")
        return number

    def write(self, df: DataFrame, partition: str | None = None) -> int:
        """The number of the new version; without data in a partition's write, the table stays as it is."""
        before = self.versions()
        after = before[-1] if before else 0
        parts = self.stage(df, partition)
        stay = []
        if partition is not None:
            new = {p["value"] for p in parts}
            stay = [p for p in self.parts() if p["value"] not in new and p["value"] is not None]
            if not parts:
                return after or self.commit(self.stage(df), after=after)
        return self.commit(parts, stay, after)

    def clear(self, keep: int = KEPT_VERSIONS) -> list[str]:
        """Delete data that none of the last ``keep`` versions names, and their log files; what was deleted."""
        known = self.versions()
        stay = {p["folder"].split("/")[0] for v in known[-keep:] for p in self.parts(v)}
        gone = [n for n in self._names("") if n.startswith("data-") and n not in stay]
        for n in [*gone, *(f"{LOG}/{v:012d}.json" for v in known[:-keep])]:
            self._store.delete(self._path(n), True)
        return gone
