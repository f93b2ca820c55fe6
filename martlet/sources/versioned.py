"""Table sets that change as one: folders of parts, and a manifest written last.

A set holds tables, a table holds parts (a month, a key bucket, ``all``), and a part is a
folder of parquet files that is never changed once written. A version of the set is one
small manifest that names the folder of every part. A commit writes new folders for the
parts that change, then the manifest under the next number; a rename that refuses to
replace a file makes the switch, so that

* a reader resolves every table through one manifest and sees one version of all of them,
  whatever fails or is written meanwhile;
* of two writers that start from one version, one commits and the other gets ``Conflict``;
* parts that a commit does not touch keep their folders: nothing is copied;
* any kept version can be read, or made the newest again (``rollback``).

Folders that no kept manifest names are removed by ``expire`` only. A writer that fails
leaves folders that no manifest names; they count as expired ones once a later version exists.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.session import shuffles_removed
from martlet.sources.sinks import PACKED, drop_files, subfolders

WHOLE = "all"  # the part of a table that has only one
PART = "part"  # column that names a row's part when written; not stored in the files


class Conflict(RuntimeError):
    """Another writer committed since the version this commit started from."""


@dataclass(frozen=True)
class TableVersion:
    schema: T.StructType
    parts: dict[str, str]  # part -> folder below the set's root


@dataclass(frozen=True)
class Manifest:
    version: int
    tables: dict[str, TableVersion] = field(default_factory=dict)
    info: dict = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps({"version": self.version, "info": self.info, "tables": {
            name: {"schema": t.schema.jsonValue(), "parts": t.parts} for name, t in self.tables.items()}})

    @classmethod
    def from_json(cls, text: str) -> Manifest:
        raw = json.loads(text)
        return cls(raw["version"], {
            name: TableVersion(T.StructType.fromJson(t["schema"]), t["parts"])
            for name, t in raw["tables"].items()}, raw["info"])


class VersionedTables:
    """The table set under ``root`` (a folder on any file system Spark can write)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()

    # -- manifests ---------------------------------------------------------------

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def versions(self) -> list[int]:
        """Numbers of the committed versions, oldest first."""
        folder = self._path("versions")
        fs = folder.getFileSystem(self._conf)
        names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and not n.startswith("."))

    def manifest(self, version: int | None = None) -> Manifest:
        """A version's manifest; the newest by default, an empty one before the first commit."""
        if version is None:
            version = max(self.versions(), default=0)
        if version == 0:
            return Manifest(0)
        path = self._path(f"versions/{version:012d}.json")
        stream = path.getFileSystem(self._conf).open(path)
        try:
            return Manifest.from_json(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def info(self, manifest: Manifest) -> dict:
        """What the commit that made these tables said of them, rolled back to or not."""
        while "rollback_to" in manifest.info:
            manifest = self.manifest(manifest.info["rollback_to"])
        return manifest.info

    def _publish(self, manifest: Manifest) -> None:
        hidden = self._path(f"versions/.{uuid.uuid4().hex}")
        stream = hidden.getFileSystem(self._conf).create(hidden, True)
        stream.write(bytearray(manifest.to_json().encode()))
        stream.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(hidden.toUri(), self._conf)
        kind = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(kind, 0)  # refuse to replace
        try:
            context.rename(hidden, self._path(f"versions/{manifest.version:012d}.json"), options)
        except Exception as error:  # noqa: BLE001 - a Java exception of the file system
            drop_files(self.spark, hidden.toString())
            if "FileAlreadyExists" in str(error):
                raise Conflict(f"version {manifest.version} is there already") from error
            raise

    # -- writing -----------------------------------------------------------------

    def write(self, table: str, rows: DataFrame, part: Column | str | None = None) -> TableVersion:
        """New folders with ``rows``, split by the text ``part``; not yet in any version.

        A column given by name only names the part and is not stored. Rows are dealt to
        tasks by their part, and a part that holds many rows is split over several tasks
        at run time (AQE rebalancing).
        """
        folder = f"data/{time.time_ns():020d}-{uuid.uuid4().hex[:8]}/{table}"
        if isinstance(part, str):
            named = rows.withColumnRenamed(part, PART)
        else:
            named = rows.withColumn(PART, F.lit(WHOLE) if part is None else part)
        if part is not None:
            named = named.hint("rebalance", PART)
        with shuffles_removed(self.spark):
            named.write.options(**PACKED).partitionBy(PART).parquet(f"{self.root}/{folder}")
        return TableVersion(_nullable(named.drop(PART).schema), {
            name.split("=", 1)[1]: f"{folder}/{name}"
            for name in subfolders(self.spark, f"{self.root}/{folder}") if name.startswith(f"{PART}=")})

    def commit(self, base: Manifest, tables: dict[str, TableVersion],
               replaced: dict[str, Iterable[str]] | None = None, **info) -> Manifest:
        """Make ``tables`` the next version after ``base``; its manifest.

        A table takes the place of its old self. For tables in ``replaced`` only the named
        parts do: they get the new folders (or none, if empty now), the others stay.
        Tables that are not named stay as they are in ``base``. The version's ``info`` holds
        what is given here and the replaced parts.
        """
        merged = dict(base.tables)
        for name, new in tables.items():
            parts = new.parts
            if replaced is not None and name in replaced and name in base.tables:
                gone = set(replaced[name])
                if extra := set(parts) - gone:
                    raise ValueError(f"{name}: rows for parts that are not replaced: {sorted(extra)}")
                parts = {k: v for k, v in base.tables[name].parts.items() if k not in gone} | parts
            merged[name] = TableVersion(new.schema, parts)
        info["replaced"] = {name: sorted(parts) for name, parts in (replaced or {}).items()}
        manifest = Manifest(base.version + 1, merged, info)
        self._publish(manifest)
        return manifest

    def rollback(self, version: int) -> Manifest:
        """The tables of an earlier version as the newest version; nothing is copied."""
        old, now = self.manifest(version), self.manifest()
        manifest = Manifest(now.version + 1, old.tables, {"rollback_to": version})
        self._publish(manifest)
        return manifest

    def expire(self, keep: int = 2) -> list[int]:
        """Remove all but the ``keep`` newest versions and the folders only they name."""
        numbers = self.versions()
        gone, kept = numbers[:-keep], numbers[-keep:]
        named = {folder for v in kept for t in self.manifest(v).tables.values() for folder in t.parts.values()}
        newest = max((f.split("/")[1] for f in named), default="")
        for version in gone:
            drop_files(self.spark, f"{self.root}/versions/{version:012d}.json")
        for commit in subfolders(self.spark, f"{self.root}/data"):
            if commit > newest:
                continue  # may belong to a commit under way
            for table in subfolders(self.spark, f"{self.root}/data/{commit}"):
                for part in subfolders(self.spark, f"{self.root}/data/{commit}/{table}"):
                    if f"data/{commit}/{table}/{part}" not in named:
                        drop_files(self.spark, f"{self.root}/data/{commit}/{table}/{part}")
        return gone

    # -- reading -----------------------------------------------------------------

    def read(self, manifest: Manifest, table: str, parts: Iterable[str] | None = None,
             part_as: str | None = None) -> DataFrame:
        """A table of one version, or only the named parts of it: no other folder is listed.

        ``part_as`` adds the name of each row's part as a column."""
        found = manifest.tables[table]
        wanted = found.parts if parts is None else [p for p in parts if p in found.parts]
        folders = [f"{self.root}/{found.parts[p]}" for p in sorted(wanted)]
        if not folders:
            extra = [T.StructField(part_as, T.StringType())] if part_as else []
            return self.spark.createDataFrame([], T.StructType([*found.schema.fields, *extra]))
        rows = self.spark.read.schema(found.schema).parquet(*folders)
        if part_as:
            rows = rows.withColumn(part_as, F.regexp_extract("_metadata.file_path", f"/{PART}=([^/]+)/", 1))
        return rows

    def register(self, manifest: Manifest | None = None, prefix: str = "") -> list[str]:
        """Temporary views of all tables of one version, for SQL; their names."""
        manifest = manifest or self.manifest()
        names = {table: prefix + table for table in manifest.tables}
        for table, name in names.items():
            self.read(manifest, table).createOrReplaceTempView(name)
        return sorted(names.values())


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
