"""A table whose loads may differ in their columns: schemas merge, no value is lost.

Every load is kept as the files it was written in, with the schema it arrived with; the
table's schema is the join of all of them in this order of types:

    nothing < boolean < text,    nothing < long < double < text

Integers of 8 to 32 bits count as long, float as double, anything else joins with another
type as text. A long meets a double as double only where every long of it is one exactly
(at most 2^53 in size, which each load's own write observes); else both become text.

Reading brings each load to the table's schema: columns are matched by name without
regard to case, a column that a load does not have is NULL, and narrower values are cast. Casts
start from the type a value arrived with, so a long that became a double's column and later
text still has its digits. Loads of equal schemas are one scan; nothing is rewritten
when a column widens, and a load's columns are pruned and filtered as in any scan.

Defined cases: an empty load changes the schema and adds no rows; a column of NULLs of
unknown type takes any type; two columns of one load whose names differ in case only raise.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.sources.versioned import Manifest, TableVersion, VersionedTables

TABLE = "rows"
EXACT = 1 << 53  # longs up to this size are doubles exactly

ADDED, MISSING, WIDENED, REORDERED = "added", "missing", "widened", "reordered"


@dataclass(frozen=True)
class Change:
    """How a load differs from the table before it."""
    column: str
    kind: str
    before: str | None
    after: str | None


@dataclass(frozen=True)
class Load:
    """What is known of a load: its schema, and its long columns that no double holds."""
    schema: T.StructType
    inexact: tuple[str, ...] = ()

    def to_info(self) -> dict:
        return {"schema": self.schema.jsonValue(), "inexact": list(self.inexact)}

    @classmethod
    def from_info(cls, info: dict) -> Load:
        return cls(T.StructType.fromJson(info["schema"]), tuple(info["inexact"]))


def general(t: T.DataType) -> T.DataType:
    """The type under which a type is merged."""
    if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType)):
        return T.LongType()
    return T.DoubleType() if isinstance(t, T.FloatType) else t


def join_types(a: T.DataType, b: T.DataType, exact: bool = True) -> T.DataType:
    """The least type that holds the values of both; ``exact``: longs are doubles exactly."""
    a, b = general(a), general(b)
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if exact and {type(a), type(b)} == {T.LongType, T.DoubleType}:
        return T.DoubleType()
    return T.StringType()


def merged(loads: Iterable[Load]) -> T.StructType:
    """The schema of a table with these loads, columns in the order they first came."""
    names: dict[str, str] = {}
    types: dict[str, list[T.DataType]] = {}
    inexact: set[str] = set()
    for load in loads:
        inexact |= {c.lower() for c in load.inexact}
        for f in load.schema.fields:
            names.setdefault(f.name.lower(), f.name)
            types.setdefault(f.name.lower(), []).append(f.dataType)
    out = []
    for key, name in names.items():
        joined: T.DataType = T.NullType()
        kinds = {type(general(t)) for t in types[key]}
        if key in inexact and T.DoubleType in kinds:
            joined = T.StringType()
        for t in types[key]:
            joined = join_types(joined, t)
        out.append(T.StructField(name, joined, True))
    return T.StructType(out)


def changes(before: T.StructType, arriving: T.StructType, after: T.StructType) -> list[Change]:
    """How the schema of a load that made ``before`` to ``after`` differs."""
    old = {f.name.lower(): f for f in before.fields}
    came = {f.name.lower(): f for f in arriving.fields}
    out = []
    for f in after.fields:
        key, now = f.name.lower(), f.dataType.simpleString()
        if key not in old:
            out.append(Change(f.name, ADDED, None, now))
            continue
        was = old[key].dataType.simpleString()
        if key not in came:
            out.append(Change(f.name, MISSING, was, now))
        elif was != now:
            out.append(Change(f.name, WIDENED, was, now))
    both = [k for k in old if k in came]
    for place, key in enumerate(k for k in came if k in old):
        if both[place] != key:
            out.append(Change(old[key].name, REORDERED, str(both.index(key)), str(place)))
    return out


def _stored(schema: T.StructType) -> T.StructType:
    """The columns of a load that files can hold (NULLs of unknown type are not stored)."""
    return T.StructType([f for f in schema.fields if not isinstance(f.dataType, T.NullType)])


def _brought(schema: T.StructType, to: T.StructType) -> list[Column]:
    have = {f.name.lower(): f for f in schema.fields}
    return [(F.col(f"`{have[f.name.lower()].name}`") if f.name.lower() in have else F.lit(None)).cast(
        f.dataType).alias(f.name) for f in to.fields]


class EvolvingTable:
    """The table under ``root``; every load is a version of it that can be read."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.tables = spark, VersionedTables(spark, root)

    def _loads(self, manifest: Manifest) -> dict[str, Load]:
        return {part: Load.from_info(i) for part, i in self.tables.info(manifest).get("loads", {}).items()}

    def schema(self, version: int | None = None) -> T.StructType:
        return merged(self._loads(self.tables.manifest(version)).values())

    def append(self, rows: DataFrame) -> list[Change]:
        """Add a load; how its columns differ from the table's. One pass writes it and
        observes which of its longs a double could not hold."""
        lower = [c.lower() for c in rows.columns]
        if twice := sorted({c for c in lower if lower.count(c) > 1}):
            raise ValueError(f"columns whose names differ in case only: {', '.join(twice)}")
        base = self.tables.manifest()
        loads = self._loads(base)
        before = merged(loads.values())
        longs = [f.name for f in rows.schema.fields if isinstance(f.dataType, T.LongType)]
        seen = Observation()
        over = [F.count_if((F.col(f"`{c}`") > EXACT) | (F.col(f"`{c}`") < -EXACT)).alias(f"over_{i}")
                for i, c in enumerate(longs)]
        kept = _stored(rows.schema)
        observed = rows.observe(seen, F.count(F.lit(1)).alias("rows"), *over)
        new = self.tables.write(TABLE, observed.select(*[f"`{f.name}`" for f in kept.fields]))
        inexact = tuple(c for i, c in enumerate(longs) if seen.get[f"over_{i}"])
        part = f"load-{len(loads):06d}"
        loads[part] = Load(rows.schema, inexact)
        after = merged(loads.values())
        parts = dict(base.tables[TABLE].parts) if TABLE in base.tables else {}
        parts |= {part: folder for folder in new.parts.values()}
        self.tables.commit(base, {TABLE: TableVersion(after, parts)},
                           loads={p: load.to_info() for p, load in loads.items()})
        return changes(before, rows.schema, after)

    def read(self, version: int | None = None, load_as: str | None = None) -> DataFrame:
        """All rows in the table's schema; ``load_as`` adds the number of each row's load."""
        manifest = self.tables.manifest(version)
        loads = self._loads(manifest)
        to = merged(loads.values())
        folders = manifest.tables[TABLE].parts if TABLE in manifest.tables else {}
        alike: dict[str, list[str]] = {}
        for part in folders:
            alike.setdefault(_stored(loads[part].schema).json(), []).append(part)
        extra = [T.StructField(load_as, T.IntegerType())] if load_as else []
        out = self.spark.createDataFrame([], T.StructType([*to.fields, *extra]))
        for schema, parts in alike.items():
            held = T.StructType([T.StructField(f.name, f.dataType, True)
                                 for f in T.StructType.fromJson(json.loads(schema)).fields])
            scan = self.spark.read.schema(held).parquet(
                *[f"{self.tables.root}/{folders[p]}" for p in parts])
            columns = _brought(held, to)
            if load_as:
                number = {folders[p]: int(p.split("-")[1]) for p in parts}
                pairs = [F.lit(x) for folder, n in number.items() for x in (folder.split("/")[1], n)]
                columns.append(F.create_map(*pairs)[F.regexp_extract(
                    "_metadata.file_path", "/data/([^/]+)/[^/]+/[^/]+/[^/]+$", 1)].alias(load_as))
            out = out.unionByName(scan.select(*columns))
        return out

