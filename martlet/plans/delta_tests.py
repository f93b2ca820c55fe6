"""The data tests kept up to date: a change of the star is tested by its own rows.

The state is the counts of every tested key (``KeyTests``), dealt into parts: date keys
by month, other keys by hash. Counts of disjoint rows add up, so added rows add theirs and
removed rows take theirs away; only parts with a key of the change are read and written
anew, the others stay in their folders. The failures of every part are kept beside it in the
version's manifest (a few numbers a part; ``buckets`` bounds their number), so a report is
their sum and reads no table. The result equals the full report over the changed star.

Defined cases: a changed row is removed with its old and added with its new values; a
change may name any of the star's tables and may be empty; repeated rows count as often as they
stand; removing rows that the star does not have raises and leaves the version as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.operators.checks import KeyTests
from martlet.sources.versioned import Manifest, TableVersion, VersionedTables

KEYS, DELTA = "keys", "delta"
# Domains dealt by the first letters of their keys: calendar keys by year and month.
PREFIXES = {("dim_date", "date_id"): 6}
LEAST = "_least"


class DeltaTests:
    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark, self.tables, self.buckets = spark, VersionedTables(spark, root), buckets
        self.tests = KeyTests()

    def _part(self) -> Column:
        """The part of a key: its domain's number, then its first letters or its hash."""
        out = F.pmod(F.xxhash64("key"), F.lit(self.buckets)).cast("string")
        for name, letters in PREFIXES.items():
            out = F.when(F.col("domain") == self.tests.domains.index(name),
                         F.coalesce(F.substring("key", 1, letters), F.lit("none"))).otherwise(out)
        return F.concat(F.col("domain").cast("string"), F.lit("-"), out)

    def _counted(self, tables: dict[str, DataFrame], sign: int) -> DataFrame:
        counted = self.tests.counted(self.tests.entries(tables))
        return counted.select("domain", "key", *[(F.col(n) * sign).alias(n) for n in self.tests.counts])

    def _added_up(self, counts: DataFrame) -> DataFrame:
        summed = counts.groupBy("domain", "key").agg(*[F.sum(n).alias(n) for n in self.tests.counts])
        return summed.where(" OR ".join(f"{n} <> 0" for n in self.tests.counts))

    def _failures(self, version: TableVersion) -> dict[str, list[int]]:
        """part -> failures of each test, of parts just written."""
        rows = self.tables.read(Manifest(0, {KEYS: version}), KEYS, part_as="part")
        found = rows.groupBy("part").agg(
            *self.tests.failures(), F.min(F.least(*self.tests.counts)).alias(LEAST)).collect()
        if any(r[LEAST] < 0 for r in found):
            raise ValueError("the change removes rows that were never added")
        return {r["part"]: [r[t.name] for t in self.tests.suite] for r in found}

    def build(self, star: dict[str, DataFrame]) -> Manifest:
        """The state of a whole star, as the next version."""
        base = self.tables.manifest()
        new = self.tables.write(KEYS, self._counted(star, 1), self._part())
        return self.tables.commit(base, {KEYS: new}, failures=self._failures(new))

    def apply(self, added: dict[str, DataFrame], removed: dict[str, DataFrame] | None = None) -> Manifest:
        """The state after a change of some rows, as the next version."""
        base = self.tables.manifest()
        sides = [self._counted(t, sign) for t, sign in ((added, 1), (removed or {}, -1)) if t]
        if not sides or KEYS not in base.tables:
            raise ValueError("a change of a built state is needed")
        both = sides[0] if len(sides) == 1 else sides[0].unionByName(sides[1])
        delta = self.tables.write(DELTA, self._added_up(both), self._part())
        hit = sorted(delta.parts)  # folder names: no row is read to find the parts
        changed = self.tables.read(Manifest(0, {DELTA: delta}), DELTA)
        merged = self.tables.read(base, KEYS, hit).unionByName(changed)
        new = self.tables.write(KEYS, self._added_up(merged), self._part())
        failures = {p: f for p, f in self.tables.info(base)["failures"].items() if p not in delta.parts}
        return self.tables.commit(base, {KEYS: new, DELTA: delta}, {KEYS: hit},
                                  failures=failures | self._failures(new))

    def report(self, version: int | None = None) -> DataFrame:
        """The report of ``checks.test_report``, from the kept failures."""
        failures = self.tables.info(self.tables.manifest(version))["failures"].values()
        names = [t.name for t in self.tests.suite]
        sums = [sum(f[i] for f in failures) for i in range(len(names))]
        return self.tests.report(self.spark.createDataFrame(
            [tuple(sums)], ", ".join(f"`{n}` long" for n in names)))
