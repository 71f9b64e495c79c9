"""Load of several tables that goes on after a failure.

Tables are written one by one to a staged folder of the load's version; each is
read back, and its record (rows and a digest of its contents) is written after
it.  A second run of the same version keeps the tables whose contents still have
the recorded digest and goes on with the first that has none.  Readers see a
version only once it is published as a whole, by one small file.

    <path>/tables/<version>/<table>     staged, then published, rows
    <path>/done/key=<version>-<table>   its rows and digest
    <path>/published/key=<version>      the version's tables
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.manifest import Manifest

Read = Callable[[str], DataFrame]


def digest(df: DataFrame) -> tuple[int, int]:
    """(rows, sum of a 32-bit hash of every row): independent of row order."""
    row = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(df.columns)]).bitwiseAND(F.lit((1 << 32) - 1))
    got = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(row), F.lit(0).cast("bigint")).alias("contents")).first()
    return got.n, got.contents


class TableSet:
    """Versions of a set of tables under ``path``; a version is a whole number."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.done = Manifest(spark, f"{path}/done", "rows bigint, contents bigint")
        self.published = Manifest(spark, f"{path}/published", "table string")

    def _at(self, version: int, table: str) -> str:
        return f"{self.path}/tables/{version}/{table}"

    def load(self, version: int, tables: Mapping[str, Callable[[Read], DataFrame]], partition_by: Mapping[str, Sequence[str]] | None = None) -> list[str]:
        """Write the tables in the given order and publish the version; the
        names written in this run.  A table is made by a function that can read
        the tables before it.  A published version is left alone."""
        if str(version) in self.published.keys():
            return []
        written, done = [], self.done.keys()

        def read(table: str) -> DataFrame:
            return self.spark.read.parquet(self._at(version, table))

        for table, make in tables.items():
            key = f"{version}-{table}"
            if key in done:
                known = self.done.read(key).first()
                if digest(read(table)) == (known.rows, known.contents):
                    continue
            writer = make(read).write.mode("overwrite")
            by = (partition_by or {}).get(table, ())
            (writer.partitionBy(*by) if by else writer).parquet(self._at(version, table))
            rows, contents = digest(read(table))
            self.done.write(key, self.spark.range(1).select(F.lit(rows).alias("rows"), F.lit(contents).alias("contents")))
            written.append(table)
        names = F.explode(F.array(*[F.lit(t) for t in tables]))
        self.published.write(version, self.spark.range(1).select(names.alias("table")))
        return written

    def paths(self) -> dict[str, str]:
        """Tables of the newest published version."""
        versions = sorted(map(int, self.published.keys()))
        return {r.table: self._at(versions[-1], r.table) for r in self.published.read(versions[-1]).collect()} if versions else {}

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(self.paths()[table])
