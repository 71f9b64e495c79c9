"""Append-only dimension: a batch adds a file of its new members to those that
are there, and never rewrites them.

    <path>/data/batch=<id>          members that a batch added
    <path>/manifest/key=<id>        live batches, and the next id to give

Ids go on from the counter of the last committed batch, so a batch that failed
leaves no gap and a repeated one adds nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.keys import dense_key
from starloom.operators.lookup import anti_new
from starloom.operators.manifest import Manifest


class DimStore:
    """Members by their ``natural`` name with ids from 1 on.  Once members lie
    in ``compact_after`` batches, the next batch puts them together."""

    def __init__(self, spark: SparkSession, path: str, natural: str, id_col: str = "id", kind: T.DataType | None = None, compact_after: int = 32):
        self.spark, self.path, self.natural, self.id_col, self.compact_after = spark, path, natural, id_col, compact_after
        self.schema = T.StructType([T.StructField(id_col, T.LongType()), T.StructField(natural, kind or T.StringType())])
        self.manifest = Manifest(spark, f"{path}/manifest", "live array<bigint>, next_id bigint")

    def _state(self, known: list[int]) -> tuple[list[int], int]:
        if not known:
            return [], 1
        row = self.manifest.read(known[-1]).first()
        return list(row.live), row.next_id

    def _read(self, live: list[int]) -> DataFrame:
        paths = [f"{self.path}/data/batch={b}" for b in live]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def read(self) -> DataFrame:
        return self._read(self._state(sorted(map(int, self.manifest.keys())))[0])

    def load(self, batch: DataFrame, batch_id: int) -> None:
        """Add the names of ``batch`` that are not there yet, in order of the
        name; null names are left out.  A committed batch is left alone."""
        known = sorted(map(int, self.manifest.keys()))
        if batch_id in known:
            return
        live, next_id = self._state([b for b in known if b < batch_id])
        there = self._read(live)
        names = batch.select(self.natural).where(F.col(self.natural).isNotNull()).distinct()
        new = anti_new(names, there.select(self.natural), [self.natural]) if live else names
        new = dense_key(new, [self.natural], self.id_col, offset=next_id - 1).select(self.id_col, self.natural)
        compact = len(live) >= self.compact_after
        target = f"{self.path}/data/batch={batch_id}"
        (new.unionByName(there) if compact else new).write.mode("overwrite").parquet(target)
        last = self.spark.read.schema(self.schema).parquet(target).agg(F.max(self.id_col)).first()[0]
        # an empty batch leaves no live files behind
        live = ([batch_id] if compact else [*live, batch_id]) if last is not None else live
        record = self.spark.range(1).select(F.array(*[F.lit(b).cast("bigint") for b in live]).cast("array<bigint>").alias("live"),
                                            F.lit(max(next_id, (last or 0) + 1)).cast("bigint").alias("next_id"))
        self.manifest.write(batch_id, record)


class DimStoreSink:
    """``foreachBatch`` function that loads feed batches into a store."""

    def __init__(self, store: DimStore):
        self.store, self.target = store, store.path

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self.store.load(batch, batch_id)
