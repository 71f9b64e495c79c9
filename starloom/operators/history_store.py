"""SCD2 history kept in hash buckets of the key; a merge rewrites only what it
changes.

Open versions (one per key) and closed ones lie apart.  A batch replaces the
open files of the buckets that its keys fall into and adds a file of newly
closed versions to them; other buckets, and versions closed earlier, are not
read or written.  Only a late row (before its key's open version) makes its
bucket's closed files be read and replaced.

    <path>/data/batch=<id>/state=open|closed/bucket=<n>/…
    <path>/manifest/key=<id>            live batches of each state and bucket

A batch counts once its manifest, a single file, is there; until then readers
see the batch before it.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.manifest import Manifest
from starloom.operators.scd2 import build_history
from starloom.session import scratch_path

Live = dict[tuple[str, int], list[int]]
_MANIFEST = "state string, bucket int, live array<bigint>"
_VERSIONS = [T.StructField("version", T.LongType()), T.StructField("date_from", T.TimestampNTZType()),
             T.StructField("date_to", T.TimestampNTZType()), T.StructField("is_current", T.BooleanType())]


class HistoryStore:
    """History of feed rows (schema ``feed``) by ``key`` under ``path``;
    ``buckets`` must not change over its life.  A bucket whose closed versions
    lie in ``compact_after`` batches has them put together by its next merge."""

    def __init__(self, spark: SparkSession, path: str, feed: T.StructType, key: str, ts: str, tiebreak: Sequence[str] = (),
                 buckets: int = 64, compact_after: int = 16):
        self.spark, self.path, self.key, self.ts, self.tiebreak = spark, path, key, ts, list(tiebreak)
        self.buckets, self.compact_after = buckets, compact_after
        self.manifest = Manifest(spark, f"{path}/manifest", _MANIFEST)
        self.feed = [f.name for f in feed]
        self.schema = T.StructType([*feed.fields, *_VERSIONS])

    def batches(self) -> list[int]:
        """Ids of the committed batches, rising."""
        return sorted(map(int, self.manifest.keys()))

    def live(self, before: int | None = None) -> Live:
        """Batches that hold the versions of each state and bucket, as of the
        newest committed batch (older than ``before``)."""
        return self._live([b for b in self.batches() if before is None or b < before])

    def _live(self, known: list[int]) -> Live:
        if not known:
            return {}
        return {(r.state, r.bucket): list(r.live) for r in self.manifest.read(known[-1]).collect()}

    def read(self, live: Live | None = None, state: str | None = None, buckets: Iterable[int] | None = None) -> DataFrame:
        """The history, or the part of one state or of some buckets."""
        wanted = None if buckets is None else set(buckets)
        paths = [f"{self.path}/data/batch={g}/state={s}/bucket={b}" for (s, b), gens in sorted((self.live() if live is None else live).items())
                 if (state is None or s == state) and (wanted is None or b in wanted) for g in gens]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def _bucket(self) -> F.Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _order(self) -> F.Column:
        return F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate([self.ts, *self.tiebreak])])

    def _stored(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def merge(self, batch: DataFrame, batch_id: int) -> None:
        """Apply feed rows; afterwards the history is as if all rows so far had
        been built at once.  A batch that is already committed is left alone."""
        known = self.batches()
        if batch_id in known:
            return
        live = self._live([b for b in known if b < batch_id])
        rows = self._stored(batch.select(*self.feed).withColumn("_bucket", self._bucket()), "history-batch")
        touched = [r[0] for r in rows.select("_bucket").distinct().collect()]
        firsts = rows.groupBy(F.col(self.key).alias("_key")).agg(F.min(self._order()).alias("_first"))
        current = self.read(live, "open", touched)
        # the open versions of the touched buckets, marked where the batch has rows of their key
        marked = self._stored(current.join(firsts, F.col(self.key).eqNullSafe(F.col("_key")), "left").drop("_key")
                                     .withColumn("_hit", F.col("_first").isNotNull()).withColumn("_late", F.coalesce(F.col("_first") < self._order(), F.lit(False)))
                                     .withColumn("_bucket", self._bucket()), "history-open")
        keys = marked.where("_hit").select(F.col(self.key).alias("_key"), F.col("version").alias("_base"), "_late")
        late = [r[0] for r in marked.where("_late").select("_bucket").distinct().collect()]
        rows = rows.join(keys, F.col(self.key).eqNullSafe(F.col("_key")), "left")
        fresh = rows.where(~F.coalesce("_late", F.lit(False)))
        versions = [F.col(c) for c in self.schema.names]

        new = build_history(fresh.select(*self.feed, "_base"), self.key, self.ts, self.tiebreak)
        new = new.withColumn("version", F.col("version") + F.coalesce("_base", F.lit(0).cast("bigint")))
        closed = (marked.where(F.col("_hit") & ~F.col("_late")).withColumn("date_to", F.col("_first.o0").cast("timestamp_ntz")).withColumn("is_current", F.lit(False)))
        out = marked.where(~F.col("_hit")).select(*versions).unionByName(closed.select(*versions)).unionByName(new.select(*versions))

        crowded = {b for b in touched if len(live.get(("closed", b), [])) >= self.compact_after}
        replaced = crowded.union(late)
        if replaced:
            old = self.read(live, "closed", replaced).join(keys.where("_late").select("_key", F.lit(True).alias("_again")), F.col(self.key).eqNullSafe(F.col("_key")), "left")
            again = old.where("_again").select(*self.feed).unionByName(marked.where("_late").select(*self.feed)).unionByName(rows.where("_late").select(*self.feed))
            out = out.unionByName(old.where("_again is null").select(*versions))
            if late:
                out = out.unionByName(build_history(again, self.key, self.ts, self.tiebreak).select(*versions))

        target = f"{self.path}/data/batch={batch_id}"
        laid = out.withColumn("state", F.when(F.col("is_current"), F.lit("open")).otherwise(F.lit("closed"))).withColumn("bucket", self._bucket())
        # a bucket's files by their size, a large one in several tasks
        laid.hint("rebalance", "state", "bucket").write.mode("overwrite").partitionBy("state", "bucket").parquet(target)
        written = {(m[1], int(m[2])) for f in self.spark.read.schema(self.schema).parquet(target).inputFiles() if (m := re.search(r"/state=(\w+)/bucket=(\d+)/", f))}
        after = dict(live)
        for b in touched:
            after[("open", b)] = [batch_id] if ("open", b) in written else []
            kept = [] if b in replaced else live.get(("closed", b), [])
            after[("closed", b)] = kept + ([batch_id] if ("closed", b) in written else [])
        entries = [(s, b, gens) for (s, b), gens in sorted(after.items()) if gens]
        lines = ", ".join(f"('{s}', {b}, array({', '.join(f'{g}L' for g in gens)}))" for s, b, gens in entries) or "('', 0, array(0L))"
        record = self.spark.sql(f"SELECT * FROM VALUES {lines} AS t(state, bucket, live)")
        self.manifest.write(batch_id, record if entries else record.limit(0))


class HistorySink:
    """``foreachBatch`` function that merges feed batches into a store."""

    def __init__(self, store: HistoryStore):
        self.store, self.target = store, store.path

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self.store.merge(batch, batch_id)
