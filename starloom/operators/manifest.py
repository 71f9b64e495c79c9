"""Commit records of a stored table: one small file per batch, which is there
as a whole or not at all.  What a batch wrote counts once its record is there."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class Manifest:
    """Records under ``path``, by a key of letters, digits, ``_`` and ``-``."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema, self._made = spark, path, schema, False

    def write(self, key: object, record: DataFrame, mode: str = "overwrite") -> None:
        types = T._parse_datatype_string(self.schema)
        record.select(*[record[f.name].cast(f.dataType) for f in types]).coalesce(1).write.mode(mode).parquet(f"{self.path}/key={key}")

    def keys(self) -> set[str]:
        """Keys of the committed records."""
        if not self._made:
            # an empty record, so that there is always a folder to list
            self.spark.createDataFrame([], self.schema).write.mode("ignore").parquet(f"{self.path}/key=-")
            self._made = True
        found = self.spark.read.schema(self.schema).option("basePath", self.path).parquet(self.path)
        return {m[1] for f in found.inputFiles() if (m := re.search(r"/key=([\w-]+)/", f)) and m[1] != "-"}

    def read(self, key: object) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/key={key}")
