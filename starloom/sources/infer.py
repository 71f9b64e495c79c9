"""Column types of a CSV feed, found by one aggregation.

Every column is read as text.  One pass keeps, per column, whether all its
values fit each type; the narrowest type that holds them all is taken.  Unlike
a sample, this cannot be wrong for a row not yet seen, and it is one partial
aggregate per task whatever the size.  Rows that do not have the header's
number of fields are kept and returned apart.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
#: From narrow to wide; a value that fits one fits those it leads to:
#: boolean → string, int → bigint → double → string, date → timestamp → string.
TYPES = ("boolean", "int", "bigint", "double", "date", "timestamp_ntz")


def read_text_columns(spark: SparkSession, path: str, names: Sequence[str], header: bool = True, delimiter: str = ",") -> DataFrame:
    """All columns as text, and ``_corrupt_record`` with the whole line where
    it has another number of fields."""
    schema = T.StructType([*[T.StructField(n, T.StringType()) for n in names], T.StructField(CORRUPT, T.StringType())])
    return (spark.read.schema(schema).option("header", header).option("sep", delimiter).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False).csv(path))


def _fits(c: Column, kind: str) -> Column:
    text = F.trim(c)
    if kind == "boolean":
        return F.lower(text).isin("true", "false")
    if kind in ("int", "bigint"):
        # the pattern first: a cast of what is no number is slow to fail
        return F.when(text.rlike(r"^[+-]?\d{1,19}$"), text.try_cast(kind).isNotNull()).otherwise(F.lit(False))
    if kind == "double":
        return text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$")
    if kind == "date":
        return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text.try_cast("date").isNotNull()).otherwise(F.lit(False))
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?)?$"), text.try_cast(kind).isNotNull()).otherwise(F.lit(False))


def column_types(text: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(position, column_name, data_type, n_values, n_null) of text columns,
    one aggregation; a column without values is text.  Corrupt rows are left
    out; where there may be some, a last row named ``_corrupt_record`` counts
    them as values and the others as nulls."""
    columns = [c for c in (columns or text.columns) if c != CORRUPT]
    sound = F.col(CORRUPT).isNull() if CORRUPT in text.columns else F.lit(True)
    aggs = []
    for i, c in enumerate(columns):
        value = F.col(f"`{c}`")
        fits = [F.every(F.when(sound & value.isNotNull(), _fits(value, kind))).alias(kind) for kind in TYPES]
        aggs.append(F.struct(F.lit(i + 1).cast("bigint").alias("position"), F.lit(c).alias("column_name"),
                             F.count_if(sound & value.isNotNull()).alias("n_values"), F.count_if(sound & value.isNull()).alias("n_null"), *fits))
    if CORRUPT in text.columns:
        none = [F.lit(False).alias(kind) for kind in TYPES]
        aggs.append(F.struct(F.lit(len(columns) + 1).cast("bigint").alias("position"), F.lit(CORRUPT).alias("column_name"),
                             F.count_if(~sound).alias("n_values"), F.count_if(sound).alias("n_null"), *none))
    rows = text.agg(*[a.alias(f"c{i}") for i, a in enumerate(aggs)])
    rows = rows.select(F.explode(F.array(*[F.col(f"c{i}") for i in range(len(aggs))])).alias("c")).select("c.*")
    kind = F.lit("string")
    for t in reversed(TYPES):
        kind = F.when(F.col(t), F.lit(t)).otherwise(kind)
    return rows.select("position", "column_name", kind.alias("data_type"), "n_values", "n_null")


def corrupt_rows(text: DataFrame) -> DataFrame:
    """The lines that do not fit the header."""
    # Spark refuses to read that column alone
    fields = F.concat_ws("", *[F.col(f"`{c}`") for c in text.columns if c != CORRUPT])
    return text.where(F.col(CORRUPT).isNotNull() & (F.length(fields) >= 0)).select(F.col(CORRUPT).alias("line"))


def typed(text: DataFrame, types: DataFrame) -> DataFrame:
    """``text`` with the columns cast to the types found (a row per column
    reaches the driver); corrupt rows are left out."""
    found = {r.column_name: r.data_type for r in types.collect()}
    sound = text.where(F.col(CORRUPT).isNull()) if CORRUPT in text.columns else text
    return sound.select(*[(F.col(f"`{c}`") if found[c] == "string" else F.trim(F.col(f"`{c}`")).cast(found[c])).alias(c) for c in text.columns if c in found and c != CORRUPT])
