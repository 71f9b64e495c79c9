"""Divergence of a source's words from its language, by count cells.

A term's probability in a group depends on its count alone, so terms with equal
counts are one cell: f is evaluated once for each distinct pair of counts and
weighted by the number of terms there.  Cells are ranked by cumulative
multiplicity, and only the cells that reach the ranks asked for are expanded
into terms.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import written

#: Distinct (group, term) entries that a task holds before it sends them on.
HELD = 1 << 18
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def term_counts(docs: DataFrame, held: int = HELD) -> DataFrame:
    """(lang, source, term, n, docs): occurrences of each term and documents
    with it, summed within a task only.  Every group has a row with an empty
    term.  Terms are runs of ASCII letters, lower-cased, and of all characters
    beyond ASCII; nulls count as ''."""
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        told: set[tuple[str, str]] = set()

        def flush() -> Iterator[pa.RecordBatch]:
            for group, (times, docs_with) in seen.items():
                terms = list(times)
                more = [] if group in told else [b""]
                told.add(group)
                if terms or more:
                    size = len(terms) + len(more)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([group[0]] * size, pa.string()), pa.array([group[1]] * size, pa.string()),
                         pa.array([t.decode("utf-8", "replace") for t in terms + more], pa.string()),
                         pa.array([*times.values(), *[0] * len(more)], pa.int64()),
                         pa.array([*(docs_with[t] for t in terms), *[0] * len(more)], pa.int64())], ["lang", "source", "term", "n", "docs"])
            seen.clear()

        for batch in batches:
            for group_lang, source, text in zip(*(batch.column(c).to_pylist() for c in range(3))):
                counts = seen.get((group_lang, source)) or seen.setdefault((group_lang, source), (Counter(), Counter()))
                terms = text.encode("utf-8", "surrogatepass").translate(_LETTERS).split()
                counts[0].update(terms)
                counts[1].update(set(terms))
            if sum(len(times) for times, _ in seen.values()) >= held:
                yield from flush()
        yield from flush()

    return rows.mapInArrow(count, "lang string, source string, term string, n bigint, docs bigint")


def _p(count: str, total: str, vocabulary: str) -> str:
    """SQL of 1 + floor(1e9 (count + 2) / (N + 2 V)), exact beyond 64 bits;
    null for an empty vocabulary."""
    return (f"cast(1 + (cast(1000000000 AS decimal(10, 0)) * (cast({count} AS decimal(20, 0)) + 2)) div "
            f"nullif(cast({total} AS decimal(20, 0)) + 2 * cast({vocabulary} AS decimal(18, 0)), 0) AS bigint)")


def _f(p: str, q: str) -> Column:
    """floor((p - q)^2 / (p + q)), or 0 without p; both are at most 1e9 + 1."""
    return F.coalesce(F.expr(f"(({p}) - ({q})) * (({p}) - ({q})) div (({p}) + ({q}))"), F.lit(0).cast("bigint"))


def _groups(terms: DataFrame) -> DataFrame:
    """(lang, source, total, lang_total, vocabulary) of every group."""
    entries = _entries(terms).groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = terms.filter("term <> ''").groupBy("lang").agg(F.sum("of_lang").alias("lang_total"), F.count(F.lit(1)).alias("vocabulary"))
    every = terms.filter("term = ''").select("lang", F.explode("parts.source").alias("source"))
    return every.join(entries, ["lang", "source"], "left").join(langs, ["lang"], "left").fillna(0)


def _entries(terms: DataFrame) -> DataFrame:
    return terms.filter("term <> ''").select("lang", "term", "of_lang", F.explode("parts").alias("part")).select("lang", "term", "of_lang", "part.*")


def top_terms(terms: DataFrame, groups: DataFrame, ranks: int) -> DataFrame:
    """(lang, source, item, value, rank) of each group's terms with a higher
    probability than in the language, the first ``ranks`` by f."""
    group = ["lang", "source"]
    entries = _entries(terms)
    cells = entries.groupBy(*group, "n", "of_lang").agg(F.count(F.lit(1)).alias("many"))
    cells = cells.join(groups, group).withColumn("p", F.expr(_p("n", "total", "vocabulary"))).withColumn("q", F.expr(_p("of_lang", "lang_total", "vocabulary")))
    cells = written(cells.filter("p > q").select(*group, "n", "of_lang", "many", _f("p", "q").alias("value")), "divergence-cells")
    by_value = Window.partitionBy(*group).orderBy(F.col("value").desc())
    values = cells.groupBy(*group, "value").agg(F.sum("many").alias("many")).withColumn("place", F.row_number().over(by_value)).filter(F.col("place") <= ranks)
    values = values.withColumn("before", F.sum("many").over(by_value) - F.col("many")).filter(F.col("before") < ranks)
    chosen = cells.drop("many").join(values.select(*group, "value"), [*group, "value"])
    place = F.row_number().over(Window.partitionBy(*group).orderBy(F.col("value").desc(), "term"))
    found = entries.join(chosen, [*group, "n", "of_lang"]).withColumn("rank", place).filter(F.col("rank") <= ranks)
    return found.select(*group, F.col("term").alias("item"), "value", "rank")


def source_pairs(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value, rank): f summed over all kept terms for
    every two sources of a language.

    Only cells of two positive counts are counted for a pair.  Those with a
    zero follow from each source's own counts by inclusion and exclusion: with
    g(x, y) = f(x, y) - f(x, 0) - f(0, y) + f(0, 0), the value is the sum of g
    over the first, of f(x, 0) - f(0, 0) over the sources' counts, and V f(0, 0)."""
    own = _entries(terms).groupBy("lang", "source", "n").agg(F.count(F.lit(1)).alias("many"))
    both = F.flatten(F.transform("parts", lambda a, i: F.transform(
        F.slice("parts", i + 2, F.size("parts")), lambda b: F.struct(a["source"].alias("s"), b["source"].alias("t"), a["n"].alias("x"), b["n"].alias("y")))))
    cells = (terms.filter("term <> ''").select("lang", F.explode(both).alias("c")).select("lang", "c.*")
                  .groupBy("lang", "s", "t", "x", "y").agg(F.count(F.lit(1)).alias("many")))
    one, two = (groups.select("lang", F.col("source").alias(name), F.col("total").alias(f"total_{name}"), *more)
                for name, more in (("s", ["vocabulary"]), ("t", [])))

    def f(x: str, y: str) -> Column:
        return _f(_p(x, "total_s", "vocabulary"), _p(y, "total_t", "vocabulary"))

    many, pairs = F.col("many"), one.join(two, "lang").filter("s < t")
    first, second = (own.withColumnRenamed("source", name).join(pairs, ["lang", name]) for name in ("s", "t"))
    parts = [cells.join(one, ["lang", "s"]).join(two, ["lang", "t"]).withColumn("value", many * (f("x", "y") - f("x", "0") - f("0", "y") + f("0", "0"))),
             first.withColumn("value", many * (f("n", "0") - f("0", "0"))), second.withColumn("value", many * (f("0", "n") - f("0", "0"))),
             pairs.withColumn("value", F.col("vocabulary") * f("0", "0"))]
    summed = None
    for part in parts:
        part = part.select("lang", "s", "t", "value")
        summed = part if summed is None else summed.unionByName(part)
    summed = summed.groupBy("lang", "s", "t").agg(F.sum("value").alias("value"))
    sides = F.explode(F.array(F.struct(F.col("s").alias("source"), F.col("t").alias("item")), F.struct(F.col("t").alias("source"), F.col("s").alias("item"))))
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))
    return summed.select("lang", sides.alias("side"), "value").select("lang", "side.*", "value").withColumn("rank", place)


def divergence(docs: DataFrame, min_docs: int = 10, ranks: int = 10, held: int = HELD) -> DataFrame:
    """(lang, source, part, item, value, rank) over ``docs`` (lang, source,
    text; other columns ignored).

    A language keeps its terms that are in at least ``min_docs`` documents.
    Part ``pair``: how far each other source of the language is, all of them;
    part ``term``: the group's most over-used terms, ``ranks`` of them.  Equal
    values are ranked by the item's bytes.  Nulls count as ''; repeated rows
    are documents of their own; a group without terms has pairs only; no rows
    give no rows.  The table of kept terms holds one entry for each source of a
    term, so a frequent term is never more than its sources in one row."""
    counts = term_counts(docs, held).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    parts = F.array_sort(F.collect_list(F.struct("source", "n"))).alias("parts")
    terms = counts.groupBy("lang", "term").agg(parts, F.sum("n").alias("of_lang"), F.sum("docs").alias("docs"))
    terms = written(terms.filter((F.col("docs") >= min_docs) | (F.col("term") == "")).drop("docs"), "divergence-terms")
    groups = written(_groups(terms), "divergence-groups")
    pairs, top = source_pairs(terms, groups), top_terms(terms, groups, ranks)
    out = pairs.withColumn("part", F.lit("pair")).unionByName(top.withColumn("part", F.lit("term")))
    return out.select("lang", "source", "part", "item", "value", "rank")
