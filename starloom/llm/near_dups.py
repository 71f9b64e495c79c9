"""MinHash near-duplicate detection with tensored banding.

Two small collections of MinHash tuples are computed per document; the table
keys are all pairs of a tuple of the first and one of the second, so
``tuples``² tables of 2 × ``rows`` minima cost only 2 × ``tuples`` × ``rows``
minima.  Pairs that meet in a table are estimated from all minima and, if not
clearly apart, verified on their full shingle sets.

A table bucket is first a star around its smallest document.  Where that
leaves its members in different components, the members of different
components are compared too, in blocks, so no link is lost to the star.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import text_hash, written
from starloom.llm.components import components

TUPLES, ROWS = 16, 4
#: A pair whose minima agree in fewer than this share is not verified: at a
#: similarity of 0.8 that has a probability of 4e-5.
CLEARLY_APART = 0.66
BLOCK = 1024

_DRAW = np.random.default_rng(3)
_MULTIPLY = _DRAW.integers(1, 1 << 63, (2 * TUPLES * ROWS, 1), np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles: ASCII lower case,
    words between ASCII white space; fewer words make one shingle."""
    if not text:
        return np.zeros(0, np.uint64)
    said = text.encode("utf-8", "surrogatepass").lower().split()
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, said), np.uint64, len(said))
    if not len(h):
        return h
    n = max(1, len(h) - words + 1)
    out = np.full(n, min(len(h), words), np.uint64)
    for d in range(min(len(h), words)):
        out = (out ^ h[d:d + n]) * _MIX
        out ^= out >> np.uint64(29)
    return np.unique(out)


def minima(shingles: np.ndarray) -> np.ndarray:
    """All minima (high 32 bits of multiplicative hashes), a piece at a time."""
    out = np.full(len(_MULTIPLY), np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64)
    for lo in range(0, len(shingles), 4096):
        part = shingles[lo:lo + 4096]
        np.minimum(out, ((part ^ (part >> np.uint64(31))) * _MULTIPLY).min(1), out=out)
    return out >> np.uint64(32)


FEATURES = "doc_id bigint, text_hash bigint, n bigint, hi bigint, lo bigint, a array<bigint>, b array<bigint>, sketch binary"


def features(docs: DataFrame, words: int) -> DataFrame:
    """One narrow row per document: size and digest of its shingle set, the
    tuples of both collections, a byte of every minimum."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name, hashed, text in zip(*(c.to_pylist() for c in batch.columns)):
                s = shingle_set(text, words)
                if not len(s):
                    rows.append((name, hashed, 0, 0, 0, [], [], b""))
                    continue
                m = minima(s)
                keys = np.array([xxhash.xxh3_64_intdigest(t.tobytes(), k) for k, t in enumerate(m.reshape(2 * TUPLES, ROWS))], np.uint64).view(np.int64)
                digest = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64)
                rows.append((name, hashed, len(s), int(digest[0]), int(digest[1]), keys[:TUPLES].tolist(), keys[TUPLES:].tolist(), m.astype(np.uint8).tobytes()))
            cols = list(zip(*rows)) if rows else [[]] * 8
            kinds = [pa.int64()] * 5 + [pa.list_(pa.int64())] * 2 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["doc_id", "text_hash", "n", "hi", "lo", "a", "b", "sketch"])

    return docs.select(F.col("doc_id").cast("bigint"), text_hash().alias("text_hash"), "text").mapInArrow(run, FEATURES)


def _agreeing(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x == y).mean(-1)


def _likely(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Of (a, b), those not clearly apart by their sketches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for k in (2, 3))
                keep = pa.array(_agreeing(x, y) >= CLEARLY_APART)
                yield pa.RecordBatch.from_arrays([batch.column(k).filter(keep) for k in (0, 1)], ["a", "b"])

    one, two = (sketches.select(F.col("node").alias(c), F.col("sketch").alias(f"s{c}")) for c in ("a", "b"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "sa", "sb").mapInArrow(run, "a bigint, b bigint")


def _sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(node, shingles) of the documents in ``wanted`` (node), from their whole
    texts; rows that repeat a doc_id count as their union."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([shingle_set(t, words).tobytes() for t in part.column(1).to_pylist()], pa.binary())],
                                                 ["node", "shingles"])

    texts = docs.select(F.col("doc_id").cast("bigint").alias("node"), "text").join(written(wanted.distinct(), "near-wanted"), "node", "left_semi")
    return written(texts.mapInArrow(cut, "node bigint, shingles binary"), "near-sets")


def _verified(docs: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """Of (a, b), those linked by their full shingle sets."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                p, q = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(p) + len(q) - len(np.union1d(p, q))
                keep.append(100 * both >= percent * (len(p) + len(q) - both))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(keep) for k in (0, 1)], ["a", "b"])

    sets = _sets(docs, pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))), words)
    one, two = (sets.select(F.col("node").alias(c), F.col("shingles").alias(f"s{c}")) for c in ("a", "b"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "sa", "sb").mapInArrow(compare, "a bigint, b bigint")


def links_across(node: np.ndarray, part: np.ndarray, side: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links between documents of different components, for each document and
    other component the smallest partner.  An index of shingles gives a
    document's intersections with all others at once; those of the largest
    component are only found, not looked up.  With two sides, only across."""
    sizes = np.array([len(s) for s in sets])
    _, term = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(term, kind="stable")
    posting, first = owner[order], np.searchsorted(term[order], np.arange(term.max() + 2))
    starts = np.cumsum(sizes) - sizes
    names, inverse, count = np.unique(part, return_inverse=True, return_counts=True)
    out, both_sides = [], side.min() != side.max()
    for i in np.flatnonzero(inverse != count.argmax()).tolist():
        mine = term[starts[i]:starts[i] + sizes[i]]
        lo, n = first[mine], first[mine + 1] - first[mine]
        places = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        shared = np.bincount(posting[places], minlength=len(sets))
        linked = (100 * shared >= percent * (sizes + sizes[i] - shared)) & (part != part[i])
        if both_sides:
            linked &= side != side[i]
        found = np.flatnonzero(linked)
        if len(found):
            found = found[np.lexsort((node[found], part[found]))]
            new = np.concatenate(([True], part[found][1:] != part[found][:-1]))
            out += [(int(node[i]), int(node[j])) for j in found[new]]
    return out


def _across(docs: DataFrame, met: DataFrame, tables: DataFrame, parts: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) between members of one table bucket that are in different
    components.  Such members meet again by the tuples of the first collection
    (``met``: node, ka), each with its full set, and are compared there; a
    large group is dealt to cells of two blocks, each document to the cells of
    its own block."""
    named = parts.select(F.col("node").alias("n"), "component")
    placed = tables.join(named, F.col("node") == F.col("n"), "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    mixed = placed.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.min("component").alias("lo"), F.max("component").alias("hi"))
    mixed = mixed.filter("c > 2 AND lo != hi").select("key")
    nodes = written(placed.join(written(mixed, "near-mixed"), "key").select("node", "component").distinct(), "near-mixed-nodes")
    groups = met.join(nodes, "node")
    apart = groups.groupBy("ka").agg(F.count(F.lit(1)).alias("members"), F.min("component").alias("lo"), F.max("component").alias("hi"))
    apart = written(apart.filter("members > 2 AND lo != hi").select("ka", "members"), "near-apart")
    members = written(groups.join(apart, "ka"), "near-members")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    cells = (members.withColumn("own", F.pmod(F.xxhash64("node"), blocks.cast("bigint")).cast("int"))
                    .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
                    .select(F.xxhash64("ka", F.least("own", "other"), F.greatest("own", "other")).alias("cell"), "own", "node", "component"))
    rows = cells.join(_sets(docs, members.select("node"), words), "node").select("cell", "own", "node", "component", "shingles")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def compared(cell: list[tuple]) -> pa.RecordBatch:
            side, node, part = (np.array([r[k] for r in cell], np.int64) for k in (1, 2, 3))
            links = links_across(node, part, side, [np.frombuffer(r[4], np.uint64) for r in cell], percent) if len(cell) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], ["a", "b"])

        cell: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if cell and cell[0][0] != row[0]:
                    yield compared(cell)
                    cell = []
                cell.append(row)
        if cell:
            yield compared(cell)

    return rows.repartition("cell").sortWithinPartitions("cell", "node").mapInArrow(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, text_hash) for every row of ``docs``
    (doc_id, text; others ignored): documents are linked if their sets of
    ``words``-word shingles have a Jaccard similarity of ``percent`` / 100 or
    more; the component is the smallest doc_id reachable.

    Null and empty texts have no shingles and no links.  Equal sets are one
    class, represented by its smallest doc_id, so copies make no pairs.  A
    class in which no row has a doc_id is linked with nothing (component null,
    kept); rows that repeat a doc_id are one document."""
    rows = written(features(docs, words), "near-features")
    classes = written(rows.filter("n > 0 AND doc_id IS NOT NULL").groupBy("hi", "lo", "n")
                          .agg(F.min(F.struct("doc_id", "a", "b", "sketch")).alias("m"))
                          .select("hi", "lo", "n", F.col("m.doc_id").alias("node"), "m.a", "m.b", "m.sketch"), "near-classes")
    sketches = classes.select("node", "sketch").dropDuplicates(["node"])
    # only tuples of the first collection that two classes share go on to the tables
    firsts = classes.select("node", F.explode("a").alias("ka"))
    shared = firsts.groupBy("ka").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("ka")
    meeting = written(firsts.join(written(shared, "near-shared"), "ka"), "near-meeting")
    met = meeting.groupBy("node").agg(F.collect_list("ka").alias("ka"))
    # a list of at most TUPLES keys per node
    pairs_of_tuples = classes.select("node", "b").join(met, "node").select("node", F.explode("ka").alias("ka"), "b")
    tables = pairs_of_tuples.select("node", "ka", F.explode("b").alias("kb")).select(F.xxhash64("ka", "kb").alias("key"), "node")
    pivots = tables.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("z")).filter("a != z").select("key", "a")
    met_tables = written(tables.join(written(pivots, "near-pivots"), "key"), "near-tables")
    stars = met_tables.filter("a != node").select("a", F.col("node").alias("b")).distinct()
    links = written(_verified(docs, written(_likely(stars, sketches), "near-likely"), words, percent), "near-links")
    parts = written(components(links), "near-components")
    more = written(_across(docs, meeting, met_tables.select("key", "node"), parts, words, percent), "near-across")
    if more.take(1):
        parts = written(components(links.unionByName(more)), "near-components")
    named = written(classes.select("hi", "lo", "n", "node").join(parts, "node", "left")
                           .select(F.col("hi").alias("h"), F.col("lo").alias("l"), F.coalesce("component", "node").alias("component")), "near-named")
    out = rows.select("doc_id", "text_hash", "n", "hi", "lo").join(named, (F.col("hi") == F.col("h")) & (F.col("lo") == F.col("l")) & (F.col("n") > 0), "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return (out.withColumn("component_id", component)
               .select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "text_hash"))
