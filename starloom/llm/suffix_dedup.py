"""Removal of long repeated byte strings.

A byte goes if a string of ``length`` bytes that covers it also starts in a
document with a smaller doc_id.  Every such string holds an anchor, the
smallest of its k-mer hashes, which depends on the string alone; equal strings
meet at equal anchors.  Shards of documents send each distinct pair of anchor
and surrounding context once to the owner of the anchor's hash range.  Equal
contexts are settled there.  Different contexts of one anchor go to the merge:
the suffixes of the shards' contexts are sorted into Burrows-Wheeler transforms
of a bounded size (a shard's few contexts for an owner share one with those of
the next shards), the owner merges the transforms by refining their interleaving
one symbol (two bytes) a round, and the blocks that still hold together after
``length`` bytes are the repeated intervals (common prefix of ``length`` or
more).  The contexts of a hot anchor go to no owner: their strings do, spread by
hash, each distinct string of a shard once with its least doc_id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import written
from starloom.session import scratch_path

KMER = 16
_PLACE = 24
_STEP = 1 << 15
#: Contexts merged at a time (all contexts of an anchor stay together; an
#: anchor with more of them is hot).
MERGED = 1 << 14
#: Input bytes for each owner of a range of anchors, where there are many.
OWNED = 1 << 24
#: Symbols of a transform: sources and ranks of 16 bits sort by radix.
SYMBOLS = 1 << 16
#: Strings of a shard's hot contexts told at a time.
STRINGS = 1 << 20
_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _M3
    return x ^ (x >> np.uint64(29))


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on as one number (an unaligned view)."""
    return np.ndarray((max(0, len(data) - 7),), "<u8", data, strides=(1,))


def _kmer_keys(data: np.ndarray) -> np.ndarray:
    """40-bit hash of the k-mer at every place, above its place."""
    word = _words(data)
    n = len(data) - KMER + 1
    h = word[8:8 + n] * _M2
    h += _M3
    h ^= word[:n] * _M1
    h ^= h >> np.uint64(31)
    h *= _M3
    h ^= h >> np.uint64(29)
    h &= ~np.uint64((1 << _PLACE) - 1)
    h |= np.arange(n, dtype=np.uint64)
    return h


def _window_min(x: np.ndarray, size: int) -> np.ndarray:
    span = 1
    while 2 * span <= size:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[:len(x) - (size - span)], x[size - span:]) if size > span else x


class Anchors:
    """Anchors of a shard: place, 40-bit hash, the document around them, and
    the clipped context [lo, hi)."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int):
        windows = length - KMER + 1
        inside = np.ones(len(data), bool)  # strings that start here stay in their document
        for a, b in zip(starts.tolist(), ends.tolist()):
            inside[max(a, b - length + 1):b] = False
        places, keys = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for lo in range(0, len(data), _STEP):
            part = data[lo:lo + _STEP + length - 1]
            if len(part) < length:
                break
            least = _window_min(_kmer_keys(part), windows)
            least = least[inside[lo:lo + len(least)]]
            least = least[np.concatenate(([True], least[1:] != least[:-1]))[:len(least)]]
            places.append((least & np.uint64((1 << _PLACE) - 1)).astype(np.int64) + lo)
            # minima are small hashes: mixed again, they fill the owners' ranges evenly
            keys.append(_mixed(least >> np.uint64(_PLACE)) >> np.uint64(_PLACE))
        place, key = np.concatenate(places), np.concatenate(keys)
        new = np.concatenate(([True], place[1:] != place[:-1])) if len(place) else np.zeros(0, bool)
        self.place, self.key = place[new], key[new]
        self.doc = np.searchsorted(ends, self.place, "right")
        self.lo = np.maximum(starts[self.doc], self.place - (windows - 1))
        self.hi = np.minimum(ends[self.doc], self.place + length)

    def contexts(self, data: np.ndarray, pick: np.ndarray, width: int) -> np.ndarray:
        """Context bytes, one row each, zero beyond the context."""
        cols = np.arange(width)
        at = self.lo[pick, None] + cols
        return np.where(at < self.hi[pick, None], data[np.minimum(at, len(data) - 1)], 0).astype(np.uint8)

    def context_hash(self, data: np.ndarray, width: int) -> np.ndarray:
        """64-bit hash of each context, its size and the anchor's place in it."""
        out = ((self.hi - self.lo) * 256 + (self.place - self.lo)).astype(np.uint64)
        whole = np.flatnonzero(self.hi - self.lo == width)
        clipped = np.flatnonzero(self.hi - self.lo != width)
        steps = [*range(0, width - 7, 8), width - 8]
        word, h, lo = _words(data), out[whole], self.lo[whole]
        for d in steps:
            h = _mixed((h ^ word[lo + d]) * _M1)
        out[whole] = h
        rows = np.ascontiguousarray(self.contexts(data, clipped, width))
        h = out[clipped]
        for d in steps:
            h = _mixed((h ^ np.ascontiguousarray(rows[:, d:d + 8]).view("<u8").ravel()) * _M1)
        out[clipped] = h
        return out


def _planes(x: np.ndarray) -> bytes:
    """Bytes of 64-bit numbers, all lowest bytes first: equal high bytes compress away."""
    return x.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _from_planes(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint8).reshape(8, -1).T.copy().view("<u8").ravel()


class Shard:
    """A shard's anchors and its distinct (anchor, context) entries, ordered by
    hash, the same on every reading."""

    def __init__(self, row: dict, length: int):
        self.names = np.array(row["doc_id"], np.int64)
        sizes = np.array(row["size"], np.int64)
        self.data = np.frombuffer(row["data"], np.uint8)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.width = 2 * length - KMER
        self.anchors = a = Anchors(self.data, self.starts, self.ends, length)
        names = self.names[a.doc] if len(a.doc) else np.zeros(0, np.int64)
        hashed = a.context_hash(self.data, self.width)
        # by the anchor's 40 bits, then 24 of the context's
        self.order = np.argsort((a.key << np.uint64(24)) | (hashed >> np.uint64(40)), kind="stable")
        k, c = a.key[self.order], hashed[self.order]
        new = np.concatenate(([True], (k[1:] != k[:-1]) | (c[1:] != c[:-1]))) if len(k) else np.zeros(0, bool)
        self.entry = np.cumsum(new) - 1  # of the occurrences in order
        # documents lie in order of doc_id and the sort is stable: the first has the least
        first = self.order[new]
        self.first, self.key, self.context, self.least = first, a.key[first], hashed[first], names[first]
        self.name = names


# ---- merging Burrows-Wheeler transforms


END = 0xFF  # closes a text; no UTF-8 byte


def _order(ranks: np.ndarray) -> np.ndarray:
    """Stable order of numbers below 2^32, by radix."""
    if not len(ranks) or ranks.max() < 1 << 16:
        return np.argsort(ranks.astype(np.uint16), kind="stable")
    low = np.argsort(ranks.astype(np.uint16), kind="stable")
    return low[np.argsort((ranks[low] >> 16).astype(np.uint16), kind="stable")]


def transform(texts: np.ndarray, sizes: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(transform, start of each sorted rotation) of the texts (one row each,
    of ``sizes`` bytes, more than half of ``depth``), each closed by an end mark,
    rotations in order of ``depth`` bytes.  A symbol is a pair of bytes.  Eight
    bytes are sorted pair by pair, then rotations by the ranks of their parts."""
    raw = np.full((len(texts), texts.shape[1] + 1), END, np.uint16)
    raw[:, :-1] = texts
    raw[np.arange(len(texts)), sizes] = END
    raw = raw[np.arange(raw.shape[1]) <= sizes[:, None]]
    ends = np.cumsum(sizes + 1)
    size = np.repeat((sizes + 1).astype(np.int32), sizes + 1)
    start = np.repeat((ends - sizes - 1).astype(np.int32), sizes + 1)
    here = np.arange(len(raw), dtype=np.int32)

    def moved(step: int) -> np.ndarray:
        """The place ``step`` bytes on in the same text, around its end."""
        to = here + np.int32(step)
        to -= np.where(to >= start + size, size, 0).astype(np.int32)
        to += np.where(to < start, size, 0).astype(np.int32)
        return to

    symbols = (raw << np.uint16(8)) | raw[moved(1)]
    before, after, at = moved(-2), moved(2), here
    word, place = symbols.astype(np.uint64), after
    for _ in range(3):
        word = (word << np.uint64(16)) | symbols[place]
        place = after[place]
    for _ in range(4):
        at = before[at]
        at = at[np.argsort(symbols[at], kind="stable")]
    # told: the order by the first ``done`` bytes; first: what tells two of these apart
    done, first, second = 8, word, None
    while True:
        sorted_ = first[at]
        new = sorted_[1:] != sorted_[:-1]
        if second is not None:
            sorted_ = second[at]
            new |= sorted_[1:] != sorted_[:-1]
        if done >= depth:
            return symbols[before[at]], at
        rank = np.empty(len(at), np.int32)
        rank[at] = np.concatenate((np.zeros(min(1, len(at)), np.int32), np.cumsum(new, dtype=np.int32)))
        step = min(done, depth - done)
        at = moved(-step)[at]
        at = at[_order(rank[at])]
        first, second, done = rank, rank[moved(step)], done + step


def merge(transforms: list[np.ndarray], depth: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, block) of those of ``rows`` that share a block with another one, in
    the merged transform after ``depth`` / 2 rounds; rows are numbered through
    all transforms.  A row moves to the place its preceding symbol sorts it to,
    and so to the row of its own transform that this symbol leads to; rows of a
    block that take the same symbol stay one block.  Blocks are the intervals
    whose suffixes share ``depth`` bytes.  A row that is alone in its block
    stays so: it takes no part in further rounds."""
    # 16-bit sources and symbols sort by radix
    source = np.repeat(np.arange(len(transforms), dtype=np.int32), [len(t) for t in transforms])
    symbols = np.concatenate([*transforms, np.zeros(0, np.uint16)])
    back = np.argsort(symbols, kind="stable")
    back = back[_order(source[back])].astype(np.int32)
    forth = np.empty(len(back), np.int32)
    forth[back] = np.arange(len(back), dtype=np.int32)
    row = rows.astype(np.int32)
    for _ in range(depth // 2):
        row = back[row]  # where those that end at ``rows`` begin
    block = np.zeros(len(row), np.int32)
    for _ in range(depth // 2):
        if not len(row):
            break
        symbol = symbols[row]
        order = np.argsort(symbol, kind="stable")
        row, symbol, block = forth[row[order]], symbol[order], block[order]
        new = np.ones(len(row) + 1, bool)
        np.not_equal(symbol[1:], symbol[:-1], out=new[1:-1])
        new[1:-1] |= block[1:] != block[:-1]
        shared = ~(new[1:] & new[:-1])
        block = np.cumsum(new[:-1], dtype=np.int32)[shared]
        row = row[shared]
    return row, block


def repeated(texts: np.ndarray, sizes: np.ndarray, documents: np.ndarray, length: int) -> np.ndarray:
    """A mask for each context (one row each, in order of shard), bit i set if
    the string at i also stands in a context of a smaller document."""
    masks = np.zeros(len(sizes), np.uint64)
    # a transform of at most SYMBOLS for each run of contexts
    ends = np.cumsum(sizes + 1)
    cuts = [0]
    while cuts[-1] < len(sizes):
        begun = ends[cuts[-1]] - sizes[cuts[-1]] - 1
        cuts.append(max(cuts[-1] + 1, int(np.searchsorted(ends, begun + SYMBOLS, "right"))))
    transforms, places = [], []
    for a, b in zip(cuts, cuts[1:]):
        told, at = transform(texts[a:b], sizes[a:b], length)
        transforms.append(told)
        places.append(at + (ends[a] - sizes[a] - 1))
    place = np.concatenate([*places, np.zeros(0, np.int64)])
    context = np.repeat(np.arange(len(sizes)), sizes + 1)
    offset = np.arange(len(context)) - np.repeat(ends - sizes - 1, sizes + 1)
    whole = offset <= sizes[context] - length
    row, block = merge(transforms, length, np.flatnonzero(whole[place]))
    if len(row):
        context, offset = context[place[row]], offset[place[row]]
        document = documents[context]
        cuts = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
        least = np.repeat(np.minimum.reduceat(document, cuts), np.diff(np.concatenate((cuts, [len(block)]))))
        gone = least < document
        np.bitwise_or.at(masks, context[gone], np.uint64(1) << offset[gone].astype(np.uint64))
    return masks


# ---- strings of hot contexts


def hot_strings(data: np.ndarray, lo: np.ndarray, hi: np.ndarray, place: np.ndarray, least: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Strings around the anchors at ``place`` in the contexts [lo, hi), all that
    reach equally far left at once, about STRINGS at a time: (context of each,
    its place in it, its entry; key, hash and least document of each entry).
    Entries are the distinct strings, in order of their 40-bit key."""
    word, held, size = _words(data), [], 0
    for left in range(length - KMER + 1):
        pick = np.flatnonzero((place - lo >= left) & (hi - place >= length - left))
        held.append((pick, place[pick] - left))
        size += len(pick)
        if size >= STRINGS or size and left == length - KMER:
            which, at = (np.concatenate(x) for x in zip(*held))
            key, h = np.full(len(at), length, np.uint64), np.zeros(len(at), np.uint64)
            for d in [*range(0, length - 7, 8), length - 8]:
                w = word[at + d]
                key, h = _mixed((key ^ w) * _M2), _mixed((h ^ w) * _M1)
            key >>= np.uint64(_PLACE)
            order = np.argsort((key << np.uint64(24)) | (h >> np.uint64(40)), kind="stable")
            k, c = key[order], h[order]
            new = np.concatenate(([True], (k[1:] != k[:-1]) | (c[1:] != c[:-1])))
            yield which[order], (at - lo[which])[order], np.cumsum(new) - 1, k[new], c[new], np.minimum.reduceat(least[which[order]], np.flatnonzero(new))
            held, size = [], 0


# ---- the distributed steps


def _shards(docs: DataFrame, shard_bytes: int) -> tuple[DataFrame, int]:
    """(documents dealt to shards by hash, a row per shard, their bytes), in a
    bucketed table: later joins on the shard move no text."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit((1 << 63) - 1)).alias("doc_id"), F.col("doc_id").isNull().alias("unnamed"),
                       F.coalesce("text", F.lit("")).cast("binary").alias("data"))
    total = rows.agg(F.sum(F.length("data"))).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # null ids are spread by text; they rank after every id
    dealt = rows.withColumn("shard", F.pmod(F.when(F.col("unnamed"), F.xxhash64("data")).otherwise(F.xxhash64("doc_id")), F.lit(shards)))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = [], None

        def row() -> pa.RecordBatch:
            cols = list(zip(*held))
            return pa.RecordBatch.from_arrays(
                [pa.array([at], pa.int64()), pa.array([cols[0]], pa.list_(pa.int64())), pa.array([cols[1]], pa.list_(pa.bool_())),
                 pa.array([[len(x) for x in cols[2]]], pa.list_(pa.int64())), pa.array([b"".join(cols[2])], pa.binary())],
                ["shard", "doc_id", "unnamed", "size", "data"])

        for batch in batches:
            for k, *rest in zip(*(c.to_pylist() for c in batch.columns)):
                if held and k != at:
                    yield row()
                    held = []
                at = k
                held.append(rest)
        if held:
            yield row()

    rows = (dealt.select("shard", "doc_id", "unnamed", "data").repartition(buckets, "shard").sortWithinPartitions("shard", "doc_id", "data")
                 .mapInArrow(gather, "shard bigint, doc_id array<bigint>, unnamed array<boolean>, size array<bigint>, data binary"))
    # bucketed files need a table; its files lie in the shared folder, and the
    # name goes once the frame has them
    path = scratch_path(spark, "shards")
    name = "llm_" + path.rsplit("-", 1)[-1]
    rows.write.option("compression", "zstd").option("path", path).bucketBy(buckets, "shard").saveAsTable(name)
    shards = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return shards, total


def _by_shard(sent: DataFrame, name: str, *columns: str) -> DataFrame:
    """For each shard the list of what it was sent, in order of ``columns``."""
    return sent.groupBy("shard").agg(F.sort_array(F.collect_list(F.struct(*columns))).alias(name))


def remove_repeats(docs: DataFrame, length: int = 50, shard_bytes: int = 4 << 20, hot_contexts: int = MERGED) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) for every row
    of ``docs`` (doc_id, text; others ignored); ``kept`` holds the remaining
    bytes.  Null text counts as empty, null doc_id as larger than any other;
    rows with equal doc_id never remove each other's bytes.  Tasks hold one
    shard of about ``shard_bytes`` (or one longer document), or one owner's
    range of anchors, of which there are twice as many as shuffle partitions
    (few bytes, much work: their number is fixed, so AQE merges none), more for
    inputs of many ``OWNED`` bytes.  Anchors with more than ``hot_contexts``
    open contexts are not merged in one place."""
    spark = docs.sparkSession
    if length % 2 or not KMER + 8 <= length <= 64 + KMER:
        raise ValueError("length out of range")
    shards, total = _shards(docs, shard_bytes)
    owners = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // OWNED))
    width, reach = 2 * length - KMER, length - KMER

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield batch.slice(k, 1).to_pylist()[0]

    def bounds(keys: np.ndarray) -> list[tuple[int, int, int]]:
        """(owner, begin, end) of each owner's range of the sorted 40-bit keys."""
        cut = np.searchsorted(keys, np.array([-(-(o << 40) // owners) for o in range(owners + 1)], np.uint64)).tolist()
        return [(o, a, b) for o, (a, b) in enumerate(zip(cut, cut[1:])) if b > a]

    def dealt(shard: int, part: int, key: np.ndarray, context: np.ndarray, least: np.ndarray) -> pa.RecordBatch:
        """Entries in order of key, a row for each owner: one batch, as a batch costs more than its rows."""
        cut = bounds(key)
        return pa.RecordBatch.from_arrays(
            [pa.array([o for o, *_ in cut], pa.int32()), pa.array([shard] * len(cut), pa.int64()), pa.array([part] * len(cut), pa.int32()),
             *(pa.array([_planes(x[a:b]) for _, a, b in cut], pa.binary()) for x in (key, context, least.astype(np.uint64)))],
            ["owner", "shard", "part", "key", "context", "least"])

    def send(batches):
        for row in rows_of(batches):
            s = Shard(row, length)
            yield dealt(row["shard"], 0, s.key, s.context, s.least)

    def settle(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        """Per entry: 1 if a smaller document has the same context, 2 if it is
        the first with its context but the anchor has other contexts too, 3 if
        such an anchor is hot."""
        parts = [[_from_planes(x) for x in table.column(c).to_pylist()] for c in ("key", "context", "least")]
        sizes = [len(x) for x in parts[0]]
        k, c, least = (np.concatenate(p) for p in parts)
        least = least.astype(np.int64)
        order = np.lexsort((least, c, k))
        ko, co = k[order], c[order]
        new_key = np.concatenate(([True], ko[1:] != ko[:-1]))
        new = new_key | np.concatenate(([True], co[1:] != co[:-1]))
        first = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
        later = least[order] > least[order][first]
        cut = np.flatnonzero(new_key)
        each = np.diff(np.concatenate((cut, [len(order)])))
        many = np.repeat(np.add.reduceat(new.astype(np.int64), cut), each) > 1
        hot = np.repeat(np.add.reduceat((~later).astype(np.int64), cut), each) > hot_contexts
        verdict = np.empty(len(order), np.uint8)
        verdict[order] = np.where(later, 1, np.where(many, np.where(hot, 3, 2), 0))
        at = np.cumsum([0, *sizes])
        return pa.table({"shard": table.column("shard"), "part": table.column("part"), "owner": table.column("owner"),
                         "verdict": pa.array([verdict[a:b].tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary())})

    def send_hot(batches):
        for row in rows_of(batches):
            told = (_from_planes(row[c]).astype(np.int64) for c in ("hot_lo", "hot_hi", "hot_place", "hot_least"))
            for part, (*_, key, hashed, least) in enumerate(hot_strings(np.frombuffer(row["data"], np.uint8), *told, length)):
                yield dealt(row["shard"], part, key, hashed, least)

    def apply(batches):
        """Coverage by settled entries; contexts of the open ones, per owner."""
        for row in rows_of(batches):
            s = Shard(row, length)
            verdict = np.frombuffer(b"".join(t["verdict"] for t in row["told"] or []), np.uint8)
            a = s.anchors
            occ = s.order
            v = verdict[s.entry] if len(occ) else np.zeros(0, np.uint8)
            gone = (v == 1) | (s.name[occ] > s.least[s.entry] if len(occ) else np.zeros(0, bool))
            delta = (np.bincount(a.lo[occ[gone]], minlength=len(s.data) + 1) - np.bincount(a.hi[occ[gone]], minlength=len(s.data) + 1))
            covered = np.packbits(np.cumsum(delta[:len(s.data)]) > 0)
            open_ = np.flatnonzero(verdict == 2)
            number = np.full(len(verdict), -1, np.int64)
            number[open_] = np.arange(len(open_))
            hot = np.flatnonzero(verdict == 3)
            number[hot] = len(open_) + np.arange(len(hot))
            left = ~gone & (v >= 2)
            apart = [pa.array([_planes(x.astype(np.uint64)) if len(hot) else None], pa.binary())
                     for x in (*(y[s.first[hot]] for y in (a.lo, a.hi, a.place)), s.least[hot])]
            first = s.first[open_]
            texts = a.contexts(s.data, first, width)
            sizes = (a.hi - a.lo)[first].astype("<u2")
            sent = [{"owner": o, "texts": texts[lo:hi].tobytes(), "sizes": sizes[lo:hi].tobytes(), 
                     "places": (a.place - a.lo)[first][lo:hi].astype("<u2").tobytes(), "least": _planes(s.least[open_][lo:hi].astype(np.uint64))}
                    for o, lo, hi in bounds(s.key[open_])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["shard"]], pa.int64()), pa.array([covered.tobytes()], pa.binary()),
                 pa.array([_planes(a.lo[occ[left]].astype(np.uint64))], pa.binary()), pa.array([_planes(number[s.entry[left]].astype(np.uint64))], pa.binary()),
                 pa.array([sent], pa.list_(pa.struct([("owner", pa.int32()), *((n, pa.binary()) for n in ("texts", "sizes", "places", "least"))]))), *apart],
                ["shard", "covered", "open_lo", "open_number", "sent", "hot_lo", "hot_hi", "hot_place", "hot_least"])

    def compare(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        """Masks of the open contexts of an owner.  A string shared at an
        anchor agrees on most of ``length`` bytes around it, so contexts
        without a counterpart for that are left out of the merge."""
        rows = table.sort_by("shard").to_pylist()
        texts = [np.frombuffer(r["texts"], np.uint8).reshape(-1, width) for r in rows]
        sizes = [np.frombuffer(r["sizes"], "<u2").astype(np.int64) for r in rows]
        least = [_from_planes(r["least"]).astype(np.int64) for r in rows]
        shape = np.cumsum([0, *map(len, sizes)])
        every, place = np.concatenate(texts), np.concatenate([np.frombuffer(r["places"], "<u2") for r in rows]).astype(np.int64)
        size, word = np.concatenate(sizes), _words(every.ravel())

        def hashed(pick: np.ndarray, lo: np.ndarray, n: int) -> np.ndarray:
            at, h = pick * width + lo, np.zeros(len(pick), np.uint64)
            for d in [*range(0, n - 7, 8), n - 8]:
                h = _mixed((h ^ word[at + d]) * _M1)
            return h

        # a shared string reaches l bytes left and r right of the anchor, l + r = reach:
        # the contexts agree from a quarter step at or below l to one at or below r
        likely, step = np.zeros(len(every), bool), -(-(reach + 1) // 4)
        for left in range(0, reach + 1, step):
            right = max(0, reach - left - step + 1)
            pick = np.flatnonzero((place >= left) & (place + KMER + right <= size))
            _, back, count = np.unique(hashed(pick, place[pick] - left, left + KMER + right), return_inverse=True, return_counts=True)
            likely[pick[count[back] > 1]] = True
        # anchors are independent: a bounded number of contexts is merged at a time
        chosen = np.flatnonzero(likely)
        anchor = hashed(chosen, place[chosen], KMER)
        chosen = chosen[np.argsort(anchor, kind="stable")]
        anchor = np.sort(anchor)
        cuts, masks = [0], np.zeros(len(every), np.uint64)
        while cuts[-1] < len(chosen):
            to = min(len(chosen), cuts[-1] + MERGED)
            cuts.append(int(np.searchsorted(anchor, anchor[to - 1], "right")))
        document = np.concatenate(least)
        for a, b in zip(cuts, cuts[1:]):
            part = np.sort(chosen[a:b])  # in order of shard
            masks[part] = repeated(every[part], size[part], document[part], length)
        masks = [masks[a:b] for a, b in zip(shape, shape[1:])]
        return pa.table({"shard": pa.array([r["shard"] for r in rows], pa.int64()), "owner": pa.array([r["owner"] for r in rows], pa.int32()),
                         "masks": pa.array([m.astype("<u8").tobytes() for m in masks], pa.binary())})

    def finish(batches):
        for row in rows_of(batches):
            data = np.frombuffer(row["data"], np.uint8)
            covered = np.unpackbits(np.frombuffer(row["covered"], np.uint8), count=len(data)).astype(bool)
            masks = np.frombuffer(b"".join(t["masks"] for t in row["told"] or []), "<u8")
            lo = _from_planes(row["open_lo"]).astype(np.int64)
            if len(lo):
                number = _from_planes(row["open_number"]).astype(np.int64)
                if row["hot_lo"] is not None:
                    # the entries of the parts again, told in order of part and owner
                    from_, to, place, least = (_from_planes(row[c]).astype(np.int64) for c in ("hot_lo", "hot_hi", "hot_place", "hot_least"))
                    verdict = np.frombuffer(b"".join(t["verdict"] for t in row["told_hot"]), np.uint8)
                    hot, seen = np.zeros(len(from_), np.uint64), 0
                    for which, at, entry, _, _, first in hot_strings(data, from_, to, place, least, length):
                        gone = (verdict[seen + entry] == 1) | (first[entry] < least[which])
                        np.bitwise_or.at(hot, which[gone], np.uint64(1) << at[gone].astype(np.uint64))
                        seen += len(first)
                    masks = np.concatenate((masks, hot))  # hot contexts are numbered after the others
                mask = masks[number]
                at = np.concatenate([lo[(mask >> np.uint64(i)) & np.uint64(1) == 1] + i for i in range(width - length + 1)])
                delta = np.bincount(at, minlength=len(data) + 1) - np.bincount(at + length, minlength=len(data) + 1)
                covered |= np.cumsum(delta[:-1]) > 0
            out, end = [], 0
            for name, unnamed, size in zip(row["doc_id"], row["unnamed"], row["size"]):
                gone = covered[end:end + size]
                kept = data[end:end + size][~gone].tobytes()
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if size else 0
                out.append((None if unnamed else name, size, int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
                end += size
            kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                             ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    text, kind = shards.select("shard", "doc_id", "size", "data"), "owner int, shard bigint, part int, key binary, context binary, least binary"
    settled = "shard bigint, part int, owner int, verdict binary"
    entries = text.mapInArrow(send, kind)
    verdicts = written(entries.repartition(owners, "owner").groupBy("owner").applyInArrow(settle, settled), "repeat-verdicts")
    state = written(text.join(_by_shard(verdicts, "told", "owner", "verdict"), "shard", "left").mapInArrow(
        apply, "shard bigint, covered binary, open_lo binary, open_number binary, "
               "sent array<struct<owner:int,texts:binary,sizes:binary,places:binary,least:binary>>, "
               "hot_lo binary, hot_hi binary, hot_place binary, hot_least binary"), "repeat-state")
    sent = state.select("shard", F.explode("sent").alias("s")).select("shard", "s.owner", "s.texts", "s.sizes", "s.places", "s.least")
    masks = written(sent.repartition(owners, "owner").groupBy("owner").applyInArrow(compare, "shard bigint, owner int, masks binary"), "repeat-masks")
    hot = text.join(state.select("shard", "hot_lo", "hot_hi", "hot_place", "hot_least").filter("hot_lo IS NOT NULL"), "shard")
    told_hot = _by_shard(hot.mapInArrow(send_hot, kind).groupBy("owner").applyInArrow(settle, settled), "told_hot", "part", "owner", "verdict")
    last = shards.join(state.drop("sent"), "shard").join(_by_shard(masks, "told", "owner", "masks"), "shard", "left").join(told_hot, "shard", "left")
    return last.mapInArrow(finish, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")
