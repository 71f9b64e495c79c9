"""Lexical retrieval packing.

Documents are dealt to shards by content: in order of three MinHash terms,
rare terms drawn more often, so that documents that share terms lie in one
shard wherever they stand in the table.  Each shard builds a BM25 inverted
index over the token ids of its documents.  A seed's open window is filled with its
best-scoring unused neighbours, the last of them cut to close the window; the
rest of it stays in the pool.  Full windows of long documents are sequences of
their own.  What is left at a shard's end is cut at powers of two, lengths that
take no padding.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import written
from starloom.llm.tokens import encoder, slices

PIECES = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
          "sequence_id bigint, offset bigint")

#: Terms in a dealing key (21 bits each), shards of a task, rows that tell where a range begins.
DRAWS, SHARDS, ROWS_PER_RANGE = 3, 16, 100


def draws(df: np.ndarray, n: int) -> np.ndarray:
    """One row per draw: the place of each term in it.  A document's first term
    is its weighted MinHash: two documents agree on it with the probability of
    their weighted Jaccard similarity, weights being the terms' idf among all
    ``n`` documents."""
    idf = np.log((n - df + 0.5) / (df + 0.5))
    out = np.empty((DRAWS, len(df)))
    for k in range(DRAWS):
        h = (np.arange(len(df), dtype=np.uint64) + np.uint64(k * 1000003 + 1)) * np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x165667B19E3779F9)
        u = ((h ^ (h >> np.uint64(29))) >> np.uint64(11)).astype(np.float64) + 1
        # terms in half the documents or more come after all others
        out[k] = np.where(idf > 0, -np.log(u / (2.0 ** 53 + 1)) / np.maximum(idf, 1e-9), 1e12 + u)
    # ranks keep the order in half the memory
    return np.argsort(np.argsort(out, axis=1, kind="stable"), axis=1, kind="stable").astype(np.int32)


def dealing_keys(raw: bytes, kind: str, ends: np.ndarray, places: np.ndarray) -> np.ndarray:
    """A key for each document of a run, its first terms, one of each draw.
    ``raw`` holds its ids laid end to end, ``ends`` their ends; the last id of a
    document is no term, one without terms has key 0."""
    ids = np.frombuffer(raw, kind).astype(np.int64)
    last = ends - 1
    ids[last] = 0
    key, starts = np.zeros(len(ends), np.int64), np.append(0, ends[:-1])[:len(ends)]
    for place in places:
        at = place[ids]
        at[last] = len(place)
        term = np.append(np.argsort(place), 0)
        key = key << 21 | term[np.minimum.reduceat(at, starts) if len(ends) else at] & (1 << 21) - 1
    return key


class Bm25Index:
    """Postings of a shard: term → documents and their BM25 weights."""

    def __init__(self, docs: list[np.ndarray], k1: float = 1.2, b: float = 0.75):
        n = len(docs)
        size = np.array([len(d) for d in docs], np.int64)
        lengths = size.astype(np.float64)
        norm = k1 * (1 - b + b * lengths / max(1.0, lengths.mean() if n else 1.0))
        # each document's ids sorted; a term starts where the id changes
        ids, ends = np.concatenate(docs) if n else np.zeros(0, np.uint32), np.cumsum(size)
        for end, m in zip(ends.tolist(), size.tolist()):
            ids[end - m:end].sort()
        starts = np.append(True, ids[1:] != ids[:-1])[:len(ids)]
        starts[(ends - size)[size > 0]] = True
        first = np.flatnonzero(starts)
        term, doc = ids[first], np.repeat(np.arange(n), size)[first]
        tf = np.diff(np.append(first, len(ids))).astype(np.float64)
        self.terms = np.split(term, np.searchsorted(doc, np.arange(1, n)))
        order = np.argsort(term, kind="stable")
        names, first, df = np.unique(term[order], return_index=True, return_counts=True)
        # a term in half the documents or more has no positive weight and no postings
        idf = np.log((n - df + 0.5) / (df + 0.5))
        self.doc, self.weight = doc[order], (tf * (k1 + 1) / (tf + norm[doc]))[order] * np.repeat(idf, df)
        keep = idf > 0
        size = int(names[-1]) + 1 if len(names) else 1
        self.lo, self.hi = np.zeros(size, np.int64), np.zeros(size, np.int64)
        self.lo[names[keep]], self.hi[names[keep]] = first[keep], (first + df)[keep]
        self.n = self.open = n

    def close(self, open_: np.ndarray) -> None:
        """Drop the postings of documents that are not ``open_``, once they are
        a fifth of those left: the scores of the others stay as they are."""
        left = int(open_.sum())
        if 5 * left > 4 * self.open:
            return
        keep = open_[self.doc]
        place = np.append(0, np.cumsum(keep))
        self.doc, self.weight, self.lo, self.hi, self.open = self.doc[keep], self.weight[keep], place[self.lo], place[self.hi], left

    def scores(self, seed: int) -> np.ndarray:
        lo, hi = self.lo[self.terms[seed]], self.hi[self.terms[seed]]
        size = hi - lo
        places = np.repeat(lo - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
        return np.bincount(self.doc[places], self.weight[places], self.n)


def pack_shard(ids: list[np.ndarray], window: int) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of one shard."""
    pieces, sequence = [], 0
    start, left = np.zeros(len(ids), np.int64), np.array([len(x) for x in ids], np.int64)
    for i in range(len(ids)):
        for _ in range(int(left[i]) // window):
            pieces.append((i, int(start[i]), window, sequence, 0))
            sequence += 1
            start[i] += window
        left[i] %= window
    index = Bm25Index(ids)
    # seeds by size: the fullest windows need the fewest neighbours
    pool = int(left.sum())
    for seed in np.argsort(-left, kind="stable").tolist():
        if pool < window:
            break
        if not left[seed]:
            continue
        index.close(left > 0)
        score, offset, nxt = None, 0, seed
        while offset < window:
            take = min(int(left[nxt]), window - offset)
            pieces.append((nxt, int(start[nxt]), take, sequence, offset))
            start[nxt] += take
            left[nxt] -= take
            offset += take
            if offset < window:
                if score is None:
                    score = np.where(left > 0, index.scores(seed), -1.0)
                else:
                    score[nxt] = -1.0  # used up, or the window would be full
                nxt = int(np.argmax(score))
        sequence += 1
        pool -= window
    # under one window is left: sequences of the powers of two in its length
    rest = int(left.sum())
    room, offset = 1 << rest.bit_length() >> 1, 0
    for i in np.flatnonzero(left).tolist():
        while left[i]:
            take = min(int(left[i]), room - offset)
            pieces.append((i, int(start[i]), take, sequence, offset))
            start[i] += take
            left[i] -= take
            offset += take
            if offset == room:
                rest -= room
                room, offset, sequence = 1 << rest.bit_length() >> 1, 0, sequence + 1
    return pieces


def _document_counts(counts: DataFrame, size: int) -> tuple[np.ndarray, int]:
    """(documents that hold each of ``size`` terms, documents) of the whole
    table: ``counts`` has what its tasks counted (terms, then documents; the
    last term stands for all documents).  One row per term reaches the driver."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size + 1, np.int64)
        for batch in batches:
            for x in batch.column(0).to_pylist():
                term, n = np.frombuffer(x, "<i8").reshape(2, -1)
                df[term] += n
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(df[held])], ["term", "n"])

    df = np.zeros(size + 1, np.int64)
    for term, n in counts.mapInArrow(add, "term bigint, n bigint").groupBy("term").agg(F.sum("n")).collect():
        df[term] = n
    return df[:-1], int(df[-1])


def pack(docs: DataFrame, tokenizer: str, end_id: int, window: int = 1024, shard_docs: int = 2048) -> DataFrame:
    """Pack every token of ``docs`` (doc_id, text; others ignored) into
    sequences of at most ``window`` ids; one row per piece.  Null text counts
    as empty (its piece holds ``end_id`` alone); rows with equal or null doc_id
    are packed as documents of their own.  A shard is about ``shard_docs``
    neighbours in the order of the dealing keys at any input size (a hot key is
    cut by a hash of the row); a task holds one shard at a time.  A neighbour
    in another shard is not found."""
    if window & (window - 1):
        raise ValueError("window must be a power of two")
    rows = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    size = encoder(tokenizer).library.get_vocab_size()
    kind = "<u2" if max(size, end_id + 1) <= 1 << 16 else "<u4"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Ids of every document and, as a task's last row, in how many of its
        documents each term occurs."""
        coder, df, place = encoder(tokenizer), np.zeros(size + 1, np.int64), np.zeros(size, np.int64)
        for batch in batches:
            for part in slices(batch, 1):
                got = [np.frombuffer(x, "<u4") for x in coder.encode(part.column(1).to_pylist())]
                for x in got:
                    # each term once: where it stands last
                    place[x] = at = np.arange(len(x))
                    df[x[place[x] == at]] += 1
                df[-1] += len(got)
                ids = pa.array([np.append(x, end_id).astype(kind).tobytes() for x in got], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), ids, pa.nulls(len(got), pa.binary())], ["doc_id", "ids", "counts"])
        held = np.flatnonzero(df)
        counts = np.concatenate([held, df[held]]).astype("<i8").tobytes()
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([counts], pa.binary())], ["doc_id", "ids", "counts"])

    encoded = written(rows.mapInArrow(encode, "doc_id bigint, ids binary, counts binary"), "packing-ids")
    df, total = _document_counts(encoded.filter("counts IS NOT NULL").select("counts"), size)

    def keyed(rows: DataFrame, bounds: list[tuple[int, int]]) -> DataFrame:
        """``rows`` with their dealing keys and the ranges between ``bounds`` (key, tie) that they lie in."""
        def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            places, width = draws(df, total), np.dtype(kind).itemsize
            for batch in batches:
                for part in slices(batch, 1):
                    raw, tie = part.column(1).to_pylist(), part.column(2)
                    keys = dealing_keys(b"".join(raw), kind, np.cumsum([len(x) // width for x in raw], dtype=np.int64), places)
                    ranges = [bisect_left(bounds, x) for x in zip(keys.tolist(), tie.to_pylist())]
                    yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), tie, pa.array(keys), pa.array(ranges, pa.int32())],
                                                     ["doc_id", "ids", "tie", "key", "range"])

        return rows.mapInArrow(key, "doc_id bigint, ids binary, tie bigint, key bigint, range int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, names, held, sequence = TaskContext.get().partitionId() << 32, [], [], 0

        def shard(size: int) -> pa.RecordBatch:
            nonlocal names, held, sequence
            ids, own = held[:size], names[:size]
            names, held = names[size:], held[size:]
            found = pack_shard(ids, window)
            raw = [x.tobytes() for x in ids]
            cols = [[own[i] for i, *_ in found], [s for _, s, *_ in found], [m for _, _, m, *_ in found],
                    [zlib.crc32(raw[i][4 * s:4 * (s + m)]) for i, s, m, *_ in found], [len(ids[i]) for i, *_ in found],
                    [at + sequence + q for *_, q, _ in found], [o for *_, o in found]]
            sequence += 1 + max(q for *_, q, _ in found)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                              ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

        for batch in batches:
            for name, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                names.append(name)
                held.append(np.frombuffer(x, kind).astype("<u4"))
                # what is left for the last shard is never a small remainder
                if len(names) >= shard_docs + -(-shard_docs // 2):
                    yield shard(shard_docs)
        if names:
            yield shard(len(names))

    rows = encoded.filter("counts IS NULL").select("doc_id", "ids", F.xxhash64("doc_id", "ids").alias("tie"))
    # as many tasks as other exchanges have, more where one would hold over SHARDS shards
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(1, min(-(-total // shard_docs), max(tasks, -(-total // (SHARDS * shard_docs)))))
    bounds: list[tuple[int, int]] = []
    if ranges > 1:
        # where all rows are cut into ranges; repartitionByRange would compute every key twice to tell
        step = max(1, total // (ROWS_PER_RANGE * ranges))
        seen = sorted((r.key, r.tie) for r in keyed(rows.filter(F.pmod("tie", F.lit(step)) == 0), []).select("key", "tie").collect())
        bounds = [seen[k * len(seen) // ranges] for k in range(1, ranges)] if seen else []
    return (keyed(rows, bounds).repartitionById(ranges, "range").sortWithinPartitions("key", "tie", "doc_id", "ids")
                               .select("doc_id", "ids").mapInArrow(run, PIECES))
