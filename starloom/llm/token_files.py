"""Token ids as directly addressable codes.

A segment holds the ids of consecutive documents.  Each id is cut into chunks
of ``widths`` bits, low chunk first; level k stores the k-th chunk of every id
that has one, a continuation bitmap says which ids go on in level k + 1, and a
rank directory (ones before every 512 bits) finds an id's place there.  Any id
or range of ids is read without decoding what lies before it.

File image (little endian): ``DAC1``, levels u32, ids u64; then per level:
width in bits u32, chunks u64, the chunks (u8, u16 or u32 each), the bitmap
(one bit per chunk, absent in the last level) and its directory (u32 each).
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import written
from starloom.llm.tokens import encoder, slices

_TYPE = {8: np.dtype("u1"), 16: np.dtype("<u2"), 32: np.dtype("<u4")}
_BLOCK = 512
_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint32)


def pack_ids(ids: np.ndarray, widths: tuple[int, ...] = (8, 8, 16)) -> bytes:
    """File image of ``ids`` (unsigned 32-bit)."""
    out = [b"DAC1", struct.pack("<IQ", len(widths), len(ids))]
    left = ids.astype(np.uint64)
    for k, width in enumerate(widths):
        out += [struct.pack("<IQ", width, len(left)), (left & np.uint64((1 << width) - 1)).astype(_TYPE[width]).tobytes()]
        left = left >> np.uint64(width)
        if k + 1 < len(widths):
            goes_on = left > 0
            bits = np.packbits(goes_on, bitorder="little")
            ones = np.add.reduceat(_ONES[bits], np.arange(0, len(bits), _BLOCK // 8)) if len(bits) else np.zeros(0, np.uint32)
            out += [bits.tobytes(), (np.cumsum(ones) - ones).astype("<u4").tobytes()]
            left = left[goes_on]
        elif left.any():
            raise ValueError(f"ids need more than {sum(widths)} bits")
    return b"".join(out)


class IdReader:
    """Random access to a file image."""

    def __init__(self, raw: bytes):
        if raw[:4] != b"DAC1":
            raise ValueError("not a file of directly addressable codes")
        n_levels, self.n = struct.unpack_from("<IQ", raw, 4)
        at, self.levels = 16, []
        for k in range(n_levels):
            width, n = struct.unpack_from("<IQ", raw, at)
            at += 12
            chunks = np.frombuffer(raw, _TYPE[width], n, at)
            at += chunks.nbytes
            bits = directory = None
            if k + 1 < n_levels:
                bits = np.frombuffer(raw, np.uint8, -(-n // 8), at)
                at += bits.nbytes
                directory = np.frombuffer(raw, "<u4", -(-n // _BLOCK), at)
                at += directory.nbytes
            self.levels.append((width, chunks, bits, directory))

    def read(self, lo: int, hi: int) -> np.ndarray:
        """Ids lo .. hi - 1: one rank a level, then consecutive chunks."""
        out = np.zeros(max(0, hi - lo), np.uint32)
        places, shift = np.arange(len(out)), 0
        for width, chunks, bits, directory in self.levels:
            if not len(places):
                break
            out[places] |= chunks[lo:hi].astype(np.uint32) << np.uint32(shift)
            shift += width
            if bits is None:
                break
            goes_on = np.unpackbits(bits[lo // 8:-(-hi // 8)], bitorder="little")[lo % 8:lo % 8 + hi - lo].astype(bool)
            block = lo // _BLOCK
            before = int(directory[block]) + int(np.unpackbits(bits[block * _BLOCK // 8:-(-lo // 8)], bitorder="little")[:lo % _BLOCK].sum())
            lo, hi, places = before, before + int(goes_on.sum()), places[goes_on]
        return out


SEGMENT = "part int, seq int, doc_id array<bigint>, n_tokens array<bigint>, image binary"


def write_segments(docs: DataFrame, tokenizer: str, end_id: int, segment_tokens: int = 1 << 20,
                   widths: tuple[int, ...] = (8, 8, 16)) -> DataFrame:
    """Encode ``docs`` (doc_id, text; others ignored) in ascending order of
    doc_id (nulls first, ties by a hash of the text) and write the segments to the shared
    folder.  Null text counts as empty; every document ends with ``end_id``.
    A segment is closed at the first document end at or beyond
    ``segment_tokens`` ids, so a task holds one segment at a time."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, seq, coder, end = TaskContext.get().partitionId(), 0, encoder(tokenizer), struct.pack("<I", end_id)
        ids: list[bytes] = []
        names: list[int | None] = []
        held = 0

        def segment() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([names], pa.list_(pa.int64())),
                 pa.array([[len(x) // 4 for x in ids]], pa.list_(pa.int64())),
                 pa.array([pack_ids(np.frombuffer(b"".join(ids), "<u4"), widths)], pa.binary())],
                ["part", "seq", "doc_id", "n_tokens", "image"])

        for batch in batches:
            for rows in slices(batch, 1):
                for name, got in zip(rows.column(0).to_pylist(), coder.encode([t or "" for t in rows.column(1).to_pylist()])):
                    names.append(name)
                    ids.append(got + end)
                    held += len(got) // 4 + 1
                    if held >= segment_tokens:
                        yield segment()
                        ids, names, held, seq = [], [], 0, seq + 1
        if ids:
            yield segment()

    # the range bounds are sampled through the driver: hashes, not texts
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    rows = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    # encoding runs after the exchange, so sampling the range bounds costs no encoding
    return written(rows.repartitionByRange(*order).sortWithinPartitions(*order, "text").mapInArrow(encode, SEGMENT), "token-files")


def read_documents(segments: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, its ids read
    back by address.  ``start`` counts the ids of all documents before it."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                reader, n = IdReader(row["image"]), row["n_tokens"]
                ends = np.cumsum(np.array(n, np.int64))
                starts = ends - np.array(n, np.int64)
                crc = [zlib.crc32(reader.read(a, b).astype("<u4").tobytes()) for a, b in zip(starts.tolist(), ends.tolist())]
                k = len(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_id"], pa.int64()), pa.array([row["part"]] * k, pa.int32()), pa.array([row["seq"]] * k, pa.int32()),
                     pa.array(starts, pa.int64()), pa.array(n, pa.int64()), pa.array(crc, pa.int64())],
                    ["doc_id", "part", "seq", "within", "n_tokens", "ids_crc32"])

    found = segments.mapInArrow(read, "doc_id bigint, part int, seq int, within bigint, n_tokens bigint, ids_crc32 bigint")
    sizes = segments.select("part", "seq", F.aggregate("n_tokens", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("n"))
    # two levels: one row per partition in the only unpartitioned window
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n"))
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("seq")
    offsets = (sizes.select("part", "seq", (F.sum("n").over(inside) - F.col("n")).alias("seq_start"))
                    .join(before, "part").select("part", "seq", (F.col("part_start") + F.col("seq_start")).alias("base")))
    return (found.join(offsets, ["part", "seq"])
                 .select("doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32"))
