"""Phrase collocations by top-order marginalisation.

Every word position gives one padded window, the word and up to three after it
in its piece; only these longest windows are counted.  Each contiguous
occurrence of a shorter phrase is the prefix of exactly one window, so a Spark
ROLLUP over the window's columns sums the counts of all lengths at once: no
n-gram of another length is ever made.

Passes before it keep the windows few.  The first counts words and word pairs by
hash, the second longer prefixes of the windows whose pairs are frequent enough.
A window is cut in front of the first word with which it cannot reach the wanted
frequency: cut windows lose only phrases that are too rare to be a candidate or
part of one.  What is frequent is told by a bit table of fixed size; its clashes
cost work, never results.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count as counter

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from starloom.llm.common import written

#: Bits of the table that tells what is frequent: 16 MB.
TABLE_BITS = 27
#: Words held in a task, of all its languages, before they are counted and sent on.
HELD = 1 << 21
#: Windows that a task sums up, of all its languages, before it sends them on;
#: windows of a batch; input splits of a task.
MOST, BATCH, SPLITS = 1 << 21, 1 << 16, 4
WIDTH = 4

_TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz\n\n\n\n\n\n\n\n\n ")


class _Words:
    """Words of one language as numbers; 0 stands between pieces."""

    def __init__(self):
        self.clear()

    def clear(self):
        self.ids, self.parts, self.held = defaultdict(counter(1).__next__), [], 0
        self.ids[b"\n"] = 0

    def add(self, text: str) -> None:
        words = text.encode("utf-8", "surrogatepass").translate(_TABLE).replace(b"\n", b" \n ").split(b" ")
        found = np.fromiter(map(self.ids.__getitem__, filter(None, words)), np.int32)
        self.parts += [found, np.zeros(1, np.int32)]
        self.held += len(found) + 1

    def row(self) -> np.ndarray:
        return np.concatenate(self.parts) if self.parts else np.zeros(0, np.int32)

    def names(self) -> list[bytes]:
        """By number: a word seen first has the next number."""
        out = list(self.ids)
        out[0] = b""
        return out


def _hashes(names: list[bytes], lang: str) -> np.ndarray:
    """A hash of every word in its language."""
    seed = xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass"))
    return np.fromiter((xxh3_64_intdigest(w, seed) for w in names), np.uint64, len(names))


def _joined(key: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Key of a phrase with one word more."""
    key = (key ^ (key >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + h
    return (key ^ (key >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)


def _sorted_counts(values: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and how often they occur."""
    if times is None:
        values = np.sort(values)
    else:
        order = np.argsort(values, kind="stable")
        values, times = values[order], times[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(values)), bool), values[1:] != values[:-1]]))
    if times is None:
        return values[first], np.diff(np.append(first, len(values)))
    return values[first], np.add.reduceat(times, first) if len(first) else times


def _places(keys: np.ndarray, bits: int) -> list[np.ndarray]:
    """Two places in the bit table, from the first 48 bits of a key."""
    return [keys >> np.uint64(64 - bits), ((keys >> np.uint64(16)) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - bits)]


class Frequent:
    """Keys that occur often: no false answers on those that do."""

    def __init__(self, table: bytes):
        self.table, self.bits = np.frombuffer(table, np.uint8), (8 * len(table)).bit_length() - 1

    def holds(self, keys: np.ndarray) -> np.ndarray:
        one, two = (self.table[at >> np.uint64(3)] >> (np.uint8(7) - (at & np.uint64(7)).astype(np.uint8)) for at in _places(keys, self.bits))
        return (one & two & np.uint8(1)).astype(bool)


def _grown(row: np.ndarray, h: np.ndarray, pairs: Frequent, longer: Frequent | None) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Windows at the words that are frequent: the word number of each place (0
    once a window is cut), and without ``longer`` the keys of the prefixes of 3
    words and more."""
    n = len(row)
    good = pairs.holds(h)
    good[0] = False
    kept = np.append(np.where(good[row], row, 0), np.zeros(WIDTH, np.int32)).astype(np.int64)
    at = np.flatnonzero((kept[:-1] > 0) & (kept[1:] > 0))
    goes_on = np.zeros(n + WIDTH, bool)
    goes_on[at] = pairs.holds(_joined(h[kept[at]], h[kept[at + 1]]))
    at = np.flatnonzero(kept[:n])
    columns, keys, on, key = [kept[at]], [], np.ones(len(at), bool), h[kept[at]]
    for k in range(1, WIDTH):
        on = on & goes_on[at + k - 1]
        word = np.where(on, kept[at + k], 0)
        key = _joined(key, h[word])
        if k > 1:
            if longer is not None:
                on = on & longer.holds(key)
                word = np.where(on, word, 0)
            else:
                keys.append(key[on])
        columns.append(word)
    return columns, keys


def _texts(batches: Iterator[pa.RecordBatch], flush, most: int) -> Iterator[pa.RecordBatch]:
    """Collects the words of (lang, text) rows by language; calls ``flush`` on
    that with the most words once all hold ``most``, and on the rest at the end."""
    langs: dict[str, _Words] = {}
    total = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = langs.get(lang) or langs.setdefault(lang, _Words())
            total -= words.held
            words.add(text)
            total += words.held
            if total >= most:
                lang = max(langs, key=lambda x: langs[x].held)
                words = langs.pop(lang)
                total -= words.held
                yield from flush(lang, words)
    for lang, words in langs.items():
        yield from flush(lang, words)


def frequent(rows: DataFrame, least: int, bits: int, held: int, pairs: Broadcast | None = None) -> bytes:
    """Bit table of the keys that occur ``least`` times or more in ``rows``
    (lang, text): words and pairs, or where those are given the prefixes of 3
    and 4 words of the windows that they leave.  Keys are counted in parts by
    their first bits, as many as there are shuffle partitions."""
    split = max(0, (int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())
    parts = 1 << split

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = Frequent(pairs.value) if pairs else None

        def flush(lang: str, words: _Words) -> Iterator[pa.RecordBatch]:
            row, h = words.row(), _hashes(words.names(), lang)
            if first:
                keys = _grown(row, h, first, None)[1]
            else:
                at = np.flatnonzero((row[:-1] > 0) & (row[1:] > 0))
                keys = [h[row[row > 0]], _joined(h[row[at]], h[row[at + 1]])]
            key, times = _sorted_counts(np.concatenate(keys))
            cuts = np.searchsorted(key, np.arange(parts, dtype=np.uint64) << np.uint64(64 - split)) if split else np.zeros(1, np.int64)
            # the first bits are the part's, 48 more tell keys apart
            key = key << np.uint64(split) >> np.uint64(16)
            low, high = (key & np.uint64((1 << 32) - 1)).astype("<u4"), (key >> np.uint64(32)).astype("<u2")
            times = np.minimum(times, least).astype("<u1" if least < 256 else "<u4")
            spans = [(p, a, b) for p, (a, b) in enumerate(zip(cuts, [*cuts[1:], len(key)])) if b > a]
            for lo in range(0, len(spans), 64):
                some = spans[lo:lo + 64]
                yield pa.RecordBatch.from_arrays([pa.array([p for p, *_ in some], pa.int32()),
                                                  *(pa.array([x[a:b].tobytes() for _, a, b in some], pa.binary()) for x in (low, high, times))],
                                                 ["part", "low", "high", "times"])
        yield from _texts(batches, flush, held)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}

        def compact(part: int) -> tuple[np.ndarray, np.ndarray]:
            keys, times, _ = sums[part]
            key, n = _sorted_counts(np.concatenate(keys), np.concatenate(times))
            sums[part] = [[key], [np.minimum(n, least)], len(key)]
            return key, n

        for batch in batches:
            for part, low, high, times in zip(*(batch.column(c).to_pylist() for c in range(4))):
                have = sums.setdefault(part, [[], [], 0])
                have[0].append(np.frombuffer(high, "<u2").astype(np.uint64) << np.uint64(32) | np.frombuffer(low, "<u4"))
                have[1].append(np.frombuffer(times, "<u1" if least < 256 else "<u4").astype(np.int64))
                if sum(map(len, have[0])) > 2 * have[2] + (1 << 20):
                    compact(part)
        for part in sums:
            key, n = compact(part)
            key = (key[n >= least] << np.uint64(16) >> np.uint64(split)) | np.uint64(part << 64 - split if split else 0)
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(_places(key, bits))).astype(np.int64))], ["bit"])

    counted = rows.mapInArrow(count, "part int, low binary, high binary, times binary").repartition(parts, "part").mapInArrow(add, "bit bigint")
    # Spark's bitmaps: 32,768 bits in a row, the lowest bit of a byte first
    maps = counted.groupBy(F.expr("bit div 32768").alias("at")).agg(F.expr("bitmap_construct_agg(bit % 32768)").alias("bits")).collect()
    out = np.zeros(max(1, (1 << bits) >> 15) << 12, np.uint8)
    for at, held_bits in maps:
        out[at << 12:(at + 1) << 12] = np.packbits(np.unpackbits(np.frombuffer(held_bits, np.uint8), bitorder="little"))
    return out[:max(1, (1 << bits) >> 3)].tobytes()


class _Windows:
    """Windows of one language and how often they occur, by number of word."""

    def __init__(self):
        self.names: dict[str, int] = {"": 0}
        self.left = self.right = self.times = np.zeros(0, np.int64)
        self.words = 0

    def add(self, names: list[bytes], columns: list[np.ndarray], words: int) -> None:
        self.words += words
        left, right = columns[0] << 32 | columns[1], columns[2] << 32 | columns[3]
        columns.clear()
        right, r_at = np.unique(right, return_inverse=True)
        left, both = np.unique(left, return_inverse=True)
        both, times = _sorted_counts(both << 32 | r_at)
        del r_at
        low = (1 << 32) - 1
        used, place = np.unique(np.concatenate([left >> 32, left & low, right >> 32, right & low]), return_inverse=True)
        number = np.array([self.names.setdefault(names[w].decode("utf-8", "replace"), len(self.names)) for w in used.tolist()], np.int64)[place]
        left, right = (a << 32 | b for a, b in (np.split(number[:2 * len(left)], 2), np.split(number[2 * len(left):], 2)))
        left, right = np.concatenate([self.left, left[both >> 32]]), np.concatenate([self.right, right[both & low]])
        times = np.concatenate([self.times, times])
        order = np.lexsort((right, left))
        left, right, times = left[order], right[order], times[order]
        first = np.flatnonzero(np.concatenate([np.ones(min(1, len(left)), bool), (left[1:] != left[:-1]) | (right[1:] != right[:-1])]))
        self.left, self.right = left[first], right[first]
        self.times = np.add.reduceat(times, first) if len(first) else times

    def batches(self, lang: str) -> Iterator[pa.RecordBatch]:
        """One row a window, and one with the number of words."""
        book, low = pa.array(list(self.names), pa.string()), (1 << 32) - 1
        for lo in range(0, len(self.times) + 1, BATCH):
            left, right, times = (np.append(x[lo:lo + BATCH], np.full(int(lo + BATCH > len(x)), end, np.int64))
                                  for x, end in ((self.left, 0), (self.right, 0), (self.times, self.words)))
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(lang, len(times)), *(book.take(pa.array(x)) for x in (left >> 32, left & low, right >> 32, right & low)),
                 pa.array(times)], ["lang", "w1", "w2", "w3", "w4", "n"])


def windows(rows: DataFrame, least: int, bits: int = TABLE_BITS, held: int = HELD, most: int = MOST) -> DataFrame:
    """(lang, w1 .. w4, n): how often each padded window occurs, cut in front
    of what cannot occur ``least`` times.  A row with empty ``w1`` holds the
    number of all words of its language."""
    context = rows.sparkSession.sparkContext
    pairs = context.broadcast(frequent(rows, least, bits, held))
    longer = context.broadcast(frequent(rows, least, bits, held, pairs))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        short, long = Frequent(pairs.value), Frequent(longer.value)
        sums: dict[str, _Windows] = {}

        def flush(lang: str, words: _Words) -> Iterator[pa.RecordBatch]:
            row, names = words.row(), words.names()
            have = sums.setdefault(lang, _Windows())
            have.add(names, _grown(row, _hashes(names, lang), short, long)[0], np.count_nonzero(row))
            if sum(len(x.times) for x in sums.values()) > most:
                largest = max(sums, key=lambda x: len(sums[x].times))
                yield from sums.pop(largest).batches(largest)

        yield from _texts(batches, flush, held)
        for lang, have in sums.items():
            yield from have.batches(lang)

    # larger tasks give each of their windows once; at least two for every core
    tasks = rows.rdd.getNumPartitions()
    rows = rows.coalesce(max(1, min(tasks, max(2 * context.defaultParallelism, -(-tasks // SPLITS)))))
    return rows.mapInArrow(cut, "lang string, w1 string, w2 string, w3 string, w4 string, n bigint")


def phrases(counted: DataFrame, least: int) -> DataFrame:
    """(lang, words array, phrase, f) of all phrases of 1 to 4 words that occur
    ``least`` times: window counts rolled up over successively shorter
    prefixes."""
    names = [f"w{k + 1}" for k in range(WIDTH)]
    counted.groupBy("lang", *names).agg(F.sum("n").alias("n")).createOrReplaceTempView(view := f"_starloom_windows_{id(counted)}")
    try:
        rolled = counted.sparkSession.sql(
            f"SELECT lang, {', '.join(names)}, sum(n) AS f, cast(grouping_id() AS int) AS rolled FROM {view} "
            f"WHERE w1 <> '' GROUP BY lang, ROLLUP({', '.join(names)}) HAVING sum(n) >= {int(least)}")
    finally:
        counted.sparkSession.catalog.dropTempView(view)
    # level k keeps k words: the last grouping bits are ones
    size = sum(F.when(F.col("rolled") == (1 << WIDTH - k) - 1, F.lit(k)).otherwise(F.lit(0)) for k in range(WIDTH + 1))
    words = F.slice(F.array(*names), F.lit(1), F.col("size"))
    return (rolled.withColumn("size", size).filter("size > 0").withColumn("words", words).filter(F.element_at("words", -1) != "")
                  .select("lang", "words", F.array_join("words", " ").alias("phrase"), F.col("f").cast("bigint")))


def collocations(docs: DataFrame, least: int = 30, scale: int = 2_000_000, top: int | None = 2000, inside: int = 80,
                 bits: int = TABLE_BITS, held: int = HELD, most: int = MOST) -> DataFrame:
    """Ranked phrases of 2 to 4 words by language: (lang, rank, phrase, a, l,
    r, n, score) from ``docs`` (lang, text; other columns ignored).

    Texts are lower-cased in A-Z and cut at ``[.,;:!?\\x0A-\\x0D]`` into
    pieces, those at blanks and tabs into words; ``n`` counts the words of the
    language, ``a`` the phrase.  A phrase that occurs ``least`` times is a
    candidate; of its cuts into two parts (occurring l and r times) that with
    the lowest floor(scale * a / (l + r)) counts, ties to the shortest first
    part.  It goes if a longer candidate holds it and occurs at least
    ``inside`` percent as often.  The best ``top`` of a language (None: all)
    are ranked by score and a, falling, then by the phrase's bytes.

    ``bits`` (3 or more) sets the size of the bit tables and ``held`` and ``most``
    the words and windows a task holds: none changes the result.

    Null text counts as empty, null lang as ``und``; repeated rows count each;
    no rows give no rows."""
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    counted = written(windows(rows, least, bits, held, most), "collocation-windows")
    totals = counted.filter("w1 = ''").groupBy(F.col("lang").alias("t_lang")).agg(F.sum("n").cast("bigint").alias("n"))
    known = written(phrases(counted, least), "collocation-phrases")
    candidates = known.filter(F.size("words") > 1)

    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("words") - 1)))
    cuts = (cuts.withColumn("first", F.array_join(F.slice("words", F.lit(1), F.col("k")), " "))
                .withColumn("rest", F.array_join(F.slice("words", F.col("k") + 1, F.size("words") - F.col("k")), " ")))
    left = known.select(F.col("lang").alias("l_lang"), F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = known.select(F.col("lang").alias("r_lang"), F.col("phrase").alias("rest"), F.col("f").alias("r"))
    cuts = (cuts.join(left, (F.col("lang") == F.col("l_lang")) & (cuts["first"] == left["first"]))
                .join(right, (F.col("lang") == F.col("r_lang")) & (cuts["rest"] == right["rest"])))
    # beyond 64 bits: a product of 20 digits and a sum of 20
    score = F.expr(f"cast((cast({int(scale)} AS decimal(18, 0)) * cast(f AS decimal(20, 0))) div (cast(l AS decimal(20, 0)) + r) AS bigint)")
    scored = (cuts.withColumn("score", score).groupBy("lang", "phrase")
                  .agg(F.first("f").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut")))

    longer = candidates.filter(F.size("words") > 2)
    within = F.flatten(F.transform(F.sequence(F.lit(2), F.size("words") - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.size("words") - m + 1), lambda s: F.array_join(F.slice("words", s, m), " "))))
    held = longer.select(F.col("lang").alias("h_lang"), F.explode(F.array_distinct(within)).alias("part"), "f")
    held = held.groupBy("h_lang", "part").agg(F.max("f").alias("longer"))
    kept = scored.join(held, (F.col("lang") == F.col("h_lang")) & (F.col("phrase") == F.col("part")), "left")
    kept = kept.filter(F.col("longer").isNull() | (F.col("longer").cast("decimal(20, 0)") * 100 < F.col("a").cast("decimal(20, 0)") * inside))
    kept = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    # ranked with a limit, each task keeps its own best before the exchange
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase"))
    ranked = kept.withColumn("rank", place)
    if top is not None:
        ranked = ranked.filter(F.col("rank") <= top)
    return (ranked.join(totals, F.col("lang") == F.col("t_lang"))
                  .select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
