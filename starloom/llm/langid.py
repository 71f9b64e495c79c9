"""Language identification by error-correcting output codes.

Each language is a codeword.  One binary classifier per bit, a naive Bayes
model over hashed byte 3- and 4-grams of letters, tells the languages whose
bit is 1 from the others.  Decoding weighs each bit's loss by how firmly the
language stands on its side of that bit, and takes the nearest codeword; a
document about as near to the second one is flagged ambiguous.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import written

GRAM_BITS = 15
#: A lower-case ASCII letter keeps its byte, other ASCII is a word break, bytes beyond are kept.
_KEEP = np.array([b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256)], np.uint8)
_PIECE = 1 << 20


def grams(text: str) -> Iterator[np.ndarray]:
    """Hashed gram numbers of the whole text, those that start in a bounded
    piece at a time; piece borders change nothing."""
    raw = _KEEP[np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)]
    # runs of breaks as one; a break also stands before and after the text
    border = np.array([32], np.uint8)
    raw = np.concatenate((border, raw[(raw != 32) | (np.append(np.uint8(0), raw[:-1]) != 32)], border))
    for lo in range(0, max(0, len(raw) - 3), _PIECE):
        x = raw[lo:lo + _PIECE + 3].astype(np.uint32)
        three = (x[:-2] << np.uint32(16)) | (x[1:-1] << np.uint32(8)) | x[2:]
        four = (three[:-1] << np.uint32(8)) | x[3:]
        if lo + _PIECE + 3 < len(raw):
            three = three[:-1]
        yield np.concatenate((three * np.uint32(2654435761), four * np.uint32(2246822519))) >> np.uint32(32 - GRAM_BITS)


def codewords(n: int) -> np.ndarray:
    """n codewords of ±1: every split of the languages for up to five, else
    about 10·log2(n) bits, the best separated of a fixed series of draws."""
    if n <= 1:
        return np.ones((n, 1), np.int8)
    if n <= 5:
        bits = [(1, *(1 if b else -1 for b in rest)) for rest in itertools.product((0, 1), repeat=n - 1)]
        return np.array([b for b in bits if -1 in b], np.int8).T
    rng, best = np.random.default_rng(0), None
    for _ in range(200):
        code = rng.choice(np.array([-1, 1], np.int8), (n, int(np.ceil(10 * np.log2(n)))))
        code = code[:, np.abs(code.sum(0)) < n]
        apart = (code[:, None, :] != code[None, :, :]).sum(2) + 10**6 * np.eye(n, dtype=int)
        if best is None or apart.min() > best[0]:
            best = (apart.min(), code)
    return best[1]


class Model:
    """Languages, their codewords, one weight per gram and bit, and how firmly
    each language stands on its side of each bit."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages, self.code = languages, codewords(len(languages)).astype(np.float32)
        p = (counts + 0.5) / (counts + 0.5).sum(1, keepdims=True)
        bits = self.code.shape[1] if len(languages) > 1 else 0
        self.weights = np.zeros((1 << GRAM_BITS, bits), np.float32)
        for b in range(bits):
            self.weights[:, b] = np.log(p[self.code[:, b] > 0].mean(0)) - np.log(p[self.code[:, b] < 0].mean(0))
        mean = p @ self.weights if bits else np.zeros((len(languages), 0))
        self.scale = np.abs(mean).mean(0) if bits else np.zeros(0)
        firm = np.abs(mean) / np.maximum(self.scale, 1e-9)
        self.firm = (firm / np.maximum(firm.sum(1, keepdims=True), 1e-9)).astype(np.float32)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language or ``und``, score 0..1, ambiguous)."""
        if not text or not self.languages or not any(map(str.isalpha, text)):
            return "und", 0.0, True
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        total, n = np.zeros(len(self.scale), np.float64), 0
        for g in grams(text):
            total += self.weights.take(g, 0).sum(0, dtype=np.float64)
            n += len(g)
        margin = total / max(n, 1) / np.maximum(self.scale, 1e-9)
        loss = (self.firm * np.log1p(np.exp(-2.0 * self.code * margin))).sum(1)
        first, second = np.argsort(loss, kind="stable")[:2]
        gap = float(loss[second] - loss[first])
        return self.languages[first], float(1.0 / (1.0 + np.exp(-8.0 * gap))), gap < AMBIGUOUS_GAP


#: Losses closer than this leave the language open.
AMBIGUOUS_GAP = 0.02


def train(rows: DataFrame, per_language: int = 4000, tasks: int = 16) -> Model:
    """Model from ``rows`` (doc_id, text, lang).  At most about
    ``per_language`` rows of each language, chosen by hash, are read whole;
    rows without language or text teach nothing."""
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    have = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not have:
        return Model([], np.zeros((0, 1 << GRAM_BITS)))
    languages = sorted(have)
    share = F.element_at(F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, per_language / have[lang]))]), F.col("lang"))
    sample = rows.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) < share * (1 << 20)).select("lang", "text")
    at = {lang: k for k, lang in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((len(at), 1 << GRAM_BITS), np.int64)
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for g in grams(text):
                    seen[at[lang]] += np.bincount(g, minlength=1 << GRAM_BITS)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(at)), pa.int32()), pa.array([x.tobytes() for x in seen], pa.binary())], ["k", "counts"])

    # a fixed number of tasks, so the driver gets tasks × languages rows of one gram table each
    parts = written(sample.repartition(tasks).mapInArrow(count, "k int, counts binary"), "langid-counts")

    def add(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.int64) for x in table.column("counts").to_pylist())
        return pa.table({"k": pa.array([key[0].as_py()], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})

    summed = {r["k"]: np.frombuffer(r["counts"], np.int64) for r in parts.groupBy("k").applyInArrow(add, "k int, counts binary").collect()}
    return Model(languages, np.array([summed.get(k, np.zeros(1 << GRAM_BITS)) for k in range(len(languages))], np.float64))


def identify(docs: DataFrame, model: Model, *keep: str, prefix: str = "") -> DataFrame:
    """The ``keep`` columns of ``docs`` with lang_pred, score and ambiguous
    (names after ``prefix``), read from ``text`` alone.  Null text, or text
    without a letter, is ``und`` with score 0; an empty ``docs`` gives an empty
    result."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages × grams, not rows
    names = list(dict.fromkeys(keep))
    text = names.index("text") if "text" in names else len(names)
    found = [prefix + n for n in ("lang_pred", "score", "ambiguous")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [shared.value.predict(t) for t in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(names)], pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64()),
                 pa.array([g[2] for g in got], pa.bool_())], [*names, *found])

    schema = T.StructType([*(docs.schema[n] for n in names), *map(T.StructField, found, (T.StringType(), T.DoubleType(), T.BooleanType()))])
    return docs.select(*(F.col(f"`{n}`") for n in names), *([] if "text" in names else ["text"])).mapInArrow(run, schema)
