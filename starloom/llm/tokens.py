"""Whole-text encoding with the ``tokenizers`` library, one call per distinct
chunk instead of one per text.

Both pre-tokenizers handled here cut a text at white space and between letters
and punctuation before any merge, so the ids of a text are the ids of its chunks
in order.  Texts are cut by array operations and their chunks numbered by Arrow;
distinct chunks are looked up in a bounded cache, those not in it go to the
library: words of letters to its model where that takes them as they are, others
together in one call.  Texts that do not cut so plainly (characters whose white
space or lower case is not plain, apostrophes, symbols beyond ASCII, strings that
are tokens of their own) go to the library whole.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: ASCII punctuation without the apostrophe.
_MARKS = r"!-&(-/:-@\[-`{-~"
#: Beyond letters of Latin-1 and Latin Extended, digits, marks, blanks and newlines.
_ODD = re.compile(rf"[^\n\x20a-zA-Z0-9{_MARKS}ªµºÀ-ÖØ-öø-įı-ɏ]")
_LETTERS = "[a-zA-ZªµºÀ-ÖØ-öø-įı-ɏ]"
_RUNS = ("  ", " \n", "\n ", "\n\n")
#: Kind of a byte where chunks are cut: space, newline, punctuation, all else.
_SPACE, _KIND = 3, np.zeros(256, np.uint8)
_KIND[[c for c in range(128) if re.match(f"[{_MARKS}]", chr(c))]] = 1
_KIND[ord("\n")], _KIND[ord(" ")] = 2, _SPACE
#: The characters by which byte-level models name bytes, those without a
#: printable Latin-1 character from U+0100 on; a newline parts chunks here.
_BYTE_NAMES = np.arange(256, dtype="<u2")
_UNPRINTED = [b for b in range(256) if not (33 <= b < 127 or 161 <= b < 173 or 174 <= b)]
_BYTE_NAMES[_UNPRINTED] = 256 + np.arange(len(_UNPRINTED))
_BYTE_NAMES[ord("\n")] = ord("\n")


#: ASCII that is plain in any place.
_PLAIN = bytes(c for c in range(128) if not _ODD.search(chr(c)))


def _odd(text: str) -> bool:
    """Whether a text holds a character that is not plain: only those beyond
    plain ASCII are looked at one by one."""
    rest = text.encode("utf-8", "replace").translate(None, _PLAIN)
    return bool(rest) and _ODD.search(rest.decode()) is not None


def tokenizer_path(name: str) -> str:
    """Place of a tokenizer file: ``name`` itself if it is a path, else the
    file of the installed ``public_tokenizers`` package."""
    if "/" in name:
        return name
    import public_tokenizers
    return public_tokenizers.path(name)


def slices(batch: pa.RecordBatch, column: int, size: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows whose texts hold about ``size`` bytes: chunks
    that repeat in a run are looked up once."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + size)))
        yield batch.slice(lo, hi - lo)
        lo = hi


_ENCODERS: dict[str, ChunkEncoder] = {}


def encoder(name: str) -> ChunkEncoder:
    """This Python worker's encoder of ``name``: its cache serves every task
    that the worker runs."""
    if name not in _ENCODERS:
        _ENCODERS[name] = ChunkEncoder(name)
    return _ENCODERS[name]


def _spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Places start .. start + size of every entry, one after the other."""
    ends = np.cumsum(size)
    return np.repeat(start - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)


class ChunkEncoder:
    """Texts → ids as little-endian unsigned 32-bit bytes, those that the
    library gives for the whole text with ``add_special_tokens=False``.

    Known chunks have a place in an array of ids, so joining is an array
    operation.  Beyond ``cache_chunks`` those looked up since the last time
    stay, the latest half at most: the cache is bounded (some 200 bytes a chunk)
    and never emptied as a whole."""

    def __init__(self, name: str, cache_chunks: int = 3 << 17):
        from tokenizers import Tokenizer
        path = tokenizer_path(name)
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            conf = json.load(f)
        pre, norm = conf.get("pre_tokenizer") or {}, conf.get("normalizer") or {}
        if not norm and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space"):
            self._plain, self._chunks = self._plain_bytes, self._byte_chunks
        elif [n.get("type") for n in norm.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]:
            self._plain, self._chunks = self._plain_words, self._word_chunks
        else:
            self._plain, self._chunks = lambda text: False, None
        # a space belongs to the word after it, or a word's last token says so
        self._lead = self._chunks is self._byte_chunks
        end = conf["model"].get("end_of_word_suffix") or ""
        self._border = np.zeros(self.library.get_vocab_size(), bool)
        for token, number in self.library.get_vocab().items():
            self._border[number] = bool(end) and token.endswith(end)
        # strings that are tokens of their own wherever they stand
        added = [t["content"] for t in conf.get("added_tokens") or []]
        self._added = re.compile("|".join(map(re.escape, added)), re.I) if added else None
        self.limit = cache_chunks
        # in order of their places
        self.words: dict[str, int] = {}
        self.flat, self.ends, self.used = np.zeros(0, "<u4"), np.zeros(1, np.int64), np.zeros(0, bool)
        self.looked_up = self.learned = self.turns = 0

    @staticmethod
    def _plain_words(text: str) -> bool:
        return not _odd(text)

    @staticmethod
    def _word_chunks(texts: pa.Array) -> pa.Array:
        apart = pc.replace_substring_regex(pc.utf8_lower(texts), rf"([{_MARKS}]+)", r" \1 ")
        return pc.utf8_split_whitespace(apart)

    @staticmethod
    def _plain_bytes(text: str) -> bool:
        return not (text[0] in " \n" or text[-1] in " \n" or _odd(text) or any(run in text for run in _RUNS))

    @staticmethod
    def _byte_chunks(texts: pa.Array) -> pa.Array:
        """A single space belongs to what follows it, a single newline stands
        alone; longer runs of white space go to the library."""
        data, ends = np.frombuffer(texts.buffers()[2], np.uint8), np.frombuffer(texts.buffers()[1], np.int64)[:len(texts) + 1]
        kind = _KIND[data[:ends[-1]]]
        border = np.append(True, (kind[1:] != kind[:-1]) & (kind[:-1] != _SPACE))
        border[ends[:-1]] = True
        cuts = np.append(np.flatnonzero(border), ends[-1])
        chunks = pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts), texts.buffers()[2])
        return pa.LargeListArray.from_arrays(np.searchsorted(cuts, ends), chunks)

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each) of chunks that are letters."""
        if not words:
            return np.zeros(0, "<u4"), np.zeros(0, np.int64)
        if self._lead:
            # the pre-tokenizer keeps such a chunk whole and names its bytes
            raw = np.frombuffer("\n".join(words).encode(), np.uint8)
            tokenize, found, size = self.library.model.tokenize, [], np.empty(len(words), np.int64)
            for k, word in enumerate(_BYTE_NAMES[raw].tobytes().decode("utf-16-le").split("\n")):
                tokens = tokenize(word)
                size[k] = len(tokens)
                found += [t.id for t in tokens]
            return np.array(found, "<u4"), size
        # one call on all, told apart again by the tokens that end a word
        ids = np.array(self.library.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        cuts = np.append(0, np.flatnonzero(self._border[ids]) + 1)
        if len(cuts) != len(words) + 1:
            raise AssertionError("the vocabulary does not mark its words")
        return ids, np.diff(cuts)

    def _learn(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each chunk): those that are letters by
        themselves, the others in one library call."""
        self.learned += len(chunks)
        letters = pc.match_substring_regex(pa.array(chunks, pa.large_string()), f"^{' ?' if self._lead else ''}{_LETTERS}+$")
        size = np.zeros(len(chunks), np.int64)
        is_word = letters.to_numpy(zero_copy_only=False)
        ids, size[is_word] = self._words(list(compress(chunks, is_word)))
        others = list(compress(chunks, ~is_word))
        if others:
            got = self.library.encode(others, is_pretokenized=True, add_special_tokens=False)
            size[~is_word] = np.bincount(np.array(got.word_ids, np.int64), minlength=len(others)) if got.ids else 0
            ids = np.concatenate([ids, np.array(got.ids, "<u4")])
        # letters first, then the others: back to the order of the chunks
        order = np.concatenate([np.flatnonzero(is_word), np.flatnonzero(~is_word)])
        start = np.empty(len(chunks), np.int64)
        start[order] = np.cumsum(size[order]) - size[order]
        return ids[_spread(start, size)], size

    def _look_up(self, chunks: pa.Array) -> np.ndarray:
        """Places of distinct chunks among the known ones, learned if need be."""
        self.looked_up += len(chunks)
        names = chunks.to_numpy(zero_copy_only=False).tolist()
        place = np.fromiter(map(self.words.get, names, repeat(-1)), np.int64, len(names))
        is_new = place < 0
        self.used[place[~is_new]] = True
        if is_new.any():
            new, known = list(compress(names, is_new)), len(self.words)
            ids, size = self._learn(new)
            place[is_new] = known + np.arange(len(new))
            self.words.update(zip(new, range(known, known + len(new))))
            self.flat = np.concatenate([self.flat, ids])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(size)])
            self.used = np.concatenate([self.used, np.zeros(len(new), bool)])
        return place

    def _evict(self) -> None:
        keep = np.flatnonzero(self.used)[-(self.limit // 2):] if self.limit > 1 else np.zeros(0, np.int64)
        size = np.diff(self.ends)[keep]
        self.flat = self.flat[_spread(self.ends[keep], size)]
        words = list(self.words)
        self.words = {words[k]: place for place, k in enumerate(keep.tolist())}
        self.ends, self.used = np.append(0, np.cumsum(size)), np.zeros(len(keep), bool)
        self.turns += 1

    def _encode_plain(self, texts: list[str]) -> list[bytes]:
        chunks = self._chunks(pa.array(texts, pa.large_string()))
        coded = chunks.flatten().dictionary_encode()
        place = self._look_up(coded.dictionary)[coded.indices.to_numpy()]
        size = np.diff(self.ends)[place]
        raw = self.flat[_spread(self.ends[place], size)].tobytes()
        cuts = (4 * np.append(0, np.cumsum(size))[chunks.offsets.to_numpy()]).tolist()
        if len(self.words) > self.limit:
            self._evict()
        return [raw[a:b] for a, b in zip(cuts, cuts[1:])]

    def encode(self, texts: list[str]) -> list[bytes]:
        out, plain, size = [b""] * len(texts), [], 0
        for k, text in enumerate(texts):
            if not text:
                continue
            if self._added and self._added.search(text) or not self._plain(text):
                out[k] = np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
                continue
            plain.append(k)
            size += len(text)
            if size > 1 << 21:
                self._fill(out, plain, texts)
                plain, size = [], 0
        self._fill(out, plain, texts)
        return out

    def _fill(self, out: list[bytes], places: list[int], texts: list[str]) -> None:
        for k, ids in zip(places, self._encode_plain([texts[k] for k in places]) if places else ()):
            out[k] = ids
