"""Main text of web pages, with boilerplate found by a suffix array per host.

A host's pages are laid end to end as token streams (words and block starts)
and sorted by suffix.  A string of ``LENGTH`` tokens that starts on two or more
distinct pages is repeated; overlapping ones make the long repeats.  Blocks that
repeats cover are boilerplate, what is unique stays.

Every page is in its stream as a whole, so what an article says counts on the
host's other pages too.  The article itself stays whole: repeated elsewhere it is
a copy, not boilerplate.  A page without one holds its text among what the site
says on every page, and only repeats tell them apart.  Markup that never holds
main text (menus, forms, notices …) settles what repeats cannot, such as a host's
only page.

A host of any size is cut into pieces of bounded size, each with a suffix array
of its own.  A piece settles the hosts that lie in it whole; of its first and last
host, which may go on in other pieces, it gives each distinct string once, with
its pages, packed for the owners of ranges of hashes; these sum the counts of all
pieces by host and string.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.html_blocks import Block, blocks, main_level
from starloom.llm.suffix_dedup import _from_planes, _planes
from starloom.session import scratch_path

#: Tokens of a repeat (a power of two), distinct pages it needs, tokens of a piece
#: (told from its characters, about so many to a token).
LENGTH, PAGES, PIECE = 8, 2, 1 << 18
_CHARS = 6
#: Share of a block's words that repeats must cover; share of the words of a main
#: part (or unmarked page) beyond which its repeats are the page's own text, copied.
COVERED, COPIED = 2 / 3, 0.5
#: Strings of an owner, where there are many.
OWNED = 1 << 21

def host(url: Column) -> Column:
    """Lower-case host of a URL, '' where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _named(pages: DataFrame) -> DataFrame:
    """Pages with their name: two rows with the same are the same page."""
    return pages.select("page_id", "url", "html").withColumn("_id", F.coalesce(F.col("page_id").cast("bigint"), F.lit(0).cast("bigint"))).withColumn("_mark", F.xxhash64("page_id", "url", "html"))


def stream(found: list[Block]) -> tuple[np.ndarray, np.ndarray]:
    """Token numbers of a page's stream, all its blocks, and the block of each
    (-1 - block for the token that starts it)."""
    tokens: list[int] = []
    of: list[int] = []
    for k, b in enumerate(found):
        words = b.text.split()
        tokens.append(zlib.crc32(b"<" + b.tag.encode()))
        tokens += [zlib.crc32(w.encode("utf-8", "replace")) for w in words]
        of += [-1 - k, *[k] * len(words)]
    return np.array(tokens, "<u4"), np.array(of, np.int64)


def _pieces(pages: DataFrame, size_of: int) -> DataFrame:
    """Pages in order of host and name, one row per piece, in a bucketed table:
    a join on the piece moves no page.  Rows of one page lie in a piece once."""
    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size, kinds = TaskContext.get().partitionId() << 32, [], 0, [pa.int64()] * 3

        def piece() -> pa.RecordBatch:
            cols = [pa.array([list(c)], pa.list_(k)) for c, k in zip(zip(*held), [*kinds, pa.int32()])]
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *cols], ["piece", "hosts", "ids", "marks", "page_ids", "urls", "html", "times"])

        for batch in batches:
            kinds = [f.type for f in batch.schema]
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and tuple(held[-1][:-1]) == row:
                    held[-1][-1] += 1  # the same page again
                    continue
                if size >= size_of:
                    yield piece()
                    number, held, size = number + 1, [], 0
                held.append([*row, 1])
                size += len(row[-1] or "") // _CHARS + 1
        if held:
            yield piece()

    spark, order = pages.sparkSession, ["host", "_id", "_mark"]
    rows = _named(pages).select(F.xxhash64(host(F.col("url"))).alias("host"), "_id", "_mark", "page_id", "url", "html")
    kind = dict(rows.dtypes)["page_id"]
    laid = rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        lay, "piece bigint, hosts array<bigint>, ids array<bigint>, marks array<bigint>, "
             f"page_ids array<{kind}>, urls array<string>, html array<string>, times array<int>")
    path = scratch_path(spark, "html-pieces")
    name, buckets = "llm_" + path.rsplit("-", 1)[-1], int(spark.conf.get("spark.sql.shuffle.partitions"))
    laid.write.option("compression", "zstd").option("path", path).bucketBy(buckets, "piece").saveAsTable(name)
    pieces = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the frame has its files
    return pieces


def suffix_ranks(tokens: np.ndarray, hosts: np.ndarray, length: int) -> np.ndarray:
    """Rank of the suffix at every place by its first ``length`` tokens, within
    its host: prefix doubling, equal strings get equal ranks."""
    rank = np.unique(hosts.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ tokens.astype(np.uint64), return_inverse=True)[1]
    step = 1
    while step < length:
        after = np.append(rank[step:], np.full(min(step, len(rank)), -1))
        rank = np.unique(rank.astype(np.int64) * (len(rank) + 1) + after + 1, return_inverse=True)[1]
        step *= 2
    return rank


class _Piece:
    """Blocks and streams of one piece's pages; its strings: where they start,
    their names, their pages."""

    def __init__(self, hosts: list[int], html: list[str | None]):
        self.found = [blocks(x or "") for x in html]
        streams, self.of = zip(*(stream(x) for x in self.found))
        tokens, size = np.concatenate(streams), np.array([len(x) for x in streams])
        self.ends = ends = np.cumsum(size)
        page = np.repeat(np.arange(len(ends)), size)
        host_of = np.array(hosts, np.int64)[page]
        self.starts = np.flatnonzero(np.arange(len(tokens)) + LENGTH <= ends[page])
        rank = suffix_ranks(tokens, host_of, LENGTH)[self.starts]
        # the suffix array: places by rank, then page
        array = np.lexsort((page[self.starts], rank))
        r, p = rank[array], page[self.starts][array]
        new_string = np.append(True, r[1:] != r[:-1])[:len(r)]
        new_page = new_string | np.append(True, p[1:] != p[:-1])[:len(r)]
        first = array[new_string]
        self.interval = np.empty(len(array), np.int64)
        self.interval[array] = np.cumsum(new_string) - 1
        self.pages = np.add.reduceat(new_page.astype(np.int64), np.flatnonzero(new_string)) if len(r) else np.zeros(0, np.int64)
        at = self.starts[first]
        name = host_of[at].astype(np.uint64)
        for k in range(LENGTH):
            name = (name ^ tokens[at + k]) * np.uint64(0x9E3779B97F4A7C15)
            name ^= name >> np.uint64(29)
        self.names, self.hosts, self.total = name.astype(np.int64), host_of[at], len(tokens)

    def asked(self, hosts: list[int], owners: int) -> Iterator[tuple[int, int, np.ndarray]]:
        """(host, owner, strings in order of name) of the first and last host:
        the others lie in this piece whole."""
        names = self.names.view(np.uint64)
        edges = np.array([-(-(o << 64) // owners) for o in range(owners)], np.uint64)
        for host in dict.fromkeys([hosts[0], hosts[-1]]):
            own = np.flatnonzero(self.hosts == host)
            own = own[np.argsort(names[own], kind="stable")]
            cut = [*np.searchsorted(names[own], edges).tolist(), len(own)]
            yield from ((host, o, own[a:b]) for o, (a, b) in enumerate(zip(cut, cut[1:])) if b > a)

    def covered(self, often: np.ndarray) -> list[np.ndarray]:
        """For each page, whether a token lies in a string that is ``often`` or
        repeats within the piece."""
        hit = self.starts[((self.pages >= PAGES) | often)[self.interval]]
        edge = np.zeros(self.total + 1, np.int64)
        np.add.at(edge, hit, 1)
        np.add.at(edge, hit + LENGTH, -1)
        return np.split(np.cumsum(edge)[:-1] > 0, self.ends[:-1])


def _settle(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """For each row one bit per string: whether all its pieces have it on PAGES pages."""
    names = [_from_planes(x) for x in table.column("names").to_pylist()]
    sizes = [len(x) for x in names]
    name, pages = np.concatenate(names), np.frombuffer(b"".join(table.column("pages").to_pylist()), np.uint8)
    host = np.repeat(table.column("host").to_numpy(), sizes)
    order = np.lexsort((name, host))
    n, h = name[order], host[order]
    cuts = np.flatnonzero(np.concatenate(([True], (n[1:] != n[:-1]) | (h[1:] != h[:-1]))))
    often = np.empty(len(order), bool)
    often[order] = np.repeat(np.add.reduceat(pages[order].astype(np.int64), cuts) >= PAGES, np.diff(np.append(cuts, len(order))))
    return pa.table({"piece": table.column("piece"), "host": table.column("host"), "owner": table.column("owner"),
                     "often": pa.array([np.packbits(x).tobytes() for x in np.split(often, np.cumsum(sizes)[:-1])], pa.binary())})


def _judged(pages: DataFrame, piece: int, read: Callable[[_Piece, list[np.ndarray], dict], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """What ``read`` makes of each piece, the tokens of its pages that repeats
    cover, and the columns of its row."""
    pieces = _pieces(pages, piece)
    owners = max(int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-pieces.count() * piece // OWNED))

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield batch.slice(k, 1).to_pylist()[0] | {"types": {f.name: f.type for f in batch.schema}}

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            p = _Piece(row["hosts"], row["html"])
            asked = list(p.asked(row["hosts"], owners))
            of, to, which = ([x[k] for x in asked] for k in range(3))
            cols = [pa.array(to, pa.int32()), pa.array([row["piece"]] * len(to), pa.int64()), pa.array(of, pa.int64()),
                    pa.array([_planes(p.names[w]) for w in which], pa.binary()),
                    pa.array([np.minimum(p.pages[w], PAGES).astype(np.uint8).tobytes() for w in which], pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, ["owner", "piece", "host", "names", "pages"])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            p = _Piece(row["hosts"], row["html"])
            bits, often = {(t["host"], t["owner"]): t["often"] for t in row["told"] or []}, np.zeros(len(p.names), bool)
            for of, to, which in p.asked(row["hosts"], owners):
                often[which] = np.unpackbits(np.frombuffer(bits[of, to], np.uint8), count=len(which)).astype(bool)
            yield from read(p, p.covered(often), row)

    # a string is told at most once for each piece of its host
    told = pieces.select("piece", "hosts", "html").mapInArrow(strings, "owner int, piece bigint, host bigint, names binary, pages binary")
    told = told.repartition(owners, "owner").groupBy("owner").applyInArrow(_settle, "piece bigint, host bigint, owner int, often binary")
    told = told.groupBy("piece").agg(F.collect_list(F.struct("host", "owner", "often")).alias("told"))
    return pieces.join(told, "piece", "left").mapInArrow(judge, schema)


def repeats(pages: DataFrame, piece: int = PIECE) -> DataFrame:
    """(_r_id, _r_mark, repeats): for every page with a stream, one bit for
    each of its tokens, set where a repeat covers it."""
    def read(p: _Piece, held: list[np.ndarray], row: dict) -> Iterator[pa.RecordBatch]:
        out = [(i, m, np.packbits(x).tobytes()) for i, m, x in zip(row["ids"], row["marks"], held) if len(x)]
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.binary()))], ["_r_id", "_r_mark", "repeats"])

    return _judged(pages, piece, read, "_r_id bigint, _r_mark bigint, repeats binary")


def keep(found: list[Block], of: np.ndarray, held: np.ndarray) -> tuple[list[str], int, int]:
    """(texts that stay, words dropped as repeats, words dropped by markup) of a
    page's blocks, the block of each token and whether a repeat covers it."""
    words, hit = (np.bincount(of[(of >= 0) & mask], minlength=len(found)) for mask in (np.ones(len(of), bool), held))
    repeated = (words > 0) & (hit >= COVERED * words)
    level = main_level(found)
    plain = np.array([b.level == level and not b.junk for b in found], bool)
    if level == 2 or (words * plain * repeated).sum() > COPIED * (words * plain).sum():
        repeated &= ~plain
    out, by_repeat, by_markup = [], 0, 0
    for k, b in enumerate(found):
        if repeated[k]:
            by_repeat += int(words[k])
        elif b.junk or b.level < level:
            by_markup += int(words[k])
        elif b.text:
            out.append(b.text)
    return out, by_repeat, by_markup


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars, repeated_words, markup_words), one row for
    each row of ``pages`` (page_id, url, html; other columns ignored).

    ``text``: the blocks of the page's main part in page order, joined by two
    newlines, '' if there is none (null html has none).  On a page with text in
    an article that is its text; on others all blocks (of the main part, if that
    has text) that neither repeats nor markup rule out, unless repeats would rule
    out most of it: then the page is a copy and keeps them.  The last two columns
    count the words that repeats and markup dropped.  Pages without a URL are
    one host; rows with equal page_id, url and html are one page, each gets its
    row.  Strings are told apart across pieces by a 64-bit hash."""
    kind = dict(pages.dtypes)["page_id"]

    def read(p: _Piece, held: list[np.ndarray], row: dict) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "url", "text", "n_chars", "repeated_words", "markup_words"]
        types = [row["types"]["page_ids"].value_type, pa.string(), pa.string(), *[pa.int64()] * 3]
        got = ((*x[:2], "\n\n".join(t), r, m, x[2]) for x in zip(row["page_ids"], row["urls"], row["times"], map(keep, p.found, p.of, held)) for t, r, m in [x[3]])
        out = ((i, u, t, len(t), r, m) for i, u, t, r, m, n in got for _ in range(n))
        while part := list(islice(out, 256)):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part), types)], names)

    return _judged(pages, PIECE, read, f"page_id {kind}, url string, text string, n_chars bigint, repeated_words bigint, markup_words bigint")
