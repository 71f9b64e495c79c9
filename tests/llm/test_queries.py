"""The registered queries over whole tables: against SQL where it exists, else
against a plain version, an exact round trip or held-out accuracy."""

import hashlib
import zlib

import duckdb
import numpy as np
import pandas as pd
import pytest

import brute

from starloom.llm.queries import ORACLE, QUERIES
from tools.oracle_check import TABLES, digest

SF_SMALL, SF_CHECK = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_CHECK}/{t}.parquet')")
    return c


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").collect()}


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_sql(spark, con, key):
    got = QUERIES[key](spark, SF_CHECK)
    got = pd.DataFrame.from_records([tuple(r) for r in got.collect()], columns=got.columns)
    want = con.execute(ORACLE[key]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert digest(got)[0] == digest(want)[0]


def test_order_minhash(spark, docs):
    got = {r.doc_id: r for r in QUERIES["op1_order_minhash"](spark, SF_CHECK).collect()}
    ids = sorted(docs, reverse=True)
    same = {}
    for d, nxt in zip(ids, ids[1:] + ids[:1]):
        t, n, r = docs[d].text or "", docs[nxt].text or "", got[d]
        cut = len(t) // 3
        assert r.n_chars == len(t)
        assert r.edited_sha256 == hashlib.sha256((t[:len(t) - cut] + n[:cut]).encode()).hexdigest()
        assert same.setdefault(t, r.fingerprint) == r.fingerprint
    near = np.array([(r.near_edited, r.near_next) for r in got.values() if r.n_chars > 300])
    assert (near[:, 0] > near[:, 1]).mean() > 0.99 and near.min() >= 0 and near.max() <= 1


def test_tensored_minhash(spark, docs):
    got = QUERIES["op3_tensored_minhash"](spark, SF_CHECK).collect()
    assert sorted(map(tuple, got)) == brute.near([(d, r.text) for d, r in docs.items()], 4, 80)


def test_language_codes(spark, docs):
    got = QUERIES["op5_language_codes"](spark, SF_CHECK).collect()
    assert {r.doc_id: r.held_out for r in got} == {d: brute.crc(d) % 5 == 0 for d in docs}
    held = [r for r in got if r.held_out]
    assert np.mean([r.lang_pred == docs[r.doc_id].lang for r in held]) > 0.97


def test_suffix_merge(spark, docs):
    want = brute.repeats([(d, r.text) for d, r in docs.items()], 50)
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op6_suffix_merge"](spark, SF_CHECK).collect()}
    assert got == {d: (n, gone, spans, hashlib.sha256(kept).hexdigest()) for d, (n, gone, spans, kept) in want.items()}


def _ids(name, texts, end):
    import public_tokenizers
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(public_tokenizers.path(name))
    return [np.array([*x.ids, end], "<u4") for x in library.encode_batch(texts, add_special_tokens=False)]


def test_token_files(spark, docs):
    got = {r.doc_id: r for r in QUERIES["op8_token_files"](spark, SF_CHECK).collect()}
    ids, start = sorted(docs), 0
    for d, x in zip(ids, _ids("word_bpe_49k.json", [docs[d].text or "" for d in ids], 2)):
        assert (got[d].start, got[d].n_tokens, got[d].ids_crc32) == (start, len(x), zlib.crc32(x.tobytes()))
        start += len(x)


def check_pieces(rows, ids):
    """Every id in one piece, sequences gapless and at most 1024 long; returns the padding."""
    of_doc, of_sequence = {}, {}
    for r in rows:
        x = ids[r.doc_id][r.start:r.start + r.length]
        assert len(x) == r.length and zlib.crc32(x.tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
        of_doc.setdefault(r.doc_id, []).append((r.start, r.length))
        of_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in [*of_doc.values(), *of_sequence.values()]:
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:]))
    assert {d: sum(n for _, n in p) for d, p in of_doc.items()} == {d: len(x) for d, x in ids.items()}
    sizes = [sum(n for _, n in p) for p in of_sequence.values()]
    assert max(sizes) <= 1024
    return sum(1024 - n for n in sizes if n & (n - 1))


def test_lexical_packing(spark, docs):
    ids = dict(zip(docs, _ids("byte_bpe_50k.json", [r.text or "" for r in docs.values()], 0)))
    assert check_pieces(QUERIES["op9_lexical_packing"](spark, SF_CHECK).collect(), ids) == 0


def test_small_tables_run(spark):
    for key, query in QUERIES.items():
        if key != "pipeline":
            assert query(spark, SF_SMALL).limit(1).collect()
