"""Nulls in any column, empty and very long texts, ties and repeated rows,
empty tables, extra columns with clashing names."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from starloom.llm import components, curriculum, exact_index, langid, license_scan, near_dups, order_minhash, packing, reply_trees, suffix_dedup, token_files
from starloom.llm.tokens import ChunkEncoder, tokenizer_path

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, n int, size string, shard int, slot int, kept int, score int"
WORDS = [f"w{i}" for i in range(400)]
LONG = " ".join(random.Random(1).choices(WORDS, k=30_000))
ROWS = [
    (1, "a b c d e f g"), (1, "a b c d e f g"), (2, "a b  c\td e f g"), (3, None), (4, ""), (5, " \n "), (None, None), (None, "a b c d e f g"),
    (None, "only here, without a name"), (None, "only here, without a name"), (6, LONG), (7, LONG + " end"), (8, "12 34 !!"), (9, "über straße ÉTÉ"),
    (10, "x" * 200), (11, "y" + "x" * 200), (12, "wort " * 300), (13, "漢字かな交じり文です" * 20), (14, "b\u0000c   d e \U0001F600" * 9),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(d, t, None if i % 3 == 0 else "en", [None, "b", "a"][i % 3], None, "k", 1, "s", 2, 3, 4, 5) for i, (d, t) in enumerate(ROWS)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def _norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def test_exact(docs, none):
    assert exact_index.exact_dedup(none).count() == 0
    for bits in (64, 3):  # with 3-bit keys nearly all texts collide and are told apart by their bytes
        got = sorted((r.text_sha256, r.doc_id is None, r.doc_id or 0, r.keep_id, r.group_size, r.kept)
                     for r in exact_index.exact_dedup(docs, bucket_keys=2, key_bits=bits).collect())
        groups = {}
        for d, t in ROWS:
            groups.setdefault(_norm(t), []).append(d)
        want = []
        for t, ds in groups.items():
            keep = min((d for d in ds if d is not None), default=None)
            want += [(hashlib.sha256(t.encode()).hexdigest(), d is None, d or 0, keep, len(ds), d == keep) for d in ds]
        assert got == sorted(want, key=lambda r: r[:3])


def test_directory_splits_overfull_buckets(spark):
    keys = spark.range(5000).select(F.xxhash64("id").alias("key"))
    slots, depth = exact_index.directory(keys, 100)
    placed = keys.withColumn("slot", F.expr(f"shiftrightunsigned(key, {64 - depth})")).join(slots, "slot")
    sizes = [r["count"] for r in placed.groupBy("depth", "bucket").count().collect()]
    assert sum(sizes) == 5000 and max(sizes) <= 100 and depth >= 6


def test_near(docs, none):
    assert near_dups.near_duplicates(none).count() == 0
    got = near_dups.near_duplicates(docs, words=4).collect()
    named = {d: t for d, t in ROWS if d is not None}
    want = {r[0]: r for r in brute.near(list(named.items()), 4, 80)}
    assert sorted(r.doc_id for r in got if r.doc_id is not None) == sorted(d for d, _ in ROWS if d is not None)
    for r in got:
        if r.doc_id is not None:
            assert (r.doc_id, r.n_shingles, r.component_id, r.kept) == want[r.doc_id]
    bare = sorted((r.n_shingles, r.component_id, r.kept) for r in got if r.doc_id is None and r.component_id is not None)
    assert bare == [(4, 1, False)]  # the copy of document 1


def test_near_group_whose_centre_does_not_reach_all(spark):
    """Documents drift apart step by step: neighbours are linked, ends are not."""
    rng, text, rows = random.Random(5), [f"t{i}" for i in range(300)], []
    for d in range(40):
        rows.append((d, " ".join(text)))
        for _ in range(5):
            text[rng.randrange(300)] = f"n{d}{rng.random()}"
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(tuple(r)[:4] for r in near_dups.near_duplicates(df, words=4).collect())
    assert got == brute.near(rows, 4, 80)


def test_components(spark):
    pairs = [(i, i + 1) for i in range(60)] + [(100, 70 + i) for i in range(9)] + [(5, 5)]
    got = dict(map(tuple, components.components(spark.createDataFrame(pairs, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(61)}, **{70 + i: 70 for i in range(9)}, 100: 70}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_mix(docs, none):
    assert curriculum.mix(none).count() == 0
    got = curriculum.mix(docs).collect()
    assert len(got) == len(ROWS)
    sizes = {}
    for i, (_, t) in enumerate(ROWS):
        s = [None, "b", "a"][i % 3]
        sizes[s] = sizes.get(s, 0) + len(brute.words(t))
    total, caps, weights = sum(sizes.values()), {s: 3 * n for s, n in sizes.items()}, {"a": 5, "b": 2, None: 1}
    goal, open_ = {}, set(sizes)
    while open_:
        left = total - sum(goal.values())
        share = {s: left * weights[s] / sum(weights[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] > caps[s]}
        goal.update({s: caps[s] for s in full} if full else share)
        open_ = open_ - full if full else set()
    for s in sizes:
        mine = [r for r in got if r.source == s]
        assert mine[0].source_size == sizes[s] and mine[0].target == pytest.approx(goal[s])
        assert sum(p["words"] for r in mine for p in r.passes) == pytest.approx(goal[s], abs=0.51)
        times = sorted((p["time"], p["words"]) for r in mine for p in r.passes)
        assert all(0 <= t <= 1 for t, _ in times)
    assert all(sum(p["words"] for p in r.passes) <= 3 * r.size for r in got)


def test_training_time_inverts_the_schedule(spark):
    knots = ((0.0, 1.0), (0.25, 3.0), (0.5, 0.0), (1.0, 2.0))
    area = [(b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:])]

    def used(t):
        out = 0.0
        for (t0, r0), (t1, r1) in zip(knots, knots[1:]):
            x = min(max(t - t0, 0), t1 - t0)
            out += r0 * x + (r1 - r0) / (t1 - t0) * x * x / 2
        return out / sum(area)

    df = spark.range(1, 100).select((F.col("id") / 100).alias("u"))
    for r in df.select("u", curriculum.training_time(F.col("u"), F.lit(0), (knots,)).alias("t")).collect():
        assert used(r.t) == pytest.approx(r.u, abs=1e-9)


def test_language(docs, none):
    model = langid.train(none)
    assert model.languages == [] and langid.identify(none, model, "doc_id").count() == 0
    assert {r.lang_pred for r in langid.identify(docs, model, "doc_id").collect()} == {"und"}
    one = langid.train(docs)
    got = {r.text: (r.lang_pred, r.score) for r in langid.identify(docs, one, "text", "score", "key", prefix="p_").select(
        "text", F.col("p_lang_pred").alias("lang_pred"), F.col("p_score").alias("score")).collect()}
    for t in (None, "", " \n ", "12 34 !!"):
        assert got[t] == ("und", 0.0)
    assert got[LONG][0] == "en"
    code = langid.codewords(12)
    assert min((a != b).sum() for i, a in enumerate(code) for b in code[:i]) >= 10


def test_repeats(docs, none):
    assert suffix_dedup.remove_repeats(none).count() == 0
    rows = [(d, t) for d, t in ROWS if d is not None]
    want = brute.repeats(sorted(set(rows), key=lambda r: r[0]), 50)
    for shard_bytes in (1 << 20, 300):
        got = suffix_dedup.remove_repeats(docs, shard_bytes=shard_bytes).collect()
        assert len(got) == len(ROWS)
        for r in got:
            if r.doc_id is not None:
                assert (r.n_bytes, r.n_removed, r.n_spans, r.kept) == want[r.doc_id]
    bare = [r for r in got if r.doc_id is None and r.n_bytes == 25]
    assert [r.n_removed for r in bare] == [0, 0]


def test_repeats_against_brute_force(spark):
    rng = random.Random(9)
    passages = ["".join(rng.choices("abcd é", k=rng.randrange(40, 160))) for _ in range(12)]
    rows = []
    for d in range(120):
        parts = [rng.choice(passages)[rng.randrange(20):] if rng.random() < 0.6 else "".join(rng.choices("abcd é", k=rng.randrange(90))) for _ in range(rng.randrange(6))]
        rows.append((d, "".join(parts)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = brute.repeats(rows, 50)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept) for r in suffix_dedup.remove_repeats(df, shard_bytes=2000).collect()}
    assert got == want


def test_repeats_at_hot_anchors(spark):
    """One passage in most documents between different neighbours: its anchors
    have more contexts than are merged in one place."""
    rng = random.Random(3)
    passage = "".join(rng.choices("abcdefgh é", k=120))
    side = lambda: "".join(rng.choices("abcdefgh é", k=rng.randrange(10, 70)))
    rows = [(d if d % 9 else None, side() + passage[rng.randrange(30):] + side() if d % 4 else side()) for d in range(1, 150)]
    named = [(d, t) for d, t in rows if d is not None]
    want = brute.repeats(named, 50)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for hot in (1, 20):
        got = suffix_dedup.remove_repeats(df, shard_bytes=2000, hot_contexts=hot).collect()
        assert len(got) == len(rows)
        assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept) for r in got if r.doc_id is not None} == want


def test_contexts_of_many_shards_share_transforms(monkeypatch):
    """However many shards an owner's contexts come from, their transforms are
    as many as their symbols need, and the rounds of the merge drop what is alone."""
    rng = random.Random(4)
    base = "".join(rng.choices("abc", k=3000)).encode()
    begin = [rng.randrange(2900) for _ in range(2000)]
    sizes = np.array([rng.randrange(50, 85) for _ in begin])
    texts = [bytearray(base[b:b + n]) for b, n in zip(begin, sizes)]
    for t in texts:
        t[rng.randrange(len(t))] = ord("x")
    named = np.array([rng.randrange(300) for _ in begin])
    rows = np.array([list(t.ljust(84, b"\0")) for t in texts], np.uint8)
    first = {}
    for t, d in zip(texts, named.tolist()):
        for i in range(len(t) - 49):
            s = bytes(t[i:i + 50])
            first[s] = min(first.get(s, d), d)
    want = [sum(1 << i for i in range(len(t) - 49) if first[bytes(t[i:i + 50])] < d) for t, d in zip(texts, named.tolist())]
    calls, plain = [], suffix_dedup.transform
    monkeypatch.setattr(suffix_dedup, "transform", lambda *a: (calls.append(1), plain(*a))[1])
    assert suffix_dedup.repeated(rows, sizes, named, 50).tolist() == want and sum(map(bool, want)) > 100
    assert len(calls) <= -(-sum(sizes + 1) // ((1 << 16) - 85))


def test_strings_of_hot_contexts(monkeypatch):
    """Each distinct string around an anchor once, with its least document, a
    bounded number at a time."""
    rng = random.Random(5)
    passage = "".join(rng.choices("abcdefgh", k=60))
    texts = ["".join(rng.choices("ab", k=rng.randrange(34))) + passage + "".join(rng.choices("ab", k=60)) for _ in range(60)]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    place = np.array([data.tobytes().find(passage.encode(), sum(map(len, texts[:i]))) + 9 for i in range(60)])
    least = np.array([rng.randrange(40) for _ in texts])
    lo, hi = place - np.array([rng.randrange(35) for _ in texts]), place + 50
    strings = [(c, i, data[a + i:a + i + 50].tobytes()) for c, (a, b, p) in enumerate(zip(lo, hi, place)) for i in range(max(0, p - a - 34), min(p - a, b - a - 50) + 1)]
    want = {}
    for c, _, s in strings:
        want[s] = min(want.get(s, 99), least[c])
    monkeypatch.setattr(suffix_dedup, "STRINGS", 200)
    parts = list(suffix_dedup.hot_strings(data, lo, hi, place, least, 50))
    got = {(c, i): first[e] for which, at, entry, _, _, first in parts for c, i, e in zip(which.tolist(), at.tolist(), entry.tolist())}
    assert got == {(c, i): want[s] for c, i, s in strings}
    assert sum(len(p[-1]) for p in parts) == len(want) < len(strings) and max(len(p[0]) for p in parts) < 260
    for *_, key, h, first in parts:
        assert (np.diff(key.astype(np.int64)) >= 0).all() and len(key) == len(h) == len(first)


def test_token_files(docs, none):
    assert token_files.read_documents(token_files.write_segments(none, "word_bpe_49k.json", 2)).count() == 0
    got = token_files.read_documents(token_files.write_segments(docs, "word_bpe_49k.json", 2, segment_tokens=64)).collect()
    order = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    assert [r.doc_id for r in sorted(got, key=lambda r: r.start)] == [d for d, _ in order]
    ends = sorted((r.start, r.start + r.n_tokens) for r in got)
    assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))


def test_letters_are_unicode_letters():
    """Numbers that look like letters (superscripts, fractions, circled and
    Roman numerals) are none."""
    from collections import Counter

    import numpy as np
    model = langid.Model(["de", "en"], np.random.default_rng(0).random((2, 1 << langid.GRAM_BITS)) * 9)
    for text in ("½ ² Ⅷ", "①② 12", "٣", "…!", "", None):
        assert model.predict(text)[0] == "und"
    for text in ("a", "½ é", "漢", "ª"):
        assert model.predict(text)[0] in ("de", "en")
    # piece borders change nothing: a text over 1 MiB against a plain count
    text = " ".join(random.Random(3).choices(["über", "a", "b-c", "日本", "X1"], k=300_000))
    raw = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in text.lower().encode())
    raw = b" " + re.sub(b" +", b" ", raw) + b" "
    assert len(raw) > 1 << 20
    want = Counter(raw[i:i + n] for n in (3, 4) for i in range(len(raw) - n + 1))
    number = lambda g: int.from_bytes(g, "big") * (2654435761 if len(g) == 3 else 2246822519) % (1 << 32) >> 32 - langid.GRAM_BITS
    hashed = Counter()
    for g, n in want.items():
        hashed[number(g)] += n
    got = sum(np.bincount(x, minlength=1 << langid.GRAM_BITS) for x in langid.grams(text))
    assert {i: n for i, n in enumerate(got.tolist()) if n} == dict(hashed)


def test_directly_addressable_codes():
    import numpy as np
    rng = np.random.default_rng(0)
    for n in (0, 1, 7, 512, 5000):
        for widths in ((8, 8, 16), (16, 16), (8, 8, 8, 8)):
            ids = (rng.integers(0, 1 << 32, n) >> rng.integers(0, 33, n)).astype(np.uint32)
            reader = token_files.IdReader(token_files.pack_ids(ids, widths))
            assert (reader.read(0, n) == ids).all()
            for i in rng.integers(0, n, 50) if n else []:
                assert reader.read(int(i), int(i) + 1)[0] == ids[i]


def test_chunk_encoder_equals_the_library():
    texts = [t or "" for _, t in ROWS] + ["a  b", "a \n b", " lead", "trail ", "a\n\nb", "it's don't I'LL", "tab\tx", "<|endoftext|> x", "x<|endoftext|>", "<|EndOfText|>", "é́ ﬁ İ Σ", "(a) \"b\" --c", "x ,y . z", "«a», b", "½ ² ①", "a-1b 12 345", "…", "\u00a0a", "ǅ ŉ", "a.b,c!!d", "x_1 y__", "'", "a 's b"]
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        import numpy as np
        from tokenizers import Tokenizer
        # the library as it comes, with the strings that are tokens of their own
        library = Tokenizer.from_file(tokenizer_path(name))
        want = [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
        for size in (1, 20, 1 << 19):  # caches that turn over at once, and one that never does
            e = ChunkEncoder(name, cache_chunks=size)
            assert e.encode(texts) == want and e.encode(texts[::-1]) == want[::-1]
            assert e.encode(["", *texts[:1]]) == [b"", want[0]] and e.encode([]) == []
            assert (e.turns > 0) == (size < 1 << 19)
        assert len(library.encode("<|endoftext|> x", add_special_tokens=False).ids) == 2


def test_packing(docs, none):
    assert packing.pack(none, "byte_bpe_50k.json", 0).count() == 0
    got = packing.pack(docs, "byte_bpe_50k.json", 0, shard_docs=5).collect()
    of = {}
    for r in got:
        of.setdefault(r.sequence_id, []).append((r.offset, r.length))
    sizes = []
    for parts in of.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:]))
        sizes.append(sum(n for _, n in parts))
    assert all(n == 1024 or n & (n - 1) == 0 for n in sizes)
    e = ChunkEncoder("byte_bpe_50k.json")
    assert sum(sizes) == sum(len(x) // 4 + 1 for x in e.encode([t or "" for _, t in ROWS]))


def test_packing_finds_neighbours_of_the_whole_table(spark):
    """64 topics of 4 documents in shards of 32: by content, most pieces of a
    sequence are of one topic; by a random draw, few."""
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(2000)]
    rows = []
    for topic in range(64):
        base = rng.sample(words, 80)
        rows += [(topic * 4 + k, " ".join(rng.choice(words) if rng.random() < 0.1 else w for w in base)) for k in range(4)]
    rng.shuffle(rows)
    got = packing.pack(spark.createDataFrame(rows, "doc_id bigint, text string"), "byte_bpe_50k.json", 0, shard_docs=32).collect()
    of = {}
    for r in got:
        of.setdefault(r.sequence_id, set()).add(r.doc_id)
    same = [a // 4 == b // 4 for ds in of.values() for a in ds for b in ds if a < b]
    assert sum(same) / len(same) > 0.4


def test_bm25_scores_of_open_documents_stay_as_postings_are_dropped():
    rng = np.random.default_rng(5)
    docs = [np.append(rng.integers(0, 400, n), 0).astype("<u4") for n in [0, *rng.integers(1, 300, 79)]]
    whole, index, left = packing.Bm25Index(docs), packing.Bm25Index(docs), np.ones(len(docs), bool)
    for i in rng.permutation(len(docs))[:70].tolist():
        left[i] = False
        index.close(left)
        seed = int(np.flatnonzero(left)[0])
        assert (index.scores(seed)[left] == whole.scores(seed)[left]).all()
    assert len(index.doc) < len(whole.doc) / 4


def test_packing_computes_a_dealing_key_once(spark):
    """Ranges are told from some keys before all rows are dealt: a range
    exchange would run the step before it over all rows to sample them."""
    rows = spark.createDataFrame([(i, f"text {i % 50} of {i}") for i in range(400)], "doc_id bigint, text string")
    got = packing.pack(rows, "byte_bpe_50k.json", 0, shard_docs=40)
    assert "rangepartitioning" not in got._jdf.queryExecution().toString().lower()
    of = {}
    for r in got.collect():
        of.setdefault(r.sequence_id >> 32, set()).add(r.doc_id)
    # equal shares of the documents, each in one range
    assert sum(map(len, of.values())) == 400 == len(set().union(*of.values()))
    assert len(of) > 1 and max(map(len, of.values())) < 3 * 400 / len(of)


def test_chunk_encoder_names_every_letter():
    from tokenizers import Tokenizer
    letters = [chr(c) for c in range(0x250) if chr(c).isalpha()]
    texts = ["".join(letters), " ".join(letters), *(f"a{c}{c} {c}b x{c},{c}" for c in letters)]
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        library, e = Tokenizer.from_file(tokenizer_path(name)), ChunkEncoder(name)
        assert e.encode(texts) == [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_packing_counts_terms_over_all_documents(spark, monkeypatch):
    """Rarity is that of the whole table, not of some of its documents."""
    seen, counts = [], packing._document_counts
    monkeypatch.setattr(packing, "_document_counts", lambda *a: seen.append(counts(*a)) or seen[-1])
    texts = [f"word{i % 7} and {'rare ' * (i == 4321)}{i}" for i in range(5000)] + [None, ""]
    rows = spark.createDataFrame([(i % 4000, t) for i, t in enumerate(texts)], "doc_id bigint, text string").repartition(3)
    assert packing.pack(rows, "byte_bpe_50k.json", 0).agg({"length": "sum"}).first()[0] > 5000
    e = ChunkEncoder("byte_bpe_50k.json")
    want = np.zeros(e.library.get_vocab_size(), np.int64)
    for x in e.encode([t or "" for t in texts]):
        want[np.unique(np.frombuffer(x, "<u4"))] += 1
    (df, n), = seen
    assert n == 5002 and (df == want).all()


def test_licenses(spark, docs, none):
    assert license_scan.scan(none).count() == 0 and license_scan.scan(docs).count() == 0
    mit = license_scan.TEMPLATES["MIT"]
    words = mit.split()
    half = " ".join(words[:len(words) // 2])
    edited = " ".join("changed" if i in (20, 60) else w for i, w in enumerate(words))
    rows = [(1, "junk " * 40 + mit.upper()), (2, half), (None, edited), (3, LONG + " Released under\nthe MIT License! " + LONG), (3, None), (4, "released under the MIT")]
    got = sorted((r.doc_id or 0, r.license_id) for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(0, "MIT"), (1, "MIT"), (3, "MIT-notice")]


def test_license_bands_are_independent(spark):
    """Windows that share three of four shingles miss all four bands about as
    often as four independent draws do: 0.4 ** 4."""
    draws = spark.range(20_000).select(*[F.xxhash64("id", F.lit(k)).alias(f"s{k}") for k in range(5)])
    a, b = (license_scan.band_keys(F.array(*names), license_scan.LONG, 1) for names in (["s0", "s1", "s2", "s3"], ["s1", "s2", "s3", "s4"]))
    bands = license_scan.LONG[2]
    same = [F.get(a, F.lit(k)) == F.get(b, F.lit(k)) for k in range(bands)]  # one window each
    any_same = same[0]
    for s in same[1:]:
        any_same = any_same | s
    got = draws.select(*[F.avg(s.cast("int")).alias(f"b{k}") for k, s in enumerate(same)], F.avg(any_same.cast("int")).alias("found")).first()
    assert all(abs(got[f"b{k}"] - 0.6) < 0.02 for k in range(bands)) and abs(got.found - (1 - 0.4**4)) < 0.01


def test_order_minhash(spark, docs, none):
    fp = order_minhash.fingerprint(F.col("text"))
    assert none.select(fp).count() == 0
    got = [(r.text, r.fp) for r in docs.select("text", fp.alias("fp")).collect()]
    assert all(len(f) == (0 if not (t or "").strip() else len(f)) and len(f) <= 64 for t, f in got)
    a, b = "one two three four five six seven".split(), [f"v{i}" for i in range(300)]
    texts = [" ".join(a + b), " ".join(b + a), " ".join(a + b), " ".join(b[::-1]), " ".join(b + b)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").withColumn("fp", fp)
    one = df.select(F.col("i").alias("x"), F.col("fp").alias("p")).join(df.select(F.col("i").alias("y"), F.col("fp").alias("q")))
    like = {(r.x, r.y): r.s for r in one.select("x", "y", order_minhash.likeness(F.col("p"), F.col("q")).alias("s")).collect()}
    assert like[0, 2] == 1.0 and 0.7 < like[0, 1] < 1.0 and like[0, 3] < 0.1 and like[1, 4] < 0.9


def test_next_row(spark, docs):
    rows = [(d, f"t{d}-{i}") for i, d in enumerate([5, 3, None, 9, 9, 1, None, 100000, -7])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = order_minhash.with_next(df, "doc_id", "text").where("is_ghost = 0").collect()
    nxt = {r.text: r.next_text for r in got}
    assert len(nxt) == len(rows) and sorted(nxt.values()) == sorted(t for _, t in rows)  # one round through all
    chain, at = [], "t100000-7"
    for _ in rows:
        chain.append(at)
        at = nxt[at]
    ids = [re.match(r"t(.*?)-\d+$", t)[1] for t in chain]
    assert at == "t100000-7" and ids == ["100000", "9", "9", "5", "3", "1", "-7", "None", "None"]
    assert order_minhash.with_next(df.limit(0), "doc_id", "text").count() == 0


TALK = ["</s>[INST] ok [/INST]", "", None, "[\\INST] <\\\\/s> <<SYS>><s<s>>", "a\\[INST]\\", "<<ROLE>>x<</ROLE>>", "<s><<SYS>> hi <</SYS>></s>", "plain\n\ntext é\U0001F600", "[[INST]]<<s>", "<<\\SYS>>"]


def test_reply_trees(spark):
    rng, rows, want = random.Random(2), [], {}
    for c in [1, 2, 3, None]:
        turns = [(rng.choice(["user", "assistant", "system", "tool<s>", "", None]), rng.choice(TALK)) for _ in range(7)]
        want[c] = [(r or "", t or "") for r, t in turns]
        rows += [(c, i, i - 1 if i else None, r, t, 0.0) for i, (r, t) in enumerate(turns)]
    schema = "tree long, node long, parent long, role string, text string, score double"
    made = reply_trees.conversations(spark.createDataFrame(rows, schema))
    got = made.select("tree", "formatted", "loss", reply_trees.read_turns(F.col("formatted")).alias("read"),
                      reply_trees.loss_text(F.col("formatted"), F.col("loss")).alias("masked")).collect()
    assert {r.tree: [tuple(t) for t in r.read] for r in got} == want
    for r in got:
        assert r.masked == "".join(t for role, t in want[r.tree] if role == "assistant")
        for s in r.loss:
            inside = r.formatted[s["start"]:s["start"] + s["length"]]
            assert not any(c in inside for c in reply_trees.CONTROLS)


def test_reply_branches(spark):
    schema = "tree long, node long, parent long, role string, text string, score double"
    rows = [(1, 0, None, "user", "q", 0.0), (1, 1, 0, "assistant", "bad", -1.0), (1, 2, 0, "assistant", "good", 2.0), (1, 3, 2, "user", "more", 0.0),
            (1, 4, 1, "user", "end", None), (1, 0, None, "user", "q", 0.0), (2, 9, 77, "user", "lost parent", 0.0)]
    df = spark.createDataFrame(rows, schema)
    best = {r.tree: [t.text for t in r.read] for r in reply_trees.conversations(df).select("tree", reply_trees.read_turns(F.col("formatted")).alias("read")).collect()}
    assert best == {1: ["q", "good", "more"], 2: ["lost parent"]}
    both = reply_trees.conversations(df, branches=2)
    assert sorted((r.tree, r.leaf) for r in both.collect()) == [(1, 3), (1, 4), (2, 9)]
    assert reply_trees.conversations(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        reply_trees.conversations(spark.createDataFrame([(1, 1, 2, "user", "a", 0.0), (1, 2, 1, "user", "b", 0.0)], schema)).count()
