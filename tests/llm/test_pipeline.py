"""The pipeline's stages against plain versions, and their edge cases."""

import re

import pytest

import brute
import corpus_pipeline
from starloom.llm import langid
from test_queries import _ids, check_pieces

SMALL = "/root/testdata/sf0.001"


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def stages(spark):
    out, docs = {}, spark.read.parquet(f"{SMALL}/documents.parquet")
    out["documents"] = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL).cache()
        assert docs.columns == out["documents"].columns
        out[name] = docs
    return out


def test_language_keeps_clean_documents(spark, stages):
    before, after = stages["documents"].collect(), stages["language ID"].collect()
    model = langid.train(stages["documents"])
    want = [r for r in before for lang, _, open_ in [model.predict(r.text)] if lang != "und" and not open_]
    assert sorted(after) == sorted(want) and len(after) >= 0.97 * len(before)


def test_exact_keeps_the_smallest_id(stages):
    first = {}
    for r in sorted(stages["language ID"].collect(), key=lambda r: r.doc_id):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r.text), r)
    assert sorted(stages["exact dedup"].collect()) == sorted(first.values())


def test_near_keeps_one_of_each_component(stages):
    rows = stages["exact dedup"].collect()
    kept = {d for d, _, _, kept in brute.near([(r.doc_id, r.text) for r in rows], 5, 80) if kept}
    assert sorted(stages["near-dedup"].collect()) == sorted(r for r in rows if r.doc_id in kept)


def test_mix_and_pack(spark, stages):
    mixed = stages["mixing"].collect()
    size = {}
    for r in stages["near-dedup"].collect():
        size[r.source] = size.get(r.source, 0) + len(brute.words(r.text))
    taken, times = {}, {}
    for r in mixed:
        taken[r.source] = taken.get(r.source, 0) + len(brute.words(r.text))
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    assert max(times.values()) <= 3
    # words taken are within half of a document of the target, and all together near all words
    assert abs(sum(taken.values()) - sum(size.values())) < 0.1 * sum(size.values())
    pieces = corpus_pipeline.STAGES[-1][1](spark, stages["mixing"], SMALL).collect()
    assert sum(r.length for r in pieces) == sum(len(x) for x in _ids("byte_bpe_50k.json", [r.text or "" for r in mixed], 0))


def test_run(spark):
    assert corpus_pipeline.run(spark, SMALL).count() > 100 and corpus_pipeline.ORACLE_SQL is None


def test_edges(spark):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, score int, n int, key string, passes int"
    text = "the cat sat on the mat and then it went home to eat some more fish"
    rows = [(1, text, "en", "s", 1, 1, 1, "k", 1), (1, text, "en", "s", 1, 1, 1, "k", 1), (2, text.replace(" ", "  "), "en", None, 1, 1, 1, "k", 1),
            (None, None, None, None, None, None, None, None, None), (None, text + " x", "en", "s", 1, 1, 1, "k", 1), (None, text + " x", "en", "s", 1, 1, 1, "k", 1),
            (3, "", "en", "s", 1, 1, 1, "k", 1), (4, "el gato come pescado en la casa de la abuela", "es", "t", 1, 1, 1, "k", 1)]
    df = spark.createDataFrame(rows, schema)
    lang, exact, near, mix, pack = (f for _, f in corpus_pipeline.STAGES)
    assert {r.doc_id for r in lang(spark, df, SMALL).collect()} <= {1, 2, 4, None}
    kept = exact(spark, df, SMALL)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) + str(r.text is None) for r in kept.collect()) == ["1False", "3False", "4False", "NoneFalse"]
    assert sorted(str(r.doc_id) for r in near(spark, df, SMALL).collect()) == ["1", "1", "3", "4", "None", "None", "None"]
    assert mix(spark, df, SMALL).columns == df.columns
    assert sum(r.text is None for r in mix(spark, df, SMALL).collect()) == 0
    assert pack(spark, df, SMALL).count() >= len(rows)
    for stage in (lang, exact, near, mix, pack):
        assert stage(spark, df.limit(0), SMALL).count() == 0
