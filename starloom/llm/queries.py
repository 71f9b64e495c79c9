"""Queries of this package: each applies its operator, with production
parameters, to the whole table.  ``ORACLE`` holds the SQL where it exists."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from starloom.llm import collocations, curriculum, divergence, exact_index, host_boilerplate, langid, license_scan, near_dups, order_minhash, packing, reply_trees, suffix_dedup, token_files
from starloom.llm.common import documents

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql:
            ORACLE[key] = sql
        return fn
    return deco


@query("op8_token_files")
def op8_token_files(spark, sf_dir):
    """Ids of every document, written as directly addressable codes in order
    of doc_id and read back."""
    return token_files.read_documents(token_files.write_segments(documents(spark, sf_dir), "word_bpe_49k.json", end_id=2))


@query("op9_lexical_packing")
def op9_lexical_packing(spark, sf_dir):
    """All documents packed into sequences of at most 1024 ids."""
    return packing.pack(documents(spark, sf_dir), "byte_bpe_50k.json", end_id=0)


_WORD = r"[^\x20\x09-\x0D]+"


@query("op4_curriculum_mix", rf"""
WITH d AS (SELECT doc_id, source, CAST(length(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][CAST(rank % 3 AS INT) + 1] AS weight, 3 * source_size AS cap FROM s),
r AS (SELECT *, cap / weight AS ratio,
             (sum(source_size) OVER () - sum(cap) OVER (ORDER BY cap / weight, rank) + cap)
             / (sum(weight) OVER () - sum(weight) OVER (ORDER BY cap / weight, rank) + weight) AS level FROM w),
l AS (SELECT arg_min(level, ratio) FILTER (WHERE ratio > level) AS level FROM r),
t AS (SELECT r.source, rank, source_size, least(CAST(cap AS DOUBLE), coalesce(weight * l.level, CAST(cap AS DOUBLE))) AS target FROM r, l),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target, t.rank, CAST(floor(t.target + 0.5) AS BIGINT) AS goal,
             sum(d.size) OVER (PARTITION BY d.source ORDER BY md5(coalesce(CAST(d.doc_id AS VARCHAR), '')), d.doc_id, d.size
                               ROWS UNBOUNDED PRECEDING) - d.size AS start
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, round(target, 6) AS target,
       CAST(least(size, greatest(goal - start, 0)) + least(size, greatest(goal - start - source_size, 0))
            + least(size, greatest(goal - start - 2 * source_size, 0)) AS BIGINT) AS taken
FROM p""")
def op4_curriculum_mix(spark, sf_dir):
    """Words that the mix takes of every document."""
    mixed = curriculum.mix(documents(spark, sf_dir)).withColumn("first", F.get("passes", F.lit(0))["time"])
    taken = F.aggregate("passes", F.lit(0).cast("bigint"), lambda a, p: a + p["words"])
    return curriculum.in_training_order(mixed, "first", "doc_id").select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), taken.alias("taken"))


@query("op2_exact_index", r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, CAST(count(*) OVER g AS BIGINT) AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)""")
def op2_exact_index(spark, sf_dir):
    """Every document with the one that stays for its text."""
    return exact_index.exact_dedup(documents(spark, sf_dir)).drop("key", "bucket", "depth", "chain")


_ESCAPE = r"regexp_replace({0}, '([<\[])(\\*(?:s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>|<ROLE>>|</ROLE>>))', '\1\\\2', 'g')"
_ROWS = """SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')"""


@query("op10_reply_trees", rf"""
WITH m AS ({_ROWS}),
t AS (SELECT *, CASE role WHEN 'user' THEN 22 WHEN 'system' THEN 24 WHEN 'assistant' THEN 7
                     ELSE 24 + length({_ESCAPE.format('role')}) END + length({_ESCAPE.format('text')}) AS n FROM m)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(n) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id""")
def op10_reply_trees(spark, sf_dir):
    """Every conversation formatted and read back.  A row replies to the row
    before it (order: turn, role, text), so each tree has one branch."""
    told = "'</s>[INST] ok [/INST]'"
    probe = spark.sql(f"SELECT -7L AS conv_id, 0L AS turn, 'user' AS role, {told} AS text UNION ALL SELECT -7L, 1L, 'assistant', {told}")
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").unionByName(probe)
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    messages = (rows.withColumn("node", place.cast("bigint"))
                    .select(F.col("conv_id").alias("tree"), "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
                            "role", "text", F.lit(0.0).alias("score")))
    made = reply_trees.conversations(messages).withColumn("read", reply_trees.read_turns(F.col("formatted")))
    said = F.array_join(F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    masked = reply_trees.loss_text(F.col("formatted"), F.col("loss"))
    return made.select(F.col("tree").alias("conv_id"), F.size("read").cast("bigint").alias("n_turns"), F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
                       F.length(masked).cast("bigint").alias("loss_chars"), F.sha2(masked.cast("binary"), 256).alias("loss_sha256"),
                       F.length("formatted").cast("bigint").alias("formatted_chars"))


@query("op5_language_codes")
def op5_language_codes(spark, sf_dir):
    """Predicted language of every document; learned from the rows whose
    crc32(doc_id) mod 5 is not 0."""
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    docs = documents(spark, sf_dir).withColumn("held_out", F.coalesce(rest == 0, F.lit(False)))
    model = langid.train(docs.filter(rest != 0))
    return langid.identify(docs, model, "doc_id", "held_out")


@query("op1_order_minhash")
def op1_order_minhash(spark, sf_dir):
    """Fingerprints of every text and of its edited text, whose last third is
    replaced by the start of the next document (descending doc_id)."""
    fp = order_minhash.fingerprint
    docs = documents(spark, sf_dir).select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    rows = order_minhash.with_next(docs, "doc_id", "text").withColumn("n_chars", F.length("text").cast("bigint"))
    cut = F.floor(F.col("n_chars") / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - cut), F.substring("next_text", F.lit(1), cut))
    rows = (rows.withColumn("edited", F.when(F.col("is_ghost") == 0, edited))
                .select("doc_id", "bucket", "is_ghost", "_o", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                        fp(F.col("text")).alias("own"), fp(F.col("edited")).alias("other"), F.xxhash64("text").alias("tie")))
    # the same buckets and order again: no further exchange
    order = Window.partitionBy("bucket").orderBy("is_ghost", F.col("_o").desc(), F.col("doc_id").desc_nulls_last(), "tie")
    rows = rows.withColumn("next", F.lead("own").over(order)).filter(F.col("is_ghost") == 0)
    return rows.select("doc_id", "n_chars", "edited_sha256", order_minhash.as_text(F.col("own")).alias("fingerprint"),
                       order_minhash.as_text(F.col("other")).alias("edited_fingerprint"),
                       order_minhash.likeness(F.col("own"), F.col("other")).alias("near_edited"),
                       order_minhash.likeness(F.col("own"), F.col("next")).alias("near_next"))


def _license_sql() -> str:
    names = ", ".join("({}, {})".format(*("'" + x.replace("'", "''") + "'" for x in pair)) for pair in license_scan.TEMPLATES.items())

    def cut(table: str, key: str, text: str) -> str:
        return (f"SELECT {key}, unnest([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) AS shingle "
                f"FROM (SELECT {key}, regexp_extract_all(lower(coalesce({text}, '')), '[\\pL\\pN]+') AS w FROM {table})")

    return f"""
WITH t(license_id, template) AS (VALUES {names}),
ts AS (SELECT DISTINCT * FROM ({cut('t', 'license_id', 'template')})),
n AS (SELECT license_id, count(*) AS n_shingles FROM ts GROUP BY license_id),
ds AS (SELECT DISTINCT * FROM ({cut('documents', 'doc_id', 'text')})),
m AS (SELECT doc_id, license_id, count(*) AS n_matched FROM ds JOIN ts USING (shingle) GROUP BY doc_id, license_id)
SELECT doc_id, license_id, CAST(n_shingles AS INT) AS n_shingles, CAST(n_matched AS INT) AS n_matched
FROM m JOIN n USING (license_id) WHERE n_matched >= n_shingles * 0.8"""


@query("op7_license_scan", _license_sql())
def op7_license_scan(spark, sf_dir):
    """License templates held by each document."""
    return license_scan.scan(documents(spark, sf_dir))


@query("op3_tensored_minhash")
def op3_tensored_minhash(spark, sf_dir):
    """Near-duplicate components on 4-word shingles, Jaccard 0.8 or more."""
    return near_dups.near_duplicates(documents(spark, sf_dir), words=4, percent=80).drop("text_hash")


@query("op6_suffix_merge")
def op6_suffix_merge(spark, sf_dir):
    """Bytes left of every document once strings of 50 bytes that also start
    in a document with a smaller doc_id are removed."""
    return suffix_dedup.remove_repeats(documents(spark, sf_dir)).drop("kept")


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op11_collocations", rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
c AS (SELECT lang, len(w) AS size, unnest(flatten([[array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)] FOR k IN range(1, 5)])) AS phrase FROM w),
f AS (SELECT lang, phrase, count(*) AS f, string_split(phrase, ' ') AS words FROM c GROUP BY lang, phrase),
n AS (SELECT lang, sum(f) AS n FROM f WHERE len(words) = 1 GROUP BY lang),
d AS (SELECT lang, phrase, f AS a, words FROM f WHERE f >= 30 AND len(words) > 1),
k AS (SELECT lang, phrase, a, words, unnest(range(1, len(words))) AS k FROM d),
s AS (SELECT k.lang, k.phrase, k.a, k.k, x.f AS l, y.f AS r, CAST(2000000 AS HUGEINT) * k.a // (x.f + y.f) AS score
      FROM k JOIN f x ON x.lang = k.lang AND x.phrase = array_to_string(k.words[1:k.k], ' ')
             JOIN f y ON y.lang = k.lang AND y.phrase = array_to_string(k.words[k.k + 1:], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
h AS (SELECT lang, part, max(a) AS longer FROM (
        SELECT lang, a, unnest(flatten([[array_to_string(words[i:i + m - 1], ' ') FOR i IN range(1, len(words) - m + 2)] FOR m IN range(2, len(words))])) AS part
        FROM d WHERE len(words) > 2) GROUP BY lang, part),
r AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank
      FROM b LEFT JOIN h ON h.lang = b.lang AND h.part = b.phrase WHERE longer IS NULL OR 100 * longer < 80 * a)
SELECT r.lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM r JOIN n USING (lang) WHERE rank <= 2000""")
def op11_collocations(spark, sf_dir):
    """The 2000 strongest phrases of every language."""
    return collocations.collocations(documents(spark, sf_dir))


@query("op12_host_suffix_text")
def op12_host_suffix_text(spark, sf_dir):
    """Main text of every page."""
    return host_boilerplate.main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


@query("op13_source_divergence", rf"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all({_LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
o AS (SELECT row, lang, source, unnest(terms) AS term FROM d),
t AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS n FROM o GROUP BY lang, term HAVING count(DISTINCT row) >= 10),
v AS (SELECT lang, CAST(count(*) AS HUGEINT) AS v, sum(n) AS n FROM t GROUP BY lang),
c AS (SELECT o.lang, o.source, o.term, CAST(count(*) AS HUGEINT) AS n FROM o JOIN t USING (lang, term) GROUP BY ALL),
g AS (SELECT x.lang, x.source, coalesce(sum(c.n), 0) AS n FROM (SELECT DISTINCT lang, source FROM d) x LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (SELECT g.lang, g.source, t.term, coalesce(c.n, 0) AS n, 1 + CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 2) // (g.n + 2 * v.v) AS p,
             1 + CAST(1000000000 AS HUGEINT) * (t.n + 2) // (v.n + 2 * v.v) AS q
      FROM g JOIN t USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = t.term),
e AS (SELECT x.lang, x.source, 'term' AS part, x.term AS item, (p - q) * (p - q) // (p + q) AS value FROM p x WHERE n > 0 AND p > q),
f AS (SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) AS value
      FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
a AS (SELECT lang, source, 'pair' AS part, item, coalesce(value, 0) AS value
      FROM (SELECT x.lang, x.source, y.source AS item FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source) LEFT JOIN f USING (lang, source, item)
      UNION ALL SELECT * FROM e)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INT) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM a)
WHERE part = 'pair' OR rank <= 10""")
def op13_source_divergence(spark, sf_dir):
    """How far the sources of a language are apart, and their over-used terms."""
    return divergence.divergence(documents(spark, sf_dir))


@query("pipeline")
def pipeline(spark, sf_dir):
    """The corpus pipeline from documents to packed sequences."""
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)
