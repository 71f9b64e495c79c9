"""Phrase collocations, host boilerplate and source divergence against plain
versions: nulls, empty and very long texts, ties, repeated rows, empty tables,
clashing columns, many pieces."""

import html as entities
import random
import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import pytest

from starloom.llm import collocations, divergence, host_boilerplate
from starloom.llm.html_blocks import blocks
from starloom.llm.queries import QUERIES

SF_CHECK = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, lang string, source string, text string, n int, w1 string, term string, phrase string, rank int, parts int, value int, url string"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    words = ["Ada", "böse", "c++", "d", "e'f", "Ünder", "g_h", "日本", "\U0001F600x", "zz"]
    text = lambda n: "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ". ", "\n", "; ", "\r\n", "?!"]) for _ in range(n))
    out = [(rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", None]), text(rng.randrange(60))) for _ in range(150)]
    out += [("en", "only", None), ("en", "only", ""), ("fr", "x", " \t\n"), ("fr", "y", "..,;:!?"), (None, None, None), ("en", "long", text(40_000))]
    return out + [("de", "a", "Ada böse zz Ada böse zz")] * 9 + [("de", "\U0001F600", "b\u0000c d"), ("de", "é", "b\u0000c d")] * 6


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(None if i % 9 == 0 else i % 50, lang, source, t, 1, "w", "t", "p", 2, 3, 4, "u") for i, (lang, source, t) in enumerate(rows)], SCHEMA)


def _lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain_collocations(rows, least, top, inside=80):
    f, n = Counter(), Counter()
    for lang, _, text in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", _lower(text)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            f.update((lang or "und", tuple(w[i:i + k])) for k in range(1, 5) for i in range(len(w) - k + 1))
    found = {x: a for x, a in f.items() if a >= least and len(x[1]) > 1}
    out = []
    for lang in n:
        scored = []
        for (of, w), a in found.items():
            if of != lang:
                continue
            holds = [b for (other, v), b in found.items() if other == lang and len(v) > len(w) and any(v[i:i + len(w)] == w for i in range(len(v)))]
            if any(100 * b >= inside * a for b in holds):
                continue
            s, _, left, r = min((2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
            scored.append((-s, -a, " ".join(w).encode(), left, r))
        out += [(lang, i + 1, p.decode(), -a, left, r, n[lang], -s) for i, (s, a, p, left, r) in enumerate(sorted(scored)[:top])]
    return sorted(out)


@pytest.mark.parametrize("least,top", [(4, 5), (30, 2000), (150, 2000)])
def test_collocations(docs, rows, least, top):
    # tasks that send on after few words, and so few buckets that many are shared
    got = collocations.collocations(docs, least=least, top=top, bits=12, held=500, most=100)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = plain_collocations(rows, least, top)
    assert sorted(tuple(r) for r in got.collect()) == want and len(want) > 3


def test_collocations_of_nothing(docs):
    assert collocations.collocations(docs.limit(0)).count() == 0
    assert collocations.collocations(docs.where("text is null or lang = 'fr'"), least=1).count() == 0


def test_collocations_hold_no_more_with_many_languages():
    """Words and windows of all languages together are bounded, and the
    windows come in batches of bounded size."""
    rng, held, most = random.Random(5), {}, 0
    texts = [(f"l{i % 20}", " ".join(rng.choice("abcdefgh") for _ in range(50))) for i in range(400)]

    class Batch:
        def column(self, k):
            return pa.array([t[k] for t in texts])

    out = Counter()
    for lang, n in collocations._texts([Batch()], lambda lang, words: iter([(lang, words.held)]), 500):
        out[lang] += n
        most = max(most, n)
    # one language holds a twentieth of what all do: it is sent on long before it has 500 words
    assert sum(out.values()) == 400 * 51 and len(out) == 20 and most < 500
    w = collocations._Windows()
    n = 2 * collocations.BATCH
    w.names.update({str(i): i + 1 for i in range(1 << 10)})
    w.left, w.right, w.times, w.words = np.arange(n) % 1024 + 1 << 32, np.zeros(n, np.int64), np.arange(n), 7
    got = list(w.batches("de"))
    assert [b.num_rows for b in got] == [n // 2, n // 2, 1] and got[-1].to_pylist() == [{"lang": "de", "w1": "", "w2": "", "w3": "", "w4": "", "n": 7}]
    assert got[1].slice(5, 1).to_pylist() == [{"lang": "de", "w1": "5", "w2": "", "w3": "", "w4": "", "n": n // 2 + 5}]


def plain_divergence(rows, min_docs, ranks):
    times, with_it, groups = Counter(), Counter(), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", _lower(text))
        times.update((lang, source, t) for t in terms)
        with_it.update((lang, t) for t in set(terms))
    out = []
    for lang, source in groups:
        kept = [t for (of, t), d in with_it.items() if of == lang and d >= min_docs]
        sources = [s for of, s in groups if of == lang]

        def probability(of):
            count = [sum(times[lang, s, t] for s in of) for t in kept]
            return count, [1 + 10**9 * (c + 2) // (sum(count) + 2 * len(kept)) for c in count]

        def f(p, q):
            return (p - q) ** 2 // (p + q)
        count, p = probability([source])
        _, q = probability(sources)
        pairs = [(-sum(f(*x) for x in zip(p, probability([s])[1])), s.encode()) for s in sources if s != source]
        terms = [(-f(a, b), t.encode()) for t, c, a, b in zip(kept, count, p, q) if c and a > b]
        for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:ranks])):
            out += [(lang, source, part, item.decode(), -v, i + 1) for i, (v, item) in enumerate(found)]
    return sorted(out)


@pytest.mark.parametrize("min_docs,ranks", [(10, 10), (1, 2), (1000, 10)])
def test_divergence(docs, rows, min_docs, ranks):
    got = divergence.divergence(docs, min_docs=min_docs, ranks=ranks, held=20)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in got.collect()) == plain_divergence(rows, min_docs, ranks)


def test_divergence_of_nothing(docs):
    assert divergence.divergence(docs.limit(0)).count() == 0


def test_probabilities_beyond_64_bits(spark):
    big = 9 * 10**17
    p = spark.range(1).selectExpr(f"{big}L AS n", f"{big + 5}L AS total", "7L AS vocabulary").selectExpr(divergence._p("n", "total", "vocabulary")).first()[0]
    assert p == 1 + 10**9 * (big + 2) // (big + 5 + 14)


class _Article(HTMLParser):
    """Main text of pages whose article holds headings and paragraphs only."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.blocks = False, [""]

    def handle_starttag(self, tag, attrs):
        self.inside |= tag == "article"
        if tag != "b":
            self.blocks += [""] if tag != "br" else []
            self.blocks[-1] += " "

    def handle_endtag(self, tag):
        self.inside &= tag != "article"
        if tag in ("p", "h1"):
            self.blocks.append("")

    def handle_data(self, data):
        if self.inside:
            self.blocks[-1] += data


def test_main_text_of_all_pages(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF_CHECK}/pages.parquet").collect()}
    got = QUERIES["op12_host_suffix_text"](spark, SF_CHECK).collect()
    assert sorted(r.page_id for r in got) == sorted(pages)
    for r in got:
        p = _Article()
        p.feed(pages[r.page_id].html)
        p.close()
        want = "\n\n".join(t for t in (" ".join(b.split()) for b in p.blocks) if t)
        assert r.text == want and r.n_chars == len(want) and r.url == pages[r.page_id].url
    assert sum(r.repeated_words for r in got) > 500


def test_blocks():
    page = """<!DOCTYPE html><HTML><head><title>No</title><style>p{}</style></head><body class="has-sidebar"><header><h1>No</h1></header>
    <div class=ad>No <b>no</b></div><!-- <p>no --><MAIN><article class="post"><header><h1>Head &amp; &#x41;&#66;&nbsp;&hellip;</h1></header>
    <p>One<br>line &lt;b&gt; <i>in</i>line<script>if (a</p>b) no("</script"+"x")</script> end<p>Two <a href="x>y">link</a></div>
    <ul><li>a<li>b</ul><table><tr><td>c<td>d</table><aside>No</aside><form><p>No</form><div id="comments"><p>No</p></div><p>1 < 2 & 3 &am
    <section class="shareButtons">No</section></article><article class="comment"><p>No</p></article><p>Outside</p></main><footer>No</footer><p"""
    found = [b.text for b in blocks(page) if b.level == 2 and not b.junk]
    assert found == ["Head & AB …", "One line <b> inline end", "Two link", "a", "b", "c", "d", "1 < 2 & 3 &am"]
    assert [b.text for b in blocks(page) if b.level == 1 and not b.junk] == ["Outside"]
    assert not [b for b in blocks(page) if b.level == 0 and not b.junk]
    assert blocks("") == blocks("<p> \n<br>") == blocks("<script>x") == blocks("<!-- x") == [] and blocks("a <b")[0].text == "a"


def plain_repeats(pages, length):
    """Covered tokens of each page by a table of all strings of a host."""
    where = {}
    for host, name, tokens in pages:
        for i in range(len(tokens) - length + 1):
            where.setdefault((host, tuple(tokens[i:i + length])), set()).add(name)
    out = {}
    for host, name, tokens in pages:
        held = np.zeros(len(tokens), bool)
        for i in range(len(tokens) - length + 1):
            if len(where[host, tuple(tokens[i:i + length])]) > 1:
                held[i:i + length] = True
        out[name] = held.tolist()
    return out


@pytest.mark.parametrize("piece", [1 << 18, 300])
def test_repeats_across_pieces(spark, piece):
    rng = random.Random(5)
    passages = [" ".join(rng.choices("abcdefgh", k=rng.randrange(3, 30))) for _ in range(30)]
    rows = [(i, f"http://{rng.choice('xxxxy')}.org/{i}", "".join(f"<p>{rng.choice(passages)}" if rng.random() < .5 else f"<div>{rng.random()} z" for _ in range(9))) for i in range(120)]
    rows += [(200, "http://x.org/q", None), (201, None, ""), (None, None, "<p>" + passages[0]), (None, None, "<p>" + passages[0]), (7, "http://x.org/long", "<p>u v " * 20_000)]
    got = {(r._r_id, len(r.repeats)): np.unpackbits(np.frombuffer(r.repeats, np.uint8)) for r in host_boilerplate.repeats(
        spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3), piece).collect()}
    streams = [(re.sub("//|/.*", "", u.split(":")[1]) if u else "", (i or 0, -(-len(t) // 8)), t) for i, u, h in dict.fromkeys(rows)
               if len(t := host_boilerplate.stream(blocks(h or ""))[0].tolist())]
    want = plain_repeats(streams, host_boilerplate.LENGTH)
    assert sorted(got) == sorted(want) and sum(map(sum, want.values())) > 1000
    for name, held in want.items():
        assert got[name][:len(held)].astype(bool).tolist() == held


def test_pages_without_an_article(spark):
    rng = random.Random(6)
    text = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    line, teaser, copied = "All rights reserved by the good people of example dot org", text(12), text(60)
    rows = [(i, f"https://x.org:80/{i}", f"<div>{line}</div><p>{(t := text(40))}</p><div>{teaser} &copy;</div>", t) for i in range(20)]
    rows += [(100 + i, "https://x.org/c", f"<div>{copied}</div>", copied) for i in range(3)]
    rows += [(200, "https://other.org/", f"<div>{line}</div><p>alone</p><nav>menu</nav>", f"{line}\n\nalone"), (300, None, None, ""), (301, "", "", ""), (302, "http://x.org/", "plain", "plain")]
    df = spark.createDataFrame([(i, u, h, 1, "r", 5) for i, u, h, _ in rows] * 2, "page_id int, url string, html string, host int, repeats string, _id int")
    got = host_boilerplate.main_text(df).collect()
    want = Counter((i, u, t, len(t)) for i, u, _, t in rows for _ in range(2))
    assert Counter((r.page_id, r.url, r.text, r.n_chars) for r in got) == want
    assert {r.repeated_words for r in got if r.page_id < 20} == {len(line.split()) + 13}
    assert host_boilerplate.main_text(df.limit(0)).count() == 0
    assert entities.unescape("&amp;") == "&"


def test_repeats_in_main_parts(spark):
    rng = random.Random(7)
    text = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    line, copied, footing = text(10), text(60), text(10)
    # a line of every main part goes, outside it all goes; in an article it stays
    rows = [(i, f"<p>outside {i}</p><main><h1>Head {i}</h1><p>{(t := text(40))}</p><nav>menu</nav><div>{line}</div></main><footer>{line}</footer>", f"Head {i}\n\n{t}", 21) for i in range(9)]
    rows += [(20 + i, f"<div role=main><p>{(t := text(40))}</p><div>{line}</div></div>", t, 10) for i in range(3)]
    rows += [(30, f"<main><article><p>{(t := text(40))}</p><div>{line}</div></article><div>{footing}</div></main>", f"{t}\n\n{line}", 10)]
    # what lies outside an article tells of pages without one
    rows += [(31, f"<p>{(t := text(40))}</p><div>{footing}</div>", t, 10)]
    # copies keep all, whatever lies around them
    rows += [(40 + i, f"<main><p>{copied}</p><div>{line}</div></main><nav>{text(300)}</nav>", f"{copied}\n\n{line}", 0) for i in range(3)]
    pages = [(i, "http://x.org/", h) for i, h, *_ in rows] + [(90, "http://other.org/", f"<main><p>alone</p><div>{line}</div></main>")]
    got = host_boilerplate.main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    want = [(i, t, n) for i, _, t, n in rows] + [(90, f"alone\n\n{line}", 0)]
    assert sorted((r.page_id, r.text, r.repeated_words) for r in got) == want


def test_articles_are_in_the_streams(spark):
    rng = random.Random(8)
    text = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    told, teaser, news = text(30), text(12), text(12)
    found = blocks(f"<p>out</p><article><p>{told}</p><nav>menu</nav></article>")
    assert len(host_boilerplate.stream(found)[0]) == 1 + 1 + 1 + 30 + 1 + 1  # block starts and words, the article's too
    rows = [(1, f"<div>{text(9)}</div><article><p>{told}</p><p>{teaser}</p></article>", f"{told}\n\n{teaser}", 0),  # stays whole, though repeated
            (2, f"<p>{(t := text(40))}</p><div>{teaser}</div>", t, 12),  # a page without an article that quotes one
            (3, f"<main><p>{(t := text(40))}</p><div>{teaser}</div></main>", t, 12),
            (4, f"<aside>{teaser}</aside><article><p>{(t := text(40))}</p></article>", t, 12),  # what lies around an article
            (5, f"<p>{told}</p>", told, 0),  # a copy of what an article says keeps it
            (6, f"<p>{(t := text(40))}</p><div>{news}</div>", f"{t}\n\n{news}", 0)]
    pages = [(i, "http://x.org/", h) for i, h, *_ in rows] + [(9, "http://y.org/", f"<article>{news}</article>")]
    got = host_boilerplate.main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert sorted((r.page_id, r.text, r.repeated_words) for r in got) == [(i, t, n) for i, _, t, n in rows] + [(9, news, 0)]
