"""The divergence audit, embedding whitening and HTML extraction against brute force, and on awkward rows."""

import html
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_ORACLE, SF_SMALL
from tidemark.llm import divergence, html_text, whitening

# divergence audit

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
ASCII = {i: i + 32 for i in range(65, 91)}


def brute_audit(rows, min_docs=10, top=10):
    docs = [(lang or "", source or "", TERM.findall((text or "").translate(ASCII))) for lang, source, text in rows]
    out = []
    for lang in {d[0] for d in docs}:
        df, count = Counter(), defaultdict(Counter)
        for a, source, words in docs:
            if a == lang:
                df.update(set(words))
                count[source].update(words)
        kept = sorted(w for w, n in df.items() if n >= min_docs)

        def shares(c):
            total = sum(c[w] for w in kept) + 2 * len(kept)
            return {w: 1 + 10**9 * (c[w] + 2) // total for w in kept}

        def f(p, q):
            return (p - q) ** 2 // (p + q)

        p = {s: shares(c) for s, c in count.items()}
        whole = shares(sum(count.values(), Counter()))
        for s in p:
            pairs = [(o, sum(f(p[s][w], p[o][w]) for w in kept)) for o in p if o != s]
            terms = [(w, f(p[s][w], whole[w])) for w in kept if count[s][w] and p[s][w] > whole[w]]
            for part, items, last in (("pair", pairs, len(pairs)), ("term", terms, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(items[:last])]
    return sorted(out)


def audit_rows(df, **options):
    return sorted(map(tuple, divergence.audit(df, **options).select("lang", "source", "part", "item", "value", "rank").collect()))


def test_audit_of_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert audit_rows(docs) == brute_audit([(r.lang, r.source, r.text) for r in docs.collect()])


AWKWARD_TEXTS = [
    (None, None, None), (None, "a", ""), ("en", None, "One two two éa É ßx"), ("en", "a", "one TWO three-four 5five"), ("en", "a", "one TWO three-four 5five"),
    ("en", "b", "\x00\x7f[]`{}@ 12"), ("en", "c", "w" * 9 + " " + "w" * 8 + " " + "w" * 17 + " " + "w" * 16), ("de", "only", "eins"),
    ("en", "d", " ".join(f"{'abcdefgh' * (i % 4)}{chr(97 + i % 26)}" for i in range(50_000))), ("xx", "a", None), ("xx", "b", "!"),
]


@pytest.mark.parametrize("small", [1 << 14, 4])
def test_audit_of_awkward_texts(spark, monkeypatch, small):
    """With small slices the quicksort itself does the sorting; with a tiny table of sums it is put out often."""
    monkeypatch.setattr(divergence, "SMALL_SLICE", small)
    monkeypatch.setattr(divergence, "PAIR_CELLS", 2 if small == 4 else 1 << 20)
    monkeypatch.setattr(divergence, "BLOCK_CELLS", 8 if small == 4 else 1 << 20)
    docs = spark.createDataFrame(AWKWARD_TEXTS * 2, "lang string, source string, text string").repartition(3) \
        .withColumn("term", F.lit(1)).withColumn("n", F.lit("x")).withColumn("uses", F.lit(0))
    for least in (1, 2, 4):
        assert audit_rows(docs, min_docs=least) == brute_audit(AWKWARD_TEXTS * 2, least)


def test_audit_of_nothing(spark):
    assert audit_rows(spark.createDataFrame([], "lang string, source string, text string")) == []


def test_runs_are_sorted_and_complete():
    """The quicksort orders words by their bytes, and its runs are the distinct words of each slice."""
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("abé"), rng.integers(1, 20))) for _ in range(3000)]
    text = pa.array([" ".join(words[i:i + 100]) for i in range(0, 3000, 100)], pa.large_string())
    offsets = np.frombuffer(text.buffers()[1], np.int64)
    p = divergence.Pointers(np.frombuffer(text.buffers()[2], np.uint8)[:offsets[-1]], offsets)
    for small in (2, 50, 1 << 14):
        divergence.SMALL_SLICE, before = small, divergence.SMALL_SLICE
        order, runs = divergence.multikey_quicksort(p, np.array([0, 1000, len(p.at)]))
        divergence.SMALL_SLICE = before
        got = p.words(order).to_pylist()
        assert got == sorted(words[:1000], key=str.encode) + sorted(words[1000:], key=str.encode)
        assert [got[i] for i in runs] == sorted(set(words[:1000]), key=str.encode) + sorted(set(words[1000:]), key=str.encode)


def test_scaled_is_exact_far_beyond_a_long():
    a, b = np.array([2**50, 1, 3, 2**52]), np.int64(2**52)
    assert divergence.scaled(a, b).tolist() == [1 + 10**9 * int(x) // 2**52 for x in a]


# whitening

def brute_whitening(vectors):
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    distinct = np.unique(x, axis=0)
    n, sums = len(distinct), distinct.sum(axis=0)
    centred = distinct - sums / n
    values, parts = np.linalg.eigh(centred.T @ centred / n)
    values, parts = values[::-1], parts[:, ::-1]
    return n, ((n * x - sums) ** 2).sum(axis=1), (x - sums / n) @ parts / np.sqrt(np.maximum(values, 1e-300)), values


@pytest.mark.parametrize("block_rows", [1024, 7])
def test_whitening_of_embeddings(spark, monkeypatch, block_rows):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(whitening, "MID_BLOCKS", 3)
    source = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").limit(150)
    rows = source.collect()
    n, deviation, whitened, values = brute_whitening([r.embedding for r in rows])
    monkeypatch.setattr(whitening, "load", lambda *a: source.repartition(3))
    got = whitening.op12(spark, "").collect()
    assert len(got) == 16 * len(rows)
    place = {r.vec_id: i for i, r in enumerate(rows)}
    mine = np.zeros((len(rows), 16))
    for r in got:
        assert (r.n, r.deviation) == (n, deviation[place[r.vec_id]])
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-9) and r.identity_error < 1e-9
        mine[place[r.vec_id], r.component - 1] = r.whitened
    sign = np.sign((mine * whitened[:, :16]).sum(axis=0))
    assert np.abs(mine * sign - whitened[:, :16]).max() < 1e-8


def test_whitening_of_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [[0.1, 0.2, 0.3], [0.5, -0.2, 0.3], [1.5, 0.9, -0.3], [0.1, 0.2, 0.3], [100.0, -100.0, 0.0]]
    rows = [(i, v) for i, v in enumerate(good)] + [(None, good[0]), (1, good[2])] + \
        [(10, None), (11, []), (12, [1.0, None, 2.0]), (13, [nan, 0.0, 0.0]), (14, [0.0, inf, 0.0]), (15, [1.0, 2.0]), (16, [1e300, 0.0, 0.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("x", F.lit(1)).withColumn("ids", F.lit("s")).withColumn("part", F.lit(0))
    out, model = whitening.whiten(table)
    out = out.collect()
    vectors = [v for i, v in rows if v and len(v) == 3 and all(c is not None and abs(c) < 1e200 for c in v)]
    n, deviation, _, values = brute_whitening(vectors)
    assert (model.n, model.components) == (n, 3) and model.identity_error < 1e-4
    assert Counter((r.id, int(r.deviation)) for r in out) == Counter(zip([0, 1, 2, 3, 4, None, 1], deviation.tolist()))
    assert model.explained == pytest.approx((values / values.sum()).tolist(), rel=1e-4)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [0.5, 0.5]), (2, [0.5, 0.5])]])
def test_whitening_without_components(spark, rows):
    out, model = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert model is None and out.count() == 0


def test_deviation_beyond_a_long_is_exact(spark):
    far = float(1 << 39)
    out, model = whitening.whiten(spark.createDataFrame([(1, [far, 0.0]), (2, [-far, 1.0]), (3, [0.0, 5.0])], "vec_id long, embedding array<double>"))
    x = [[(1 << 45) + 10**6, 10**6], [-(1 << 45) + 10**6, 10**6 + 64], [10**6, 10**6 + 320]]
    sums = [sum(v) for v in zip(*x)]
    assert {r.id: int(r.deviation) for r in out.collect()} == {i + 1: sum((3 * c - s) ** 2 for c, s in zip(v, sums)) for i, v in enumerate(x)}


# html extraction

def article(source):
    """The text of the only article element of a generated page, by regular expressions."""
    inner = re.search(r"<article>(.*)</article>", source, re.S)[1]
    return " ".join(html.unescape(re.sub(r"<[^>]*>", "", re.sub(r"</?(h1|p|br)\b[^>]*>", " ", inner))).split())


def test_pages(spark):
    pages = spark.read.parquet(f"{SF_ORACLE}/pages.parquet")
    got = {r.id: r for r in html_text.extract(pages).collect()}
    for r in pages.collect():
        assert got[r.page_id].text == article(r.html) and got[r.page_id].n_chars == len(got[r.page_id].text) and got[r.page_id].url == r.url


LOREM = "Word one, two and three. "
PAGES = {
    "Just some text & more.": "Just some text &amp;\n more.",
    "One two Three <tag> © x": "<article><p>One <b>two<p>Three &lt;tag&gt; &copy; x</article><footer>foo<script>var a='</p>';",
    f"The title {LOREM * 5}Short. {LOREM * 4}": "<div><a href=x>Home</a> | <a href=y>About</a></div><div><div><h1>The title</h1><p>" + LOREM * 5 + "</p><p>Short.</p><p>"
        + LOREM * 4 + "</p></div><div><p>Nice post!</p><p>me too</p></div></div><div>Copyright 2020</div>",
    f"Title here {LOREM * 5}one two A quote.": "<body class='comments-open'><div class='has-sidebar'><header><h1>Site</h1></header><div class='cookie-notice'>We use cookies, ok? "
        "Accept them all now, please.</div><main><article class=post><header><h2>Title here</h2></header><p>" + LOREM * 5 + "</p><ul><li>one<li>two</ul><blockquote>A quote."
        "</blockquote><form><label>Your name</label></form><div class=share>Tell all</div></article><section id=comments><article class=comment><p>" + LOREM * 9
        + "</p></article></section></main><aside>Side text.</aside></div></body>",
    f"Heading A b, c. {LOREM * 9}": "<div class=page><div class='top-menu'><ul><li><a>Home</a></ul></div><div class=content><h2>Heading</h2><p>A b, c.</p><div class=ad>Buy now, cheap!</div><p>"
        + LOREM * 9 + "</p></div><div class='comments'><p>" + LOREM * 20 + "</p></div></div>",
    "a b": "<p>a<br>b</p><!-- never closed",
    "wholeword in two": "<article>whole<b>word</b> in&#32;<i>two</i></article>",
    "shown": "<main><p hidden>not</p><p style='display: none'>nor</p><p>shown</p></main>",
    "": "<nav>Menu</nav><script>x</script>",
}


@pytest.mark.parametrize("text", list(PAGES))
def test_templates(text):
    assert html_text.main_text(PAGES[text]) == text.strip()


def test_awkward_pages(spark):
    rows = [(None, None, None), (1, "u", ""), (1, "u", ""), (2, None, "<"), (3, "u", "<p"), (4, "u", "<article>" + "<p>word, word." * 30_000), (5, "u", "&am")]
    table = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2).withColumn("id", F.lit(1)).withColumn("text", F.lit(2)).withColumn("n_chars", F.lit("x"))
    got = sorted(map(tuple, html_text.extract(table).collect()), key=str)
    long = " ".join(["word, word."] * 30_000)
    want = [(None, None, "", 0), (1, "u", "", 0), (1, "u", "", 0), (2, None, "<", 1), (3, "u", "", 0), (4, "u", long, len(long)), (5, "u", "&am", 3)]
    assert got == sorted(want, key=str)
    assert html_text.extract(table.limit(0)).collect() == []


@pytest.mark.parametrize("piece", ["<div>", "<p>", "<", '<a "', "<li>x", "<!--", "<div>x</span>", "&am", "<script>", '<div class="', "<ul><li>", "</p>"])
def test_broken_html_takes_linear_time(piece):
    import time
    start = time.perf_counter()
    html_text.main_text(piece * 40_000)
    assert time.perf_counter() - start < 10
