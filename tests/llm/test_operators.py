"""Each corpus operator against a brute-force version on a whole small table, and on awkward rows."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_ORACLE, SF_SMALL
from tidemark.llm import decontaminate, exact_dedup, fingerprints, near_dedup, packing, paragraph_dedup, pii, preference, quality, suffix_dedup, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i}" for i in range(3000))
PASSAGE = " ".join(f"p{i}" for i in range(60)) + "."
AWKWARD = [
    (1, None, None, None, None), (2, "", "en", "s", 0), (3, " \n\t ", "en", "s", 4), (4, "one", "en", "s", 3),
    (5, "one  two\tthree four five", "en", "s", 0), (6, "one two three four five", "en", "s", 0),
    (6, "one two three four five", "en", "s", 0), (7, LONG, "en", "s", 0), (8, LONG + " x", "en", "s", 0),
    (9, LONG, "en", "s", 0), (None, "one two three four five", None, None, None), (None, None, None, None, None),
    (10, "These are words that come in front of it here. " + PASSAGE + " After that.", "en", "s", 0), (11, "Other words stand here before the passage in this line. " + PASSAGE + " The end.", "en", "s", 0),
    (12, "É" * 40 + " ß 😀 " * 30, "de", "s", 0), (13, "É" * 40 + " ß 😀 " * 30, "de", "s", 0),
]
UNIQUE = [r for i, r in enumerate(AWKWARD) if r[0] is not None and i != 6]


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(AWKWARD, SCHEMA).repartition(3).withColumn("kept", F.lit(7)).withColumn("id", F.lit("x")).withColumn("row", F.lit(1))


@pytest.fixture(scope="module")
def unique(spark):
    return spark.createDataFrame(UNIQUE, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


# exact dedup

def brute_exact(rows):
    import re
    groups = {}
    for k, t in rows:
        groups.setdefault(re.sub("[\x20\x09-\x0d]+", " ", t or ""), []).append(k)
    return {k: (min(ids), len(ids), k == min(ids), hashlib.sha256(n.encode()).hexdigest()) for n, ids in groups.items() for k in ids}


def marks(df):
    return {r.id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()}


@pytest.mark.parametrize("hot_part", [0.25, 1e-9])
def test_exact_copies(docs, texts, unique, monkeypatch, hot_part):
    """With the tiny part every group of copies takes the pre-aggregated way."""
    monkeypatch.setattr(exact_dedup, "HOT_PART", hot_part)
    assert marks(exact_dedup.mark_copies(docs)) == brute_exact(texts)
    assert marks(exact_dedup.mark_copies(unique)) == brute_exact([r[:2] for r in UNIQUE])


@pytest.mark.parametrize("hot_part", [0.25, 1e-9])
def test_exact_drop(awkward, empty, monkeypatch, hot_part):
    monkeypatch.setattr(exact_dedup, "HOT_PART", hot_part)
    out = exact_dedup.drop_copies(awkward)
    assert out.columns == awkward.columns
    rows = out.collect()
    assert sorted(r.doc_id for r in rows) == [1, 3, 4, 5, 7, 8, 10, 11, 12]
    assert all(r.id == "x" and r["kept"] == 7 for r in rows)
    assert exact_dedup.drop_copies(empty).count() == 0
    assert exact_dedup.mark_copies(empty).count() == 0


# decontamination

ITEMS = [(1, "p3 p4 p5 p6 p7 p8 p9 p10 p11 p12 p13 p14"), (2, "one two"), (3, None), (4, ""), (4, "W5 w6, w7! w8 w9 w10 w11 w12 w13 w14"), (None, "four five")]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("spans", F.lit(1))


def test_contamination(spark, docs, texts, unique, items):
    given = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    for d, rows, i, keys in ((docs, texts, given, [tuple(r) for r in given.collect()]), (unique, [r[:2] for r in UNIQUE], items, [(k if k is not None else "", t) for k, t in ITEMS])):
        want = decontaminate.brute_force(rows, keys)
        for block in (decontaminate.BLOCK_WORDS, 15):
            got = {r.id: (r.n_words, r.n_hit, len(r["items"]), hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), r.n_hit > 0)
                   for r in decontaminate.contamination(d, i, block_words=block).collect()}
            assert got == want
    assert any(w[1] for w in want.values())


def test_remove_benchmark(awkward, empty, items):
    for block in (decontaminate.BLOCK_WORDS, 15):
        out = decontaminate.remove_benchmark(awkward, items, max_coverage=0.5, block_words=block)
        assert out.columns == awkward.columns
        rows = out.collect()
        assert sorted(r.doc_id or 0 for r in rows) == [0, 1, 2, 3, 4, 7, 8, 9, 10, 11, 12, 13]   # "one two three four five" is mostly item
        text = {r.doc_id: r.text for r in rows}
        assert "p3 " not in text[10] and "p2 " in text[10] and " p15 " in text[10]
        assert text[12] == AWKWARD[-2][1]
        assert decontaminate.remove_benchmark(empty, items, block_words=block).count() == 0
    assert decontaminate.remove_benchmark(awkward, items.where("item_id = 99")).count() == len(AWKWARD)


def test_automaton_against_all_substrings():
    rng = np.random.default_rng(3)
    for _ in range(30):
        rows = [(i, " ".join(rng.choice(list("abc"), rng.integers(0, 25)))) for i in range(12)]
        got = decontaminate.Automaton([(str(k), decontaminate.words_of(t)) for k, t in rows[:6]], 4)
        want = decontaminate.brute_force(rows[6:], rows[:6], 4)
        for k, t in rows[6:]:
            hits, found, _ = got.match(decontaminate.words_of(t))
            assert (0 if hits is None else hits.sum(), len(found)) == want[k][1:3]


# near dedup

def classes(df):
    return {r.id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_near_duplicates(spark, unique, awkward, empty):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    assert classes(near_dedup.near_duplicates(docs)) == near_dedup.brute_force([(r.doc_id, r.text) for r in docs.collect()])
    assert classes(near_dedup.near_duplicates(unique)) == near_dedup.brute_force([r[:2] for r in UNIQUE])
    out = near_dedup.near_duplicates(awkward).collect()
    assert len(out) == len(AWKWARD) and all(r.component_id is None for r in out if r.id is None)
    assert near_dedup.near_duplicates(empty).count() == 0
    kept = near_dedup.keep_one(awkward)
    assert kept.columns == awkward.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 1, 2, 3, 4, 5, 7, 10, 11, 12]


@pytest.mark.parametrize("limit", [near_dedup.GROUP_SHINGLES, 500])
def test_near_chain_of_edits(spark, monkeypatch, limit):
    """Each text is near the next one only; a hub with many near copies; all found without pairs of a bucket."""
    monkeypatch.setattr(near_dedup, "GROUP_SHINGLES", limit)   # the small limit sends groups through the rounds
    base = [f"t{i}" for i in range(100)]
    rows, words = [], list(base)
    for i in range(40):
        rows.append((i, " ".join(words)))
        words[(7 * i) % 100] = f"x{i}"
    hub = [f"h{i}" for i in range(100)]
    for i in range(150):
        rows.append((1000 + i, " ".join(hub[:99] + [f"y{i}"])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert classes(near_dedup.near_duplicates(df)) == near_dedup.brute_force(rows)


def test_sketch_estimates_similarity():
    rng, sketch = np.random.default_rng(0), near_dedup.Sketcher(288)
    for share in (0.5, 0.8):
        got = []
        for _ in range(40):
            u = rng.integers(0, 2**63, 900).astype(np.uint64)
            n = int(900 * (1 - share) / 2)
            got.append((sketch(np.sort(u[n:])) == sketch(np.sort(u[:900 - n]))).mean())
        assert abs(np.mean(got) - share) < 0.02 and np.std(got) < 1.5 * math.sqrt(share * (1 - share) / 288)
    for n in (1, 2, 10, 5000):
        assert (sketch(rng.integers(0, 2**63, n).astype(np.uint64)) != np.iinfo(np.uint64).max).all()


# suffix dedup

def cuts(df):
    return {r.id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()}


@pytest.mark.parametrize("hot", [None, 2])
def test_suffix_dedup(docs, texts, unique, awkward, empty, monkeypatch, hot):
    if hot:
        monkeypatch.setattr(fingerprints, "RUN_HOT", hot)
        monkeypatch.setattr(fingerprints, "BUCKET_HOT", hot)
    assert cuts(suffix_dedup.remove_repeats(docs)) == suffix_dedup.brute_force(texts)
    want = suffix_dedup.brute_force([r[:2] for r in UNIQUE])
    assert cuts(suffix_dedup.remove_repeats(unique)) == want
    assert want[11][1] > 200 and want[9][1] == want[9][0]
    out = suffix_dedup.remove_repeats(awkward)
    assert out.count() == len(AWKWARD)
    assert suffix_dedup.remove_repeats(empty).count() == 0


@pytest.mark.parametrize("hot", [None, 1])
def test_suffix_dedup_low_entropy(spark, monkeypatch, hot):
    """Few letters: anchors repeat, contexts overlap, windows meet in many ways.  With 1 all repeated anchors are hot."""
    if hot:
        monkeypatch.setattr(fingerprints, "RUN_HOT", hot)
        monkeypatch.setattr(fingerprints, "BUCKET_HOT", hot)
    rng = np.random.default_rng(1)
    shared = ["".join(rng.choice(list("ab"), 90)) for _ in range(4)]
    rows = []
    for i in range(60):
        parts = [shared[rng.integers(4)][rng.integers(0, 30):rng.integers(55, 90)] if rng.random() < 0.6 else "".join(rng.choice(list("abc"), rng.integers(0, 70)))
                 for _ in range(rng.integers(0, 6))]
        rows.append((i, "".join(parts)))
    rows += [(100, "a" * 300), (101, "a" * 49), (102, "b" + "a" * 60), (103, "ab" * 80), (104, "ba" * 30)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert cuts(suffix_dedup.remove_repeats(df)) == suffix_dedup.brute_force(rows)


def test_loser_tree_merges_front_coded_runs():
    rng = np.random.default_rng(2)
    for k in (1, 2, 3, 7):
        keys, runs = [], []
        for r in range(k):
            m = rng.integers(0, 3, (int(rng.integers(0, 50)), suffix_dedup._KEY)).astype(np.uint8)
            m[:, :60] = 1
            m = m[np.argsort(m.view(f"S{suffix_dedup._KEY}").ravel(), kind="stable")] if len(m) else m
            runs.append(suffix_dedup._Run(r, *suffix_dedup.front_coded(m)) if len(m) else suffix_dedup._Run(r, b"", b""))
            keys += [m[i].tobytes() for i in range(len(m))]
        got, last = [], None
        for same, r, _ in suffix_dedup.merged(runs):
            assert same == (runs[r].key == last)
            last = runs[r].key
            got.append(last)
        assert got == sorted(keys)


# paragraph dedup

def test_paragraph_dedup(unique, awkward, empty, docs):
    out = {r.id: r for r in paragraph_dedup.remove_paragraphs(unique).collect()}
    assert len(out) == len(UNIQUE)
    assert out[11].n_removed >= 1 and "p30" not in out[11].text and "Other words stand" in out[11].text and "The end." in out[11].text
    assert out[10].n_removed == 0 and out[10].text == UNIQUE[[r[0] for r in UNIQUE].index(10)][1]
    assert out[9].n_removed == 1 and out[8].n_removed == 1 and out[7].n_removed == 0
    assert all(out[k].n_removed == 0 for k in (1, 2, 3, 4, 5, 6))
    assert paragraph_dedup.remove_paragraphs(awkward).count() == len(AWKWARD)
    assert paragraph_dedup.remove_paragraphs(empty).count() == 0


def test_word_hashes_and_layout():
    cut = paragraph_dedup.Paragraphs()
    for text in ("", " \n ", "a", "One two.\n\nThree  four\tfive six seven eight nine ten eleven. End é! x" + " y" * 5000, "\nA b"):
        raw = text.encode()
        h, first = cut(raw)
        words = raw.lower().split()
        assert len(h) == len(words) and len(set(zip(words, h.tolist()))) == len(set(words)) == len(set(h.tolist()))
        begin, ends, _ = paragraph_dedup.layout(raw)
        assert [raw[a:b + 1].lower() for a, b in zip(begin.tolist(), ends.tolist())] == words
    h, first = cut(b"One two.\n\nThree four five six seven eight nine ten. End x\nlast")
    assert first.tolist() == [0, 2, 10, 12]


def test_paragraph_copies_against_all_pairs(spark, docs):
    """Every paragraph with a similar one in an earlier document (over its cluster) is found."""
    cut, rows = paragraph_dedup.Paragraphs(), []
    for r in docs.collect():
        h, first = cut((r.text or "").encode())
        ends = [*first[1:].tolist(), len(h)]
        x = paragraph_dedup.shingle_hashes(h)
        rows += [(r.doc_id, p, frozenset(x[a:b - 4].tolist())) for p, (a, b) in enumerate(zip(first.tolist(), ends)) if b - a >= paragraph_dedup.MIN_WORDS]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = {}
    for i, (_, _, s) in enumerate(rows):
        for j in {j for x in s for j in holders.get(x, ())}:
            o = rows[j][2]
            if 100 * len(s & o) >= 80 * len(s | o):
                a, b = sorted((find(i), find(j)))
                root[b] = a
        for x in s:
            holders.setdefault(x, []).append(i)
    least = {}
    for i, (d, _, _) in enumerate(rows):
        least[find(i)] = min(d, least.get(find(i), d))
    want = {(d, p) for i, (d, p, _) in enumerate(rows) if d > least[find(i)]}
    got = {(r.oid, r.number) for r in paragraph_dedup.paragraph_copies(docs).collect()}
    assert want and got <= want and len(got) >= 0.99 * len(want)


def test_short_paragraphs_are_copies(spark):
    """Short lines count in a run of copies, and every one is a candidate; one alone stays."""
    lines = [" ".join(f"{c}{i}" for i in range(n)) for c, n in zip("abcdefghi", (11, 3, 21, 3, 20, 1, 6, 7, 4))]
    poem = "\n".join(" ".join(f"z{i}x{j}" for j in range(4)) for i in range(13))
    texts = {1: "\n".join(lines[:5]), 2: "Quite another start\n" + "\n".join(lines[:5]) + "\nand another end", 3: poem, 4: "Mine.\n" + poem + "\nYours.",
             5: "\n".join(lines[5:]), 6: "\n".join(["here", lines[6], "there", lines[8], "and", lines[5]])}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    sets, want = {}, set()
    for k, t in texts.items():
        for p, line in enumerate(t.split("\n")):
            w = line.split()
            sets[k, p] = {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))}
    for k, p in sets:
        if any(j < k and 100 * len(s & sets[k, p]) >= 80 * len(s | sets[k, p]) for (j, _), s in sets.items()):
            want.add((k, p))
    assert {(r.oid, r.number) for r in paragraph_dedup.all_copies(docs).collect()} == want
    out = {r.id: r for r in paragraph_dedup.remove_paragraphs(docs).collect()}
    assert out[2].text.split() == "Quite another start and another end".split() and out[2].n_removed == 5
    assert out[4].text.split() == ["Mine.", "Yours."] and out[4].n_removed == 13
    assert all(out[k].text == texts[k] and out[k].n_removed == 0 for k in (1, 3, 5, 6))


def test_passages_inside_paragraphs(spark):
    """A passage that starts and ends inside sentences goes whole, and one inside a long line too."""
    def some(c, n):
        return [f"{c}{i}" for i in range(n)]

    middle = " ".join(some("k", 14)) + " m."
    passage = " ".join(some("p", 21)) + " s. " + middle + " " + " ".join(some("q", 20))
    inside = " ".join(some("v", 60))
    texts = {1: " ".join(some("a", 9)) + " " + passage + " " + " ".join(some("b", 12)) + ".", 2: " ".join(some("c", 15)) + " " + passage + " " + " ".join(some("d", 9)) + ".",
             3: " ".join(some("e", 200)) + " " + inside + " " + " ".join(some("f", 300)), 4: " ".join(some("g", 170)) + " " + inside + " " + " ".join(some("i", 240)),
             5: " ".join(some("y", 9)) + ". " + middle}
    out = {r.id: r for r in paragraph_dedup.remove_paragraphs(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert all(out[k].text == texts[k] and out[k].n_removed == 0 for k in (1, 3, 5))
    assert out[2].text.split() == some("c", 15) + some("d", 8) + ["d8."] and out[2].n_removed == 3
    assert out[4].text.split() == some("g", 170) + some("i", 240) and out[4].n_removed == 1


# personal data

HARD = ["a@b.c-d_e@x.y", "x@y..z a@b.c.d. é a.b@c.d", "1.2.3.4.5.6.7.8 300.1.1.1 0001.02.3.255", "4111 1111 1111 1111 1 4111-1111-1111-1111",
        "4111\x011111 1111 1111 1111", "+1 (743) 555-3824 +1-2 ++4412345678)(", "😀 a@b.co 😀 +12345678", "1 " * 20000, "9" * 50000,
        "a." * 50000 + "@b.c", "a@" + "b." * 50000 + "c", "+" + "1" * 50000 + " " * 1000, "", None, "%a@b.c%d@e.f", "\x01a@b\x01c a@b.c"]


def test_base_spans(spark, docs, texts):
    hard = spark.createDataFrame([(i, t) for i, t in enumerate(HARD)], "doc_id long, text string")
    for df, rows in ((docs, texts), (hard, list(enumerate(HARD)))):
        got = {r.id: [(pii.KINDS[s.kind], s.start, s.stop) for s in r.base] for r in pii.find_pii(df).collect()}
        assert got == {k: pii.brute_force(t) for k, t in rows}


def test_op3_counts_and_digests_by_kind(spark, workdir):
    """The columns of the query: texts whose spans are of other kinds than their places in the list."""
    rows = [*enumerate(t for t in HARD if len(t or "") < 1000), (100, "a@b.co, c@d.org, 10.0.0.1"), (101, "+1 743 555 3824"), (102, "4111 1111 1111 1111 or +1 743 555 3824, 10.0.0.1 c@d.org"),
            (102, "1.2.3.4 5.6.7.8 +44 1234 5678"), (None, "4111-1111-1111-1111"), (None, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{workdir}/documents.parquet")
    out = pii.op3(spark, workdir)
    got = sorted(map(repr, (tuple(r) for r in out.select("doc_id", *[f"n_{k}" for k in pii.KINDS], "base_sha256").collect())))
    want = []
    for k, t in rows:
        spans = pii.brute_force(t)
        digest = hashlib.sha256(",".join(f"{kind}:{a}:{b}" for kind, a, b in spans).encode()).hexdigest()
        want.append((k, *[sum(s[0] == kind for s in spans) for kind in pii.KINDS], digest))
    assert got == sorted(map(repr, want))
    assert {out.schema[f"n_{k}"].dataType.simpleString() for k in pii.KINDS} == {"bigint"}


def test_contexts_reveal_unseen_identifiers(spark, awkward, empty):
    rows = [(i, f"Note {i % 3}: please call me at +1 555 010 {1000 + i} today") for i in range(12)]
    rows += [(100, "please call me at 01234/5678 now"), (101, "later 01234/5678 again"), (102, "version 3.14x is out")]
    out = {r.id: r for r in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string"), confidence=0.6).collect()}
    assert [(s.kind, s.start, s.stop) for s in out[100].added] == [(3, 18, 28)]
    assert [(s.kind, s.start, s.stop) for s in out[101].added] == [(3, 6, 16)]
    assert not out[102].added and not out[0].added and len(out[0].base) == 1
    assert pii.find_pii(awkward).count() == len(AWKWARD)
    assert pii.find_pii(empty).count() == 0


def test_contexts_at_production_settings(spark):
    """Runs of tokens and spelt-out addresses, behind contexts that base spans teach; base spans stay apart."""
    rows = [(i, f"Note {i % 3}: please call me at +1 555 010 {1000 + i} today") for i in range(12)]
    rows += [(20 + i, f"my address is user{i}@example.com thanks") for i in range(12)]
    rows += [(100, "please call me at 01234 567 890 now"), (101, "again 01234 567 890, ok"), (102, "my address is jane(at)corp.org!"),
             (103, "the figure is 1234 5678"), (104, "please call me at 1234/555 a@b.co")]
    out = {r.id: r for r in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    added = {k: [(s.kind, rows_text[s.start:s.stop]) for s in r.added] for k, r in out.items() for rows_text in [dict(rows)[k]] if r.added}
    assert added == {100: [(3, "01234 567 890")], 101: [(3, "01234 567 890")], 102: [(0, "jane(at)corp.org")], 104: [(3, "1234/555")]}


def test_occurrences_against_brute_force(spark):
    """Every token with a mark is an occurrence unless it touches a base span or lies in a run."""
    import random
    import re
    rnd = random.Random(4)
    words = ["a1", "12345", "1234", "+12345678", "x@y.co", "1.2.3.4", "the", "é", "4111111111111111", "jo(at)x", "99", "w,5555", "zz7-77", "[", "\n", "=8888"]
    texts = [" ".join(["so", *rnd.choices(words, k=rnd.randint(0, 40))]) for _ in range(150)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").withColumn("base", pii.base_spans(F.col("text")))
    got = {r.i: sorted((o.start, o.stop) for o in r.seen if o.kind is None) for r in pii.with_occurrences(df).select("i", "seen").collect()}
    token = re.compile(pii.TOKEN)
    for i, t in enumerate(texts):
        base = [s[1:] for s in pii.brute_force(t)]
        apart = lambda m, spans: all(b <= m.start() or m.end() <= a for a, b in spans)     # noqa: E731
        for m in token.finditer(t):
            if 4 <= len(m[0]) <= 64 and apart(m, base):
                stop = m.start() + len(re.sub(r"[.!?:)]+$", "", m[0]))
                assert any(a <= m.start() and stop <= b for a, b in got[i]), (t, m)
        assert all(b <= c or d <= a for a, b in got[i] for c, d in base)
        assert all(x[1] <= y[0] for x, y in zip(got[i], got[i][1:]))
        assert all(any(m.start() == a for m in token.finditer(t)) for a, _ in got[i])


def test_a_text_of_numbers_takes_seconds(spark):
    import time
    texts = [(1, " ".join(f"n {i * 7919 % 1000003:07d}" for i in range(100_000))), (2, "7 " * 300_000), (3, "a@b.co +12345678 " * 40_000)]
    begin = time.time()
    out = {r.id: r for r in pii.find_pii(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert time.time() - begin < 60
    assert not out[1].base and not out[2].base and len(out[3].base) == 80_000


def test_mask(spark):
    df = spark.createDataFrame([(1, "é a@b.co or 1.2.3.4!")], "doc_id long, text string")
    out = df.join(pii.find_pii(df).withColumnRenamed("id", "doc_id"), "doc_id").select(pii.mask(F.col("text"), F.col("base")).alias("m")).first()
    assert out.m == "é [email] or [ip]!"


# toxicity

def test_toxicity_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = toxicity.train(docs, labels)
    known = toxicity.with_score(docs.join(labels, "doc_id"), model).where(toxicity.fold(F.col("doc_id")) == 0).select("toxic", "toxicity").toPandas()
    hit = known.toxicity >= 0.5
    assert (hit == (known.toxic == 1)).mean() > 0.95
    assert hit[known.toxic == 1].mean() > 0.75 and hit[known.toxic == 0].mean() < 0.02


def test_factors_learn_what_weights_cannot():
    """The label is whether two terms come together or not at all: no weights can tell."""
    rng, rows, y = np.random.default_rng(0), [], []
    for _ in range(1500):
        terms, a, b = list(rng.integers(100, 160, 12)), rng.random() < 0.5, rng.random() < 0.5
        rows.append(np.unique(terms + [1] * a + [2] * b))
        y.append(int(a == b))
    model = toxicity.fit(rows[:1000], np.asarray(y[:1000]), buckets=256)
    assert ((model.scores(rows[1000:]) >= 0.5) == np.asarray(y[1000:])).mean() > 0.98


def test_toxicity_awkward(spark, awkward, empty):
    labels = spark.createDataFrame([(1, None), (None, 1), (4, 0), (4, 1), (7, 0), (99, 1)], "doc_id long, toxic int")
    model = toxicity.train(awkward, labels)
    out = toxicity.with_score(awkward, model)
    assert out.count() == len(AWKWARD) and out.where("toxicity between 0 and 1").count() == len(AWKWARD)
    assert toxicity.drop_toxic(awkward, model).columns == awkward.columns
    assert toxicity.drop_toxic(empty, toxicity.train(empty, labels)).count() == 0
    none = toxicity.train(awkward, labels.where("doc_id = 5"))
    assert toxicity.drop_toxic(awkward, none).count() == len(AWKWARD)


# packing

def check_packed(rows, want):
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(want)
    for k, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(want[k])
            assert r.ids_crc32 == zlib.crc32(np.asarray(want[k][at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(want[k])
    used = padded = 0
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= 2048
        used, padded = used + at, padded + (0 if at & (at - 1) == 0 else 2048 - at)
    assert padded <= 0.01 * used


@pytest.mark.parametrize("buffer_tokens", [packing.BUFFER_TOKENS, 3000])
def test_packing(docs, texts, unique, empty, buffer_tokens):
    from tokenizers import Tokenizer
    path = packing.default_tokenizer()
    tok = Tokenizer.from_file(path)
    for df, rows in ((docs, texts), (unique, [r[:2] for r in UNIQUE])):
        want = {k: tok.encode(t or "", add_special_tokens=False).ids + [1] for k, t in rows}
        check_packed(packing.pack(df, path, buffer_tokens=buffer_tokens).collect(), want)
    assert packing.pack(empty, path).count() == 0


def test_packing_awkward(awkward):
    """Null and repeated ids, clashing columns: every row is packed for itself, in full."""
    from tokenizers import Tokenizer
    path = packing.default_tokenizer()
    tok = Tokenizer.from_file(path)
    want = sorted((str(r.doc_id), len(tok.encode(r.text or "", add_special_tokens=False).ids) + 1) for r in awkward.select("doc_id", "text").collect())
    rows = packing.pack(awkward, path).collect()
    assert sorted((str(r.id), r.doc_tokens) for r in rows if r.start == 0) == want
    assert sum(r.length for r in rows) == sum(n for _, n in want)


def test_step_groups_are_balanced():
    """Long documents and short ones, several flushes: full groups, but for the last ones, of like cost."""
    rng = np.random.default_rng(3)
    packer, rows = packing.Packer(0, buffer_tokens=200_000), []
    for doc, n in enumerate([4096] * 60 + [int(x) for x in rng.integers(1, 9000, 300)] + [100_000]):
        packer.add(doc, b"\1\0\0\0" * n)
        if packer.held >= packer.limit:
            rows += packer.flush(False)
    before = len({r[8] for r in rows})
    rows += packer.flush(True)
    cost, members = {}, {}
    for r in rows:
        members.setdefault(r[8], set()).add(r[5])
        cost[r[8]] = cost.get(r[8], 0) + r[2] ** 2
    sizes = [len(members[g]) for g in sorted(members)]
    assert before > 5 and set(sizes[:before]) == {packing.STEP_SEQUENCES}
    assert max(sizes[before:]) <= packing.STEP_SEQUENCES and max(sizes[before:]) - min(sizes[before:]) <= 1
    full = [cost[g] for g in sorted(members)[:before]]
    assert max(full) < 1.6 * min(full)
    assert sum(r[2] for r in rows) == 4096 * 60 + 100_000 + sum(int(x) for x in np.random.default_rng(3).integers(1, 9000, 300))
    assert packer.flush(True) == []


def test_word_tokenizer_matches_whole_texts(texts):
    from tokenizers import Tokenizer
    path = packing.default_tokenizer()
    tok = Tokenizer.from_file(path)
    hard = ["", "a\x1cb c\x1fd", "x\u00a0y\u3000z   w", "é e\u0301 E\u0301. Σας ΣΑΣ. ΌΣΟΣ, İI", "don't we'll, <|endoftext|>x I'M.", "1234 $$ 漢字かな, 😀😀!",
            "\x85 \x0b\x0c", "a.,b c.,\nd!? e'. f\"! É. ñ,", None, "ſtreet ẞ ß Å K ﬁ", "\u0301a \u0301 b\u0301.", ". , ...", "\x00 a\x00b", "\u200bz \ufeffq",
            "<|ENDOFTEXT|> A<|endoftext|>1", "H\u0331 h\u0331 1\u0301 =\u0338", "a1'd 12'S ('ve).'re x2024-01-31y"]
    rng = random.Random(5)
    signs = [*"abstvdlmASTV019.,!'’-_<|>() \t\n\x1c\x00", "'ll", "H\u0331", "\u0301", "\u0338", "\u212a", "\u037e", "\xa0", "é", "İ", "漢", "²", "<|endoftext|>"]
    hard += ["".join(rng.choices(signs, k=rng.randint(0, 30))) for _ in range(3000)]
    for cache in (50, 10_000):
        own = packing.WordTokenizer(path, cache_words=cache)
        for rows in (hard, [t for _, t in texts][:150], [hard[3]], hard):
            assert [np.frombuffer(x, "<u4").tolist() for x in own.ids(rows)] == [tok.encode(t or "", add_special_tokens=False).ids for t in rows]


# preference formatting

def test_preference(spark):
    rows = [(1, True, 0, "user", "hi"), (1, True, 1, "assistant", "good"), (1, False, 0, "user", "hi"), (1, False, 1, "assistant", "bad é"), (1, False, 2, "user", None),
            (2, True, 0, "user", "same"), (2, False, 0, "user", "same"), (3, True, None, None, None), (3, True, 1, "assistant", ""),
            (4, True, 0, "user", "a"), (4, False, 0, "system", "a"), (None, True, 0, "user", "lost"), (5, True, 0, "user", "x"), (5, True, 0, "user", "x"), (5, False, 0, "user", "x")]
    df = spark.createDataFrame(rows, "p long, good boolean, turn int, role string, text string").withColumn("prompt", F.lit("clash"))
    out = {r.pair_id: r for r in preference.format_pairs(df, "p", "good").collect()}
    assert set(out) == {1, 2, 3, 4, 5}
    assert out[1].prompt == "<|user|>\nhi<|end|>\n" and out[1].n_prompt_turns == 1
    assert out[1].chosen == "<|assistant|>\ngood<|end|>\n" and out[1].rejected == "<|assistant|>\nbad é<|end|>\n<|user|>\n<|end|>\n"
    a, b = map(int, out[1].rejected_mask.split(":"))
    assert out[1].rejected[a:b] == "bad é<|end|>\n"
    assert out[2].prompt == "<|user|>\nsame<|end|>\n" and out[2].chosen == out[2].rejected == out[2].chosen_mask == ""
    assert out[3].prompt == "" and out[3].rejected is None and out[3].chosen == "<|assistant|>\n<|end|>\n<||>\n<|end|>\n" and out[3].chosen_mask == "14:22"
    assert out[4].n_prompt_turns == 0 and out[4].rejected.startswith("<|system|>")
    assert out[5].n_prompt_turns == 1 and out[5].chosen == "<|user|>\nx<|end|>\n" and out[5].rejected == ""
    assert preference.format_pairs(df.where("p = 99"), "p", "good").count() == 0


# quality

def test_label_model_recovers_accuracies():
    rng = np.random.default_rng(0)
    truth = rng.random(20000) < 0.7
    right = [0.9, 0.8, 0.75, 0.6]
    votes = np.stack([np.where(rng.random(20000) < 0.2, quality.SILENT, np.where(rng.random(20000) < a, truth, ~truth)) for a in right], 1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality.label_model(patterns, counts.astype(float))
    for j, a in enumerate(right):
        t = model.table[:, j, :2]
        got = (t[1, 1] + t[0, 0]) / t.sum()
        assert abs(got - a) < 0.05
    assert abs(model.good - 0.7) < 0.05


def test_quality(spark, awkward, empty):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    labels = spark.read.parquet(f"{SF_ORACLE}/labels.parquet")
    out = quality.scored(docs, quality.train(docs)).withColumnRenamed("id", "doc_id").join(labels, "doc_id").toPandas()
    assert ((out.score >= 0.5) == (out.quality == 1)).mean() > 0.9
    assert (out.score >= 0.5)[out.quality == 1].mean() > 0.97
    assert quality.scored(awkward, quality.train(awkward)).count() == len(AWKWARD)
    assert quality.scored(empty, quality.train(empty)).count() == 0


# components

def test_components_match_union_find(spark):
    from tidemark.llm.components import connected
    rng = np.random.default_rng(4)
    for edges in ([(i, i + 1) for i in range(60)], [(i + 1, 0) for i in range(200)],
                  [tuple(map(int, rng.integers(0, 120, 2))) for _ in range(90)], []):
        root = {}

        def find(x):
            root.setdefault(x, x)
            while root[x] != x:
                x = root[x]
            return x

        for a, b in edges:
            x, y = sorted((find(a), find(b)))
            root[y] = x
        want = {x: find(x) for x in root if find(x) != x}
        assert {r.a: r.b for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()} == want
