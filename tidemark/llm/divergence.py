"""Source divergence audit by token-start pointer sort.

1. Each task cuts its rows into shards of at most ``SHARD_BYTES`` of text.  A shard is one Arrow byte
   buffer, its documents in order of their (lang, source) group.  Suffix pointers to the word starts of
   the buffer are sorted by a multikey quicksort, one slice per group, eight bytes at a time.
2. Words that end together form equal runs: a run's length is the word's count in the group, the number of
   documents in it the document frequency.  So a shard puts out one row per group and term.
3. Spark adds these up per (lang, term, source), with one exchange by (lang, term), and keeps the terms in at
   least ``min_docs`` documents of their lang.
4. A second pass over the kept terms adds the divergences of all pairs of sources in each task, and picks
   candidates for the terms that a source uses more than its lang.  A term never leaves its task as pairs:
   only sums per pair do.

The driver and the tasks hold one number per (lang, source) group.  Groups are as many as there are sources,
and the result itself has a row for each pair of them, so this table is at most the root of the result.

Cases: null lang, source and text count as ''.  A text without terms still makes its group appear.  Repeated
rows count as often as they occur.  Langs without kept terms give pairs with value 0 and no terms.  A very
long text is one shard, in time linear in its length and memory of about ten times its bytes.  Ties rank by
the UTF-8 bytes of the item.  An empty table gives an empty result.  Only the three named columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ASCII_LOWER, ASCII_UPPER, load, share, shared, text_or_empty, written

SHARD_BYTES = 8 << 20
#: Slices of at most so many pointers are finished together, a chunk of eight bytes at a time.
SMALL_SLICE = 1 << 14
MIN_DOCS = 10
TOP_TERMS = 10
#: Cells of a task's table of pair sums, and of one block of term counts.
PAIR_CELLS, BLOCK_CELLS = 4 << 20, 1 << 20
SCALE_STEPS = (1000, 1000, 1000)

_BYTES = np.arange(256, dtype=np.uint8)
LETTER = (_BYTES >= 0x80) | ((_BYTES >= 0x41) & (_BYTES <= 0x5A)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A))
LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 0x20, _BYTES).astype(np.uint8)
#: First n bytes of a big-endian chunk.
FIRST = np.array([0] + [((1 << 8 * n) - 1) << 8 * (8 - n) for n in range(1, 9)], np.uint64)


class Pointers:
    """Word-start pointers into one byte buffer, in text order; ``doc`` is the document of each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        letter = LETTER[data]
        starts, ends = letter.copy(), letter.copy()
        starts[1:] &= ~letter[:-1]
        ends[:-1] &= ~letter[1:]
        whole = offsets[:-1] < offsets[1:]      # a word ends with its document
        first, last = offsets[:-1][whole], offsets[1:][whole] - 1
        starts[first], ends[last] = letter[first], letter[last]
        whole_number = np.int32 if len(data) < 1 << 31 else np.int64
        self.at = np.flatnonzero(starts).astype(whole_number)
        self.size = (np.flatnonzero(ends) + 1).astype(whole_number) - self.at
        self.doc = np.searchsorted(offsets, self.at, "right").astype(whole_number) - 1
        self.bytes = np.concatenate([LOWER[data], np.zeros(8, np.uint8)])
        self.chunks = np.ndarray(len(data) + 1, ">u8", self.bytes, strides=(1,))

    def chunk(self, which: np.ndarray, depth) -> np.ndarray:
        """Bytes ``depth`` to ``depth + 8`` of words, as big-endian numbers; zero beyond the word's end."""
        left = self.size[which] - depth
        return self.chunks[self.at[which] + depth].astype(np.uint64) & FIRST[np.minimum(left, 8)]

    def words(self, which: np.ndarray) -> pa.Array:
        size = self.size[which]
        stops = np.cumsum(size, dtype=np.int64)
        at = np.repeat(self.at[which] - (stops - size), size) + np.arange(stops[-1] if len(stops) else 0)
        offsets = np.concatenate([[0], stops]).astype(np.int64)
        return pa.LargeStringArray.from_buffers(len(which), pa.py_buffer(offsets), pa.py_buffer(self.bytes[at]))


def multikey_quicksort(p: Pointers, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, run starts): the pointers of each slice between ``bounds`` by their words, ties in text order."""
    order = np.arange(len(p.at))
    new = np.zeros(len(order) + 1, bool)
    new[bounds] = True
    stack = [(lo, hi, 0) for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()) if lo < hi]
    small = []
    while stack:
        lo, hi, depth = stack.pop()
        if hi - lo <= SMALL_SLICE:
            if hi - lo > 1:
                small.append((lo, hi, depth))
            continue
        part = order[lo:hi]
        key = p.chunk(part, depth)
        sample = np.sort(key[::max(1, len(key) // 9)])
        pivot = sample[len(sample) // 2]
        less, more = key < pivot, key > pivot
        same = part[~(less | more)]
        below, above = part[less], part[more]
        a, b = lo + len(below), hi - len(above)
        order[lo:a], order[a:b], order[b:hi] = below, same, above
        new[a] = new[b] = True
        stack += [(lo, a, depth), (b, hi, depth)]
        if int(pivot) & 0xFF:                  # words go on beyond this chunk
            stack.append((a, b, depth + 8))
    if small:
        lo, hi, depth = (np.array(c) for c in zip(*small))
        size = hi - lo
        place = np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(size.sum())
        slice_no, depth = np.repeat(np.arange(len(lo)), size), np.repeat(depth, size)
        while len(place):
            key = p.chunk(order[place], depth)
            by = np.lexsort((key, slice_no))
            order[place], key, depth = order[place][by], key[by], depth[by]
            fresh = np.concatenate([[True], (key[1:] != key[:-1]) | (slice_no[1:] != slice_no[:-1])])
            new[place[fresh]] = True
            slice_no = np.cumsum(fresh)
            more = (np.bincount(slice_no)[slice_no] > 1) & ((key & np.uint64(0xFF)) != 0)
            place, slice_no, depth = place[more], slice_no[more], depth[more] + 8
    return order, np.flatnonzero(new[:-1])


def shard_counts(lang: pa.Array, source: pa.Array, text: pa.Array) -> pa.RecordBatch:
    """(lang, source, term, n, df) of one shard."""
    langs, sources = lang.dictionary_encode(), source.dictionary_encode()
    group = langs.indices.to_numpy().astype(np.int64) * len(sources.dictionary) + sources.indices.to_numpy()
    by = np.argsort(group, kind="stable")
    text, group = text.cast(pa.large_string()).take(pa.array(by)), group[by]
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
    data = np.frombuffer(text.buffers()[2] or b"", np.uint8)[:offsets[-1]]
    p = Pointers(data, offsets)
    of = group[p.doc]
    bounds = np.concatenate([[0], np.flatnonzero(of[1:] != of[:-1]) + 1, [len(of)]]) if len(of) else np.zeros(1, np.int64)
    order, runs = multikey_quicksort(p, bounds)
    doc = p.doc[order]
    fresh = np.ones(len(doc), np.int64)
    fresh[1:] = doc[1:] != doc[:-1]
    fresh[runs] = 1
    of = of[order[runs]]
    n = np.diff(np.append(runs, len(order)))
    df = np.add.reduceat(fresh, runs) if len(runs) else fresh
    return pa.RecordBatch.from_arrays([
        langs.dictionary.take(pa.array(of // len(sources.dictionary))), sources.dictionary.take(pa.array(of % len(sources.dictionary))),
        p.words(order[runs]), pa.array(n, pa.int64()), pa.array(df, pa.int64())], names=["lang", "source", "term", "n", "df"])


def term_counts(docs: DataFrame, lang_col: str, source_col: str, text_col: str) -> DataFrame:
    """Rows (lang, source, term, n, df), several for a key: one of each shard it occurs in."""

    def run(batches):
        out = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.large_string()), ("n", pa.int64()), ("df", pa.int64())])
        for batch in batches:
            if not batch.num_rows:
                continue
            size = np.cumsum(pc.binary_length(batch.column(2)).to_numpy())
            lo = 0
            while lo < batch.num_rows:
                base = size[lo - 1] if lo else 0
                hi = max(lo + 1, int(np.searchsorted(size, base + SHARD_BYTES, "right")))
                rows = shard_counts(*(batch.column(i).slice(lo, hi - lo) for i in range(3)))
                for i in range(0, rows.num_rows, 100_000):
                    yield rows.slice(i, 100_000).cast(out)
                lo = hi

    return docs.select(*(text_or_empty(c).alias(f"c{i}") for i, c in enumerate((lang_col, source_col, text_col)))) \
        .mapInArrow(run, "lang string, source string, term string, n long, df long")


def kept_terms(counts: DataFrame, min_docs: int) -> DataFrame:
    """(lang, term, n, uses): terms in at least ``min_docs`` documents of their lang; uses: (source, n)."""
    per_source = counts.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    return per_source.groupBy("lang", "term") \
        .agg(F.sum("n").alias("n"), F.sum("df").alias("df"), F.collect_list(F.struct("source", "n")).alias("uses")) \
        .where(F.col("df") >= min_docs).drop("df")


def scaled(a: np.ndarray, b) -> np.ndarray:
    """1 + floor(10**9 * a / b) in whole numbers, for a <= b < 2**53; the product never overflows."""
    out, rest = np.zeros_like(a), a
    for step in SCALE_STEPS:
        rest = rest * step
        out = out * step + rest // b
        rest = rest % b
    return out + 1


class Sources:
    """The groups of each lang in order, their totals, and the lang's kept terms."""

    def __init__(self, rows):
        by: dict[str, list] = {}
        for r in rows:
            by.setdefault(r.lang, []).append((r.source, r.total, r.terms))
        self.names = {k: [x[0] for x in sorted(v)] for k, v in by.items()}
        self.totals = {k: np.array([x[1] for x in sorted(v)], np.int64) for k, v in by.items()}
        self.terms = {k: v[0][2] for k, v in by.items()}
        self.place = {k: {s: i for i, s in enumerate(v)} for k, v in self.names.items()}


def _divergences(kept: DataFrame, sources) -> DataFrame:
    """(lang, source, part, item, value): sums per pair (source < item) of each task, and term candidates."""
    out = pa.schema([(c, pa.string()) for c in ("lang", "source", "part", "item")] + [("value", pa.int64())])

    def run(batches):
        groups = shared(sources)
        sums: dict[tuple[str, int], np.ndarray] = {}

        def put_out():
            for (lang, first), table in sums.items():
                names = groups.names[lang]
                i, j = np.nonzero(table)
                for k in range(0, len(i), 50_000):
                    a, b = i[k:k + 50_000], j[k:k + 50_000]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([lang] * len(a)), pa.array([names[x + first] for x in a]), pa.array(["pair"] * len(a)),
                        pa.array([names[x] for x in b]), pa.array(table[a, b])], schema=out)
            sums.clear()

        def add(lang: str, count: np.ndarray):
            """``count``: occurrences, one row for each source of the lang and one column for each term."""
            p = scaled(count + 2, (groups.totals[lang] + 2 * groups.terms[lang])[:, None])
            rows = max(1, PAIR_CELLS // len(p))
            for first in range(0, len(p), rows):
                table = sums.setdefault((lang, first), np.zeros((min(rows, len(p) - first), len(p)), np.int64))
                for i in range(len(table)):
                    me, rest = p[first + i], p[first + i + 1:]
                    table[i, first + i + 1:] += ((rest - me) ** 2 // (rest + me)).sum(axis=1)
                if sum(map(np.size, sums.values())) > PAIR_CELLS:
                    yield from put_out()
            return p

        def candidates(lang: str, terms: list[str], count: np.ndarray, p: np.ndarray, n: np.ndarray):
            q = scaled(n + 2, np.int64(groups.totals[lang].sum() + 2 * groups.terms[lang]))
            for i, name in enumerate(groups.names[lang]):
                at = np.flatnonzero((count[i] > 0) & (p[i] > q))
                value = (p[i, at] - q[at]) ** 2 // (p[i, at] + q[at])
                if len(at) > TOP_TERMS:        # ties with the last place stay
                    best = value >= np.partition(value, -TOP_TERMS)[-TOP_TERMS]
                    at, value = at[best], value[best]
                if len(at):
                    yield pa.RecordBatch.from_arrays([
                        pa.array([lang] * len(at)), pa.array([name] * len(at)), pa.array(["term"] * len(at)),
                        pa.array([terms[k] for k in at]), pa.array(value)], schema=out)

        for batch in batches:
            lang_of = np.array(batch.column(0).to_pylist(), object)
            for lang in dict.fromkeys(lang_of):
                mine = batch.take(pa.array(np.flatnonzero(lang_of == lang)))
                place, wide = groups.place[lang], len(groups.names[lang])
                step = max(1, BLOCK_CELLS // wide)
                for k in range(0, mine.num_rows, step):
                    block = mine.slice(k, step)
                    uses = block.column(3)
                    who = np.array([place[s] for s in uses.flatten().field(0).to_pylist()], np.int64)
                    count = np.zeros((wide, block.num_rows), np.int64)
                    count[who, np.repeat(np.arange(block.num_rows), uses.value_lengths().to_numpy())] = uses.flatten().field(1).to_numpy()
                    p = yield from add(lang, count)
                    yield from candidates(lang, block.column(1).to_pylist(), count, p, block.column(2).to_numpy())
        yield from put_out()

    return kept.select("lang", "term", "n", "uses").mapInArrow(run, "lang string, source string, part string, item string, value long")


def audit(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
          min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): how each source differs from the others of its lang, and by which terms.

    ``top`` is at most ``TOP_TERMS``.
    """
    spark = docs.sparkSession
    kept = written(kept_terms(term_counts(docs, lang_col, source_col, text_col), min_docs), "divergence_terms")
    groups = docs.select(text_or_empty(lang_col).alias("lang"), text_or_empty(source_col).alias("source")).distinct()
    totals = kept.select("lang", F.explode("uses").alias("u")).groupBy("lang", F.col("u.source").alias("source")).agg(F.sum("u.n").alias("total"))
    terms = kept.groupBy("lang").agg(F.count("*").alias("terms"))
    groups = written(groups.join(totals, ["lang", "source"], "left").join(terms, "lang", "left")
                     .select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("terms", F.lit(0)).alias("terms")),
                     "divergence_groups")
    parts = written(_divergences(kept, share(spark, Sources(groups.collect()))), "divergence_parts")

    half = parts.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    both = half.unionByName(half.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    pairs = groups.select("lang", "source").join(groups.select("lang", F.col("source").alias("item")), "lang") \
        .where(F.col("source") != F.col("item")).join(both, ["lang", "source", "item"], "left") \
        .select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).cast("long").alias("value"))
    places = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    best = parts.where("part = 'term'").withColumn("rank", F.row_number().over(places)).where(F.col("rank") <= min(top, TOP_TERMS))
    return pairs.withColumn("rank", F.row_number().over(places)).unionByName(best)


def op11(spark, sf_dir: str) -> DataFrame:
    """The audit of every document."""
    return audit(load(spark, sf_dir, "documents"))


OP11_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  translate(coalesce(text, ''), '{ASCII_UPPER}', '{ASCII_LOWER}') AS t FROM documents),
w AS (SELECT id, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= {MIN_DOCS}),
v AS (SELECT lang, count(*) AS terms, sum(n)::BIGINT AS total FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM w GROUP BY lang, source, term),
dense AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS lang_n
          FROM g JOIN kept k ON g.lang = k.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
t AS (SELECT lang, source, sum(n)::BIGINT AS total FROM dense GROUP BY lang, source),
p AS (SELECT e.lang, e.source, e.term, e.n, 1 + (1000000000 * (e.n + 2)) // (t.total + 2 * v.terms) AS p,
             1 + (1000000000 * (e.lang_n + 2)) // (v.total + 2 * v.terms) AS q
      FROM dense e JOIN t ON e.lang = t.lang AND e.source = t.source JOIN v ON e.lang = v.lang),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p))::BIGINT AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value
          FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
           FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {TOP_TERMS}
"""
