"""MinHash near-dedup with fast similarity sketches.

A document is the set of its distinct shingles (4 words here), as 64-bit hashes.  Its sketch has T
coordinates, filled in rounds: in round i < T each shingle is thrown into bin h_i(x) mod T with value
i + fraction; round T + j throws all shingles into bin j, so at the latest then every coordinate is
filled.  Each bin keeps its least value.  A set of n shingles needs about T ln T / n rounds, not T hashes
for each shingle, and equal coordinates still estimate the Jaccard similarity with concentration.

The T = BANDS * ROWS coordinates are cut in bands.  Two documents of similarity s share a band with
probability 1 - (1 - s^ROWS)^BANDS: over 0.9999995 at s = 0.8 (48 bands of 6 rows).

Documents with one shingle set are one class first.  The members of a bucket are linked to its least one
only, and the connected components of these star links are candidate groups: similar documents are in
one group.  A group of up to GROUP_SHINGLES shingles is solved in one task, which counts the shingles that
its members share through an inverted index and puts out one root per member, never pairs.  Larger
groups go on in rounds: the least member of each bucket's slots leads; the others of a different component
are verified with it on the full sets.  Components are updated, leaders leave, and buckets whose members
are in one component are done.  Slots grow 4-fold per round, so a bucket of unrelated members is through
in a logarithmic number of rounds and no link between two components is left untested.

Cases: null and empty texts, and texts without words, have an empty set and are linked with nothing.
Fewer words than a shingle: the whole sequence is the one shingle.  Rows that share an id are one node.
Rows with a null id are linked with nothing and kept.  Equal texts are linked.  An empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ASCII_LOWER, ASCII_UPPER, WordHashes, load, picked, pieces, spent, written
from tidemark.llm.components import connected

WORDS = 4
SIMILARITY = (80, 100)
BANDS, ROWS = 48, 6
#: Pairs of one leader that are verified in one group, as a mean.
CHUNK_PAIRS = 2048
#: Shingles (8 bytes each) of a candidate group that one task solves.
GROUP_SHINGLES = 4_000_000

_U = np.uint64
_MULT = [_U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, in place."""
    x ^= x >> _U(33)
    x *= _U(0xFF51AFD7ED558CCD)
    x ^= x >> _U(33)
    x *= _U(0xC4CEB9FE1A85EC53)
    x ^= x >> _U(33)
    return x


class Shingles:
    """Text to the sorted distinct 64-bit hashes of its word shingles."""

    def __init__(self, words: int = WORDS):
        self.words, self.hashes = words, WordHashes()

    def __call__(self, text: str | None) -> np.ndarray:
        h = self.hashes.of((text or "").encode("utf-8", "replace").lower().split())
        n = len(h)
        if n == 0:
            return h
        k = min(self.words, n)
        out = np.full(n - k + 1, _U(k))
        for j in range(k):
            out = mix((out + _MULT[j % 4]) ^ h[j:n - k + 1 + j]) * _MULT[(j + 1) % 4]
        return np.unique(out)


class Sketcher:
    """Fast similarity sketch of ``t`` coordinates."""

    def __init__(self, t: int, seed: int = 1):
        self.t = t
        self.seeds = mix(np.arange(1, 2 * t + 1, dtype=_U) * _MULT[0] + _U(seed))
        self.need = int(1.25 * t * math.log(t)) + 1

    def __call__(self, x: np.ndarray) -> np.ndarray:
        t, n = self.t, len(x)
        least, done = np.full(t, np.iinfo(_U).max), 0
        while done < 2 * t:
            rounds = min(t if done < t else 2 * t, done + max(1, min(-(-self.need // n), 1 + 4_000_000 // n)))
            i = np.arange(done, rounds, dtype=_U)
            h = mix(x[None, :] ^ self.seeds[done:rounds, None])
            # Key: bin, then round, then 44 bits of the hash.
            value = (i << _U(44))[:, None] | (h >> _U(20))
            if done < t:
                bins = ((h & _U(0xFFFFF)) * _U(t)) >> _U(20)
                key = np.sort(((bins << _U(54)) | value).ravel())
                b = (key >> _U(54)).astype(np.int64)
                first = np.flatnonzero(np.concatenate(([True], b[1:] != b[:-1])))
                at, value = b[first], key[first] & _U((1 << 54) - 1)
            else:
                at, value = i.astype(np.int64) - t, value.min(axis=1)
            least[at] = np.minimum(least[at], value)
            done = rounds
            if (least != np.iinfo(_U).max).all():
                break
        return least


def band_keys(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each band, the number of the band mixed in."""
    s = sketch[:bands * rows].reshape(bands, rows)
    out = np.arange(1, bands + 1, dtype=_U) * _MULT[1]
    for j in range(rows):
        out = mix((out + _MULT[j % 4]) ^ s[:, j])
    return out


def _features(docs: DataFrame, id_col: str, text_col: str, words: int, bands: int, rows: int) -> DataFrame:
    """id, size of the set, digest of the set (null when empty), band keys."""
    schema = f"id {docs.schema[id_col].dataType.simpleString()}, n long, digest binary, bands array<long>"

    def run(batches):
        shingles, sketch = Shingles(words), Sketcher(bands * rows)
        for batch in pieces(batches):
            n, digests, keys = [], [], []
            for t in batch.column(1):
                x = shingles(t.as_py())
                n.append(len(x))
                digests.append(hashlib.blake2b(x.tobytes(), digest_size=16).digest() if len(x) else None)
                keys.append(band_keys(sketch(x), bands, rows).view(np.int64) if len(x) else [])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(digests, pa.binary()),
                                              pa.array(keys, pa.list_(pa.int64()))], names=["id", "n", "digest", "bands"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def _sets(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """id and the sorted shingle hashes, as bytes."""
    schema = f"id {docs.schema[id_col].dataType.simpleString()}, s binary"

    def run(batches):
        shingles = Shingles(words)
        for batch in pieces(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([shingles(t.as_py()).tobytes() for t in batch.column(1)], pa.binary())], names=["id", "s"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def _verified(pairs: DataFrame, sets: DataFrame, similarity: tuple[int, int], label: str) -> DataFrame:
    """The pairs (a: leader, b) whose full sets are similar enough, written.

    A leader of very many pairs is copied to one group for each CHUNK_PAIRS of them.
    """
    pairs = written(pairs, label)
    chunks = max(1, math.ceil(pairs.count() / CHUNK_PAIRS))
    part = F.pmod(F.xxhash64("b"), F.lit(chunks)).alias("part")
    keyed = pairs.select("a", "b", part)
    left = keyed.select("a", "part").distinct().join(sets.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a")
    right = keyed.join(sets.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b")
    both = right.join(left, ["a", "part"]).select("a", "b", "sa", "sb")
    num, den = similarity

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), _U), np.frombuffer(y.as_buffer(), _U)
                small, large = sorted((len(x), len(y)))
                if den * small < num * large:
                    keep.append(False)
                    continue
                z = np.concatenate((x, y))
                z.sort(kind="stable")
                common = int((z[1:] == z[:-1]).sum())
                keep.append(den * common >= num * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    links = written(both.mapInArrow(run, pairs.schema), "near_links")
    spent(pairs)
    return links


def _links(buckets: DataFrame, sets: DataFrame, similarity: tuple[int, int]) -> DataFrame | None:
    """(a, b): the components (b the least id) that the verified candidates of the buckets (key, id) make."""
    parent, slots = None, 1
    buckets = written(buckets.withColumn("c", F.col("id")), "near_buckets")
    while True:
        # Buckets that still hold two components.
        open_ = buckets.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("key")
        live = written(buckets.join(open_, "key", "left_semi"), "near_buckets")
        spent(buckets)
        if live.isEmpty():
            spent(live)
            return parent
        slot = F.pmod(F.xxhash64("id", F.lit(slots)), F.lit(slots))
        # A bucket's least member leads in the first round, later the least of each slot.
        leaders = live.groupBy("key", slot.alias("slot")).agg(F.min_by(F.struct("id", "c"), "id").alias("l")).select("key", F.col("l.id").alias("a"), F.col("l.c").alias("ca"))
        leaders = written(leaders, "near_leaders")
        pairs = live.join(leaders, "key").where("c != ca and id != a").select(F.col("a"), F.col("id").alias("b")).distinct()
        links = _verified(pairs, sets, similarity, "near_pairs")
        rest = live.join(leaders.select("key", F.col("a").alias("id")), ["key", "id"], "left_anti")
        if links.isEmpty():
            buckets = written(rest, "near_buckets")
        else:
            known = links if parent is None else links.unionByName(parent)
            before, parent = parent, connected(known, "near_parent")
            spent(*[] if before is None else [before])
            named = rest.join(parent.select(F.col("a").alias("id"), F.col("b").alias("now")), "id", "left")
            buckets = written(named.select("id", "key", F.coalesce("now", "id").alias("c")), "near_buckets")
        spent(live, leaders, links)
        slots *= 4


def roots(sets: list[np.ndarray], similarity: tuple[int, int]) -> np.ndarray:
    """Number of the first member of each one's component.  Counts shared shingles by an inverted index."""
    num, den = similarity
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    owner, x = np.repeat(np.arange(len(sets)), size), np.concatenate(sets)
    order = np.argsort(x, kind="stable")
    posting = owner[order]                      # members of each shingle, in order
    first = np.concatenate(([True], x[order][1:] != x[order][:-1]))
    begin = np.empty(len(x), np.int64)          # of a shingle's postings
    at = np.empty(len(x), np.int64)             # of the member itself in them
    begin[order] = np.maximum.accumulate(np.where(first, np.arange(len(x)), 0))
    at[order] = np.arange(len(x))
    root = list(range(len(sets)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    ends = np.cumsum(size)
    for i in range(1, len(sets)):
        lo, hi = begin[ends[i] - size[i]:ends[i]], at[ends[i] - size[i]:ends[i]]
        n = hi - lo
        total = int(n.sum())
        if not total:
            continue
        earlier = posting[np.repeat(lo - np.cumsum(n) + n, n) + np.arange(total)]
        common = np.bincount(earlier, minlength=i)[:i]
        for j in np.flatnonzero(den * common >= num * (size[:i] + size[i] - common)).tolist():
            a, b = find(i), find(j)
            if a != b:
                root[max(a, b)] = min(a, b)
    return np.fromiter((find(i) for i in range(len(sets))), np.int64, len(sets))


def _solved(grouped: DataFrame, similarity: tuple[int, int], schema: str) -> DataFrame:
    """(a, b): root b of the members a that aren't it.  ``grouped``: g, id, s, sorted by g and id."""
    def run(batches):
        def solve(ids, sets):
            r = roots(sets, similarity)
            moved = np.flatnonzero(r != np.arange(len(ids)))
            return [(ids[i], ids[r[i]]) for i in moved.tolist()]

        g, ids, sets, out, types = None, [], [], [], None
        for batch in batches:
            types = (batch.schema.field(1).type,) * 2
            for group, key, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if group != g:
                    if len(ids) > 1:
                        out += solve(ids, sets)
                    g, ids, sets = group, [], []
                if not ids or ids[-1] != key:
                    ids.append(key)
                    sets.append(np.frombuffer(s.as_buffer(), _U).copy())
            if len(out) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=["a", "b"])
                out = []
        if len(ids) > 1:
            out += solve(ids, sets)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=["a", "b"])

    return grouped.mapInArrow(run, schema)


def components_of(rows: DataFrame, sizes: DataFrame, sets_of, similarity: tuple[int, int]) -> DataFrame | None:
    """(a, b), written: the least member b of a's component, for each a that isn't it; None when there is none.

    ``rows``: key (of a bucket), id.  ``sizes``: id, n (shingles of its set).  ``sets_of(ids)`` gives id, s
    of a table of distinct ids.
    """
    shared = rows.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("key", "lo")
    # Written, as a bucket may hold a third of all rows: adaptive execution splits joins of plain exchanges.
    shared = written(shared, "near_keys")
    stars = written(rows.join(shared, "key").where("id != lo").select(F.col("id").alias("a"), F.col("lo").alias("b")).distinct(), "near_stars")
    spent(shared)
    group = connected(stars, "near_groups")
    spent(stars)
    members = group.select(F.col("a").alias("id"), F.col("b").alias("g")).unionByName(group.select(F.col("b").alias("id"), F.col("b").alias("g")).distinct())
    members = written(members.join(sizes, "id"), "near_members")
    spent(group)
    if members.isEmpty():
        spent(members)
        return None
    sets = written(sets_of(members.select("id")), "near_sets")
    large = members.groupBy("g").agg(F.sum("n").alias("n")).where(F.col("n") > GROUP_SHINGLES).select("g")
    large = written(members.join(large, "g", "left_semi").select("id"), "near_large")
    few = members.select("id", "g") if large.isEmpty() else members.select("id", "g").join(large, "id", "left_anti")
    grouped = sets.join(few, "id").select("g", "id", "s").repartition("g").sortWithinPartitions("g", "id")
    kind = rows.schema["id"].dataType.simpleString()
    parent = written(_solved(grouped, similarity, f"a {kind}, b {kind}"), "near_parent")
    if not large.isEmpty():
        more = _links(rows.join(large, "id", "left_semi").select("key", "id"), sets, similarity)
        if more is not None:
            both = parent, more
            parent = written(parent.unionByName(more), "near_parent")
            spent(*both)
    spent(members, sets, large)
    return parent


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                    similarity: tuple[int, int] = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per document: id, n_shingles, component_id (least id of its component)."""
    feats = written(_features(docs, id_col, text_col, words, bands, rows), "near_features")
    real = feats.where("digest is not null and id is not null")
    # Classes of equal sets; only their least ids go on.
    classes = real.groupBy("digest").agg(F.min("id").alias("rep"), F.count("*").alias("size"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    classes = written(classes, "near_classes")

    def sets_of(ids: DataFrame) -> DataFrame:
        return _sets(picked(docs.select(id_col, text_col), ids.select(F.col("id").alias(id_col)), id_col), id_col, text_col, words)

    parent = components_of(classes.select(F.col("rep").alias("id"), F.explode("bands").alias("key")),
                           classes.groupBy(F.col("rep").alias("id")).agg(F.sum("n").alias("n")), sets_of, similarity)
    moved = classes.select("digest", "rep", "size")
    if parent is not None:
        moved = moved.join(parent.select(F.col("a").alias("rep"), F.col("b").alias("root")), "rep", "left") \
            .select("digest", "size", F.coalesce("root", "rep").alias("root"), "rep")
    else:
        moved = moved.withColumn("root", F.col("rep"))
    # Classes of one document that is its own component need no row.
    moved = moved.where("size > 1 or root != rep").select("digest", "root")
    out = feats.select("id", "n", "digest").join(moved, "digest", "left")
    return out.select("id", F.col("n").alias("n_shingles"),
                      F.when(F.col("id").isNotNull(), F.coalesce("root", "id")).alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with one document of each component; rows with a null id stay."""
    names = docs.columns
    gone = near_duplicates(docs, id_col, text_col, **how).where("id != component_id").select(F.col("id").alias(id_col)).distinct()
    return docs.join(gone, id_col, "left_anti").select(*names)


def op7(spark, sf_dir: str) -> DataFrame:
    """Every document with its component."""
    out = near_duplicates(load(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


OP7_SQL = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{ASCII_UPPER}', '{ASCII_LOWER}'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, list_slice(ws, i, i + least(4, len(ws)) - 1) AS g
      FROM d, unnest(range(1, len(ws) - least(4, len(ws)) + 2)) AS u(i) WHERE len(ws) > 0),
c AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT p.a, p.b FROM p JOIN c x ON x.doc_id = p.a JOIN c y ON y.doc_id = p.b WHERE 100 * k >= 80 * (x.n + y.n - k)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b)
SELECT d.doc_id, coalesce(c.n, 0) AS n_shingles, m.root AS component_id, d.doc_id = m.root AS kept
FROM d LEFT JOIN c USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS root FROM reach GROUP BY a) m USING (doc_id)
"""


def brute_force(docs: list[tuple], words: int = WORDS, similarity: tuple[int, int] = SIMILARITY) -> dict:
    """id -> (n_shingles, component_id) by comparing all pairs (for tests)."""
    import re
    sets = {}
    for key, t in docs:
        w = re.findall("[^\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        k = min(words, len(w))
        sets[key] = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set()
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    keys, (num, den) = sorted(sets), similarity
    holders: dict = {}
    for k in keys:
        tried = set()
        for s in sets[k]:
            tried.update(holders.setdefault(s, []))
            holders[s].append(k)
        for j in tried:
            common = len(sets[j] & sets[k])
            if den * common >= num * (len(sets[j]) + len(sets[k]) - common):
                a, b = sorted((find(j), find(k)))
                root[b] = a
    return {k: (len(sets[k]), find(k)) for k in keys}
