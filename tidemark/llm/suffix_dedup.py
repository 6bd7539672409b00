"""Substring dedup by a distributed merge of sorted suffixes.

Removed is each byte covered by a string of ``LENGTH`` bytes that also starts in a document with a
smaller id.  The work is cut down in exact steps before suffixes are sorted:

1. Documents with equal texts: all but the one with the least id are covered whole.
2. Each window of ``LENGTH`` bytes has one anchor, its K-byte string of least hash (leftmost), which
   depends on the window's bytes alone.  Windows that are equal in two documents so have equal anchors.
   A document has about one anchor for 16 bytes.  Fingerprints of anchors are exchanged in sorted runs;
   anchors in one text only are dropped.  False matches cost work, not correctness.
3. A surviving anchor becomes a suffix: the bytes from the anchor on, then those before it in reverse,
   as far as the windows of the anchor reach.  Each task sorts its suffixes, cuts them into buckets and
   front-codes each run (length of the common prefix, rest).  A bucket merges its runs with a loser tree
   whose nodes keep the common prefix with the last winner, so known prefixes are never compared again.
   Equal suffixes come out together; their least id covers the others.  Equal suffixes of one run are
   settled in the task: only the least id goes on.  Suffixes of a hot anchor (a line that very many texts
   share) go on as single windows, which are dealt by their own hash and so do not meet in one task.
4. Distinct suffixes of one bucket may still share windows (a passage's ends).  Their windows are grouped
   by a hash and each is compared in full with its group's first, so a hash never decides alone.

Covered spans go back to the documents, are united and cut.  Texts are exchanged twice (joined with their
anchors and with their spans) by document id, so no text of a hot group meets its copies in one task.

Cases: null is the empty text.  A null id is larger than all others.  Rows that share an id are not
smaller than each other; equal rows get equal results.  Texts shorter than ``LENGTH`` lose nothing.  Ids
must be integers.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import load, picked, text_or_empty, written
from tidemark.llm.fingerprints import SCATTERED, by_value, gathered, repeated, scattered, squeezed, unsqueezed
from tidemark.llm.near_dedup import mix

LENGTH = 50
K = 19
#: Text bytes whose anchors meet in one bucket.
BUCKET_BYTES = 8 << 20
#: Suffixes that a task sorts into one run, and windows that a bucket compares at a time.
RUN_SUFFIXES, PART_WINDOWS = 300_000, 500_000
_NO_ID = (1 << 63) - 1
_U = np.uint64
_BACK = LENGTH - K            # bytes before an anchor that its windows reach
_CTX = _BACK + LENGTH         # bytes around an anchor
_KEY = _CTX + 4               # and the clipped lengths and first and last window
_PLACES = (*range(0, LENGTH - 8, 8), LENGTH - 8)   # 8-byte pieces that make up a window
_M = [_U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def _loads(buf: np.ndarray) -> np.ndarray:
    """The 8 bytes at every offset of ``buf`` as a number (7 bytes of padding needed)."""
    return np.ndarray(shape=(len(buf) - 7,), dtype="<u8", buffer=buf, strides=(1,))


def anchors(text: bytes) -> tuple[np.ndarray, np.ndarray] | None:
    """Hash of the K bytes at every offset, and for every window the offset of its anchor."""
    if len(text) < LENGTH:
        return None
    v = _loads(np.frombuffer(text + bytes(8), np.uint8))
    m, w = len(text) - K + 1, LENGTH - K + 1
    h = v[:m] * _M[0]
    h ^= h >> _U(29)
    h += v[8:8 + m]
    h *= _M[1]
    h ^= h >> _U(29)
    h += v[K - 8:K - 8 + m]
    h *= _M[2]
    h ^= h >> _U(32)
    x, s = (h & _U(0xFFFFFFFF00000000)) | np.arange(m, dtype=_U), 1
    while s * 2 <= w:
        x = np.minimum(x[:-s], x[s:])
        s *= 2
    if s < w:
        x = np.minimum(x[:-(w - s)], x[w - s:])
    return h, (x & _U(0xFFFFFFFF)).astype(np.int64)


def _runs(a: np.ndarray) -> np.ndarray:
    """First windows of the runs that share an anchor."""
    return np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1])))


def _digest(text: bytes) -> bytes:
    return hashlib.blake2b(text, digest_size=16).digest()


# 1. Documents

def _features(texts: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            raw = [t.as_buffer().to_pybytes() for t in batch.column(1)]
            digests = [_digest(t) for t in raw]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(digests, pa.binary()), pa.array([int.from_bytes(d[:8], "little", signed=True) for d in digests], pa.int64()),
                pa.array(list(map(len, raw)), pa.int64()), pa.array([hashlib.sha256(t).hexdigest() for t in raw], pa.string())],
                names=["oid", "digest", "k8", "n", "sha"])

    return texts.mapInArrow(run, "oid long, digest binary, k8 long, n long, sha string")


# 2. Anchors that occur in two texts

def _anchor_hashes():
    def find(_, text: bytes):
        name = int.from_bytes(_digest(text)[:8], "little", signed=True)
        found = anchors(text)
        if not found:
            return name, np.zeros(0, _U), np.zeros(0, np.int64)
        h, a = found
        p = a[_runs(a)]
        return name, mix(h[p]), p

    return find


# 3. Sorted suffix runs and their merge

def _suffixes(text: bytes, wanted: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys (rows of bytes), offsets and bucket hashes of the wanted anchors and of the windows of hot ones."""
    h, a = anchors(text)
    s0 = _runs(a)
    s1 = np.concatenate((s0[1:], [len(a)])) - 1
    p = a[s0]
    padded = np.frombuffer(bytes(_BACK) + text + bytes(LENGTH), np.uint8)
    split = np.isin(p, hot)
    n = (s1 - s0 + 1)[split]
    start = np.repeat(s0[split] - np.cumsum(n) + n, n) + np.arange(n.sum())
    at = np.isin(p, wanted) & ~split
    s0, s1, p = s0[at], s1[at], p[at]
    key = np.zeros((len(p) + len(start), _KEY), np.uint8)
    around = padded[p[:, None] + np.arange(_CTX)]
    own = key[:len(p)]
    own[:, :LENGTH] = around[:, _BACK:]
    own[:, LENGTH:_CTX] = around[:, :_BACK][:, ::-1]
    own[:, _CTX] = np.minimum(LENGTH, len(text) - p)
    own[:, _CTX + 1] = np.minimum(_BACK, p)
    own[:, _CTX + 2], own[:, _CTX + 3] = p - s0, p - s1
    # A window is a suffix of LENGTH bytes that reaches no byte back.
    windows = key[len(p):]
    windows[:, :LENGTH] = padded[(_BACK + start)[:, None] + np.arange(LENGTH)]
    windows[:, _CTX] = LENGTH
    deal = np.zeros(len(start), _U)
    v = _loads(padded)
    for j, o in enumerate(_PLACES):
        deal = mix((deal + _M[j % 3]) ^ v[_BACK + start + o])
    return key, np.concatenate((p, start)), np.concatenate((mix(h[p]), deal)) & _U(0xFFFFFFFF)


def front_coded(keys: np.ndarray) -> tuple[bytes, bytes]:
    """Of sorted keys: lengths of the prefix shared with the one before, and the rests."""
    n, width = keys.shape
    differ = keys[1:] != keys[:-1]
    lcp = np.concatenate(([0], np.where(differ.any(axis=1), differ.argmax(axis=1), width))).astype(np.uint8)
    return lcp.tobytes(), keys[np.arange(width)[None, :] >= lcp[:, None]].tobytes()


def _suffix_runs(joined: DataFrame, buckets: int) -> DataFrame:
    """Sorted front-coded runs, by bucket.  ``joined``: oid, text, digest, wanted and hot (offsets).

    A row without ``rest`` holds spans that are known to be covered: ids, first and last bytes.
    """
    def sorted_run(keys, pos, oid, bucket):
        keys, pos, oid, bucket = np.concatenate(keys), np.concatenate(pos), np.concatenate(oid), np.concatenate(bucket)
        order = np.argsort(keys.view(f"S{_KEY}").ravel(), kind="stable")
        keys, pos, oid, bucket = keys[order], pos[order], oid[order], bucket[order]
        # Equal suffixes: the least id goes on (each of its places), the others are covered.
        first = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]).any(axis=1))))
        least = np.repeat(np.minimum.reduceat(oid, first), np.diff(np.concatenate((first, [len(oid)]))))
        done, rows = oid > least, []
        if done.any():
            begin, end = pos[done].astype(np.int64) - keys[done, _CTX + 2], pos[done].astype(np.int64) - keys[done, _CTX + 3] + LENGTH
            rows.append((int(oid[0] % buckets), b"", b"", squeezed(oid[done].astype("<i8")), squeezed(begin.astype("<u4")), squeezed(end.astype("<u4"))))
        keys, pos, oid, bucket = keys[~done], pos[~done], oid[~done], bucket[~done]
        for b, at in by_value((bucket % _U(buckets)).astype(np.int64)):
            ids, local = np.unique(oid[at], return_inverse=True)
            lcp, rest = front_coded(keys[at])
            rows.append((b, squeezed(np.frombuffer(lcp, np.uint8)), squeezed(np.frombuffer(rest, np.uint8)), squeezed(ids.astype("<i8")),
                         squeezed(local.astype("<u4")), squeezed(pos[at])))
        cols = list(zip(*rows))
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *(pa.array(c, pa.binary()) for c in cols[1:])],
                                          names=["bucket", "lcp", "rest", "ids", "doc", "pos"])

    def run(batches):
        held, n = ([], [], [], []), 0
        for batch in batches:
            for i, t, d, w, hot in zip(*batch.columns):
                text = t.as_buffer().to_pybytes()
                if _digest(text) != d.as_py() or len(text) < LENGTH:
                    continue   # another row with the same id
                key, p, b = _suffixes(text, *(np.frombuffer(x.as_py(), "<u4").astype(np.int64) for x in (w, hot)))
                for of, x in zip(held, (key, p.astype("<u4"), np.full(len(p), i.as_py()), b)):
                    of.append(x)
                n += len(p)
                if n >= RUN_SUFFIXES:
                    yield sorted_run(*held)
                    held, n = ([], [], [], []), 0
        if n:
            yield sorted_run(*held)

    return joined.mapInArrow(run, "bucket int, lcp binary, rest binary, ids binary, doc binary, pos binary")


class _Run:
    """Decodes one front-coded run; ``key`` is the current suffix, ``lcp`` what it shares with the last winner."""

    __slots__ = ("lcps", "rest", "at", "i", "key", "lcp", "number")

    def __init__(self, number: int, lcps: bytes, rest: bytes):
        self.lcps, self.rest, self.number = lcps, rest, number
        self.at = self.i = 0
        self.key, self.lcp = b"", 0

    def advance(self) -> bool:
        if self.i == len(self.lcps):
            self.key = None
            return False
        n = self.lcps[self.i]
        if n < _KEY:
            end = self.at + _KEY - n
            self.key = self.key[:n] + self.rest[self.at:end]
            self.at = end
        # This run was the last winner, so the coded length is what it shares with the last winner.
        self.lcp = n
        self.i += 1
        return True


def _common(a: bytes, b: bytes, start: int) -> int:
    """Length of the common prefix, known to be ``start`` at least."""
    if a[start:] == b[start:]:
        return _KEY
    while a[start:start + 8] == b[start:start + 8]:
        start += 8
    while a[start] == b[start]:
        start += 1
    return start


def merged(runs: list[_Run]):
    """(shares the whole key with the one before, run number, index in the run) in sorted order.

    A loser tree.  Every loser keeps its common prefix with the winner that it lost to.  Of two
    suffixes the one that shares more with the last winner is smaller; only if both share the same are
    bytes behind the known prefix compared.
    """
    k = 1
    while k < len(runs):
        k *= 2
    tree: list[_Run | None] = [None] * k

    def play(x: _Run | None, y: _Run | None):
        """(winner, loser); the loser's lcp becomes what it shares with the winner."""
        if x is None or x.key is None:
            return y, x
        if y is None or y.key is None:
            return x, y
        if x.lcp > y.lcp:
            return x, y
        if y.lcp > x.lcp:
            return y, x
        n = _common(x.key, y.key, x.lcp)
        if n == _KEY or x.key[n] < y.key[n]:
            y.lcp = n
            return x, y
        x.lcp = n
        return y, x

    def build(node: int):
        if node >= k:
            i = node - k
            if i >= len(runs):
                return None
            runs[i].advance()
            return runs[i]
        winner, tree[node] = play(build(2 * node), build(2 * node + 1))
        return winner

    top = build(1) if k > 1 else (runs[0] if runs and runs[0].advance() else None)
    first = True
    while top is not None and top.key is not None:
        yield (not first and top.lcp == _KEY), top.number, top.i - 1
        first = False
        top.advance()
        node = (top.number + k) >> 1
        while node:
            top, tree[node] = play(top, tree[node])
            node >>= 1


# 4. Covered spans of a bucket

def _least_by_window(flat: np.ndarray, at: np.ndarray, least: np.ndarray) -> np.ndarray:
    """For windows that start at offsets ``at`` of ``flat``: the least id with equal bytes."""
    v = _loads(flat)
    h = np.zeros(len(at), _U)
    for j, o in enumerate(_PLACES):
        h = mix((h + _M[j % 3]) ^ v[at + o])
    out = np.empty(len(at), np.int64)
    # Parts by hash keep equal windows together and bound the memory.
    for _, part in by_value((h % _U(len(at) // PART_WINDOWS + 1)).astype(np.int64)):
        order = part[np.argsort(h[part], kind="stable")]
        first = np.flatnonzero(np.concatenate(([True], h[order][1:] != h[order][:-1])))
        head = np.repeat(order[first], np.diff(np.concatenate((first, [len(order)]))))
        if all((v[at[order] + o] == v[at[head] + o]).all() for o in _PLACES):
            out[order] = np.repeat(np.minimum.reduceat(least[order], first), np.diff(np.concatenate((first, [len(order)]))))
        else:
            # Two strings with one hash: group by the bytes themselves.
            found: dict[bytes, int] = {}
            keys = [flat[a:a + LENGTH].tobytes() for a in at[order].tolist()]
            for key, i in zip(keys, least[order].tolist()):
                found[key] = min(i, found.get(key, i))
            out[order] = [found[key] for key in keys]
    return out


def _covered(parts: int):
    def covered(table: pa.Table) -> pa.Table:
        """Of one bucket: first and last bytes of covered spans, by document."""
        runs, ids, pos, base, found = [], [], [], [0], []
        for lcp, rest, own, doc, p in zip(*(table.column(c).to_pylist() for c in ("lcp", "rest", "ids", "doc", "pos"))):
            if not rest:   # settled in the run
                found.append([unsqueezed(x, kind).astype(np.int64) for x, kind in ((own, "<i8"), (doc, "<u4"), (p, "<u4"))])
                continue
            runs.append(_Run(len(runs), unsqueezed(lcp, "u1").tobytes(), unsqueezed(rest, "u1").tobytes()))
            ids.append(unsqueezed(own, "<i8")[unsqueezed(doc, "<u4")])
            pos.append(unsqueezed(p, "<u4").astype(np.int64))
            base.append(base[-1] + len(pos[-1]))
        if runs:
            found.append(_compared(runs, np.concatenate(ids), np.concatenate(pos), base))
        docs, starts, stops = (np.concatenate(x) for x in zip(*found))
        return scattered(docs, starts.astype(_U) << _U(32) | stops.astype(_U), parts)

    return covered


def _spans(values: np.ndarray) -> tuple[bytes]:
    """United spans of one document."""
    return (united(np.stack((values >> _U(32), values & _U(0xFFFFFFFF)), 1).astype(np.int64)).astype("<u4").tobytes(),)


def _compared(runs: list[_Run], ids: np.ndarray, pos: np.ndarray, base: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, first and last bytes of the spans that the merged runs show to be covered."""
    group, keys, g = np.empty(len(ids), np.int64), [], -1
    for same, r, i in merged(runs):
        if not same:
            g += 1
            keys.append(runs[r].key)
        group[base[r] + i] = g
    keys = np.frombuffer(b"".join(keys), np.uint8).reshape(-1, _KEY)
    least = np.full(len(keys), _NO_ID)
    np.minimum.at(least, group, ids)
    flat = np.concatenate((np.concatenate((keys[:, LENGTH:_CTX][:, ::-1], keys[:, :LENGTH]), axis=1).ravel(), np.zeros(8, np.uint8)))
    first, last = keys[:, _CTX + 2].astype(np.int64), keys[:, _CTX + 3].astype(np.int64)
    # Every window of every distinct suffix: first..last bytes before the anchor, descending.
    count = first - last + 1
    owner = np.repeat(np.arange(len(keys)), count)
    back = first[owner] - (np.arange(len(owner)) - (np.cumsum(count) - count)[owner])
    small = _least_by_window(flat, owner * _CTX + _BACK - back, least[owner])
    # An entry's window is covered when an equal one has a smaller id.
    starts, stops, docs = [], [], []
    whole = ids > least[group]
    e = np.flatnonzero(whole)
    starts.append(pos[e] - first[group[e]])
    stops.append(pos[e] - last[group[e]] + LENGTH)
    docs.append(ids[e])
    hit = small < least[owner]
    e = np.flatnonzero(~whole & (np.bincount(owner, hit, len(keys)) > 0)[group])
    if len(e):
        # Runs of hit windows of each such suffix.
        edge = np.concatenate(([True], owner[1:] != owner[:-1]))
        on = np.flatnonzero(hit & (edge | ~np.concatenate(([False], hit[:-1]))))
        off = np.flatnonzero(hit & (np.concatenate((edge[1:], [True])) | ~np.concatenate((hit[1:], [False]))))
        low = np.searchsorted(owner[on], group[e])
        n = np.searchsorted(owner[on], group[e], "right") - low
        which = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        starts.append(np.repeat(pos[e], n) - back[on[which]])
        stops.append(np.repeat(pos[e], n) - back[off[which]] + LENGTH)
        docs.append(np.repeat(ids[e], n))
    return np.concatenate(docs), np.concatenate(starts), np.concatenate(stops)


# 5. Documents again

def united(spans: np.ndarray) -> np.ndarray:
    """Maximal runs of (start, stop) rows."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    end = np.maximum.accumulate(spans[:, 1])
    new = np.concatenate(([True], spans[1:, 0] > end[:-1]))
    first = np.flatnonzero(new)
    return np.stack((spans[first, 0], end[np.concatenate((first[1:], [len(spans)])) - 1]), 1)


def _cut(joined: DataFrame) -> DataFrame:
    """``joined``: oid, text, digest, spans.  The text without its spans, and their numbers."""
    def run(batches):
        for batch in batches:
            rows = []
            for i, t, d, s in zip(*batch.columns):
                text = t.as_buffer().to_pybytes()
                if _digest(text) != d.as_py():
                    continue
                u = np.frombuffer(s.as_py(), "<u4").reshape(-1, 2).astype(np.int64)
                kept, at = [], 0
                for x, y in u.tolist():
                    kept.append(text[at:x])
                    at = y
                kept = b"".join(kept) + text[at:]
                rows.append((i.as_py(), d.as_py(), len(text) - len(kept), len(u), hashlib.sha256(kept).hexdigest(), kept))
            cols = list(zip(*rows)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.binary()))],
                                             names=["oid", "digest", "n_removed", "n_spans", "kept_sha256", "kept"])

    return joined.mapInArrow(run, "oid long, digest binary, n_removed long, n_spans long, kept_sha256 string, kept binary")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_kept: bool = False) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, kept_sha256[, kept].

    ``kept`` (bytes) is null where nothing was removed, and empty where everything was.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("oid"), text_or_empty(text_col).cast("binary").alias("text"))
    feats = written(_features(texts), "suffix_features")
    total = feats.agg(F.sum("n")).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / BUCKET_BYTES))
    classes = written(feats.groupBy("digest", "k8").agg(F.min("oid").alias("oid")), "suffix_classes")
    wanted = repeated(texts, buckets, _anchor_hashes).withColumnRenamed("own", "k8").join(classes, "k8").select("oid", "digest", F.col("pos").alias("wanted"), "hot")
    joined = texts.join(written(wanted, "suffix_anchors"), "oid").select("oid", "text", "digest", "wanted", "hot")
    covered = gathered(_suffix_runs(joined, buckets).groupBy("bucket").applyInArrow(_covered(buckets), SCATTERED), "oid", ["spans"], _spans)
    spans = written(covered.join(classes, "oid").select("oid", "digest", "spans"), "suffix_spans")
    cut = _cut(picked(texts, spans, "oid").join(spans, "oid").select("oid", "text", "digest", "spans"))
    cut = cut if with_kept else cut.drop("kept")
    cut = cut.dropDuplicates(["oid", "digest"])
    least = classes.select("digest", F.col("oid").alias("least"))
    out = feats.drop("k8").join(least, "digest").join(cut, ["oid", "digest"], "left")
    copy = (F.col("oid") > F.col("least")) & (F.col("n") >= LENGTH)
    empty = hashlib.sha256(b"").hexdigest()
    cols = [F.when(copy, F.col("n")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
            F.when(copy, F.lit(1).cast("long")).otherwise(F.coalesce("n_spans", F.lit(0).cast("long"))).alias("n_spans"),
            F.when(copy, F.lit(empty)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256")]
    if with_kept:
        cols.append(F.when(copy, F.lit(b"")).otherwise(F.col("kept")).alias("kept"))
    id_type = docs.schema[id_col].dataType
    return out.select(F.when(F.col("oid") != _NO_ID, F.col("oid")).cast(id_type).alias("id"), F.col("n").alias("n_bytes"), *cols)


def op8(spark, sf_dir: str) -> DataFrame:
    """Every document without the byte strings that an earlier one has."""
    return remove_repeats(load(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def brute_force(docs: list[tuple]) -> dict:
    """id -> (n_bytes, n_removed, n_spans, kept_sha256), window by window (for tests)."""
    least: dict[bytes, int] = {}
    raw = {k: (t or "").encode() for k, t in docs}
    for k, t in raw.items():
        for i in range(len(t) - LENGTH + 1):
            w = t[i:i + LENGTH]
            least[w] = min(k, least.get(w, k))
    out = {}
    for k, t in raw.items():
        gone = bytearray(len(t))
        for i in range(len(t) - LENGTH + 1):
            if least[t[i:i + LENGTH]] < k:
                gone[i:i + LENGTH] = b"\1" * LENGTH
        kept = bytes(c for c, g in zip(t, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[k] = (len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out
