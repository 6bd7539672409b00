"""Which places of a text have a hash that another text has too.

Every task packs the hashes of its texts into one sorted run per bucket: 32-bit fingerprints, the text and
the place of each.  A bucket joins its runs and answers, for each text, with the places whose
fingerprint is in two texts.  A chance match (about one place in 2,000 of a full bucket) is harmless: what
is answered are candidates only.

Hot hashes do not meet in one task.  A hash that a run has in two texts and more than ``RUN_HOT`` times is
known to repeat: the run answers its places itself and sends two of them, marked, for the other runs.
Places of a hash that is marked, or that a bucket has more than ``BUCKET_HOT`` times, are answered as hot,
so the caller can split them further; all runs agree on that.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.near_dedup import mix

#: Places that a task packs into one run.
RUN_PLACES = 1_000_000
RUN_HOT, BUCKET_HOT = 500, 10_000
_U = np.uint64


def squeezed(a: np.ndarray) -> bytes:
    """Numbers as compressed bytes: all first bytes, all second bytes and so on, as high ones are mostly 0."""
    raw = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def unsqueezed(raw: bytes, kind: str) -> np.ndarray:
    size = int.from_bytes(raw[:8], "little")
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(raw[8:], size, "zstd", asbytes=True), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def by_value(order_key: np.ndarray):
    """Yields (value, indices) of equal values, in order."""
    if not len(order_key):
        return
    order = np.argsort(order_key, kind="stable")
    k = order_key[order]
    edges = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1], [True])))
    for x, y in zip(edges[:-1], edges[1:]):
        yield int(k[x]), order[x:y]


def _runs(texts: DataFrame, buckets: int, extract: Callable, run_hot: int, several: bool) -> DataFrame:
    def packed(own, doc, g, pos):
        own, doc, g, pos = np.asarray(own, "<i8"), np.concatenate(doc), np.concatenate(g), np.concatenate(pos)
        order = np.argsort(g, kind="stable")
        doc, g, pos = doc[order], g[order], pos[order]
        first = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1])))
        size = np.diff(np.concatenate((first, [len(g)])))
        text = own[doc]
        hot = (size > run_hot) & (np.minimum.reduceat(text, first) != np.maximum.reduceat(text, first))
        mark, keep = np.repeat(hot, size), np.ones(len(g), bool)
        rows = []
        for f, n in zip(first[hot].tolist(), size[hot].tolist()):
            # Of a hot hash two places of different texts go on.
            keep[f:f + n] = False
            keep[[f + int(text[f:f + n].argmin()), f + int(text[f:f + n].argmax())]] = True
        if mark.any():
            here, local = np.unique(doc[mark], return_inverse=True)
            rows.append((int(own[0] % buckets), squeezed(own[here]), b"", squeezed(local.astype("<u4")), squeezed(pos[mark]), b""))
        doc, g, pos, mark = doc[keep], g[keep], pos[keep], mark[keep]
        fp = (g >> _U(32)).astype("<u4")
        for b, at in by_value(((g & _U(0xFFFFFFFF)) % _U(buckets)).astype(np.int32)):
            at = at[np.argsort(fp[at], kind="stable")]
            here, local = np.unique(doc[at], return_inverse=True)
            rows.append((b, squeezed(own[here]), squeezed(fp[at]), squeezed(local.astype("<u4")), squeezed(pos[at]), squeezed(mark[at].view(np.uint8))))
        cols = list(zip(*rows))
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *(pa.array(c, pa.binary()) for c in cols[1:])],
                                          names=["bucket", "own", "fp", "doc", "pos", "hot"])

    def run(batches):
        find, held, n = extract(), ([], [], [], []), 0
        for batch in batches:
            found = find(batch) if several else (([name], np.zeros(len(places), np.int32), hashes, places)
                                                 for name, hashes, places in (find(k.as_py(), t.as_buffer().to_pybytes()) for k, t in zip(*batch.columns)))
            for names, doc, hashes, places in found:
                if not len(places):
                    continue
                for of, x in zip(held[1:], (doc + np.int32(len(held[0])), hashes, places.astype("<u4"))):
                    of.append(x)
                held[0].extend(names)
                n += len(places)
                if n >= RUN_PLACES:
                    yield packed(*held)
                    held, n = ([], [], [], []), 0
        if n:
            yield packed(*held)

    return texts.mapInArrow(run, "bucket int, own binary, fp binary, doc binary, pos binary, hot binary")


def _answer(bucket_hot: int, parts: int):
    def answer(table: pa.Table) -> pa.Table:
        fp, own, pos, mark, sure = [], [], [], [], []
        for o, f, d, p, h in zip(*(table.column(c) for c in ("own", "fp", "doc", "pos", "hot"))):
            text, places = unsqueezed(o.as_py(), "<i8")[unsqueezed(d.as_py(), "<u4")], unsqueezed(p.as_py(), "<u4")
            if not f.as_py():
                sure.append((text, places))
                continue
            fp.append(unsqueezed(f.as_py(), "<u4"))
            own.append(text)
            pos.append(places)
            mark.append(unsqueezed(h.as_py(), "u1").astype(bool))
        if fp:
            fp, own, pos, mark = map(np.concatenate, (fp, own, pos, mark))
            order = np.argsort(fp, kind="stable")
            fp, own, pos, mark = fp[order], own[order], pos[order], mark[order]
            first = np.flatnonzero(np.concatenate(([True], fp[1:] != fp[:-1])))
            size = np.diff(np.concatenate((first, [len(fp)])))
            several = np.minimum.reduceat(own, first) != np.maximum.reduceat(own, first)
            hot = np.repeat(several & (np.maximum.reduceat(mark, first) | (size > bucket_hot)), size)
            keep = np.repeat(several, size)
            own, value = own[keep], pos[keep].astype(_U) << _U(1) | hot[keep]
        else:
            own, value = np.zeros(0, "<i8"), np.zeros(0, _U)
        own = np.concatenate([own, *(o for o, _ in sure)])
        value = np.concatenate([value, *(p.astype(_U) << _U(1) | _U(1) for _, p in sure)])
        return scattered(own, value, parts)

    return answer


def _by_heat(values: np.ndarray) -> tuple[bytes, bytes]:
    """Places of one text: not hot, hot."""
    values = np.unique(values)
    hot = (values & _U(1)).astype(bool)
    return tuple((values[x] >> _U(1)).astype("<u4").tobytes() for x in (~hot, hot))


SCATTERED = "part int, keys binary, values binary"


def scattered(keys: np.ndarray, values: np.ndarray, parts: int) -> pa.Table:
    """Numbers by key, packed: one row for each part of the keys, however many keys there are."""
    rows = []
    for p, at in by_value((mix(keys.astype("<i8").view(_U).copy()) % _U(parts)).astype(np.int64)):
        at = at[np.argsort(keys[at], kind="stable")]
        rows.append((p, squeezed(keys[at].astype("<i8")), squeezed(values[at].astype("<u8"))))
    cols = list(zip(*rows)) or [[]] * 3
    return pa.table({n: pa.array(c, t) for n, c, t in zip(("part", "keys", "values"), cols, (pa.int32(), pa.binary(), pa.binary()))})


def gathered(rows: DataFrame, key: str, columns: list[str], of: Callable) -> DataFrame:
    """One row for each key of :func:`scattered` rows: ``of`` (its numbers) gives the bytes of ``columns``."""
    def gather(table: pa.Table) -> pa.Table:
        keys, values = [], []
        for k, v in zip(table.column("keys"), table.column("values")):
            keys.append(unsqueezed(k.as_py(), "<i8"))
            values.append(unsqueezed(v.as_py(), "<u8"))
        keys, values = np.concatenate(keys), np.concatenate(values)
        out = [(k, *of(values[at])) for k, at in by_value(keys)]
        cols = list(zip(*out))
        return pa.table({n: pa.array(c, t) for n, c, t in zip((key, *columns), cols, (pa.int64(), *[pa.binary()] * len(columns)))})

    return rows.groupBy("part").applyInArrow(gather, f"{key} long, " + ", ".join(f"{c} binary" for c in columns))


def repeated(texts: DataFrame, buckets: int, extract: Callable, run_hot: int | None = None, bucket_hot: int | None = None,
             several: bool = False) -> DataFrame:
    """own, pos, hot: places (unsigned 32-bit) of a text's repeated hashes, one row for each text that has any.

    ``texts``: oid, text (bytes).  ``extract()`` makes a function of both that returns the number by which
    texts are told apart, the 64-bit hashes and their places.  With ``several`` it makes one of an Arrow batch
    that yields, for some texts at a time, their numbers and for each hash the text's index in these, the hash
    and the place.
    """
    runs = _runs(texts, buckets, extract, RUN_HOT if run_hot is None else run_hot, several)
    answers = runs.groupBy("bucket").applyInArrow(_answer(BUCKET_HOT if bucket_hot is None else bucket_hot, buckets), SCATTERED)
    return gathered(answers, "own", ["pos", "hot"], _by_heat)
