"""Toxicity by a factorisation machine over hashed terms.

A text is the set of its lower-cased words and their stems, hashed to ``BUCKETS`` buckets.  The score is

    sigmoid(b + sum_i w_i + 1/2 sum_f ((sum_i v_if)^2 - sum_i v_if^2))

so pairs of terms, such as an insult and the mention of a group, add to what each term weighs alone.  A
proximal step after each update sets the weights and factor rows of uninformative terms to zero, so long
clean texts do not add up noise.

Training takes at most ``max_rows`` labelled texts, those with the smallest hash of their id, so classes
keep their shares; this bound is the only sampling here.  Their term sets (at most ``BUCKETS`` numbers each) are fitted
on the driver.  Scoring runs over all documents in Arrow batches with the broadcast model (9 MB).

Cases: null and empty texts have no terms and get the score of the bias.  Rows with a null label or id
are not learned from.  An id labelled twice
counts as toxic if one label says so.  Repeated rows and rows that share an id are scored one by one.  Without labels of
both classes the model is the constant share of label 1 (0 without any).  An empty table gives an empty
result.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import load, pieces, share, shared

BUCKETS = 1 << 18
FACTORS = 8
#: Labelled texts that are learned from, at most.
MAX_ROWS = 12_000
FOLDS = 5
#: A term is learned from so many texts on, with a likelihood ratio of so much (chi-square with one
#: degree of freedom); the most frequent terms are always learned, for their pairs.
MIN_TEXTS, MIN_G2, COMMON = 3, 12.0, 100
CACHE_WORDS = 200_000

_EDGES = b" \t\n\r\x0b\x0c!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_TABLE = bytes(32 if bytes([c]) in _EDGES or c < 32 else c for c in range(256))


class Terms:
    """Text to its sorted distinct hashed terms, with a bounded word cache.

    The terms of a word are the word and its first 3 to 6 characters, so inflected forms share terms.
    ``live`` keeps only terms with a weight.
    """

    def __init__(self, buckets: int = BUCKETS, live: np.ndarray | None = None):
        self.buckets, self.live, self.cache = buckets, live, {}

    def of_word(self, word: bytes) -> tuple[int, ...]:
        chars = word.decode("utf-8")
        stems = {word} | {b"<" + chars[:k].encode() for k in (3, 4, 5, 6) if len(chars) >= k}
        ids = {zlib.crc32(t) % self.buckets for t in stems}
        return tuple(i for i in ids if self.live is None or self.live[i])

    def __call__(self, text: str | None) -> np.ndarray:
        cache = self.cache
        if len(cache) > CACHE_WORDS:
            cache.clear()
        out: set[int] = set()
        for w in set((text or "").lower().encode("utf-8", "replace").translate(_TABLE).split()):
            h = cache.get(w)
            if h is None:
                h = cache[w] = self.of_word(w)
            if h:
                out.update(h)
        return np.sort(np.fromiter(out, np.int64, len(out)))


@dataclass
class Model:
    bias: float
    w: np.ndarray      # buckets
    v: np.ndarray      # buckets x factors

    def logits(self, rows: list[np.ndarray]) -> np.ndarray:
        """Of term sets; only terms with a weight are looked at."""
        out = np.full(len(rows), self.bias)
        if not rows:
            return out
        size = np.fromiter(map(len, rows), np.int64, len(rows))
        flat = np.concatenate(rows) if size.sum() else np.zeros(0, np.int64)
        live = self.live[flat]
        row = np.repeat(np.arange(len(rows)), size)[live]
        flat = flat[live]
        if len(flat):
            out += np.bincount(row, self.w[flat], len(rows))
            for f in range(self.v.shape[1]):
                x = self.v[flat, f]
                out += 0.5 * (np.bincount(row, x, len(rows)) ** 2 - np.bincount(row, x * x, len(rows)))
        return out

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.logits(rows), -60, 60)))

    def __post_init__(self):
        self.live = (self.w != 0) | (self.v != 0).any(axis=1)


def _informative(seen: np.ndarray, n0: int, n1: int) -> np.ndarray:
    """Terms to learn, from the numbers of texts of each class that have them."""
    def cost(k, n):
        k, n = np.broadcast_arrays(np.asarray(k, float), np.asarray(n, float))
        with np.errstate(divide="ignore", invalid="ignore"):
            return -(np.where(k > 0, k * np.log(k / n), 0) + np.where(n > k, (n - k) * np.log(1 - k / n), 0))
    both = seen.sum(0)
    g2 = 2 * (cost(both, n0 + n1) - cost(seen[0], n0) - cost(seen[1], n1))
    common = np.zeros(len(both), bool)
    common[np.argsort(-both, kind="stable")[:COMMON]] = True
    return np.flatnonzero((both >= MIN_TEXTS) & ((g2 >= MIN_G2) | common))


def fit(rows: list[np.ndarray], y: np.ndarray, buckets: int = BUCKETS, factors: int = FACTORS, epochs: int = 30,
        rate: float = 0.2, l1: float = 0.0005, l1_factors: float = 0.001, batch: int = 128, seed: int = 7) -> Model:
    """Mini-batch AdaGrad with a proximal L1 step on weights and a group one on factor rows.

    Learned are the terms that tell the classes apart on their own (:data:`MIN_G2`) and, for pairs, the
    ``COMMON`` most frequent ones; the many others could only be learned by heart.
    """
    y = np.asarray(y, float)
    if len(y) == 0 or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.0
        return Model(60.0 if share == 1 else -60.0, np.zeros(buckets), np.zeros((buckets, factors)))
    rng = np.random.default_rng(seed)
    seen = np.zeros((2, buckets))
    for r, c in zip(rows, y):
        seen[int(c), r] += 1
    ids = _informative(seen, (y == 0).sum(), (y == 1).sum())
    place = np.full(buckets, -1)
    place[ids] = np.arange(len(ids))
    rows = [place[r][place[r] >= 0] for r in rows]
    w, v, b = np.zeros(len(ids)), rng.normal(0, 0.03, (len(ids), factors)), 0.0
    gw, gv, gb = np.full(len(ids), 1e-4), np.full(len(ids), 1e-4), 1e-4
    for epoch in range(epochs):
        for part in np.array_split(rng.permutation(len(y)), max(1, len(y) // batch)):
            size = np.fromiter((len(rows[i]) for i in part), np.int64, len(part))
            flat = np.concatenate([rows[i] for i in part])
            row = np.repeat(np.arange(len(part)), size)
            vf = v[flat]
            s = np.stack([np.bincount(row, vf[:, f], len(part)) for f in range(factors)], 1)
            q = np.bincount(row, (vf ** 2).sum(1), len(part))
            z = b + np.bincount(row, w[flat], len(part)) + 0.5 * ((s ** 2).sum(1) - q)
            err = (1 / (1 + np.exp(-np.clip(z, -60, 60))) - y[part]) / len(part)
            e = err[row]
            dw = np.bincount(flat, e, len(ids))
            g = e[:, None] * (s[row] - vf)
            dv = np.stack([np.bincount(flat, g[:, f], len(ids)) for f in range(factors)], 1)
            gb += err.sum() ** 2
            b -= rate / np.sqrt(gb) * err.sum()
            gw += dw ** 2
            step = rate / np.sqrt(gw)
            w = w - step * dw
            w = np.sign(w) * np.maximum(np.abs(w) - step * l1, 0)
            if epoch < epochs // 2:   # weights first, so factors learn what weights miss
                continue
            gv += (dv ** 2).mean(1)
            step = (rate / np.sqrt(gv))[:, None]
            v = v - step * dv
            v = v * np.maximum(1 - step * l1_factors / (np.sqrt((v ** 2).sum(1, keepdims=True)) + 1e-12), 0)
    out = Model(float(b), np.zeros(buckets), np.zeros((buckets, factors)))
    out.w[ids], out.v[ids] = w, v
    out.__post_init__()
    return out


def fold(id_: Column) -> Column:
    """crc32 of the id as text, modulo the folds (null: null)."""
    return F.crc32(id_.cast("string")) % FOLDS


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
          max_rows: int = MAX_ROWS, buckets: int = BUCKETS, **how) -> Model:
    """A model of ``label_col``, learned from rows outside fold 0."""
    known = labels.where(F.col(label_col).isin(0, 1) & (fold(F.col(id_col)) != 0)).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("y"))
    sample = known.orderBy(F.xxhash64("id"), "id").limit(max_rows)

    def run(batches):
        terms = Terms(buckets)
        for batch in pieces(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(
                [terms(t.as_py()).astype("<u4").tobytes() for t in batch.column(2)], pa.binary())], names=["id", "y", "terms"])

    # The sample has at most max_rows rows of 12 bytes.
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(sample), "id")
    id_type = docs.schema[id_col].dataType.simpleString()
    got = texts.select("id", "y", "text").mapInArrow(run, f"id {id_type}, y int, terms binary").toArrow()
    got = sorted(zip(got["id"].to_pylist(), got["y"].to_pylist(), got["terms"].to_pylist()))
    return fit([np.frombuffer(t, "<u4").astype(np.int64) for _, _, t in got], np.asarray([y for _, y, _ in got]), buckets, **how)


def with_score(docs: DataFrame, model: Model, text_col: str = "text", name: str = "toxicity") -> DataFrame:
    """``docs`` with the score as a new last column ``name``."""
    sent = share(docs.sparkSession, model)
    names = [*docs.columns, name]
    at = names.index(text_col)

    def run(batches):
        m = shared(sent)
        terms = Terms(len(m.w), m.live)
        for batch in pieces(batches):
            rows = [terms(t.as_py()) for t in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(m.scores(rows), pa.float64())], names=names)

    return docs.mapInArrow(run, _plus(docs, name))


def _plus(docs: DataFrame, name: str):
    from pyspark.sql.types import DoubleType, StructField, StructType
    return StructType([*docs.schema.fields, StructField(name, DoubleType())])


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text", limit: float = 0.5) -> DataFrame:
    """``docs`` without the rows that score ``limit`` or more."""
    name = "_toxicity"
    while name in docs.columns:
        name += "_"
    return with_score(docs, model, text_col, name).where(F.col(name) < limit).drop(name)


def op4(spark, sf_dir: str) -> DataFrame:
    """Every document with its toxicity score."""
    docs = load(spark, sf_dir, "documents")
    model = train(docs, load(spark, sf_dir, "labels"))
    scored = with_score(docs.select("doc_id", "text"), model, "text", "score")
    return scored.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
