"""Quality classifier from weak labels.

Overlapping heuristics vote on each document: good, bad or nothing.  All documents are reduced to counts
of vote patterns (at most 3^8 rows).  Expectation-maximisation on these counts estimates the
share of good documents and, for each heuristic, how often it casts each vote on good and on bad ones.
The posterior of a pattern is the soft label of its documents.  A linear scorer over hashed features of
word shapes learns the soft labels of at most ``max_rows`` documents (those with the smallest hash of
their id; the only sampling here), so it also scores documents on which the heuristics are silent.

Cases: null and empty texts have no words; every heuristic but the length one is silent on them.  Rows
that share an id are voted on and scored one by one.  A null id may be sampled like any other.  An empty
table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import load, share, shared

GOOD, BAD, SILENT = 1, 0, 2
BUCKETS = 1 << 16
MAX_ROWS = 8_000
CACHE_WORDS = 500_000


class Heuristics:
    """Votes of the heuristics on one text.  Each looks at one property of the words."""

    names = ("length", "symbols", "separators", "capitals", "repeated_words", "repeated_runs", "sentences", "word_length")

    def __call__(self, text: str | None) -> list[int]:
        words = (text or "").split()
        n = len(words)
        if n < 5:
            return [BAD if n == 0 else SILENT] + [SILENT] * (len(self.names) - 1)
        distinct = set(words)
        odd = sum(1 for w in words if not w[-1].isalnum() and w[-1] not in ".,;:!?\"')|")
        bars = sum(1 for w in words if len(w) == 1 and not w.isalnum())
        upper = sum(1 for w in words if len(w) > 1 and w.isupper())
        runs = sum(1 for a, b in zip(words, words[1:]) if a == b)
        ends = sum(1 for w in words if w[-1] in ".!?")
        letters = sum(map(len, words)) / n
        return [
            GOOD if n >= 100 else SILENT,
            BAD if odd > 0.2 * n else GOOD if odd < 0.05 * n else SILENT,
            BAD if bars > 0.15 * n else GOOD if bars < 0.02 * n else SILENT,
            BAD if upper > 0.3 * n else GOOD if upper < 0.05 * n else SILENT,
            BAD if len(distinct) < 0.3 * min(n, 200) else GOOD if len(distinct) > 0.6 * min(n, 200) else SILENT,
            BAD if runs > 0.2 * n else GOOD if runs < 0.05 * n else SILENT,
            BAD if ends > 0.5 * n else GOOD if 0.04 * n <= ends <= 0.3 * n else SILENT,
            BAD if letters > 20 else GOOD if 3 <= letters <= 10 else SILENT,
        ]


def vote_code(votes: list[int]) -> int:
    """The votes as one number in base 3."""
    code = 0
    for v in votes:
        code = 3 * code + v
    return code


def votes_of(code: int, heuristics: int) -> list[int]:
    return [code // 3 ** (heuristics - 1 - j) % 3 for j in range(heuristics)]


@dataclass
class LabelModel:
    """Share of good documents and P(vote | class) of each heuristic."""

    good: float
    table: np.ndarray   # class x heuristic x vote

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """P(good) of rows of votes."""
        j = np.arange(votes.shape[1])
        bad = np.log(1 - self.good) + np.log(self.table[0][j, votes]).sum(1)
        good = np.log(self.good) + np.log(self.table[1][j, votes]).sum(1)
        return 1 / (1 + np.exp(np.clip(bad - good, -60, 60)))


def label_model(votes: np.ndarray, counts: np.ndarray, rounds: int = 100) -> LabelModel:
    """Expectation-maximisation over vote patterns and their counts, from the majority vote on."""
    m = votes.shape[1] if votes.size else len(Heuristics.names)
    if not len(votes):
        return LabelModel(0.5, np.full((2, m, 3), 1 / 3))
    good, bad = (votes == GOOD).sum(1), (votes == BAD).sum(1)
    p = (good + 1.0) / (good + 3.0 * bad + 2.0)   # a bad vote is rarer and weighs more
    for _ in range(rounds):
        table = np.empty((2, m, 3))
        for c, w in ((0, counts * (1 - p)), (1, counts * p)):
            for v in range(3):
                table[c, :, v] = ((votes == v) * w[:, None]).sum(0) + 1.0
            table[c] /= table[c].sum(1, keepdims=True)
        share_ = np.clip((counts * p).sum() / counts.sum(), 0.01, 0.99)
        model = LabelModel(float(share_), table)
        new = model.posterior(votes)
        if np.abs(new - p).max() < 1e-9:
            break
        p = new
    return model


class Shapes:
    """Text to shares of hashed word shapes (letters, digits and other characters, repeats squeezed)."""

    def __init__(self, buckets: int = BUCKETS):
        self.buckets, self.cache = buckets, {}

    def _of(self, word: str) -> int:
        shape = re.sub(r"\d+", "0", re.sub(r"[^\W\d_a-z]+", lambda m: "A" if m[0].isupper() else "a", re.sub("[a-z]+", "a", word)))
        shape = re.sub(r"(.)\1+", r"\1", shape)[:8] + ("+" if len(word) > 12 else "")
        return zlib.crc32(shape.encode("utf-8", "replace")) % (self.buckets - 4) + 4

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        cache = self.cache
        if len(cache) > CACHE_WORDS:
            cache.clear()
        words = (text or "").split()
        for w in set(words):
            if w not in cache:
                cache[w] = self._of(w)
        n = len(words)
        ids, count = np.unique(np.fromiter(map(cache.__getitem__, words), np.int64, n), return_counts=True)
        own = [1.0, len(set(words)) / n if n else 0.0, sum(a == b for a, b in zip(words, words[1:])) / n if n else 0.0, min(1.0, n / 500)]
        return np.concatenate((np.arange(4), ids)), np.concatenate((own, count / max(1, n)))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, buckets: int = BUCKETS, epochs: int = 30, rate: float = 0.5,
        l2: float = 1e-4, batch: int = 64, seed: int = 5) -> np.ndarray:
    """Weights of a logistic scorer for soft labels, by AdaGrad."""
    w, g2, rng = np.zeros(buckets), np.full(buckets, 1e-4), np.random.default_rng(seed)
    for _ in range(epochs if len(rows) else 0):
        for part in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // batch)):
            ids = np.concatenate([rows[i][0] for i in part])
            x = np.concatenate([rows[i][1] for i in part])
            row = np.repeat(np.arange(len(part)), [len(rows[i][0]) for i in part])
            err = 1 / (1 + np.exp(-np.clip(np.bincount(row, w[ids] * x, len(part)), -60, 60))) - y[part]
            at, inverse = np.unique(ids, return_inverse=True)
            g = np.bincount(inverse, err[row] * x, len(at)) / len(part) + l2 * w[at]
            g2[at] += g * g
            w[at] -= rate * g / np.sqrt(g2[at])
    return w


def _voted(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    def run(batches):
        h = Heuristics()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([vote_code(h(t.as_py())) for t in batch.column(1)], pa.int32())], names=["id", "code"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, code int")


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_rows: int = MAX_ROWS) -> tuple[LabelModel, np.ndarray]:
    """The label model of all documents and the scorer's weights."""
    counted = _voted(docs, id_col, text_col).groupBy("code").count().collect()   # at most 3^8 rows
    counted = sorted((r["code"], r["count"]) for r in counted)
    m = len(Heuristics.names)
    votes = np.asarray([votes_of(c, m) for c, _ in counted], np.int64).reshape(-1, m)
    model = label_model(votes, np.asarray([n for _, n in counted], float))

    def run(batches):
        h, shapes = Heuristics(), Shapes()
        for batch in batches:
            out = []
            for key, t in zip(batch.column(0), batch.column(1)):
                ids, x = shapes(t.as_py())
                out.append((key.as_py(), vote_code(h(t.as_py())), ids.astype("<u4").tobytes(), x.astype("<f4").tobytes()))
            cols = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.binary(), pa.binary()))], names=["h", "code", "ids", "x"])

    # The hashes of the sample: the smallest max_rows of all documents, a top-k without a full sort.
    hashed = docs.select(F.xxhash64(F.col(id_col).cast("string")).alias("h"), F.col(text_col).cast("string").alias("text"))
    taken = hashed.select("h").orderBy("h").limit(max_rows).distinct()
    got = hashed.join(F.broadcast(taken), "h").mapInArrow(run, "h long, code int, ids binary, x binary").orderBy("h", "ids").limit(max_rows).toArrow()
    rows = [(np.frombuffer(i, "<u4").astype(np.int64), np.frombuffer(x, "<f4").astype(float)) for i, x in zip(got["ids"].to_pylist(), got["x"].to_pylist())]
    y = model.posterior(np.asarray([votes_of(c, m) for c in got["code"].to_pylist()], np.int64).reshape(-1, m))
    return model, fit(rows, y)


def scored(docs: DataFrame, model: tuple[LabelModel, np.ndarray], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, votes (one character each: + - .), posterior and score of being good."""
    sent = share(docs.sparkSession, model)

    def run(batches):
        labels, w = shared(sent)
        h, shapes = Heuristics(), Shapes(len(w))
        for batch in batches:
            votes = [h(t.as_py()) for t in batch.column(1)]
            score = []
            for t in batch.column(1):
                ids, x = shapes(t.as_py())
                score.append(1 / (1 + np.exp(-np.clip((w[ids] * x).sum(), -60, 60))))
            p = labels.posterior(np.asarray(votes, np.int64).reshape(-1, len(h.names)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(["".join("-+."[v] for v in r) for r in votes], pa.string()),
                                              pa.array(p, pa.float64()), pa.array(score, pa.float64())], names=["id", "votes", "posterior", "score"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"id {docs.schema[id_col].dataType.simpleString()}, votes string, posterior double, score double")


def op9(spark, sf_dir: str) -> DataFrame:
    """Every document with its weak label and its score; ``kept`` are those of 0.5 and more."""
    docs = load(spark, sf_dir, "documents")
    return scored(docs, train(docs)).select(F.col("id").alias("doc_id"), "votes", "posterior", "score", (F.col("score") >= 0.5).alias("kept"))
