"""Benchmark decontamination with a generalised suffix automaton.

The automaton is built over the words of the normalised benchmark items.  Documents stream through it:
each state is the longest suffix of the words read that occurs in some item, so the matching length is
known at every word.  Where it reaches ``window`` words (or a whole shorter item), those words are hit.
:func:`remove_benchmark` cuts the hit spans and drops documents whose hit share exceeds a limit.

The items are taken in blocks of at most ``BLOCK_WORDS`` words; one block's automaton is broadcast, which
bounds its size, and the documents are read once for each block.  With one block there is no shuffle.

Cases: null text has no words.  Items without words match nothing.  An item shorter than the window is
one window.  Repeated documents are judged one by one.  Repeated items count by their id, a null id
counts as ''.  An empty table of items
leaves all documents clean.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ASCII_LOWER, ASCII_UPPER, load, pieces, share, shared

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
#: Item words in one broadcast automaton (at most twice as many states, about 0.5 KB each).
BLOCK_WORDS = 100_000
WINDOW = 10
#: A-Z to a-z, other ASCII outside 0-9a-z to a space; bytes of other characters stay.
_TABLE = bytes((c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32) for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """The normalised words of a text, as UTF-8."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").translate(_TABLE).split()


class Automaton:
    """Generalised suffix automaton over item words, with the items of each window."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        coded = []
        for key, words in items:
            if words:
                ids = [self.vocab.setdefault(w, len(self.vocab)) for w in words]
                coded.append((key, ids))
                last = 0
                for c in ids:
                    last = self._extend(last, c)
        self.shortest = min((min(len(ids), window) for _, ids in coded), default=0)
        #: state -> items that have the window of `window` words of that state.
        self.full: dict[int, set[str]] = {}
        #: state -> (length, items) of whole items shorter than the window.
        self.short: dict[int, tuple[int, set[str]]] = {}
        for key, ids in coded:
            state = length = 0
            for c in ids:
                state, length = self.step(state, length, c)
                if length >= window:
                    state, length = self._cut(state, length)
                    self.full.setdefault(state, set()).add(key)
            if len(ids) < window:
                self.short.setdefault(state, (len(ids), set()))[1].add(key)

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.len
        if c in nxt[last]:
            q = nxt[last][c]
            return q if length[q] == length[last] + 1 else self._clone(last, c, q)
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
        return cur

    def _clone(self, p: int, c: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.len
        new = len(nxt)
        nxt.append(dict(nxt[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = new
        while p >= 0 and nxt[p].get(c) == q:
            nxt[p][c] = new
            p = link[p]
        return new

    def step(self, state: int, length: int, c: int) -> tuple[int, int]:
        """Longest suffix of (current match + c) in any item."""
        nxt = self.next
        while state and c not in nxt[state]:
            state = self.link[state]
            length = self.len[state]
        if c in nxt[state]:
            return nxt[state][c], length + 1
        return 0, 0

    def _cut(self, state: int, length: int) -> tuple[int, int]:
        """The state of the last `window` words of the match."""
        while self.len[self.link[state]] >= self.window:
            state = self.link[state]
            length = self.len[state]
        return state, min(length, self.window)

    def _shorts(self, state: int, length: int) -> Iterator[tuple[int, set[str]]]:
        """Whole short items that end at a match of `length` words in `state`."""
        while state > 0:
            if state in self.short and self.short[state][0] <= length:
                yield self.short[state]
            state = self.link[state]

    def match(self, words: list[bytes]) -> tuple[np.ndarray | None, set[str], int]:
        """Hit flags of the words (None: none), items with occurring windows, the longest match."""
        n, hits, found, longest = len(words), None, set(), 0
        if not n or not self.shortest or n < self.shortest:
            return None, found, 0
        get = self.vocab.get
        ids = np.fromiter(map(get, words, repeat(-1)), np.int64, n)
        known = np.concatenate(([False], ids >= 0, [False]))
        edges = np.flatnonzero(known[1:] != known[:-1]).reshape(-1, 2)
        # A match holds known words only: shorter runs of them cannot hold a window.
        for a, b in edges[edges[:, 1] - edges[:, 0] >= self.shortest]:
            state = length = 0
            for i, c in enumerate(ids[a:b].tolist(), int(a)):
                state, length = self.step(state, length, c)
                longest = max(longest, length)
                size = 0
                if length >= self.window:
                    state, length = self._cut(state, length)
                    found |= self.full[state]
                    size = self.window
                if self.short:
                    for k, keys in self._shorts(state, length):
                        found |= keys
                        size = max(size, k)
                if size:
                    if hits is None:
                        hits = np.zeros(n, bool)
                    hits[i + 1 - size:i + 1] = True
        return hits, found, longest


def hit_runs(hits: np.ndarray | None) -> list[tuple[int, int]]:
    """Runs of hit words as (first, last)."""
    if hits is None:
        return []
    h = np.concatenate(([False], hits, [False]))
    return [(int(x), int(y) - 1) for x, y in np.flatnonzero(h[1:] != h[:-1]).reshape(-1, 2)]


def _blocks(items: DataFrame, key_col: str, text_col: str, block_words: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """Item words in blocks; only one block at a time is on the driver."""
    block, size = [], 0
    for r in items.select(F.col(key_col).cast("string"), F.col(text_col).cast("string")).toLocalIterator():
        words = words_of(r[1])
        if size and size + len(words) > block_words:
            yield block
            block, size = [], 0
        block.append((r[0] or "", words))
        size += len(words)
    if block:
        yield block


_FOUND = "id {id}, n_words long, n_hit long, items array<string>, spans array<struct<first:int,last:int>>"


def _scan(docs: DataFrame, id_col: str, text_col: str, automaton) -> DataFrame:
    """Per document: words, hit words, items and hit word spans of one block."""
    schema = _FOUND.format(id=docs.schema[id_col].dataType.simpleString())

    def run(batches):
        a: Automaton = shared(automaton)
        for batch in pieces(batches):
            ids, n_words, n_hit, items, spans = batch.column(0), [], [], [], []
            for t in batch.column(1):
                words = words_of(t.as_py())
                hits, found, _ = a.match(words)
                n_words.append(len(words))
                n_hit.append(0 if hits is None else int(hits.sum()))
                items.append(sorted(found))
                spans.append([{"first": x, "last": y} for x, y in hit_runs(hits)])
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(items, pa.list_(pa.string())),
                 pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())])))],
                names=["id", "n_words", "n_hit", "items", "spans"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def _key(id_col: str, text_col: str):
    """Names a row by id and text; equal rows get equal results, so they may share it."""
    return F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit(":"), F.coalesce(F.col(text_col).cast("string"), F.lit(""))))


def _merged(docs: DataFrame, automata: list, id_col: str, text_col: str) -> DataFrame:
    """The findings of several blocks united, one row for each key."""
    keyed = docs.select(_key(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
    out = _scan(keyed, "key", "text", automata[0])
    for a in automata[1:]:
        out = out.unionByName(_scan(keyed, "key", "text", a))
    merged = out.groupBy("id").agg(F.max("n_words").alias("n_words"), F.flatten(F.collect_set("items")).alias("items"),
                                   F.flatten(F.collect_set("spans")).alias("spans"))
    # Spans of different blocks may overlap: keep those that end behind all before, cut at that end.
    zero = F.expr("named_struct('out', cast(array() as array<struct<first:int,last:int>>), 'end', -1)")
    folded = F.aggregate(F.array_sort("spans"), zero, lambda acc, x: F.when(x["last"] > acc["end"], F.struct(
        F.concat(acc["out"], F.array(F.struct(F.greatest(x["first"], acc["end"] + 1).alias("first"), x["last"].alias("last")))).alias("out"),
        x["last"].alias("end"))).otherwise(acc))
    return merged.select(F.col("id").alias("key"), "n_words", F.array_sort(F.array_distinct("items")).alias("items"), folded["out"].alias("spans")) \
        .withColumn("n_hit", F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["last"] - x["first"] + 1))


def _automata(docs: DataFrame, items: DataFrame, key_col: str, text_col: str, window: int, block_words: int) -> list:
    spark = docs.sparkSession
    return [share(spark, Automaton(b, window)) for b in _blocks(items, key_col, text_col, block_words)] or [share(spark, Automaton([], window))]


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                  block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per document: id, n_words, n_hit, items (sorted item ids) and spans (hit runs of word numbers)."""
    automata = _automata(docs, items, item_col, item_text_col, window, block_words)
    if len(automata) == 1:
        return _scan(docs, id_col, text_col, automata[0])
    found = _merged(docs, automata, id_col, text_col)
    return docs.select(F.col(id_col).alias("id"), _key(id_col, text_col).alias("key")).join(found, "key") \
        .select("id", "n_words", "n_hit", "items", "spans")


def cut_words(text: str, runs: list[tuple[int, int]]) -> str:
    """``text`` without the words of ``runs`` (first, last) and what stands between the words of one run."""
    spans = [m.span() for m in WORD.finditer("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))]
    out, at = [], 0
    for first, last in runs:
        out.append(text[at:spans[first][0]])
        at = spans[last][1]
    return "".join(out) + text[at:]


def remove_benchmark(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id",
                     item_text_col: str = "text", window: int = WINDOW, max_coverage: float = 0.5,
                     block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with hit spans cut from the text; documents with a larger hit share than ``max_coverage`` go.

    The columns of ``docs`` stay as they are; clean texts are not changed.  A column ``n_chars``, if
    there is one, is set to the length of a text that was cut.
    """
    names = docs.columns
    at = names.index(text_col)
    count = names.index("n_chars") if "n_chars" in names else None
    automata = _automata(docs, items, item_col, item_text_col, window, block_words)
    given = len(automata) > 1
    frame, automaton = docs, automata[0]
    if given:
        id_col = names[0]
        row = docs.select(F.struct(*[docs[c] for c in names]).alias("row"), _key(id_col, text_col).alias("key"))
        found = _merged(docs, automata, id_col, text_col).select("key", "spans")
        frame = row.join(found, "key").select(*[F.col("row")[c].alias(c) for c in names], F.col("spans").alias("_hit_spans"))
        automaton = None

    def run(batches):
        a = shared(automaton) if automaton else None
        for batch in pieces(batches):
            keep, texts, lengths = [], batch.column(at).to_pylist(), {}
            for i, t in enumerate(texts):
                words = words_of(t)
                runs = [(x["first"], x["last"]) for x in batch.column(len(names))[i].as_py()] if given else hit_runs(a.match(words)[0])
                keep.append(sum(y - x + 1 for x, y in runs) <= max_coverage * len(words))
                if runs and keep[-1]:
                    texts[i] = cut_words(t, runs)
                    lengths[i] = len(texts[i])
            cols = list(batch.columns[:len(names)])
            if lengths:
                cols[at] = pa.array(texts, batch.schema.field(at).type)
                if count is not None:
                    old = batch.column(count).to_pylist()
                    cols[count] = pa.array([lengths.get(i, x) for i, x in enumerate(old)], batch.schema.field(count).type)
            yield pa.RecordBatch.from_arrays(cols, names=names).filter(pa.array(keep, pa.bool_()))

    return frame.mapInArrow(run, docs.schema)


def op1(spark, sf_dir: str) -> DataFrame:
    """Every document against all benchmark items."""
    found = contamination(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


OP1_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{ASCII_UPPER}', '{ASCII_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), '{ASCII_UPPER}', '{ASCII_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
g AS (SELECT item, least(10, len(ws)) AS n, list_slice(ws, i, i + least(10, len(ws)) - 1) AS g
      FROM b, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS u(i) WHERE len(ws) > 0),
sizes AS (SELECT DISTINCT n FROM g),
w AS (SELECT doc_id, n, i, list_slice(ws, i, i + n - 1) AS g FROM d, sizes, unnest(range(1, len(ws) - n + 2)) AS u(i)),
m AS (SELECT w.doc_id, w.n, w.i, g.item FROM w JOIN g ON w.n = g.n AND w.g = g.g),
hit AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM (SELECT DISTINCT doc_id, n, i FROM m), unnest(range(0, n)) AS u(k) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""


def brute_force(docs, items, window: int = WINDOW) -> dict:
    """What op1 must return, word window by word window (for tests)."""
    def words(t):
        return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))

    grams: dict[tuple, set[str]] = {}
    for key, t in items:
        w = words(t)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            grams.setdefault(tuple(w[i:i + n]), set()).add(str(key))
    out = {}
    sizes = sorted({len(g) for g in grams})
    for key, t in docs:
        w, hit, found = words(t), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in grams:
                    hit.update(range(i, i + n))
                    found |= grams[tuple(w[i:i + n])]
        out[key] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
    return out
