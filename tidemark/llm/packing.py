"""Hierarchical multi-length packing.

Each document becomes token ids and an end id.  Whole windows of the longest tier are cut off first and
fill a sequence each; they wait in the same bounded buffer of their task.  The rest is routed to the smallest context tier that holds it (256, 512, 1024 or
2048 ids) and waits, too.  When the buffer is full, the tiers are packed:

* the rests of a tier open its windows, longest first and from the longest tier down;
* the gaps of a window are filled with the longest whole rests that fit, also from shorter tiers;
* a gap that no whole rest fits takes the head of a cut one, so every window ends full;
* fewer ids than the shortest tier wait for the next flush; when the task ends, they close in windows of
  smaller powers of two.  No window needs padding.

The sequences of a flush, whole windows too, are dealt to step groups in a snake order of their attention
cost (the sum of squared piece lengths), so groups of one step take about the same time.  A group holds
``STEP_SEQUENCES`` sequences; those over a multiple of it wait for the next flush.  Only the last groups of
a task may hold fewer, and their sizes differ by one at most.

All work is local to a task: no shuffle, and a task holds at most ``BUFFER_TOKENS`` ids and one document.  A sequence id is
the task's number and a running number, so a task that runs again yields the same rows.

Cases: null and empty texts are one piece that holds the end id alone.  Rows that share an id are packed
one by one.  A null id stays null.  An empty table gives an empty result.
"""

from __future__ import annotations

import sys
import types
import zlib
from bisect import bisect_left, bisect_right, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import load, text_slices

TIERS = (256, 512, 1024, 2048)
END_ID = 1
#: Ids that wait in a task before they are packed (4 bytes each).
BUFFER_TOKENS = 2_000_000
#: Words in each of the two parts of a Python worker's word cache (about 0.25 KB each).
CACHE_WORDS = 250_000
#: Text bytes (or one text) whose words are looked up together.
TEXT_BYTES = 2 << 20
STEP_SEQUENCES = 16


class WordTokenizer:
    """Ids of texts by a tokenizer that never joins across white space, word by word with a cache.

    ``ids`` returns them as little-endian unsigned 32-bit bytes.  The words of many texts are found at once
    (:func:`cut_words`); only their distinct ones are looked up, and new ones are encoded together.
    """

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.cache: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}
        self.cache_words = cache_words

    def ids(self, texts) -> list[bytes]:
        """Of an Arrow array or a list of strings; null is empty."""
        texts = (texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())).cast(pa.large_binary()).fill_null(b"")
        stops = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[stops[0]:stops[-1]]
        words, upto = cut_words(raw, stops - stops[0])
        if not len(words):
            return [b""] * len(texts)
        words = words.dictionary_encode()
        found = self._look_up(words.dictionary.to_pylist())
        flat = np.frombuffer(b"".join(found), "<u4")
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        begin = np.cumsum(size) - size
        which = words.indices.to_numpy()
        size = size[which]
        stop = np.cumsum(size)
        out = flat[np.repeat(begin[which] - stop + size, size) + np.arange(stop[-1])]
        bounds = np.concatenate(([0], stop))[upto].tolist()
        return [out[x:y].tobytes() for x, y in zip(bounds, bounds[1:])]

    def _look_up(self, words: list[bytes]) -> list[bytes]:
        new = [w for w in words if w not in self.cache]
        if len(self.cache) + len(new) > self.cache_words:
            # The full part becomes the old one; its words move over again when they are met.
            self.before, self.cache = self.cache, {}
            new = words
        cache, before = self.cache, self.before
        cache.update((w, before[w]) for w in new if w in before)
        self._learn([w for w in new if w not in before])
        return list(map(cache.__getitem__, words))

    def _learn(self, words: list[bytes]) -> None:
        for i in range(0, len(words), 2000):
            part = words[i:i + 2000]
            e = self.tokenizer.encode([w.decode("utf-8", "replace") for w in part], is_pretokenized=True, add_special_tokens=False)
            ids = np.asarray(e.ids, "<u4")
            cuts = (4 * np.searchsorted(np.asarray(e.word_ids, np.int64), np.arange(len(part) + 1))).tolist()
            raw = ids.tobytes()
            self.cache.update((w, raw[x:y]) for w, x, y in zip(part, cuts, cuts[1:]))


def worker_tokenizer(path: str) -> WordTokenizer:
    """The tokenizer of this Python worker, which Spark uses for several tasks: its cache stays warm."""
    kept = sys.modules.setdefault("_tidemark_worker", types.ModuleType("_tidemark_worker")).__dict__
    if path not in kept:
        kept[path] = WordTokenizer(path)
    return kept[path]


_WHITE, _LETTER, _DIGIT, _MARK, _APOSTROPHE = range(1, 6)
#: Kinds of bytes.  The others (beyond ASCII, control codes, the frame of special tokens) are never cut off.
_KIND = np.zeros(256, np.uint8)
_KIND[list(b" \t\n\r\x0b\x0c")] = _WHITE
_KIND[[b for b in range(128) if chr(b).isalpha()]] = _LETTER
_KIND[list(b"0123456789")] = _DIGIT
_KIND[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in "'<|>"]] = _MARK
_KIND[ord("'")] = _APOSTROPHE
#: Whether a word ends between bytes of two kinds (first kind times 8 and second).
_CUT = np.zeros(64, bool)
for _a, _b in [(_LETTER, _MARK), (_LETTER, _APOSTROPHE), (_MARK, _LETTER), (_DIGIT, _DIGIT),
               *((k, _DIGIT) for k in (_LETTER, _MARK, _APOSTROPHE)), *((_DIGIT, k) for k in (_LETTER, _MARK, _APOSTROPHE))]:
    _CUT[8 * _a + _b] = True
_CUT[8 * _WHITE:8 * _WHITE + 8] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def cut_words(raw: np.ndarray, stops: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Words of texts that lie behind each other in ``raw``, and how many there are before each of ``stops``.

    Words lie between ASCII white space (other white space stays inside, for the tokenizer).  Digits, and
    letters and marks of ASCII, are set apart from each other and A-Z is lower-cased: the tokenizer does
    both anyway, and so there are fewer different words to look up.  What a composed character or a
    contraction may begin with, or a special token holds, is left to it.
    """
    kind = _KIND[raw]
    pair = np.empty(len(raw), np.uint8)
    pair[:1] = 8 * _WHITE
    pair[1:] = kind[:-1] << 3
    pair[stops[:-1][stops[:-1] < len(raw)]] = 8 * _WHITE
    pair |= kind
    solid = kind != _WHITE
    starts = np.flatnonzero(_CUT[pair] & solid)
    if b"<|" not in raw.tobytes():
        lower = _LOWER[raw]
        joined = np.flatnonzero(raw[1:] >= 128)
        lower[joined] = raw[joined]
        raw = lower
    packed = raw[solid]
    at = np.cumsum(solid)[starts] - 1
    offsets = np.append(at, len(packed)).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(packed)])
    return words, np.searchsorted(starts, stops)


class Packer:
    """Packs (document, ids) of one task; ``flush`` returns rows of pieces."""

    def __init__(self, task: int, tiers=TIERS, buffer_tokens: int = BUFFER_TOKENS, step_sequences: int = STEP_SEQUENCES):
        self.tiers, self.limit, self.steps = tuple(sorted(tiers)), buffer_tokens, step_sequences
        self.top = self.tiers[-1]
        self.next_id = task << 33
        self.next_group = task << 33
        self.waiting: list[tuple] = []   # (length, doc, start, ids, doc_tokens)
        self.ready: list[list[tuple]] = []   # sequences without a step group
        self.held = 0

    def add(self, doc, ids: bytes) -> None:
        """Whole windows of the document and its rest wait for the next flush."""
        n = len(ids) // 4
        full = n - n % self.top
        self.ready += [[(doc, i, ids[4 * i:4 * (i + self.top)], n)] for i in range(0, full, self.top)]
        if full < n:
            self.waiting.append((n - full, doc, full, ids[4 * full:], n))
        self.held += n

    def flush(self, last: bool) -> list[tuple]:
        """Rows of all full step groups; of the last groups, too, if ``last``."""
        self.ready += self.pack(last)
        n = len(self.ready) if last else len(self.ready) // self.steps * self.steps
        done, self.ready = self.ready[:n], self.ready[n:]
        self.held += sum(len(p[2]) // 4 for s in self.ready for p in s)
        return self.rows(done)

    def pack(self, last: bool) -> list[list[tuple]]:
        """Sequences of the waiting rests; unless ``last``, fewer ids than the shortest tier wait on."""
        # Tiers: rests by length, each list in order of arrival.
        by_length: dict[int, list[tuple]] = {}
        for r in self.waiting:
            by_length.setdefault(r[0], []).append(r)
        lengths = sorted(by_length)

        def take(n: int) -> tuple:
            rest = by_length[n].pop()
            if not by_length[n]:
                del by_length[n]
                lengths.pop(bisect_left(lengths, n))
            return rest

        def put(rest: tuple) -> None:
            if rest[0] not in by_length:
                insort(lengths, rest[0])
            by_length.setdefault(rest[0], []).append(rest)

        def cut(rest: tuple, n: int) -> tuple:
            """The head of ``n`` ids; the tail waits again."""
            size, doc, start, ids, total = rest
            put((size - n, doc, start + n, ids[4 * n:], total))
            return n, doc, start, ids[:4 * n], total

        total = sum(n * len(v) for n, v in by_length.items())
        out = []
        for tier, below in zip(reversed(self.tiers), [*reversed(self.tiers[:-1]), 0]):
            # Rests of this tier are longer than the tier below; each window is opened by the longest.
            while total >= tier and lengths[-1] > below:
                gap, pieces = tier, []
                while gap:
                    k = bisect_right(lengths, gap)
                    # The longest whole rest that fits, else the head of the shortest.
                    piece = take(lengths[k - 1]) if k else cut(take(lengths[0]), gap)
                    pieces.append(piece)
                    gap -= piece[0]
                total -= tier
                out.append([p[1:] for p in pieces])
        left = [r for v in by_length.values() for r in v]
        if last and left:
            # Fewer ids than the smallest tier: windows of smaller powers of two.
            left.sort(key=lambda r: -r[0])
            size = 1 << (total.bit_length() - 1)
            while left:
                gap, pieces = size, []
                while gap:
                    r = left.pop(0)
                    if r[0] > gap:
                        left.insert(0, (r[0] - gap, r[1], r[2] + gap, r[3][4 * gap:], r[4]))
                        r = (gap, r[1], r[2], r[3][:4 * gap], r[4])
                    pieces.append(r[1:])
                    gap -= r[0]
                out.append(pieces)
                total -= size
                size = 1 << (total.bit_length() - 1) if total else 0
            left = []
        self.waiting, self.held = left, sum(r[0] for r in left)
        return out

    def rows(self, sequences: list[list[tuple]]) -> list[tuple]:
        """Numbered pieces: (doc, start, length, crc, doc_tokens, sequence, offset, tier, step_group)."""
        cost = [sum((len(p[2]) // 4) ** 2 for p in s) for s in sequences]
        groups = -(-len(sequences) // self.steps)
        order = sorted(range(len(sequences)), key=lambda i: -cost[i])
        group = {i: (r % groups if (r // groups) % 2 == 0 else groups - 1 - r % groups) for r, i in enumerate(order)}
        out = []
        for i, s in enumerate(sequences):
            offset, size = 0, sum(len(p[2]) // 4 for p in s)
            tier = next((t for t in self.tiers if t >= size), self.top)
            for doc, start, ids, total in s:
                n = len(ids) // 4
                out.append((doc, start, n, zlib.crc32(ids), total, self.next_id, offset, tier, self.next_group + group[i], ids))
                offset += n
            self.next_id += 1
        self.next_group += groups
        return out


_PIECES = ("id {id}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
           "tier int, step_group long, ids binary")


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", tiers=TIERS,
         end_id: int = END_ID, buffer_tokens: int = BUFFER_TOKENS, with_ids: bool = False) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset, tier, step_group[, ids].

    ``ids`` holds little-endian unsigned 32-bit ids.  ``tokenizer_path`` must name a file of a tokenizer
    that drops white space, at the same place on every executor.
    """
    schema = _PIECES.format(id=docs.schema[id_col].dataType.simpleString())
    if not with_ids:
        schema = schema.removesuffix(", ids binary")
    names = [c.strip().split()[0] for c in schema.split(",")]
    end = np.asarray([end_id], "<u4").tobytes()

    def run(batches):
        from pyspark import TaskContext
        tokenizer, packer = worker_tokenizer(tokenizer_path), Packer(TaskContext.get().partitionId(), tiers, buffer_tokens)
        id_type = None

        def out(rows):
            for i in range(0, len(rows), 5000):
                cols = list(zip(*rows[i:i + 5000]))
                types = [id_type] + [pa.int64()] * 6 + [pa.int32(), pa.int64()] + [pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols[:len(names)], types)], names=names)

        for batch in batches:
            id_type = batch.schema.field(0).type
            for part in text_slices(batch, 1, TEXT_BYTES):
                for doc, ids in zip(part.column(0).to_pylist(), tokenizer.ids(part.column(1))):
                    packer.add(doc, ids + end)
                    if packer.held >= buffer_tokens:
                        yield from out(packer.flush(False))
        if packer.held:
            yield from out(packer.flush(True))
        pa.default_memory_pool().release_unused()

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def default_tokenizer() -> str:
    """The word-end BPE vocabulary named by the installed public tokenizer files."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op6(spark, sf_dir: str) -> DataFrame:
    """Every document of the table, packed."""
    return pack(load(spark, sf_dir, "documents"), default_tokenizer()).withColumnRenamed("id", "doc_id")
