"""Operator 4: packing by non-negative least squares.

Documents become ids, are cut into pieces of at most a window, and only the
pieces' lengths matter from there on.  Combinations of up to three lengths
that fill a window exactly are the columns of a matrix; non-negative least
squares finds how often to repeat each so that the lengths in use match the
histogram of pieces.  The counts are rounded down, what they leave over is
packed greedily (longest first, into the sequence it fills best), and the
plan - ranges of equal pieces to sequences and offsets - goes back to the
tasks.  The driver sees one number for each length, at most as many as the
window has tokens; pieces stay in Spark."""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.bpe import Remembered, is_plain_byte_level, load_json, packed_ids
from tablewright.llm.common import steps, texts_of, written

#: Stretches of text whose ids a worker keeps.
WORDS_KEPT = 400_000
#: Rounds of the least-squares solver.
ROUNDS = 300


class Tokens:
    """Ids of whole texts as the tokenizers library gives them.

    For a plain byte-level file each stretch between spaces is encoded once for
    as long as it is remembered.  There merging by lowest id is merging by rank, and
    tiktoken's encoder, given the file's own tokens and ids, does it in a
    fraction of the time (tests hold the two against each other).  For any
    other file whole texts go through the library."""

    def __init__(self, path: str, pattern: str):
        self.library = None
        if not is_plain_byte_level(path):
            from tokenizers import Tokenizer

            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
            self.library = Tokenizer.from_file(path)
            return
        import tiktoken

        vocab, self.special = load_json(path)
        self.own = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=vocab, special_tokens={})
        self.memory = Remembered(pattern, None, b"".join, limit=WORDS_KEPT, of_texts=self._packed)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def _packed(self, texts: list[str]) -> list[bytes]:
        return [packed_ids(self.own.encode_ordinary(t)) for t in texts]

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.library is not None:
            return [packed_ids(e.ids) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        plain = [t for t in texts if not self.marks or not self.marks.search(t)]
        known = iter(self.memory.many(plain))
        return [next(known) if not self.marks or not self.marks.search(t) else self._marked(t) for t in texts]

    def _marked(self, text: str) -> bytes:
        parts = self.marks.split(text)  # every second one is a special string
        values = self.memory.many(parts[::2])
        for k, mark in enumerate(parts[1::2]):
            values[k] += packed_ids([self.special[mark]])
        return b"".join(values)


@lru_cache(maxsize=1)
def tokens(path: str, pattern: str) -> Tokens:
    return Tokens(path, pattern)


def pieces(docs: DataFrame, path: str, pattern: str, window: int, end_id: int,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's ids, ended by ``end_id``, cut at every full window.
    ``part`` and ``nth`` number the pieces of one length within a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part = tokens(path, pattern), TaskContext.get().partitionId()
        end, met = packed_ids([end_id]), [0] * (window + 1)
        for step in steps(batches):
            ids = step.column(step.schema.get_field_index("doc_id")).to_pylist()
            cols: tuple[list, ...] = ([], [], [], [], [], [])
            for doc_id, packed in zip(ids, own.encode(step.column(step.schema.get_field_index("text")).to_pylist()), strict=True):
                packed += end
                n = len(packed) // 4
                for start in range(0, n, window):
                    length = min(window, n - start)
                    row = (doc_id, start, length, zlib.crc32(packed[4 * start:4 * (start + length)]), n, met[length])
                    met[length] += 1
                    for c, x in zip(cols, row, strict=True):
                        c.append(x)
            arrays = [pa.array(c, pa.int64()) for c in cols]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array([part] * len(cols[0]), pa.int64())],
                                             ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "nth", "part"])

    return texts_of(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, nth long, part long")


def combinations(lengths: np.ndarray, window: int) -> np.ndarray:
    """All ways to fill the window with up to three of the ``lengths``: rows
    (a, b, c) with a >= b >= c, where 0 stands for no piece."""
    has = np.zeros(window + 1, bool)
    has[lengths] = True
    has[0] = True
    found = []
    for a in range(window, 0, -1):
        if has[a]:
            left = window - a
            b = np.arange(-(-left // 2), min(a, left) + 1)
            b = b[has[b] & has[left - b]]
            found.append(np.stack([np.full(len(b), a), b, left - b], 1))
    return np.concatenate(found) if found else np.zeros((0, 3), int)


def solve(combos: np.ndarray, hist: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Repeats x >= 0 of the combinations that bring the lengths they use
    closest to ``hist`` in the sense of least squares (accelerated projected
    gradient).  Missing a long piece weighs more: short ones are easy to place
    afterwards."""
    if not len(combos):
        return np.zeros(0)
    size = len(hist)
    weight = np.where(np.arange(size) * 8 >= size, 1.0, 0.3)
    weight[0] = 0.0
    w2 = weight ** 2

    def uses(x):
        return sum(np.bincount(combos[:, k], x, size) for k in range(3))

    def pull(r):
        return r[combos].sum(1)

    x = np.ones(len(combos))
    for _ in range(12):  # largest eigenvalue, for the step
        y = pull(w2 * uses(x))
        x = y / max(np.linalg.norm(y), 1e-30)
    step = 0.95 / max(float(x @ pull(w2 * uses(x))), 1e-30)
    x = y = np.zeros(len(combos))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(y - step * pull(w2 * (uses(y) - hist)), 0)
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def plan(hist: np.ndarray, window: int, rounds: int = ROUNDS) -> list[tuple[int, tuple[int, ...]]]:
    """(repeats, lengths in order) of sequences that use every piece of the
    histogram (hist[n]: pieces of length n) exactly once."""
    left = hist.astype(np.int64).copy()
    left[0] = 0
    out: list[tuple[int, tuple[int, ...]]] = []
    combos = combinations(np.flatnonzero(left), window)
    x = solve(combos, left.astype(float), rounds)
    for i in np.argsort(-x, kind="stable"):
        lengths = tuple(int(n) for n in combos[i] if n)
        repeats = min(int(x[i] + 1e-6), min(int(left[n]) // lengths.count(n) for n in set(lengths)))
        if x[i] < 1 - 1e-6:
            break
        if repeats > 0:
            out.append((repeats, lengths))
            for n in lengths:
                left[n] -= repeats
    # greedily, longest first: a piece goes where it leaves least room, equal pieces and equal sequences at once
    rooms: dict[int, list[tuple[int, tuple[int, ...]]]] = {}
    spaces: list[int] = []

    def put(repeats: int, lengths: tuple[int, ...]) -> None:
        space = window - sum(lengths)
        if space not in rooms:
            rooms[space] = []
            insort(spaces, space)
        rooms[space].append((repeats, lengths))

    for n in range(window, 0, -1):
        count = int(left[n])
        while count:
            k = bisect_left(spaces, n)
            if k == len(spaces):
                each = window // n
                if count >= each:
                    put(count // each, (n,) * each)
                if count % each:
                    put(1, (n,) * (count % each))
                break
            space = spaces[k]
            repeats, lengths = rooms[space].pop()
            if not rooms[space]:
                del rooms[space], spaces[k]
            use = min(repeats, count)
            if repeats > use:
                put(repeats - use, lengths)
            put(use, (*lengths, n))
            count -= use
    for space in sorted(rooms):
        out += rooms[space]
    return out


def lookup(planned: list[tuple[int, tuple[int, ...]]]) -> tuple[np.ndarray, ...]:
    """The plan as ranges over the pieces of each length, numbered from 0:
    sorted keys (length << 40 | first rank), and for each range the sequence
    of its first piece and the offset there."""
    taken: dict[int, int] = {}
    keys, seqs, offsets, base = [], [], [], 0
    for repeats, lengths in planned:
        at = 0
        for n in lengths:
            rank = taken.get(n, 0)
            keys.append(n << 40 | rank)
            seqs.append(base)
            offsets.append(at)
            taken[n] = rank + repeats
            at += n
        base += repeats
    order = np.argsort(np.array(keys, np.int64))
    return tuple(np.array(v, np.int64)[order] for v in (keys, seqs, offsets))


def pack(docs: DataFrame, path: str, pattern: str, window: int = 2048, end_id: int = 1,
         id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset.

    A null or empty text is one piece that holds the end id alone.  Rows that
    repeat are packed as often as they occur.  An empty table gives an empty
    result.  Each sequence takes at most ``window`` tokens and has no gaps."""
    spark = docs.sparkSession
    cut = written(pieces(docs, path, pattern, window, end_id, id_col, text_col), "pieces")
    hist = np.zeros(window + 1, np.int64)
    for r in cut.groupBy("length").count().collect():  # at most one row for each length up to the window
        hist[r["length"]] = r["count"]
    table = spark.sparkContext.broadcast(lookup(plan(hist, window, rounds)))  # bounded by the window, not by the corpus
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = (cut.groupBy("part", "length").count()
             .select("part", "length", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first")))
    ranked = cut.join(first, ["part", "length"]).withColumn("rank", F.col("first") + F.col("nth"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, seqs, offsets = table.value
        for b in batches:
            key = b.column(2).to_numpy() << 40 | b.column(5).to_numpy()
            k = np.searchsorted(keys, key, "right") - 1
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(5)), pa.array(seqs[k] + key - keys[k]), pa.array(offsets[k])],
                                             ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "rank").mapInArrow(
        place, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
