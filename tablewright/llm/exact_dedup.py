"""Operator 8: exact duplicates by content-defined chunk recipes.

A rolling hash over a text's bytes picks chunk boundaries from content alone,
so equal texts always fall into equal chunks.  Each chunk gets a key (a prefix
of a 128-bit hash).  Before keys stand for chunks, Spark brings the distinct
(key, bytes) pairs together and compares bytes: a key that names two different
chunks is found there, and the keys are then made anew, twice as wide.  With
keys proven one-to-one, a text is its ordered list of keys (its recipe); only
recipes are grouped, so a long text's bytes move once, chunk by chunk, after
map-side removal of repeated chunks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import beside_group, raw, rows_that_stay, steps, texts_of, written

#: Chunk sizes in bytes: least, most, and (a power of two) the usual distance of boundaries.
MIN_CHUNK, MAX_CHUNK, USUAL = 512, 16384, 1024
#: The rolling hash sees this many bytes; MIN_CHUNK exceeds it, so no boundary depends on what precedes the text.
WINDOW = 32
_GEAR = np.random.Generator(np.random.PCG64(8)).integers(0, 1 << 32, 256, dtype=np.uint64).astype(np.uint32)
#: Key widths tried in turn, in bytes, each with a seed of its own.
WIDTHS = (16, 16)


def rolling(data: np.ndarray) -> np.ndarray:
    """At each byte, the sum of gear values of the last 32 bytes, the one k
    places back shifted left by k bits.  Built by doubling the window."""
    h = _GEAR[data]
    for step in (1, 2, 4, 8, 16):
        prev = h[:-step] << np.uint32(step)
        h = h.copy()
        h[step:] += prev
    return h


def boundaries(data: np.ndarray, at: list[int]) -> list[list[int]]:
    """For each row [at[i], at[i+1]) of ``data``: the ends of its chunks.  A
    chunk ends at the first content boundary past MIN_CHUNK bytes, else at
    MAX_CHUNK; the last chunk ends with the text.  An empty text has none."""
    lo, hi = at[0], at[-1]
    marks = (np.flatnonzero(rolling(data[lo:hi]) >> np.uint32(32 - USUAL.bit_length() + 1) == 0) + lo + 1).tolist()
    out, m, n = [], 0, len(marks)
    for a, b in zip(at, at[1:], strict=False):
        ends, start = [], a
        while start < b:
            while m < n and marks[m] < start + MIN_CHUNK:
                m += 1
            end = min(b, start + MAX_CHUNK, marks[m] if m < n else b)
            ends.append(end)
            start = end
        out.append(ends)
    return out


def chunk_key(width: int, seed: int):
    def key(chunk) -> bytes:
        return xxhash.xxh3_128_digest(chunk, seed)[:width]
    return key


def _chunk_rows(width: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = chunk_key(width, seed)
        for part in steps(batches):
            mv, at = raw(part.column(part.schema.get_field_index("text")))
            cuts = boundaries(np.frombuffer(mv, np.uint8), at)
            found: dict[bytes, bytes] = {}
            keys, chunks = [], []
            for a, ends in zip(at, cuts, strict=False):
                for b in ends:
                    k, c, a = key(mv[a:b]), bytes(mv[a:b]), b
                    if found.setdefault(k, c) is c or found[k] != c:  # repeats within a step, byte for byte, go no further
                        keys.append(k)
                        chunks.append(c)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(chunks, pa.binary())], ["key", "chunk"])
    return run


def _recipe_rows(width: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = chunk_key(width, seed)
        for part in steps(batches):
            mv, at = raw(part.column(part.schema.get_field_index("text")))
            cuts = boundaries(np.frombuffer(mv, np.uint8), at)
            recipes, shas = [], []
            for a, b, ends in zip(at, at[1:], cuts, strict=False):
                recipes.append(b"".join(key(mv[x:y]) for x, y in zip([a, *ends], ends, strict=False)))
                shas.append(hashlib.sha256(mv[a:b]).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [part.column(part.schema.get_field_index("doc_id")), pa.array(recipes, pa.binary()), pa.array(shas)],
                ["doc_id", "recipe", "text_sha256"])
    return run


def verified_width(rows: DataFrame, chunk_rows, widths=WIDTHS) -> tuple[int, int]:
    """The first (width, seed) whose keys name one chunk each over the whole
    corpus, shown by comparing the bytes of all distinct chunks.
    ``chunk_rows(width, seed)`` makes the task that lists (key, chunk)."""
    for seed, width in enumerate(widths):
        pairs = rows.mapInArrow(chunk_rows(width, seed), "key binary, chunk binary").distinct()
        if pairs.groupBy("key").count().where("count > 1").isEmpty():
            return width, seed
    raise ValueError("every key width named two different chunks alike; give a wider one")


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", widths=WIDTHS) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Of rows with equal texts the one with the largest doc_id is kept.  Null
    texts count as empty, and all empty texts form one group.  A null doc_id
    is below any other.  Of repeated rows (equal doc_id and text) exactly one
    is kept, so ``kept`` holds once per distinct text.  An empty table gives an
    empty result.

    A large group is spread over many tasks (``common.beside_group``)."""
    rows = texts_of(docs, id_col, text_col)
    width, seed = verified_width(rows, _chunk_rows, widths)
    listed = (rows.mapInArrow(_recipe_rows(width, seed), "doc_id long, recipe binary, text_sha256 string")
              .withColumn("rid", F.monotonically_increasing_id()))
    listed = written(listed, "recipes")
    grouped = beside_group(listed, ["recipe"], F.col("rid"), {"top": (F.max(F.struct("doc_id", "rid")), F.max),
                                                             "group_size": (F.count(F.lit(1)), F.sum)})
    return grouped.select("doc_id", F.col("top.doc_id").alias("keep_id"), "group_size",
                          (F.col("rid") == F.col("top.rid")).alias("kept"), "text_sha256")


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row for each distinct text, all columns as they were.

    The row kept is the one ``duplicate_groups`` names; of repeated rows any
    one, as they agree in doc_id and text."""
    stay = duplicate_groups(docs, id_col, text_col).where("kept").select("doc_id", F.unhex("text_sha256").alias("sha"))
    return rows_that_stay(docs, stay, id_col, text_col)
