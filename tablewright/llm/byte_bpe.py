"""Operator 10: byte-level BPE encoding and decoding.

Each match of the splitting pattern is encoded on its own by
``bpe.RankQueue``, a hierarchical-bitmap rank queue; values of short
pre-tokens are remembered, long ones are encoded each time they occur."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tablewright.llm.bpe import RankQueue, Remembered, load_ranks, packed_ids
from tablewright.llm.common import steps, texts_of


#: Strings whose ids a worker keeps, and as many stretches of text: encoding costs far more than looking up.
WORDS_KEPT = 1_000_000


class Codec:
    """Text to ids and ids to bytes, by the ranks in a file."""

    def __init__(self, path: str, pattern: str):
        ranks = load_ranks(path)
        self.queue = RankQueue(ranks)
        self.memory = Remembered(pattern, self._packed, b"".join, limit=WORDS_KEPT)
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token

    def _packed(self, pieces: list[str]) -> list[bytes]:
        return [packed_ids(self.queue.encode(p.encode())) for p in pieces]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        return self.memory.many(texts)

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(packed, "<u4").tolist()))


@lru_cache(maxsize=1)
def codec(path: str, pattern: str) -> Codec:
    """One codec for each Python worker; its memory serves all the worker's tasks."""
    return Codec(path, pattern)


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                     with_ids: bool = True) -> DataFrame:
    """One row per input row: doc_id, n_tokens, ids_sha256, decoded_sha256
    and, unless turned off, ids (array of int).

    The decoded bytes come from the ids, not from the text.  A null text
    counts as empty and has no ids.  No row moves: rows repeat as they are."""
    fields = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for part in steps(batches):
            packed = own.encode(part.column(part.schema.get_field_index("text")).to_pylist())
            cols = [part.column(part.schema.get_field_index("doc_id")),
                    pa.array([len(p) // 4 for p in packed], pa.int64()),
                    pa.array([hashlib.sha256(p).hexdigest() for p in packed]),
                    pa.array([hashlib.sha256(own.decode(p)).hexdigest() for p in packed])]
            if with_ids:
                cols.append(pa.array([np.frombuffer(p, "<i4") for p in packed], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"][:len(cols)])

    return texts_of(docs, id_col, text_col).mapInArrow(run, fields)


def decode_documents(encoded: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` (doc_id and ids) with the decoded bytes as ``decoded``.  A
    null list of ids gives null; an id outside the ranks fails the job."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = codec(path, "").tokens
        for b in batches:
            rows = b.column(b.schema.get_field_index("ids")).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [b.column(b.schema.get_field_index("doc_id")),
                 pa.array([None if r is None else b"".join(tokens[i] for i in r) for r in rows], pa.binary())], ["doc_id", "decoded"])

    from pyspark.sql import functions as F
    return encoded.select(F.col("doc_id"), F.col(f"`{ids_col}`").alias("ids")).mapInArrow(run, "doc_id long, decoded binary")
