"""Operator 7: token counts by prefix dynamic programming.

``bpe.PrefixTable`` stores the exact token count at every prefix of a
pre-token.  A text's count is the sum over its pre-tokens; where a text may be
cut to keep a budget is read off the same tables, without encoding again."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tablewright.llm.bpe import PrefixTable, Remembered, is_plain_byte_level, load_json
from tablewright.llm.common import steps, texts_of

#: Fixed: what a contraction that is cut before its end falls apart into is an apostrophe and a letter.
_CONTRACTION = regex.compile(r"'(?:re|ve|ll)")
_SPACE = regex.compile(r"\s+")


class Counter:
    """Token counts by a plain byte-level file; any other is refused."""

    def __init__(self, path: str, pattern: str):
        if not is_plain_byte_level(path):
            raise ValueError(f"{path} is not a plain byte-level file, whose prefixes this counts")
        vocab, self.special = load_json(path)
        self.table = PrefixTable(vocab)
        self.memory = Remembered(pattern, self._totals, sum)
        self.pattern = self.memory.pattern
        self.marks = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None

    def _totals(self, pieces: list[str]) -> list[int]:
        return [self.table.counts(p.encode())[-1] for p in pieces]

    def totals(self, texts: list[str]) -> list[int]:
        """The token count of each text; a special string inside is one token."""
        plain = [t for t in texts if not self.marks or not self.marks.search(t)]
        known = iter(self.memory.many(plain))
        return [next(known) if not self.marks or not self.marks.search(t)
                else sum(self.memory.many(self.marks.split(t))) + len(self.marks.findall(t)) for t in texts]

    def _piece_prefixes(self, piece: str) -> np.ndarray:
        """Counts at the character prefixes 1..len(piece) of a pre-token."""
        counts = self.table.counts(piece.encode())
        ends = np.cumsum([len(c.encode()) for c in piece])
        out = np.array(counts)[ends]
        if _CONTRACTION.fullmatch(piece):
            out[1] = out[0] + 1
        return out

    def _stretch(self, text: str) -> np.ndarray:
        """Counts at the prefixes 0..len(text) of a text without special strings.

        A prefix that ends inside or just behind white space has the whole run
        up to there as one pre-token, whoever gets its last space in the full
        text; any other prefix ends inside a pre-token of the full text."""
        out = np.zeros(len(text) + 1, np.int64)
        total, at = 0, 0
        for piece in self.pattern.findall(text):
            out[at + 1:at + len(piece) + 1] = total + self._piece_prefixes(piece)
            at += len(piece)
            total = int(out[at])
        runs = []
        for run in _SPACE.finditer(text):
            a, b = run.span()
            runs.append((a, b, out[a] + self._piece_prefixes(run[0])))
        for a, b, counts in runs:
            out[a + 1:min(b, len(text)) + 1] = counts
        return out

    def prefixes(self, text: str) -> np.ndarray:
        """out[i]: the exact token count of text[:i], for every i."""
        out = np.zeros(len(text) + 1, np.int64)
        start = total = 0
        for mark in self.marks.finditer(text) if self.marks else ():
            a, b = mark.span()
            # inside a special string the prefix holds only part of it, which is ordinary text
            out[start:b] = total + self._stretch(text[start:b - 1])
            total = int(out[a]) + 1
            out[b] = total
            start = b
        out[start:] = total + self._stretch(text[start:])
        return out

    def cut(self, text: str, budget: int) -> int:
        """Characters of the longest prefix with at most ``budget`` tokens."""
        return int(np.flatnonzero(self.prefixes(text) <= budget)[-1])


@lru_cache(maxsize=1)
def counter(path: str, pattern: str) -> Counter:
    return Counter(path, pattern)


def count_tokens(docs: DataFrame, path: str, pattern: str, limit: int = 512, id_col: str = "doc_id",
                 text_col: str = "text", with_prefixes: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_tokens, over_limit,
    and with ``with_prefixes`` also prefix_tokens (the count at every
    character prefix, from 0) and fit_chars (characters that fit the limit).

    A null text counts as empty, with no tokens.  No row moves."""
    fields = "doc_id long, n_bytes long, n_tokens long, over_limit boolean" + ", prefix_tokens array<long>, fit_chars long" * with_prefixes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path, pattern)
        for part in steps(batches):
            texts = part.column(part.schema.get_field_index("text"))
            strings = texts.to_pylist()
            totals = np.array(own.totals(strings), np.int64)
            cols = [part.column(part.schema.get_field_index("doc_id")),
                    pa.array([len(t.encode()) for t in strings], pa.int64()),
                    pa.array(totals), pa.array(totals > limit)]
            if with_prefixes:
                cols += [pa.array([own.prefixes(t) for t in strings], pa.list_(pa.int64())),
                         pa.array([own.cut(t, limit) for t in strings], pa.int64())]
            names = ["doc_id", "n_bytes", "n_tokens", "over_limit", "prefix_tokens", "fit_chars"]
            yield pa.RecordBatch.from_arrays(cols, names[:len(cols)])

    return texts_of(docs, id_col, text_col).mapInArrow(run, fields)
