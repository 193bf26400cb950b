"""Operator 11: fill-in-the-middle by repeated-capture matching.

A text is a run of units: words of ASCII letters, and any other character by
itself.  One ``fullmatch`` of ``(unit)*`` keeps every repetition of its group,
so the ends of the group give the number of units and both cuts at once, with
no loop over units.  Which cuts and which form a document gets is drawn from a
hash of its id, so a run again gives the same.

The matcher keeps some 80 bytes a character while it matches, and gives up at
about ten million of them: a text longer than STRETCH is matched in stretches
that end where a unit ends, of which only the counts are kept."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import steps, texts_of

#: Characters matched at once.
STRETCH = 1 << 20
_UNITS = regex.compile(r"([A-Za-z]++|[^A-Za-z])*+")
_LETTERS = regex.compile(r"[A-Za-z]*+")
#: The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of a hundred documents so many stay plain, and of a hundred others so many put the suffix first.
PLAIN_SHARE, SUFFIX_FIRST_SHARE = 10, 20


class Units:
    """The units of a text: ``n`` of them, and where the k-th ends."""

    def __init__(self, text: str, stretch: int = STRETCH):
        self.text, self.spans, self.n, at = text, [], 0, 0
        self.ends: list[int] = []
        while at < len(text):
            stop = min(len(text), at + stretch)
            if stop < len(text) and _LETTERS.match(text, stop - 1).end() > stop:  # a word goes on here
                stop = _LETTERS.match(text, stop).end()
            self.ends = _UNITS.fullmatch(text, at, stop).ends(1)
            self.spans.append((at, stop, self.n))
            self.n += len(self.ends)
            at = stop

    def end(self, k: int) -> int:
        """Characters in the first k units."""
        if not k:
            return 0
        at, stop, before = next(s for s in reversed(self.spans) if s[2] < k)
        ends = self.ends if at == self.spans[-1][0] else _UNITS.fullmatch(self.text, at, stop).ends(1)
        return ends[k - before - 1]


def draws(doc_id: int | None, seed: int = 1) -> tuple[int, int, int, int]:
    """Four 32-bit numbers for a document, from the hash of seed and id (null: no digits)."""
    own = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(own[k:k + 4], "big") for k in (0, 4, 8, 12))  # type: ignore[return-value]


def rearranged(text: str, doc_id: int | None, seed: int = 1, plain: int = PLAIN_SHARE, suffix_first: int = SUFFIX_FIRST_SHARE,
               stretch: int = STRETCH) -> tuple[int, str, int | None, int | None, str]:
    """(units, form, characters of the prefix, of the middle, text as rearranged)."""
    units = Units(text, stretch)
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not text or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= 100 - plain:
        return units.n, "plain", None, None, text
    a, b = sorted((h1 % (units.n + 1), h2 % (units.n + 1)))
    a, b = units.end(a), units.end(b)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < suffix_first:
        return units.n, "spm", a, b - a, "".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    return units.n, "psm", a, b - a, "".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))


def transform(docs: DataFrame, seed: int = 1, plain: int = PLAIN_SHARE, suffix_first: int = SUFFIX_FIRST_SHARE,
              id_col: str = "doc_id", text_col: str = "text", stretch: int = STRETCH) -> DataFrame:
    """One row per input row: doc_id, n, form, prefix_chars, middle_chars, text
    (rearranged).

    The prefix ends after the smaller of two drawn numbers of units, the middle
    after the larger; either may be empty.  A text that is empty (null counts
    as empty), that holds one of the marks, or that is drawn to be plain stays
    as it is, without cuts.  Rows with the same id are cut by the same draws;
    a null id draws as an id without digits.  An empty table gives an empty
    result.  Nothing is shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches):
            ids = part.column(part.schema.get_field_index("doc_id"))
            texts = part.column(part.schema.get_field_index("text")).to_pylist()
            out = [rearranged(t, i, seed, plain, suffix_first, stretch) for i, t in zip(ids.to_pylist(), texts, strict=True)]
            n, form, a, b, text = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(a, pa.int64()), pa.array(b, pa.int64()),
                 pa.array(text, pa.string())], ["doc_id", "n", "form", "prefix_chars", "middle_chars", "text"])

    return texts_of(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, text string")


def restored(text: Column, form: Column) -> Column:
    """The text as it was, from what ``transform`` made of it.  The marks are
    not in the text, so the first one found after each part ends it."""
    def after(whole: Column, part: Column) -> Column:
        return F.substring(whole, F.char_length(part) + len(MIDDLE) + 1, F.char_length(whole))

    def parts(second: str) -> tuple[Column, Column, Column]:
        body = F.substring(text, F.lit(len(PREFIX) + 1), F.char_length(text))
        one = F.substring_index(body, second, 1)
        rest = after(body, one)
        two = F.substring_index(rest, MIDDLE, 1)
        return one, two, after(rest, two)

    prefix, suffix, middle = parts(SUFFIX)
    last, first, between = parts(PREFIX)
    return (F.when(form == "psm", F.concat(prefix, middle, suffix)).when(form == "spm", F.concat(first, between, last)).otherwise(text))
