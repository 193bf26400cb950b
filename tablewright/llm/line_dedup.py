"""Operator 3: line dedup by content-defined line chunks.

A rolling hash over the hashes of neighbouring lines picks where a chunk of
lines ends, so a passage put into different documents falls into the same
chunks wherever it stands, but for its edges.  Lines go by keys that a byte
comparison of all distinct lines has proven to be one-to-one, and a chunk by
the keys of its lines.  A chunk of several lines that occurs more than once in
the corpus is removed everywhere but where it comes first.

``remove_repeated_passages`` then extends what was found line by line: pairs of
neighbouring lines that no removed chunk covers - across chunk boundaries, at a
passage's edges, in passages too short to hold a common chunk - are looked up
in the same way, so no repeated passage of two lines or more is missed."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import beside_group, raw, steps, texts_of, written
from tablewright.llm.exact_dedup import WIDTHS, chunk_key, verified_width

#: Lines of a chunk that are not blank: least, most, and one boundary in so many past the least.
MIN_LINES, MAX_LINES, USUAL = 2, 32, 2
#: The rolling hash sees this many lines that are not blank.
WINDOW = 2
_FACTOR, _MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1
_DROP = pow(_FACTOR, WINDOW, 1 << 64)


def line_chunks(lines: list[bytes]) -> list[tuple[int, int]]:
    """(first line, end) of the chunks, in order.  A chunk ends at the first
    content boundary once it has MIN_LINES lines, else at MAX_LINES.  Blank
    lines do not count and are not hashed: they go with the line before them
    (at a text's start, with the first line)."""
    kept = [i for i, x in enumerate(lines) if x.strip()]
    hashes = [xxhash.xxh3_64_intdigest(lines[i]) for i in kept]
    out, start, size, rolling = [], 0, 0, 0
    for n, h in enumerate(hashes):
        rolling = (rolling * _FACTOR + h) & _MASK
        if n >= WINDOW:
            rolling = (rolling - hashes[n - WINDOW] * _DROP) & _MASK
        size += 1
        if size >= MAX_LINES or size >= MIN_LINES and (rolling * _FACTOR & _MASK) >> 40 & (USUAL - 1) == 0:
            end = kept[n + 1] if n + 1 < len(kept) else len(lines)
            out.append((start, end))
            start, size = end, 0
    if start < len(lines):
        out.append((start, len(lines)))
    return out


def removable(lines: list[bytes]) -> bool:
    """Whether a chunk may be removed: it has two lines at least that are not blank."""
    return sum(bool(x.strip()) for x in lines) >= 2


def line_spans(lines: list[bytes]) -> list[tuple[int, int]]:
    """(first line, end) for each line that is not blank, with the blank lines
    after it; the first one has those before it too."""
    starts = [i for i, x in enumerate(lines) if x.strip()]
    return list(zip([0, *starts[1:]], [*starts[1:], len(lines)], strict=False)) if starts else []


def _chunks_of(lines: list[bytes]) -> list[tuple[int, bytes]]:
    return [(a, b"\n".join(lines[a:b])) for a, b in line_chunks(lines) if removable(lines[a:b])]


def _lines_of(lines: list[bytes]) -> list[tuple[int, bytes]]:
    return list(enumerate(x for x in lines if x.strip()))


def _texts(batches: Iterator[pa.RecordBatch]):
    for part in steps(batches):
        mv, at = raw(part.column(part.schema.get_field_index("text")))
        yield part, [bytes(mv[a:b]) for a, b in zip(at, at[1:], strict=False)]


def _chunk_rows(width: int, seed: int, of=_chunks_of):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = chunk_key(width, seed)
        for _, texts in _texts(batches):
            found: dict[bytes, bytes] = {}
            keys, chunks = [], []
            for text in texts:
                for _, c in of(text.split(b"\n")):
                    k = key(c)
                    if found.setdefault(k, c) is c or found[k] != c:
                        keys.append(k)
                        chunks.append(c)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(chunks, pa.binary())], ["key", "chunk"])
    return run


def _places(width: int, seed: int, of=_chunks_of):
    """Where each chunk stands."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = chunk_key(width, seed)
        for part, texts in _texts(batches):
            ids = part.column(part.schema.get_field_index("doc_id")).to_pylist()
            cols: tuple[list, ...] = ([], [], [], [])
            for doc_id, text in zip(ids, texts, strict=True):
                sha = hashlib.sha256(text).digest()
                for a, k in [(a, key(c)) for a, c in of(text.split(b"\n"))]:
                    for c, x in zip(cols, (doc_id, sha, a, k), strict=True):
                        c.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.binary(), pa.int32(), pa.binary()), strict=True)],
                                             ["doc_id", "sha", "line", "key"])
    return run


def _rebuilt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in _texts(batches):
        ids = part.column(part.schema.get_field_index("doc_id"))
        gone = part.column(part.schema.get_field_index("gone")).to_pylist()
        counts, removed, clean = [], [], []
        for text, drop in zip(texts, gone, strict=True):
            lines = text.split(b"\n")
            stay, drop = lines, set(drop or ())
            if drop:
                stay = [x for a, b in line_chunks(lines) if a not in drop for x in lines[a:b]]
            counts.append(len(lines))
            removed.append(len(lines) - len(stay))
            clean.append(b"\n".join(stay).decode())
        yield pa.RecordBatch.from_arrays([ids, pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(clean, pa.string())],
                                         ["doc_id", "n_lines", "removed_lines", "text"])


def remove_repeated_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", widths=WIDTHS) -> DataFrame:
    """One row per input row: doc_id, n_lines, removed_lines, text (cleaned).

    Of a repeated chunk the occurrence with the smallest (doc_id, text hash,
    line) stays; a null doc_id comes first.  Rows that agree in doc_id and text
    count as one document, so their copies do not remove each other's lines.  A
    null text counts as empty: one empty line.  Chunks with fewer than two
    lines that are not blank stay.  An empty table gives an empty result."""
    rows = texts_of(docs, id_col, text_col)
    width, seed = verified_width(rows, _chunk_rows, widths)
    places = written(rows.mapInArrow(_places(width, seed), "doc_id long, sha binary, line int, key binary"), "line-chunks")
    here = F.struct("doc_id", "sha", "line")
    found = beside_group(places, ["key"], F.col("sha"), {"first": (F.min(here), F.min), "last": (F.max(here), F.max)})
    gone = (found.where((F.col("first") != F.col("last")) & (here != F.col("first")))
            .groupBy("doc_id", "sha").agg(F.collect_set("line").alias("gone"))  # at most a document's chunks
            .select(F.col("doc_id").alias("gone_id"), F.col("sha").alias("gone_sha"), "gone"))
    keyed = rows.withColumn("sha", F.unhex(F.sha2("text", 256)))
    marked = keyed.join(gone, keyed["doc_id"].eqNullSafe(gone["gone_id"]) & (keyed["sha"] == gone["gone_sha"]), "left")
    return marked.select("doc_id", "text", "gone").mapInArrow(_rebuilt, "doc_id long, n_lines long, removed_lines long, text string")


def _without_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in _texts(batches):
        ids = part.column(part.schema.get_field_index("doc_id"))
        gone, kept = (part.column(part.schema.get_field_index(c)).to_pylist() for c in ("gone", "kept"))
        counts, removed, clean = [], [], []
        for text, drop, hold in zip(texts, gone, kept, strict=True):
            lines = text.split(b"\n")
            stay = lines
            if drop:
                out = {n + k for n in drop for k in (0, 1)} - {n + k for n in hold or () for k in (0, 1)}
                stay = [x for n, (a, b) in enumerate(line_spans(lines)) if n not in out for x in lines[a:b]]
            counts.append(len(lines))
            removed.append(len(lines) - len(stay))
            clean.append(b"\n".join(stay).decode())
        yield pa.RecordBatch.from_arrays([ids, pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(clean, pa.string())],
                                         ["doc_id", "n_lines", "removed_lines", "text"])


def _chunk_lines(width: int, seed: int):
    """For each chunk: the place of its first line (blank ones not counted), the
    keys of its lines, and that of the line after it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = chunk_key(width, seed)
        for part, texts in _texts(batches):
            ids = part.column(part.schema.get_field_index("doc_id")).to_pylist()
            cols: tuple[list, ...] = ([], [], [], [], [])
            for doc_id, text in zip(ids, texts, strict=True):
                sha, lines, at, found = hashlib.sha256(text).digest()[:16], text.split(b"\n"), 0, []
                for a, b in line_chunks(lines):
                    keys = [key(x) for x in lines[a:b] if x.strip()]
                    if keys:
                        found.append((at, keys))
                        at += len(keys)
                for (n, keys), after in zip(found, [*[k[0] for _, k in found[1:]], b""], strict=False):
                    for c, x in zip(cols, (doc_id, sha, n, b"".join(keys), after), strict=True):
                        c.append(x)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.binary()), strict=True)],
                ["doc_id", "sha", "line", "keys", "after"])
    return run


def remove_repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", widths=WIDTHS) -> DataFrame:
    """One row per input row: doc_id, n_lines, removed_lines, text (cleaned).

    A repeated passage of two lines or more, however short, goes but for its
    first place in the order of (doc_id, text hash, line); a null doc_id comes
    first.  To the line: every pair of neighbouring lines (blank ones between
    them aside) that occurs more than once stays, whole, where it comes first;
    its lines go everywhere else, unless another repeated pair that comes first
    there needs them.  A line repeated alone stays.  Blank lines go with the
    line before them.

    Chunks that repeat settle the pairs inside them at once; only the others
    are looked up.  Rows that agree in doc_id and text count as one document, a
    null text as empty: one empty line.  An empty table gives an empty result."""
    rows = texts_of(docs, id_col, text_col)
    width, seed = verified_width(rows, partial(_chunk_rows, of=_lines_of), widths)
    here = F.struct("doc_id", "sha", "line")
    ends = {"first": (F.min(here), F.min), "last": (F.max(here), F.max)}
    chunks = rows.mapInArrow(_chunk_lines(width, seed), "doc_id long, sha binary, line int, keys binary, after binary")
    chunks = written(chunks.withColumn("row", F.monotonically_increasing_id()), "line-chunks")
    chunks = beside_group(chunks, ["keys"], F.col("row"), ends).withColumn("repeated", F.col("first") != F.col("last"))
    chunks = written(chunks.withColumn("again", F.col("repeated") & (here != F.col("first"))), "line-chunks-found")

    n = F.expr(f"int(octet_length(keys) div {width})")
    inner = F.when(F.col("again") | (n < 2), F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), n - 2))
    inside = F.transform(inner, lambda i: F.struct(
        i.alias("i"), F.substring(F.col("keys"), i * width + 1, F.lit(2 * width)).alias("key"), F.col("repeated").alias("known")))
    across = F.when(F.octet_length("after") > 0, F.array(F.struct(
        (n - 1).alias("i"), F.concat(F.substring(F.col("keys"), (n - 1) * width + 1, F.lit(width)), F.col("after")).alias("key"), F.lit(False).alias("known"))))
    pairs = chunks.select("row", "doc_id", "sha", "line", F.explode(F.concat(inside, F.coalesce(across, F.filter(inside, lambda _: F.lit(False))))).alias("p"))
    pairs = pairs.select("row", "doc_id", "sha", (F.col("line") + F.col("p.i")).alias("line"), "p.key", "p.known")
    found = beside_group(pairs, ["key"], F.col("row"), ends | {"settled": (F.max("known"), F.max)})
    found = found.where((F.col("first") != F.col("last")) | F.col("settled")).withColumn("comes_first", here == F.col("first"))
    none = F.array().cast("array<int>")
    marks = found.select("doc_id", "sha", F.when(F.col("comes_first"), none).otherwise(F.array("line")).alias("gone"),
                         F.when(F.col("comes_first"), F.array("line")).otherwise(none).alias("kept"))
    marks = marks.unionByName(chunks.where(F.col("again") & (n > 1)).select(
        "doc_id", "sha", F.sequence(F.col("line"), F.col("line") + n - 2).alias("gone"), none.alias("kept")))
    marks = (marks.groupBy("doc_id", "sha")  # at most a document's lines
             .agg(*[F.array_distinct(F.flatten(F.collect_list(c))).alias(c) for c in ("gone", "kept")])
             .select(F.col("doc_id").alias("gone_id"), F.col("sha").alias("gone_sha"), "gone", "kept"))
    keyed = rows.withColumn("sha", F.expr("substring(unhex(sha2(text, 256)), 1, 16)"))
    marked = keyed.join(marks, keyed["doc_id"].eqNullSafe(marks["gone_id"]) & (keyed["sha"] == marks["gone_sha"]), "left")
    return marked.select("doc_id", "text", "gone", "kept").mapInArrow(_without_pairs, "doc_id long, n_lines long, removed_lines long, text string")
