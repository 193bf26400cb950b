"""String column functions (F1-F5).  All are compositions of built-in
expressions, so they run inside generated code."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..util import col


def replace_chain(c, pairs: Sequence[tuple[str, str]]) -> Column:
    """Literal (not regex) replacements applied left to right; each step
    sees the output of the previous one, so order matters."""
    out = col(c)
    for old, new in pairs:
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def split_fields(c, sep: str, literal: bool = True, limit: int = -1) -> Column:
    """Split into an array on ``sep``; ``literal`` escapes regex characters
    (a two-character '^A' separator is a caret and an A, not byte 0x01)."""
    return F.split(col(c), re.escape(sep) if literal else sep, limit)


def split_part(c, delim: str, part: int) -> Column:
    """1-based field of a delimited string ('' when out of range; negative
    counts from the end)."""
    return F.split_part(col(c), F.lit(delim), F.lit(part))


def path_stem(c) -> Column:
    """Last '/'-separated part of a path, up to its first '.'
    ('/a/b/insert_x_default.sql' -> 'insert_x_default')."""
    return F.substring_index(F.substring_index(col(c), "/", -1), ".", 1)


def strip_affixes(c, remove: Sequence[str]) -> Column:
    """Remove each literal in ``remove`` wherever it occurs, in order."""
    return replace_chain(c, [(r, "") for r in remove])


def tail_after(c, marker: str) -> Column:
    """Text after the last occurrence of ``marker`` (whole text if absent)."""
    return F.substring_index(col(c), marker, -1)


def word_list(c, strip_chars: str = "()", sep: str = " ", drop=("",)) -> Column:
    """Array of words: remove ``strip_chars``, split on ``sep``, drop the
    listed words (empty strings by default, so doubled separators leave no
    holes)."""
    arr = F.split(F.translate(col(c), strip_chars, ""), re.escape(sep), -1)
    for d in drop:
        arr = F.array_remove(arr, F.lit(d))
    return arr


# The grammar of an index definition, as patterns.
_NAME = r'(?:"(?:[^"]|"")+"|[\p{L}_][\w$]*)'
_HEAD = (r"(?isU)\bcreate\s+(?:unique\s+)?index\b(?:\s+concurrently)?(?:\s+if\s+not\s+exists)?"
         rf"(?:\s+(?!on\b){_NAME}(?:\.{_NAME})*)?\s+on\s+(?:only\s+)?(?:{_NAME}\.)*({_NAME})\s*(?:using\s+\w+\s*)?\(")
_TOKEN = r"""("(?:[^"]|"")*"|'(?:[^']|'')*'|[(),]|[^"'(),]+)"""
_ITEM = (rf"(?isU)^\s*({_NAME})(?:\s+collate\s+{_NAME}(?:\.{_NAME})*)?(?:\s+(?!(?:asc|desc|nulls)\b)[\w.]+(?:\s*\(.*\))?)?"
         r"(?:\s+(?:asc|desc))?(?:\s+nulls\s+(?:first|last))?\s*$")


def _plain_name(c: Column) -> Column:
    """A name without its quotes, lower case."""
    quoted = F.startswith(c, F.lit('"'))
    inner = F.replace(F.substring(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))
    return F.lower(F.when(quoted, inner).otherwise(c))


def index_items(c) -> Column:
    """What an index is on, as written, in order: the entries of the bracketed
    list in 'CREATE INDEX i ON s.t USING btree (lower(a), b DESC, "c, d")' are
    cut at the commas that stand in no inner bracket and no quotes.  NULL for
    text that is no such statement, or whose list does not end."""
    text = col(c)
    body = F.regexp_extract(text, _HEAD + "(.*)$", 2)
    step_type = "struct<depth int, done boolean, item string, items array<string>>"

    def step(s: Column, t: Column) -> Column:
        def state(depth, done, item, items):
            return F.struct(depth.alias("depth"), F.lit(done).alias("done"), item.alias("item"), items.alias("items")).cast(step_type)
        depth, item, items = s["depth"], s["item"], s["items"]
        more = F.concat(item, t)
        ended = F.concat(items, F.array(F.trim(item)))
        return (F.when(s["done"], s)
                .when(t == "(", state(depth + 1, False, more, items))
                .when((t == ")") & (depth == 0), state(depth, True, F.lit(""), ended))
                .when(t == ")", state(depth - 1, False, more, items))
                .when((t == ",") & (depth == 0), state(depth, False, F.lit(""), ended))
                .otherwise(state(depth, False, more, items)))

    start = F.struct(F.lit(0).alias("depth"), F.lit(False).alias("done"), F.lit("").alias("item"),
                     F.array().cast("array<string>").alias("items")).cast(step_type)
    end = F.aggregate(F.regexp_extract_all(body, F.lit(_TOKEN), F.lit(1)), start, step)
    return F.when(end["done"], end["items"])


def index_column_list(c) -> tuple[Column, Column]:
    """From an index definition: the table's name and the array of the plain
    columns that it is on, lower case.  Collation, operator class, direction
    and place of NULLs are left out; an expression is not a column and gives
    none.  Text that is no such statement gives '' and an empty array."""
    text = col(c)
    found = F.transform(F.coalesce(index_items(text), F.array().cast("array<string>")), lambda i: F.regexp_extract(i, _ITEM, 1))
    table = _plain_name(F.regexp_extract(text, _HEAD, 1))
    return table, F.transform(F.filter(found, lambda n: n != ""), _plain_name)


def index_columns(c) -> tuple[Column, Column]:
    """``index_column_list`` with the columns joined by commas."""
    table, columns = index_column_list(c)
    return table, F.array_join(columns, ",")
