"""Projections, filters and sorts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..util import as_list, col, qcol


def select_except(df: DataFrame, drop=(), **computed) -> DataFrame:
    """``SELECT <computed>, * EXCEPT (drop)``: computed columns first (in the
    given order), then every other column except ``drop`` and the computed
    names."""
    skip = set(as_list(drop)) | set(computed)
    first = [(F.expr(v) if isinstance(v, str) else v).alias(k) for k, v in computed.items()]
    return df.select(*first, *[qcol(c) for c in df.columns if c not in skip])


def drop_columns(df: DataFrame, names) -> DataFrame:
    """Drop columns; names that are absent are ignored."""
    present = [c for c in as_list(names) if c in df.columns]
    return df.drop(*present)


def rename_column(df: DataFrame, old: str, new: str) -> DataFrame:
    """Rename one column (e.g. the control column 'newline' -> 'delta_flg')."""
    return df.withColumnRenamed(old, new)


def filter_ilike(df: DataFrame, column: str, patterns, negate: bool = False,
                 match_all: bool = False) -> DataFrame:
    """Case-insensitive LIKE against one or more patterns ('%p%', 'p%').
    Any pattern matches by default; ``match_all`` needs all of them;
    ``negate`` keeps rows matching none (NULL text is dropped either way)."""
    conds = [qcol(column).ilike(p) for p in as_list(patterns)]
    cond = conds[0]
    for c in conds[1:]:
        cond = (cond & c) if match_all else (cond | c)
    return df.where(~cond if negate else cond)


def filter_predicate(df: DataFrame, cond) -> DataFrame:
    """Plain filter (SQL text or Column); Catalyst pushes what it can to the
    parquet scan."""
    return df.where(F.expr(cond) if isinstance(cond, str) else cond)


def filter_key_text(df: DataFrame, key: str, text: str) -> DataFrame:
    """Point lookup by a key given as text (``k = '5240...'``): the text is
    compared as the key's own type, so big integers compare exactly."""
    return df.where(qcol(key) == F.lit(text).cast(df.schema[key].dataType))


def with_literal(df: DataFrame, name: str, value, dtype: str | None = None) -> DataFrame:
    lit = F.lit(value)
    return df.withColumn(name, lit.cast(dtype) if dtype else lit)


def sort_by(df: DataFrame, cols: Sequence) -> DataFrame:
    """Global sort (range-partitioned by Spark)."""
    return df.orderBy(*[col(c) for c in cols])


def sample_rows(df: DataFrame, n: int, order: Sequence) -> DataFrame:
    """The first ``n`` rows in ``order``: a top-k (TakeOrderedAndProject),
    each task keeps only its own k best rows."""
    return df.orderBy(*[col(c) for c in order]).limit(n)


def order_spec(cols) -> list[Column]:
    return [col(c) for c in as_list(cols)]
