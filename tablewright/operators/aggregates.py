"""Aggregations (A1-A5).  All use partial (map-side) aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..util import as_list, col, qcol
from . import rank


def row_count(df: DataFrame, by=None) -> DataFrame:
    """Rows in total, or per ``by`` group (column ``rows``)."""
    by = as_list(by)
    if not by:
        return df.agg(F.count(F.lit(1)).alias("rows"))
    return df.groupBy(*[col(b) for b in by]).agg(F.count(F.lit(1)).alias("rows"))


def distinct_flags(df: DataFrame, flag: str = "delta_flg", sep: str = ", ", by=None) -> DataFrame:
    """Distinct values of a low-cardinality flag column, sorted and joined to
    one string (per ``by`` group when given).  Values are de-duplicated
    map-side first, so the shuffle carries one row per value and task."""
    by = as_list(by)
    d = df.select(*[col(b) for b in by], qcol(flag).alias("__f")).where(F.col("__f").isNotNull())
    dist = d.distinct()
    agg = F.array_join(F.sort_array(F.collect_list("__f")), sep).alias("flags")
    return dist.groupBy(*by).agg(agg) if by else dist.agg(agg)


def max_key(df: DataFrame, key: str) -> DataFrame:
    """Greatest key value, 0 for an empty table (column ``max_key``)."""
    return df.agg(F.coalesce(F.max(qcol(key)), F.lit(0).cast(df.schema[key].dataType)).alias("max_key"))


def max_key_value(df: DataFrame, key: str) -> int:
    """``max_key`` as a Python int (one aggregated row to the driver)."""
    return int(max_key(df, key).first()[0])


def distinct_profile(df: DataFrame, cols, approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """Distinct values per column, one row with one ``<col>_distinct`` column
    each.  Exact counts (Spark plans one Expand + two-level aggregate);
    ``approx`` uses HyperLogLog++ sketches instead (one pass, fixed memory)."""
    cols = as_list(cols)
    if approx:
        return df.agg(*[F.approx_count_distinct(qcol(c), rsd).alias(f"{c}_distinct") for c in cols])
    return df.agg(*[F.countDistinct(qcol(c)).alias(f"{c}_distinct") for c in cols])


#: log2 of a sketch's registers: a standard error of about 1.04 / 2^(k/2), 1.6 % at 12.
SKETCH_K = 12


def profile_drop(df: DataFrame, cols, k: int = SKETCH_K) -> DataFrame:
    """Per column: (column, n_rows, n_nulls, sketch), from one pass.  The
    HyperLogLog sketch of its values, a few kB, merges with those of other
    drops (``merge_profiles``), so a new drop is the only one to be read."""
    cols = as_list(cols)

    def value(c):  # drops may differ in a whole number's width
        kind = df.schema[c].dataType.typeName()
        return qcol(c) if kind in ("string", "binary") else qcol(c).cast("long" if kind in ("byte", "short", "integer", "long") else "string")
    one = df.agg(F.count(F.lit(1)).alias("n"), *[x for i, c in enumerate(cols) for x in (
        F.count_if(qcol(c).isNull()).alias(f"n{i}"), F.hll_sketch_agg(value(c), F.lit(k)).alias(f"s{i}"))])
    each = F.array(*[F.struct(F.lit(c).alias("column"), F.col("n").alias("n_rows"), F.col(f"n{i}").alias("n_nulls"),
                              F.col(f"s{i}").alias("sketch")) for i, c in enumerate(cols)])
    return one.select(F.inline(each))


def merge_profiles(profiles: DataFrame) -> DataFrame:
    """Profiles of several drops (``profile_drop`` rows) as one per column.
    Merging is associative: merged profiles merge again."""
    return profiles.groupBy("column").agg(F.sum("n_rows").alias("n_rows"), F.sum("n_nulls").alias("n_nulls"),
                                          F.hll_union_agg("sketch").alias("sketch"))


def profile_counts(profiles: DataFrame) -> DataFrame:
    """(column, n_rows, n_nulls, distinct_estimate); counts of rows are exact,
    those of distinct values within the sketch's error.  ``distinct_profile``
    counts exactly, over all rows."""
    return profiles.select("column", "n_rows", "n_nulls", F.hll_sketch_estimate("sketch").alias("distinct_estimate"))


def group_collect(df: DataFrame, key, value: str, order, sep: str | None = None,
                  out_col: str = "values") -> DataFrame:
    """Values of each group in ``order``, repeats kept, as an array (or a
    string joined by ``sep``).  Meant for small groups (columns per table,
    members per parent); for groups without a size bound use
    ``group_positions``, which never gathers a group in one row."""
    key = as_list(key)
    order = as_list(order)
    pairs = F.collect_list(F.struct(*[qcol(o).alias(f"__o{i}") for i, o in enumerate(order)],
                                    qcol(value).alias("__v")))
    vals = F.transform(F.array_sort(pairs), lambda s: s["__v"])
    out = F.array_join(vals, sep) if sep is not None else vals
    return df.groupBy(*[qcol(k) for k in key]).agg(out.alias(out_col))


def group_positions(df: DataFrame, key, value: str, order, pos_col: str = "pos",
                    n_ranges: int | None = None) -> DataFrame:
    """Long form of ``group_collect``: (key, pos, value), 1-based position of
    each value inside its group in ``order`` (column names, ascending).  A
    group holding a third of the table is numbered by many tasks (see
    ``rank.ranked``), never gathered in one."""
    key, order = as_list(key), as_list(order)
    cols = list(dict.fromkeys(key + order + [value]))
    out = rank.ranked(df.select(*[qcol(c) for c in cols]), order, key, rank_col=pos_col, n_ranges=n_ranges)
    return out.select(*[qcol(k) for k in key], F.col(pos_col), qcol(value))
