"""Ranking: last change per key (N3), deterministic row numbers and tiles
over a whole table or within groups (N1, N2, A5 long form).

Numbering never uses a window without a partition (one task for the whole
table) or a window partitioned by the group key alone (one task for a hot
group).  The ordering tuple (group keys, then order columns) is cut into
ranges - a group holding a third of the table spans many ranges, so many
tasks - in one of two ways (``ranked(method=...)``):

``bounds`` (up to MAX_LITERAL_BOUNDS ranges, no data written)
  1. range bounds are picked once from a bounded sample and inlined as
     literals; each row gets its range with a balanced tree of
     lexicographic comparisons (stays in generated code);
  2. rows are numbered inside (range, group) with a partitioned window;
  3. each (range, group) gets the count of the same group's rows in earlier
     ranges from a small per-(range, group) count table, joined back.
  Because the bounds are literals, recomputing any stage after an executor
  loss gives the same numbers.

``range_write`` (any number of ranges)
  Spark's range partitioner does the binary search over its own sampled
  bounds; partition id and position are taken in the sorting stage and
  written with the rows to the shared checkpoint folder, so the numbers are
  fixed on disk; offsets and group starts come from small per-partition
  tables (see ``ranked``).

Both end the ordering with a hash of the row, so they number alike also when
the ordering does not tell rows apart, and rows that share an order value are
spread over ranges.  Only rows equal in every column may trade numbers.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from ..session import default_parallelism, scratch_path
from ..util import as_list as _as_list, col as _col, qcol

_RANGE = "__range"
_ROW = "__row_in_range"
_OFFSET = "__offset"
SAMPLES_PER_RANGE = 64
MAX_SAMPLE = 200_000


def latest_per_key(df: DataFrame, keys, sequence_by, tiebreak=None) -> DataFrame:
    """Newest row per key by ``sequence_by`` (then ``tiebreak``).

    One ``max_by`` aggregate: Spark combines map-side, so a key holding a
    third of the rows is reduced inside every map task before the shuffle.
    Rows that tie on the whole ordering are broken by a hash of the row so
    the pick does not depend on arrival order."""
    keys = _as_list(keys)
    order = [_col(c) for c in _as_list(sequence_by) + _as_list(tiebreak)]
    order.append(F.xxhash64(*[F.col(c) for c in df.columns]))
    payload = F.struct(*[F.col(c) for c in df.columns])
    return (df.groupBy(*keys)
              .agg(F.max_by(payload, F.struct(*order)).alias("__latest"))
              .select("__latest.*"))


def _sort_key(row: tuple):
    # Spark's ascending order: NULLs first
    return tuple((True, v) if v is not None else (False, 0) for v in row)


def _sample_bounds(df: DataFrame, cols: list[str], n_ranges: int, total: int) -> list[tuple]:
    """Up to n_ranges - 1 distinct bound tuples at even quantiles of a
    seeded sample (at most about MAX_SAMPLE rows reach the driver)."""
    if n_ranges <= 1 or total <= 1:
        return []
    want = min(MAX_SAMPLE, SAMPLES_PER_RANGE * n_ranges)
    frac = min(1.0, want / total)
    sample = [tuple(r) for r in df.select(*[qcol(c) for c in cols]).sample(False, frac, seed=17).collect()]
    if not sample:
        return []
    sample.sort(key=_sort_key)
    bounds, seen = [], set()
    for i in range(1, n_ranges):
        b = sample[min(len(sample) - 1, (i * len(sample)) // n_ranges)]
        k = _sort_key(b)
        if k not in seen:
            seen.add(k)
            bounds.append(b)
    return bounds


def _literal(v, dtype) -> Column:
    """A literal of the column's own type.  Wall-clock (NTZ) timestamps go
    through their text form so no time zone is applied."""
    if v is None:
        return F.lit(None).cast(dtype)
    if isinstance(dtype, TimestampNTZType):
        return F.lit(v.isoformat(sep=" ")).cast(dtype)
    return F.lit(v).cast(dtype)


def _less_than(cols: list[Column], types: list, bound: tuple) -> Column:
    """Lexicographic ``cols < bound`` in ascending NULLs-first order."""
    lits = [_literal(v, t) for v, t in zip(bound, types)]

    def one(c: Column, v, lit: Column) -> Column:
        if v is None:
            return F.lit(False)            # nothing sorts before NULL
        return c.isNull() | (c < lit)
    terms = []
    for i, c in enumerate(cols):
        eq_prefix = [cols[j].eqNullSafe(lits[j]) for j in range(i)]
        terms.append(reduce(lambda a, b: a & b, eq_prefix + [one(c, bound[i], lits[i])]))
    return reduce(lambda a, b: a | b, terms)


def _range_expr(cols: list[Column], types: list, bounds: list[tuple]) -> Column:
    """Index of the range holding the row: number of bounds <= row."""
    def build(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi + 1) // 2
        return F.when(_less_than(cols, types, bounds[mid - 1]), build(lo, mid - 1)).otherwise(build(mid, hi))
    return build(0, len(bounds))


ROWS_PER_RANGE = 2_000_000
MAX_LITERAL_BOUNDS = 128
# Most ranges of any ranking: the prefix sum over ranges is one small task, and
# the table of offsets is broadcast, so both need a bound.
MAX_RANGES = 20_000
_HASH = "__row_hash"


def _planned_ranges(df: DataFrame, n_ranges: int | None, total: int, rows_per_range: int) -> int:
    if n_ranges:
        return max(1, min(n_ranges, int(math.ceil(total / 2))))
    by_size = int(math.ceil(total / rows_per_range))
    by_cores = min(default_parallelism(df.sparkSession), int(math.ceil(total / 10_000)))
    return min(MAX_RANGES, max(1, by_size, by_cores))


def ranked(df: DataFrame, order: Sequence[str], keys: Sequence[str] = (), rank_col: str = "rank",
           n_ranges: int | None = None, total: int | None = None, method: str = "auto",
           rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """1-based position of every row in ``order`` within its ``keys`` group
    (the whole table when ``keys`` is empty).  ``order`` items are column
    names, ascending (NULLs first).

    The number of ranges follows the data (about ``rows_per_range`` rows
    each, at least the cluster's parallelism).  ``method``:

    * ``bounds`` - literal sampled bounds and a comparison tree (module
      docstring); no data is written.  Used up to MAX_LITERAL_BOUNDS bounds,
      beyond which the expression grows too large to compile well.
    * ``range_write`` - Spark's range partitioner (native binary search over
      its own sampled bounds) on (keys, order, row hash), sorted within
      partitions; the partition id and the position inside the partition
      are taken in that same stage and written with the rows as a table in
      the shared checkpoint folder, so every later read sees the same
      numbers (lineage cut, executor loss safe).  Offsets come from
      per-partition counts; group starts from a per-(partition, group)
      minimum joined on (partition, group), which stays balanced because a
      hot group spans many partitions.
    * ``auto`` - ``bounds`` while the range count allows it, else
      ``range_write``."""
    keys, order = list(keys), list(order)
    total = df.count() if total is None else total
    n = _planned_ranges(df, n_ranges, total, rows_per_range)
    if method == "auto":
        method = "bounds" if n <= MAX_LITERAL_BOUNDS + 1 else "range_write"
    if method == "bounds":
        return _ranked_by_bounds(df, order, keys, rank_col, n, total)
    if method == "range_write":
        return _ranked_by_written_ranges(df, order, keys, rank_col, n)
    raise ValueError(f"unknown method {method!r}")


def _ranked_by_bounds(df: DataFrame, order: list[str], keys: list[str], rank_col: str, n: int,
                      total: int) -> DataFrame:
    df = df.withColumn(_HASH, F.xxhash64(*[qcol(c) for c in df.columns]))
    tup = keys + order + [_HASH]
    bounds = _sample_bounds(df, tup, n, total)
    types = [df.schema[c].dataType for c in tup]
    with_range = df.withColumn(_RANGE, _range_expr([qcol(c) for c in tup], types, bounds))
    part = [F.col(_RANGE)] + [qcol(k) for k in keys]
    w = Window.partitionBy(*part).orderBy(*[qcol(c).asc() for c in order + [_HASH]])
    numbered = with_range.withColumn(_ROW, F.row_number().over(w))
    counts = with_range.groupBy(*part).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*[qcol(k) for k in keys]).orderBy(_RANGE) \
        .rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*part, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias(_OFFSET))
    if not keys:
        # one row per range: bounded by the range count, safe to broadcast
        return (numbered.join(F.broadcast(offsets), _RANGE, "inner")
                        .withColumn(rank_col, F.col(_OFFSET) + F.col(_ROW))
                        .drop(_RANGE, _ROW, _OFFSET, _HASH))
    # NULL group keys form a group too: join them null-safely
    return (_join_on(numbered, offsets, [_RANGE], keys)
            .withColumn(rank_col, F.col(_OFFSET) + F.col(_ROW))
            .drop(_RANGE, _ROW, _OFFSET, _HASH))


def _join_on(left: DataFrame, right: DataFrame, plain: list[str], null_safe: list[str]) -> DataFrame:
    """Inner join on ``plain`` (equality) and ``null_safe`` (<=>) columns;
    the right side's copies of the join columns are dropped."""
    r = right.select(*[qcol(c).alias(f"__r_{c}") if c in plain + null_safe else qcol(c)
                       for c in right.columns])
    cond = [qcol(c) == F.col(f"`__r_{c}`") for c in plain] + \
           [qcol(c).eqNullSafe(F.col(f"`__r_{c}`")) for c in null_safe]
    joined = left.join(r, reduce(lambda a, b: a & b, cond), "inner")
    return joined.drop(*[f"__r_{c}" for c in plain + null_safe])


def _ranked_by_written_ranges(df: DataFrame, order: list[str], keys: list[str], rank_col: str,
                              n: int) -> DataFrame:
    spark = df.sparkSession
    tup = [qcol(c) for c in keys + order]
    pid = F.spark_partition_id()
    staged = (df.withColumn("__h", F.xxhash64(*[qcol(c) for c in df.columns]))
                .repartitionByRange(n, *tup, F.col("__h"))
                .sortWithinPartitions(*tup, F.col("__h"))
                .withColumn("__pid", pid)
                .withColumn("__local", F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33))
                .drop("__h"))
    path = scratch_path(spark, "ranked")
    staged.write.mode("overwrite").parquet(path)
    mat = spark.read.parquet(path)
    counts = mat.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition: bounded by the partition count
    offsets = F.broadcast(counts.select("__pid", F.coalesce(F.sum("__n").over(before), F.lit(0))
                                        .alias(_OFFSET)))
    pos = (mat.join(offsets, "__pid", "inner")
              .withColumn("__g0", F.col(_OFFSET) + F.col("__local")).drop(_OFFSET))
    if not keys:
        return pos.withColumn(rank_col, F.col("__g0") + 1).drop("__pid", "__local", "__g0")
    firsts = pos.groupBy("__pid", *[qcol(k) for k in keys]).agg(F.min("__g0").alias("__first"))
    starts = firsts.groupBy(*[qcol(k) for k in keys]).agg(F.min("__first").alias("__start"))
    per_part = _join_on(firsts, starts, [], keys).drop("__first")
    out = _join_on(pos, per_part, ["__pid"], keys)
    return (out.withColumn(rank_col, F.col("__g0") - F.col("__start") + 1)
               .drop("__pid", "__local", "__g0", "__start"))


def global_rank(df: DataFrame, order: Sequence[str], n_ranges: int | None = None,
                rank_col: str = "rank", total: int | None = None, method: str = "auto") -> DataFrame:
    """Consecutive 1-based row numbers over the whole DataFrame in ``order``."""
    return ranked(df, order, (), rank_col, n_ranges, total, method)


def tile_bounds(total: int, tiles: int, tile: int) -> tuple[int, int]:
    """First and last 1-based rank of tile ``tile`` (1-based): the first
    ``total % tiles`` tiles hold one extra row."""
    q, r = divmod(total, tiles)
    first = (tile - 1) * q + min(tile - 1, r) + 1
    return first, first + q - (0 if tile <= r else 1)


def tile_of(rank0: Column, total: int, tiles: int) -> Column:
    """ntile rule for a 0-based rank: the first ``total % tiles`` tiles hold
    one extra row."""
    q, r = divmod(total, tiles)
    if q == 0:
        # fewer rows than tiles: each row is its own tile
        return (rank0 + 1).cast("int")
    big = r * (q + 1)
    return (F.when(rank0 < F.lit(big), F.floor(rank0 / F.lit(q + 1)) + 1)
             .otherwise(F.floor((rank0 - F.lit(big)) / F.lit(q)) + F.lit(r) + 1)).cast("int")


def ntile_split(df: DataFrame, tiles: int, order: Sequence[str], pick: int | None = None,
                tile_col: str = "tile", n_ranges: int | None = None) -> DataFrame:
    """Split the whole table into ``tiles`` equal tiles in ``order``; keep
    only tile ``pick`` when given (1-based, as SQL ntile)."""
    total = df.count()
    r = global_rank(df, order, n_ranges=n_ranges, rank_col="__rank", total=total)
    tiled = r.withColumn(tile_col, tile_of(F.col("__rank") - 1, total, tiles)).drop("__rank")
    if pick is not None:
        tiled = tiled.where(F.col(tile_col) == F.lit(pick))
    return tiled


def assign_surrogate_keys(df: DataFrame, key_col: str, order: Sequence[str], start: int = 0,
                          n_ranges: int | None = None) -> DataFrame:
    """Replace ``key_col`` with dense new keys ``start + 1, start + 2, ...`` in
    ``order``.  Column order of ``df`` is kept."""
    r = global_rank(df, order, n_ranges=n_ranges, rank_col="__rank")
    cols = [(F.lit(start).cast("long") + F.col("__rank")).alias(key_col) if c == key_col else qcol(c)
            for c in df.columns]
    return r.select(*cols)
