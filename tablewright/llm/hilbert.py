"""Operator 5: sharding along a Hilbert curve.

Several metadata dimensions are quantised by their quantiles, the cell's place
on the Hilbert curve through the quantised space becomes the sort key, and runs
of the sorted rows become shards.  Rows that agree in several dimensions lie
close together, so the files of a shard hold narrow ranges of each and readers
can skip them whichever dimension they filter on.  DataFrame functions only."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import free_name, shuffle_partitions, written
from tablewright.llm.ordering import positions

#: Bits for each dimension: 2 ** BITS cells along it.
BITS = 5


@lru_cache(maxsize=8)
def curve_table(dims: int) -> tuple[list[int], list[int]]:
    """The Hilbert curve as a state machine, from its rule.

    A state is an (entry corner, direction) pair.  Within a cell, the corner
    ``x`` of a subcell is first reflected by the entry corner and rotated by
    the direction; its Gray-code rank is the digit.  The subcell is entered and
    crossed in turn at the corner and direction that the digit gives.
    Returns digit and next state at [state << dims | corner]."""
    full = (1 << dims) - 1

    def rotate(x: int, by: int) -> int:
        by %= dims
        return ((x >> by) | (x << (dims - by))) & full

    def gray(i: int) -> int:
        return i ^ i >> 1

    def ungray(g: int) -> int:
        i = 0
        while g:
            i ^= g
            g >>= 1
        return i

    def ones(i: int) -> int:
        return ((i + 1) & -(i + 1)).bit_length() - 1

    states = [(0, 0)]
    digits, nexts = [], []
    for entry, direction in states:  # grows while new states turn up
        for corner in range(1 << dims):
            w = ungray(rotate(corner ^ entry, direction + 1))
            e = 0 if w == 0 else gray(2 * ((w - 1) // 2))
            d = 0 if w == 0 else (ones(w - 1) if w % 2 == 0 else ones(w)) % dims
            state = (entry ^ rotate(e, -(direction + 1)), (direction + d + 1) % dims)
            if state not in states:
                states.append(state)
            digits.append(w)
            nexts.append(states.index(state))
    return digits, nexts


def curve_index(cells: list[Column], bits: int = BITS) -> Column:
    """The place on the Hilbert curve of the cell with these coordinates, each
    from 0 to 2 ** bits - 1."""
    dims = len(cells)
    digits, nexts = (F.array(*[F.lit(x).cast("long") for x in t]) for t in curve_table(dims))
    levels = F.sequence(F.lit(bits - 1), F.lit(0), F.lit(-1))

    def step(acc: Column, level: Column) -> Column:
        corner = F.lit(0).cast("long")
        for k, c in enumerate(cells):
            corner = corner.bitwiseOR(F.call_function("shiftleft", F.call_function("shiftright", c.cast("long"), level).bitwiseAND(F.lit(1).cast("long")), F.lit(k)))
        at = (acc["state"] * (1 << dims) + corner + 1).cast("int")
        return F.struct((acc["place"] * (1 << dims) + F.element_at(digits, at)).alias("place"),
                        F.element_at(nexts, at).alias("state"))

    zero = F.struct(F.lit(0).cast("long").alias("place"), F.lit(0).cast("long").alias("state"))
    return F.aggregate(levels, zero, step)["place"]


def code(df: DataFrame, name: str) -> Column:
    """A dimension as a number in the same order, or, for text, as a string
    in the same order.  Null comes first."""
    kind = dict(df.dtypes)[name]
    c = F.col(f"`{name}`")
    if kind == "string":
        return F.coalesce(F.concat(F.lit("1"), c), F.lit("0"))
    if kind in ("date", "timestamp"):
        return F.coalesce(F.unix_timestamp(c.cast("timestamp")).cast("double"), F.lit(float("-inf")))
    return F.coalesce(c.cast("double"), F.lit(float("-inf")))


def text_quantiles(df: DataFrame, name: str, cells: int) -> list[str]:
    """The values at which a share of 1, 2, ... of ``cells`` of all rows is
    reached in string order: at most ``cells`` of them.  Rows are counted by
    value; the counts are summed range by range, so no task sees all values."""
    counts = df.groupBy(F.col(name).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    counts = written(counts.repartitionByRange(shuffle_partitions(df.sparkSession), "value").withColumn("range", F.spark_partition_id()), "text-counts")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    starts = counts.groupBy("range").agg(F.sum("n").alias("of_range")).withColumn("before", F.coalesce(F.sum("of_range").over(before), F.lit(0)))
    total = counts.agg(F.sum("n")).first()[0] or 1
    within = Window.partitionBy("range").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    upto = counts.join(F.broadcast(starts), "range").withColumn("upto", F.col("before") + F.sum("n").over(within))
    reached = upto.where(F.expr(f"upto * {cells}L div {total}L > (upto - n) * {cells}L div {total}L"))
    return sorted((r["value"] for r in reached.select("value").collect()), key=lambda v: v.encode())


def quantised(df: DataFrame, names: list[str], bits: int = BITS) -> DataFrame:
    """``df`` with columns cell_0, cell_1, ...: how many of the dimension's
    2 ** bits - 1 quantiles, taken over all rows, lie below the value."""
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    texts = {n for n, kind in df.dtypes if kind == "string"}
    numbers = [n for n in names if n not in texts]
    found = df.agg(*[F.percentile_approx(F.col(n), shares, 10_000).alias(n) for n in numbers]).first() if numbers else {}
    rows = df
    for k, n in enumerate(names):
        cuts = text_quantiles(rows, n, 1 << bits) if n in texts else sorted({float(x) for x in found[n] or ()})
        value = F.col(n)
        below = F.size(F.filter(F.array(*[F.lit(x) for x in cuts]), lambda x: x < value)) if cuts else F.lit(0)  # noqa: B023
        df = df.withColumn(f"cell_{k}", below)
    return df


def shard(docs: DataFrame, dims: list[str], shards: int = 40, bits: int = BITS,
          id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, law, shard, slot,
    grown_shard, curve, and row_key, if ``row_col`` names a column that tells
    rows apart.

    The law is ``rows``: the curve is cut into runs whose row counts are at
    most one apart (size is the text's UTF-8 bytes, null: none, plus 16).
    With fewer rows than shards some shards are empty.  Rows equal in all dimensions lie side by side, ordered by text
    and then document, so a large group of copies is spread over neighbouring
    tasks and shards.  A null in a dimension comes first; rows that repeat all
    get a slot.  ``dims`` names columns of ``docs``; a name listed that is the
    text column itself stands for the text's length."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    codes = [F.length(text).cast("double") if n == text_col else code(docs, n) for n in dims]
    thin = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       (F.octet_length(text) + F.lit(16)).cast("long").alias("size"),
                       F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
                       F.xxhash64(text).alias("text_hash"), (F.col(f"`{row_col}`").cast("long") if row_col else F.lit(None).cast("long")).alias("row_key"),
                       *[c.alias(f"dim_{k}") for k, c in enumerate(codes)])
    thin = quantised(written(thin, "metadata"), [f"dim_{k}" for k in range(len(dims))], bits)
    thin = thin.select("doc_id", "size", "text_crc32", "text_hash", "row_key",
                       curve_index([F.col(f"cell_{k}") for k in range(len(dims))], bits).alias("curve"))
    placed = positions(thin, F.col("curve"), F.col("text_hash"), F.xxhash64("doc_id"), F.col("doc_id"))
    total = placed.count()
    # shard s takes the places from ceil(s * total / shards) on
    own = F.expr(f"position * {shards}L div {max(total, 1)}L")
    start = F.expr(f"(shard * {total}L + {shards - 1}L) div {shards}L")
    return (placed.withColumn("shard", own).withColumn("slot", F.col("position") - start)
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
                    F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "curve",
                    *(["row_key"] if row_col else [])))


def write_shards(docs: DataFrame, dims: list[str], path: str, shards: int = 40, bits: int = BITS,
                 id_col: str = "doc_id", text_col: str = "text") -> str:
    """All columns of ``docs``, as they are, as Parquet under path/<shard>=N, in
    the order of the slots within each file.  Returns the name of the shard
    column: ``shard``, or a longer one if ``docs`` has that.  Rows are numbered
    and written once, and find their shard by number, so rows that repeat whole
    are dealt like any others."""
    name, row, slot = (free_name(docs, x) for x in ("shard", "row_number", "slot_number"))
    numbered = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    at = shard(numbered, dims, shards, bits, id_col, text_col, row).select(
        F.col("row_key").alias(row), F.col("shard").alias(name), F.col("slot").alias(slot))
    (numbered.join(at, row).drop(row).repartitionByRange(shuffle_partitions(docs.sparkSession), name, slot)
     .sortWithinPartitions(name, slot).drop(slot).write.partitionBy(name).parquet(path))
    return name


__all__ = ["curve_index", "curve_table", "quantised", "shard", "write_shards"]
