"""Small column helpers shared by the operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bounds under which a change set is broadcast instead of shuffling the
# target.  Both are proven by one pass over at most rows + 1 rows.
DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 256 * 1024 * 1024

_FIXED_WIDTH = {
    T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8, T.FloatType: 4,
    T.DoubleType: 8, T.BooleanType: 1, T.DateType: 4, T.TimestampType: 8,
    T.TimestampNTZType: 8, T.DecimalType: 16, T.NullType: 1,
}


def as_list(x) -> list:
    if x is None:
        return []
    if isinstance(x, (str, Column)):
        return [x]
    return list(x)


def col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def qcol(name: str) -> Column:
    """Column by exact name (names with dots or spaces)."""
    return F.col(f"`{name}`")


def bit_of(bits: Column, key: Column) -> Column:
    """Whether a whole-number key is in its bucket's bitmap, as
    ``bitmap_construct_agg`` builds it; NULL without a bitmap."""
    at = F.bitmap_bit_position(key)
    byte = F.conv(F.hex(F.substring(bits, (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    return F.getbit(byte, (at % 8).cast("int")) == 1


def _value_bytes(f: T.StructField) -> Column:
    c = qcol(f.name)
    t = type(f.dataType)
    if t in _FIXED_WIDTH:
        return F.lit(_FIXED_WIDTH[t])
    if t in (T.StringType, T.BinaryType, T.CharType, T.VarcharType):
        return F.coalesce(F.octet_length(c), F.lit(0)) + F.lit(8)
    return F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + F.lit(8)


def fits_broadcast(df: DataFrame, max_rows: int | None = DEFAULT_BROADCAST_ROWS,
                   max_bytes: int | None = DEFAULT_BROADCAST_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows whose values take at
    most ``max_bytes`` bytes (fixed widths plus actual string lengths).

    One aggregation pass, combined map-side (no single-task funnel such as a
    global LIMIT): it costs one scan of ``df``, which is the (smaller) change
    side of the operations that use it."""
    if not max_rows or max_rows <= 0:
        return False
    sizes = [_value_bytes(f) for f in df.schema.fields] or [F.lit(0)]
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(reduce(lambda a, b: a + b, sizes)).alias("b")).first()
    return r["n"] <= max_rows and (max_bytes is None or (r["b"] or 0) <= max_bytes)
