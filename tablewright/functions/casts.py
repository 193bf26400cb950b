"""Type conversions (P4, P5).  One ``select`` per call (no per-column
``withColumn`` loop, which grows the plan)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

from ..util import qcol


def cast_by_type(df: DataFrame, mapping: dict[str, str], columns=None) -> DataFrame:
    """Cast every column whose type name is a key of ``mapping`` (e.g.
    ``{'double': 'bigint'}``) to the mapped type; ``columns`` limits which
    columns may change.  Uses ``try_cast``: fractions truncate toward zero,
    NaN and out-of-range values become NULL instead of failing."""
    norm = {k.lower(): v for k, v in mapping.items()}
    allowed = None if columns is None else set(columns)
    out = []
    for f in df.schema.fields:
        target = norm.get(f.dataType.simpleString().lower())
        if target is not None and (allowed is None or f.name in allowed):
            out.append(qcol(f.name).try_cast(target).alias(f.name))
        else:
            out.append(qcol(f.name))
    return df.select(*out)


def cast_to_schema(df: DataFrame, schema: StructType | str, by_position: bool = False) -> DataFrame:
    """Cast columns to the declared schema's types (by name, or by position
    with the schema's names).  Values that do not convert become NULL
    (``try_cast``; note '2.5' -> int is NULL, not 2).  Columns absent from
    ``df`` are added as NULL."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    out = []
    if by_position:
        for f, c in zip(schema.fields, df.columns):
            out.append(qcol(c).try_cast(f.dataType).alias(f.name))
        for f in schema.fields[len(df.columns):]:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        return df.select(*out)
    present = set(df.columns)
    for f in schema.fields:
        if f.name in present:
            src = qcol(f.name)
            out.append((src if df.schema[f.name].dataType == f.dataType else src.try_cast(f.dataType))
                       .alias(f.name))
        else:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*out)


# Whole-number types and the decimal digits they may need.
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def lossless(source: T.DataType, target: T.DataType) -> bool:
    """Whether every value of ``source`` is one of ``target`` too."""
    if source == target or isinstance(source, T.NullType):
        return True
    whole = _DIGITS.get(type(source))
    if isinstance(target, T.DecimalType):
        digits, scale = (source.precision - source.scale, source.scale) if isinstance(source, T.DecimalType) else (whole, 0)
        return digits is not None and target.scale >= scale and target.precision - target.scale >= digits
    if whole:
        most = {T.DoubleType: 10, T.FloatType: 5}.get(type(target), _DIGITS.get(type(target), 0))
        return whole <= most
    return (isinstance(source, T.FloatType) and isinstance(target, T.DoubleType)
            or isinstance(source, T.DateType) and isinstance(target, T.TimestampNTZType))


def narrows(source: T.DataType, target: T.DataType) -> bool:
    """Whether some values of ``source`` are in ``target`` and some not, so
    that each has to be looked at: numbers."""
    return isinstance(source, T.NumericType) and isinstance(target, T.NumericType) and not lossless(source, target)


def unchanged(src: Column, source: T.DataType, target: T.DataType) -> Column:
    """Whether a value (or NULL) is the same after a cast to ``target``."""
    back = src.try_cast(target).try_cast(source)
    return src.isNull() | F.coalesce(back == src, F.lit(False))


VALUE_CHANGES_ERROR = "a value does not fit its column"


def fit(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` (whose columns a gate has let through) in the types and column
    order of ``schema``, never changing a value: a column whose type only
    narrows is looked at row by row, and a value that the cast would change
    fails the job.  The check is a filter, so no later projection removes it."""
    types = {f.name: f.dataType for f in df.schema.fields}
    checks = [F.when(unchanged(qcol(f.name), types[f.name], f.dataType), F.lit(True)).otherwise(
        F.raise_error(F.lit(f"{VALUE_CHANGES_ERROR}: {f.name}")).cast("boolean"))
        for f in schema.fields if narrows(types[f.name], f.dataType)]
    for c in checks:
        df = df.where(c)
    return df.select(*[(qcol(f.name) if types[f.name] == f.dataType else qcol(f.name).try_cast(f.dataType)).alias(f.name) for f in schema.fields])
