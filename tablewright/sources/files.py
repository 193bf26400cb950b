"""Batch sources: parquet drops (S1), named tables (S4), text records (S2),
delimited text (S3) and rescued columns (S6)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, StringType, StructType, TimestampNTZType

from ..util import qcol


def scan_parquet(spark: SparkSession, path, schema: StructType | str | None = None) -> DataFrame:
    """A parquet drop, a directory of drops or a glob (several paths
    allowed).  A declared schema skips footer inference."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    paths = [path] if isinstance(path, str) else list(path)
    return reader.parquet(*paths)


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table by name."""
    return spark.table(name)


def scan_text_records(spark: SparkSession, path, record_sep: str = "\n",
                      with_source: bool = False) -> DataFrame:
    """One row (column ``value``) per record of the text files at ``path``,
    records ended by ``record_sep`` (any string, e.g. ';').  The text after
    the last separator is a record too.  ``with_source`` adds the file path."""
    paths = [path] if isinstance(path, str) else list(path)
    reader = spark.read
    if record_sep != "\n":
        reader = reader.option("lineSep", record_sep)
    df = reader.text(*paths)
    if with_source:
        df = df.select("value", F.col("_metadata.file_path").alias("source_file"))
    return df


EXTRA_FIELDS_ERROR = "a line has more fields than columns"


def parse_delimited(lines: DataFrame, sep: str, names, skip_pattern: str | None = None,
                    value_col: str = "value", rescue_col: str | None = None) -> DataFrame:
    """Split each text line on the literal separator ``sep`` (any length)
    into positional string columns ``names``.  Blank lines are dropped, and
    lines matching ``skip_pattern`` (case-insensitive LIKE) when one is given:
    name a pattern only header lines match.  Fields missing from a short line
    are NULL.  One empty field after a trailing separator is no field; any
    other field past ``names`` fails the job, or with ``rescue_col`` goes there
    (joined by ``sep``, NULL when there is none).  Runs as one projection on
    the executors."""
    names = list(names)
    v = F.col(value_col)
    keep = v != F.lit("")
    if skip_pattern:
        keep = keep & ~v.ilike(skip_pattern)
    parts = F.split(v, re.escape(sep), -1)
    cols = [F.try_element_at(parts, F.lit(i + 1)).alias(n) for i, n in enumerate(names)]
    extra = F.slice(parts, len(names) + 1, F.greatest(F.size(parts) - len(names), F.lit(0)))
    none = (F.size(extra) == 0) | ((F.size(extra) == 1) & (F.get(extra, F.lit(0)) == F.lit("")))
    lines = lines.where(keep)
    if rescue_col:
        cols.append(F.when(~none, F.array_join(extra, sep)).alias(rescue_col))
    else:  # a filter: whatever columns are read later, and if none are, every line is checked
        lines = lines.where(F.when(none, F.lit(True)).otherwise(F.raise_error(F.lit(EXTRA_FIELDS_ERROR)).cast("boolean")))
    return lines.select(*cols)


def _unchanged(src: Column, cast: Column, source: DataType, target: DataType) -> Column:
    """Whether a cast kept the value: casting back gives it again.  Text may
    write a value in several ways, so it only has to convert - but a time of
    day must not vanish in a date."""
    if isinstance(source, StringType):
        if isinstance(target, DateType):
            stamp = src.try_cast(TimestampNTZType())
            return cast.isNotNull() & F.coalesce(stamp == cast.cast(TimestampNTZType()), F.lit(True))
        return cast.isNotNull()
    return cast.isNotNull() & F.coalesce(cast.try_cast(source) == src, F.lit(False))


def rescue_unexpected(df: DataFrame, expected: StructType, rescue_col: str = "_rescued_data") -> DataFrame:
    """Fit ``df`` to the ``expected`` schema without losing data: expected
    columns are cast with ``try_cast``; columns that are not expected, and
    values that do not cast or that the cast would change (2.7 to an int, a
    timestamp to a date), become NULL and go into one JSON string column (null
    when nothing was rescued)."""
    present = set(df.columns)
    out: list[Column] = []
    rescued: list[Column] = []
    for f in expected.fields:
        if f.name in present:
            src = qcol(f.name)
            if df.schema[f.name].dataType == f.dataType:
                out.append(src.alias(f.name))
            else:
                cast = src.try_cast(f.dataType)
                kept = _unchanged(src, cast, df.schema[f.name].dataType, f.dataType)
                out.append(F.when(kept, cast).alias(f.name))
                rescued.append(F.when(src.isNotNull() & ~kept, src.cast("string")).alias(f.name))
        else:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
    expected_names = {f.name for f in expected.fields}
    for c in df.columns:
        if c not in expected_names and c != rescue_col:
            rescued.append(qcol(c).alias(c))
    if rescued:
        js = F.to_json(F.struct(*rescued))
        out.append(F.when(js == F.lit("{}"), F.lit(None).cast("string")).otherwise(js).alias(rescue_col))
    else:
        out.append(F.lit(None).cast("string").alias(rescue_col))
    return df.select(*out)
