"""A keyed table kept as committed versions of key ranges.

``<root>/commits/<n>``                    names version n's directory; put there
                                          only if there is no version n yet
``<root>/versions/<n>-<id>/rows``         rows of the ranges this version wrote
``<root>/versions/<n>-<id>/keys``         bitmaps of their keys (whole-number keys)
``<root>/versions/<n>-<id>/ranges.json``  all ranges of the version: lowest key,
                                          rows, directories - its own and, by
                                          reference, earlier versions'
``<root>/versions/<n>-<id>/ledger``       whatever else belongs to the version

A range holds the keys from its lowest one up to the next range's; rows of one
key stay in one range.  Nothing is overwritten, so readers of a version are
never disturbed; directories that no version in use names may be expired.
"""

from __future__ import annotations

import json
import math
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import list_names, put_if_absent, read_text
from ..util import bit_of, qcol

#: Rows in a range, about.
RANGE_ROWS = 2_000_000
RANGE, SUB = "__range", "__sub"
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_AS_TEXT = (*_WHOLE, T.DecimalType, T.StringType, T.DateType, T.TimestampNTZType, T.FloatType, T.DoubleType, T.BooleanType)


@dataclass(frozen=True)
class Range:
    """One key range: its lowest key as text, field by field, and where its rows and key bitmaps are."""

    lower: tuple[str | None, ...]
    rows: int
    at: str
    keys_at: str | None


@dataclass(frozen=True)
class Version:
    number: int
    path: str


def committed(spark: SparkSession, root: str) -> tuple[int, str] | None:
    """(number, directory) of the newest committed version under ``root``."""
    numbers = [n for n in list_names(spark, f"{root}/commits") if n.isdigit()]
    if not numbers:
        return None
    last = max(numbers)
    return int(last), f"{root}/versions/{read_text(spark, f'{root}/commits/{last}')}"


def new_version(root: str, number: int) -> Version:
    return Version(number, f"{root}/versions/{number:012d}-{uuid.uuid4().hex[:12]}")


def commit(spark: SparkSession, root: str, version: Version) -> bool:
    """Make a fully written version number ``version.number``.  False if there
    is one already: of several loads that started from the same version exactly
    one gets the next number, whatever their timing."""
    return put_if_absent(spark, f"{root}/commits/{version.number:012d}", version.path.rpartition("/")[2])


# ------------------------------------------------------------------ keys and ranges
def _as_text(c: Column, t: T.DataType) -> Column:
    if isinstance(t, T.TimestampType):
        return F.unix_micros(c).cast("string")
    if not isinstance(t, _AS_TEXT):
        raise ValueError(f"a key of type {t.simpleString()} cannot be kept in ranges")
    return c.cast("string")


def _from_text(c: Column, t: T.DataType) -> Column:
    return F.timestamp_micros(c.cast("long")) if isinstance(t, T.TimestampType) else c.cast(t)


def range_of(keys: list[str], schema: T.StructType, ranges: list[Range]) -> Column:
    """The place in ``ranges`` of the range where a key belongs: binary search
    over the lowest keys, kept as one constant of the plan.  A key below all
    others, or NULL, belongs to the first range."""
    if len(ranges) < 2:
        return F.lit(0)
    types = [schema[k].dataType for k in keys]
    bounds = F.from_json(F.lit(json.dumps([list(r.lower) for r in ranges[1:]])), "array<array<string>>")
    key = F.struct(*[qcol(k) for k in keys])

    def step(at: Column, _: Column) -> Column:
        mid = F.expr("0") + F.floor((at["lo"] + at["hi"]) / 2).cast("int")
        bound = F.get(bounds, mid)
        low = F.struct(*[_from_text(F.get(bound, F.lit(i)), t).alias(k) for i, (k, t) in enumerate(zip(keys, types))])
        right = (at["lo"] < at["hi"]) & (low <= key)
        return F.struct(F.when(right, mid + 1).otherwise(at["lo"]).alias("lo"), F.when(right, at["hi"]).otherwise(F.least(mid, at["hi"])).alias("hi"))

    n = len(ranges) - 1
    start = F.struct(F.lit(0).alias("lo"), F.lit(n).alias("hi"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(math.ceil(math.log2(n + 1)) + 1)), start, step)["lo"]


def _whole_key(keys: list[str], schema: T.StructType) -> bool:
    return len(keys) == 1 and isinstance(schema[keys[0]].dataType, _WHOLE)


def parts_of(rows: int, range_rows: int = RANGE_ROWS) -> int:
    """How many ranges so many rows make: one up to twice ``range_rows``."""
    return 1 if rows <= 2 * range_rows else -(-rows // range_rows)


def write_ranges(df: DataFrame, keys: list[str], version: Version, parts: int) -> list[Range]:
    """Write rows that carry their old range's place in ``__range`` as about
    ``parts`` new ranges within the old ones, in key order, and bitmaps of
    their keys.  A range that has lost its rows goes."""
    spark = df.sparkSession
    schema = T.StructType([f for f in df.schema.fields if f.name != RANGE])
    order = [F.col(RANGE), *[qcol(k) for k in keys]]
    (df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn(SUB, F.spark_partition_id())
     .write.partitionBy(RANGE, SUB).parquet(f"{version.path}/rows"))
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField(RANGE, T.IntegerType()), T.StructField(SUB, T.IntegerType())])
                             ).parquet(f"{version.path}/rows")
    whole = _whole_key(keys, schema)
    if whole:
        k = qcol(keys[0]).cast("long")
        (rows.where(k.isNotNull()).groupBy(RANGE, SUB, F.bitmap_bucket_number(k).alias("bucket"))
         .agg(F.bitmap_construct_agg(F.bitmap_bit_position(k)).alias("bits"))
         .repartition(RANGE, SUB).write.partitionBy(RANGE, SUB).parquet(f"{version.path}/keys"))
    # one row for each range
    found = (rows.groupBy(RANGE, SUB).agg(F.min(F.struct(*[qcol(k) for k in keys])).alias("low"), F.count(F.lit(1)).alias("n"),
                                          F.count(qcol(keys[0])).alias("keyed"))
             .select(RANGE, SUB, "n", "keyed", F.array(*[_as_text(F.col("low")[k], schema[k].dataType) for k in keys]).alias("low")).collect())
    out = []
    for r in sorted(found, key=lambda r: (r[RANGE], r[SUB])):
        at = f"{RANGE}={r[RANGE]}/{SUB}={r[SUB]}"
        out.append(Range(tuple(r["low"]), r["n"], f"{version.path}/rows/{at}", f"{version.path}/keys/{at}" if whole and r["keyed"] else None))
    return out


def joined(kept: list[tuple[int, Range]], new: list[Range], places: list[int]) -> list[Range]:
    """Ranges carried over and new ones in key order; ``places`` gives the old
    place that each new one lies in."""
    both = [(place, 0, r) for place, r in kept] + [(place, i, r) for i, (place, r) in enumerate(zip(places, new))]
    return [r for _, _, r in sorted(both, key=lambda x: x[:2])]


def place_of(r: Range) -> int:
    return int(r.at.rpartition(f"/{RANGE}=")[2].partition("/")[0])


def write_list(spark: SparkSession, root: str, version: Version, ranges: list[Range]) -> None:
    """The version's list of ranges; directories relative to the root, so that
    a table may be moved."""
    def short(path):
        return path and path[len(root) + 1:]
    rows = [[list(r.lower), r.rows, short(r.at), short(r.keys_at)] for r in ranges]
    if not put_if_absent(spark, f"{version.path}/ranges.json", json.dumps(rows)):
        raise FileExistsError(f"{version.path}/ranges.json")


def read_list(spark: SparkSession, root: str, path: str) -> list[Range]:
    def whole(x):
        return x and f"{root}/{x}"
    return [Range(tuple(low), rows, whole(at), whole(keys_at)) for low, rows, at, keys_at in json.loads(read_text(spark, f"{path}/ranges.json"))]


def read_ranges(spark: SparkSession, schema: T.StructType, ranges: list[Range]) -> DataFrame:
    """The rows of some ranges."""
    return spark.read.schema(schema).parquet(*[r.at for r in ranges]) if ranges else spark.createDataFrame([], schema)


def with_presence(changes: DataFrame, keys: list[str], schema: T.StructType, ranges: list[Range], name: str) -> DataFrame:
    """``changes`` with whether their key has a row in ``ranges``.  Whole-number
    keys are looked up in the bitmaps; of others the key columns are read."""
    spark = changes.sparkSession
    if _whole_key(keys, schema):
        k = qcol(keys[0]).cast("long")
        paths = [r.keys_at for r in ranges if r.keys_at]
        bits = (spark.read.schema("bucket long, bits binary").parquet(*paths) if paths else spark.createDataFrame([], "bucket long, bits binary"))
        bits = bits.groupBy(F.col("bucket").alias("__bucket")).agg(F.bitmap_or_agg("bits").alias("__bits"))  # a bucket may span two ranges
        return (changes.join(bits, F.bitmap_bucket_number(k) == F.col("__bucket"), "left")
                .withColumn(name, F.coalesce(bit_of(F.col("__bits"), k), F.lit(False))).drop("__bucket", "__bits"))
    own = read_ranges(spark, schema, ranges).select(*[qcol(k) for k in keys]).distinct().withColumn(name, F.lit(True))
    return changes.join(own, keys, "left").withColumn(name, F.coalesce(name, F.lit(False)))
