"""Table writes and physical layout.

A target may be a catalog table name or a parquet directory path (anything
with a '/' or a URI scheme).  Operators that rewrite a table write a *new*
directory; Spark refuses to overwrite a path it is reading, and a new
directory keeps the old version readable until the caller switches.
"""

from __future__ import annotations

from functools import reduce
from math import isqrt
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, NumericType, StructType, TimestampNTZType, TimestampType

from ..functions.casts import cast_by_type
from ..functions.text import index_column_list
from ..session import default_parallelism
from ..sources.files import parse_delimited, scan_text_records
from ..util import as_list, qcol


def _is_path(target: str) -> bool:
    return "/" in target or ":" in target


def write_drop(df: DataFrame, path: str, mode: str = "overwrite", files: int | None = None) -> str:
    """Write a parquet drop (a directory of part files).  ``files`` fixes the
    number of output files without a shuffle (coalesce)."""
    out = df.coalesce(files) if files else df
    out.write.mode(mode).parquet(path)
    return path


def _target_schema(spark: SparkSession, target: str) -> StructType:
    return spark.read.parquet(target).schema if _is_path(target) else spark.table(target).schema


def insert_positional(df: DataFrame, target: str, mode: str = "append") -> None:
    """INSERT by column *position* into an existing table (name or path).
    Values are cast to the target's types first (``try_cast``: a value that
    does not convert is NULL instead of an analysis error)."""
    spark = df.sparkSession
    schema = _target_schema(spark, target)
    if len(df.columns) != len(schema.fields):
        raise ValueError(f"insert_positional: {len(df.columns)} columns for {len(schema.fields)}")
    cols = [qcol(c).try_cast(f.dataType).alias(f.name) for c, f in zip(df.columns, schema.fields)]
    out = df.select(*cols)
    if _is_path(target):
        out.write.mode(mode).parquet(target)
    else:
        out.write.insertInto(target, overwrite=(mode == "overwrite"))


def create_table_as(df: DataFrame, target: str) -> None:
    """CREATE OR REPLACE TABLE ... AS SELECT (name or path)."""
    if _is_path(target):
        df.write.mode("overwrite").parquet(target)
    else:
        df.write.mode("overwrite").saveAsTable(target)


def truncate_load(df: DataFrame, target: str) -> None:
    """Empty the table and load ``df`` as one overwrite (positional)."""
    insert_positional(df, target, mode="overwrite")


def append_select(df: DataFrame, target: str) -> None:
    """INSERT INTO ... SELECT by column name."""
    spark = df.sparkSession
    schema = _target_schema(spark, target)
    out = df.select(*[qcol(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    if _is_path(target):
        out.write.mode("append").parquet(target)
    else:
        out.write.insertInto(target)


def template_schema(spark: SparkSession, template_path: str, drop=("newline",),
                    cast_map: dict | None = None) -> StructType:
    """Schema of a template drop (parquet footers only; no rows are read),
    minus ``drop`` columns, with ``cast_map`` type changes applied."""
    df = spark.read.parquet(template_path)
    df = df.drop(*[c for c in as_list(drop) if c in df.columns])
    if cast_map:
        df = cast_by_type(df, cast_map)
    return df.schema


def create_empty_like(spark: SparkSession, template_path: str, target: str, drop=("newline",),
                      cast_map: dict | None = None) -> StructType:
    """A table with the template's schema (after ``drop`` and ``cast_map``)
    and no rows."""
    schema = template_schema(spark, template_path, drop, cast_map)
    create_table_as(spark.createDataFrame([], schema), target)
    return schema


#: Bits of a column's quantile code in an interleaved clustering key.
CODE_BITS = 6
#: Column of the interleaved key in rows on their way to the files.
KEY_COL = "__cluster_key"


def _bounds(df: DataFrame, cols: list[str], cells: int) -> list[list]:
    """For each column at most cells - 1 values that cut its rows into equal
    shares: percentiles of numbers and times, of all such columns in one pass;
    of other types the lowest values of Spark's own range partitions of the
    column, in which a frequent value is spread over several partitions."""
    ranked = [c for c in cols if isinstance(df.schema[c].dataType, (NumericType, DateType, TimestampType, TimestampNTZType))]
    shares = [k / cells for k in range(1, cells)]
    found = {}
    if ranked:
        row = df.agg(*[F.percentile_approx(qcol(c), shares, 10_000) for c in ranked]).first()
        found = {c: set(b or []) for c, b in zip(ranked, row)}
    for c in set(cols) - set(ranked):
        values = df.select(qcol(c).alias("v")).where(qcol("v").isNotNull()).withColumn("at", F.monotonically_increasing_id())
        spread = values.repartitionByRange(cells, "v", "at")
        lowest = spread.groupBy(F.spark_partition_id().alias("p")).agg(F.min("v").alias("v")).orderBy("p").collect()  # one row for each cell
        found[c] = {r["v"] for r in lowest} - {r["v"] for r in lowest[:1]}
    return [sorted(found[c], key=lambda x: (x != x, x)) for c in cols]  # NaN is last, as in Spark


def _code(value: Column, kind: DataType, bounds: list) -> Column:
    """How many of the sorted bounds a value reaches; NULL reaches none.  Two
    short steps of plain comparisons: whole blocks of bounds, then the bounds
    of the next block."""
    if not bounds:
        return F.lit(0)
    text = isinstance(kind, (DateType, TimestampNTZType))
    literals = [(F.lit(str(x)) if text else F.lit(x)).cast(kind) for x in bounds]
    block = isqrt(len(bounds)) + 1

    def reached(limits: list[Column]) -> Column:
        return reduce(add, [F.coalesce((value >= x).cast("int"), F.lit(0)) for x in limits], F.lit(0))

    whole = reached(literals[block - 1::block]) * block
    return whole + reached([F.get(F.array(*literals), whole + i) for i in range(block - 1)])


def interleaved_key(df: DataFrame, cols, bits: int = CODE_BITS) -> Column:
    """A number that is near for rows near in every one of ``cols``: each column
    is coded by how many of its 2^bits - 1 quantiles its value reaches (NULL:
    none), and the codes' bits are interleaved, highest first (of more than 62
    columns, the first 62's)."""
    cols = as_list(cols)[:62]
    bits = min(bits, 62 // len(cols))
    key = F.lit(0).cast("long")
    for i, (c, bounds) in enumerate(zip(cols, _bounds(df, cols, 1 << bits))):
        places = [sum((code >> level & 1) << level * len(cols) + len(cols) - 1 - i for level in range(bits)) for code in range(len(bounds) + 1)]
        key = key + F.get(F.array(*[F.lit(x).cast("long") for x in places]), _code(qcol(c), df.schema[c].dataType, bounds))
    return key


def cluster_write(df: DataFrame, cols, path: str, files: int, mode: str = "overwrite", interleave: bool | None = None) -> str:
    """Write ``df`` range-partitioned and sorted on ``cols``, so each file covers
    narrow ranges and parquet min/max statistics let filters on those columns
    skip files and row groups.

    Several columns are interleaved (``interleaved_key``), so that a filter on
    any one of them skips files; ``interleave=False`` gives their lexicographic
    order, in which the first column alone decides the files.  A hash of the row
    is the last range key, so one very frequent value is spread over several
    files instead of one."""
    names = as_list(cols)
    keys = [qcol(c) for c in names]
    rows, key = df, KEY_COL
    while key in {c.lower() for c in df.columns}:
        key += "_"
    if interleave or interleave is None and len(names) > 1:
        rows = df.withColumn(key, interleaved_key(df, names))  # stored: a sort works out an expression anew in every comparison
        keys = [qcol(key), *keys]
    spread = F.xxhash64(*[qcol(c) for c in df.columns])
    (rows.repartitionByRange(files, *keys, spread).sortWithinPartitions(*keys)
         .select(*[qcol(c) for c in df.columns]).write.mode(mode).parquet(path))
    return path


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the data files under ``path``, from the file listing."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
             .agg(F.coalesce(F.sum("length"), F.lit(0)).alias("b")))
    return int(files.first()["b"])


def compact(spark: SparkSession, path: str, out_path: str, target_files: int | None = None, cluster_cols=None,
            file_bytes: int = 512 * 1024 * 1024) -> str:
    """Rewrite many small files into few in a new directory (OPTIMIZE):
    ``target_files``, or as many as files of ``file_bytes`` give.  With
    ``cluster_cols`` the clustered order is kept.  Otherwise files are merged
    without a shuffle (coalesce) where that leaves every core with work, and
    by a round-robin shuffle where coalescing would also read in too few
    tasks."""
    df = spark.read.parquet(path)
    if target_files is None:
        target_files = max(1, -(-stored_bytes(spark, path) // file_bytes))
    if cluster_cols:
        return cluster_write(df, cluster_cols, out_path, target_files)
    few = target_files < default_parallelism(spark)
    merged = df.repartition(target_files) if few else df.coalesce(target_files)
    merged.write.mode("overwrite").parquet(out_path)
    return out_path


def compact_small(spark: SparkSession, path: str, out_path: str, cluster_cols=None, file_bytes: int = 512 * 1024 * 1024,
                  small_share: float = 0.5) -> list[str]:
    """Merge the small files of a table - those under ``small_share`` of
    ``file_bytes``, by the file listing - into files of about ``file_bytes``
    under ``out_path``.  Returns the files the table now consists of: the large
    ones, which are neither read nor written, under their own names, and the
    merged ones.  Nothing is deleted; a reader of the old files is not
    disturbed.  With fewer than two small files nothing is written."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length").collect()  # a listing
    small = [r for r in listed if r["length"] < small_share * file_bytes]
    if len(small) < 2:
        return sorted(r["path"] for r in listed)
    merged = max(1, -(-sum(r["length"] for r in small) // file_bytes))
    rows = spark.read.parquet(*[r["path"] for r in small])
    if cluster_cols:
        cluster_write(rows, cluster_cols, out_path, merged)
    else:
        few = merged < default_parallelism(spark)
        (rows.repartition(merged) if few else rows.coalesce(merged)).write.mode("overwrite").parquet(out_path)
    new = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(out_path).select("path").collect()
    names = {r["path"] for r in small}
    return sorted([r["path"] for r in listed if r["path"] not in names] + [r["path"] for r in new])


def file_stats(spark: SparkSession, path: str, col: str) -> DataFrame:
    """Per data file: rows and min / max of ``col`` (layout check)."""
    df = spark.read.parquet(path)
    return (df.groupBy(F.col("_metadata.file_path").alias("file"))
              .agg(F.count(F.lit(1)).alias("rows"), F.min(qcol(col)).alias("min_v"),
                   F.max(qcol(col)).alias("max_v")))


def load_delimited(spark: SparkSession, path, target: str, sep: str, skip_pattern: str | None = None,
                   mode: str = "overwrite", record_sep: str = "\n") -> None:
    """Load delimited text into an existing table (name or path) the way a
    positional INSERT of typed columns does: records -> fields -> the
    target's declared types (``try_cast``) -> positional write.  One lazy
    plan on the executors; nothing passes through the driver."""
    schema = _target_schema(spark, target)
    lines = scan_text_records(spark, path, record_sep)
    fields = parse_delimited(lines, sep, [f.name for f in schema.fields], skip_pattern)
    insert_positional(fields, target, mode=mode)


def index_clustering(spark: SparkSession, index_path) -> DataFrame:
    """Per table of the index definitions under ``index_path`` (statements that
    end with ';'): (table, columns), the plain columns its indexes are on in
    order of file and place, each once.  Statements that drop something, and
    other text, are passed over."""
    statements = spark.read.option("lineSep", ";").text(index_path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    table, columns = index_column_list("value")
    found = (statements.withColumn("at", F.monotonically_increasing_id()).where(~F.col("value").rlike(r"(?is)^\s*drop\b"))
             .select("file", "start", "at", table.alias("table"), columns.alias("columns")).where("table <> '' AND size(columns) > 0"))
    # a table has few indexes: its definitions are one small group
    listed = F.transform(F.array_sort(F.collect_list(F.struct("file", "start", "at", "columns"))), lambda s: s["columns"])
    return found.groupBy("table").agg(F.array_distinct(F.flatten(listed)).alias("columns"))


def cluster_by_indexes(spark: SparkSession, index_path, tables: dict[str, DataFrame], out_path: str, files: int) -> dict[str, list[str]]:
    """Write each of ``tables`` that has index definitions under
    ``<out_path>/<table>``, clustered on the columns of its indexes
    (``cluster_write``).  Returns the columns by table.  A column that the
    table lacks is an error, before anything is written."""
    found = {r["table"]: r["columns"] for r in index_clustering(spark, index_path).collect()}  # one row for each table
    wanted = {t: found[t.lower()] for t in tables if t.lower() in found}
    for t, cols in wanted.items():
        missing = set(cols) - {c.lower() for c in tables[t].columns}
        if missing:
            raise ValueError(f"{t} lacks the indexed columns {sorted(missing)}")
    for t, cols in wanted.items():
        cluster_write(tables[t], [next(c for c in tables[t].columns if c.lower() == x) for x in cols], f"{out_path}/{t}", files)
    return wanted
