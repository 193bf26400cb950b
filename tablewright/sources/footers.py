"""Schemas of parquet files, read by tasks.

``file_columns`` gives one row per file and column, whatever the number of
files, in a constant number of jobs: the listing is a scan that reads no
content, and each task opens only the footers of its files.  Aggregates then
merge the types of a column over all files in a widening lattice
(``merged_columns``) or gather files of equal schema (``files_by_schema``).
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

FILE_COLUMNS = "root string, path string, position int, column string, type string, field string"
# Fixed value: the footer key under which Spark keeps a file's own schema.
ROW_METADATA = b"org.apache.spark.sql.parquet.row.metadata"


def plain_path(path: str) -> str:
    """A path as listings write it, the local scheme left out."""
    return "/" + path[len("file:"):].lstrip("/") if path.startswith("file:") else path


def plain_path_col(path: Column) -> Column:
    return F.regexp_replace(path, "^file:/*", "/")


def _fields(footer) -> list[dict]:
    """The columns of a footer as JSON fields: the schema Spark wrote, or else
    the one its types stand for."""
    from pyspark.sql.pandas.types import from_arrow_schema

    own = (footer.metadata or {}).get(ROW_METADATA)
    if own:
        return json.loads(own)["fields"]
    return json.loads(from_arrow_schema(footer, prefer_timestamp_ntz=True).json())["fields"]


def _rows(path: str, root_of, footer) -> list[tuple]:
    schema = StructType.fromJson({"type": "struct", "fields": _fields(footer)})
    return [(root_of(path), path, i + 1, f.name, f.dataType.simpleString(), json.dumps(f.jsonValue())) for i, f in enumerate(schema.fields)]


def root_finder(roots: list[str]):
    """The given path that a file lies under (or is)."""
    given = {plain_path(r).rstrip("/"): r for r in roots}

    def of(path: str) -> str:
        at = plain_path(path)
        while at and at not in given:
            at = at.rpartition("/")[0]
        return given.get(at, path)
    return of


def _footers(roots: list[str], content: bool):
    """Task that lists files' columns; of a file that Arrow cannot open, one row without a column."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.fs
        import pyarrow.parquet as pq

        root_of = root_finder(roots)

        @lru_cache(maxsize=64)
        def store(scheme: str):
            return pyarrow.fs.FileSystem.from_uri(scheme + "://x/x")[0] if scheme else pyarrow.fs.LocalFileSystem()

        for batch in batches:
            rows = []
            paths = batch.column(0).to_pylist()
            for i, path in enumerate(paths):
                if content:
                    rows += _rows(path, root_of, pq.read_schema(pa.BufferReader(batch.column(1)[i].as_py())))
                    continue
                at = plain_path(path)
                scheme, _, rest = at.rpartition("://")
                try:
                    footer = pq.read_schema(rest or at, filesystem=store({"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)))
                except (pa.ArrowInvalid, OSError) as e:
                    if not scheme:
                        raise OSError(f"no parquet footer in {path}: {e}") from e
                    rows.append((root_of(path), path, 0, None, None, None))
                    continue
                rows += _rows(path, root_of, footer)
            names = ("root", "path", "position", "column", "type", "field")
            cols = list(zip(*rows, strict=True)) or [()] * len(names)
            types = (pa.string(), pa.string(), pa.int32(), pa.string(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names)
    return run


def file_columns(spark: SparkSession, paths) -> DataFrame:
    """One row per parquet file under ``paths`` (files or directories) and
    column: root (the given path it lies under), path, position (from 1),
    column, type (simple string) and field (JSON).  A file without columns has
    no row.  Files in a store that Arrow cannot open are read through Spark,
    content and all; that costs a second job, for those files alone."""
    roots = [paths] if isinstance(paths, str) else list(paths)
    if not roots:
        return spark.createDataFrame([], FILE_COLUMNS)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    found = listed.load(roots).select("path").mapInArrow(_footers(roots, False), FILE_COLUMNS)
    if all("://" not in plain_path(r) for r in roots):
        return found
    closed = [r["path"] for r in found.where("column IS NULL").select("path").distinct().collect()]  # names of files just listed
    if not closed:
        return found
    content = listed.load(closed).select("path", "content").mapInArrow(_footers(roots, True), FILE_COLUMNS)
    return found.where("column IS NOT NULL").unionByName(content)


def files_by_schema(columns: DataFrame) -> list[tuple[StructType, list[str]]]:
    """The distinct schemas among ``file_columns`` and each one's files, in a
    stable order.  What comes to the driver is file names, as a listing."""
    per_file = columns.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("position", "field"))).alias("f"))  # one file's columns
    alike = per_file.groupBy(F.col("f.field").alias("fields")).agg(F.array_sort(F.collect_list("path")).alias("paths"))
    rows = sorted(((list(r["fields"]), list(r["paths"])) for r in alike.collect()))
    return [(StructType.fromJson({"type": "struct", "fields": [json.loads(x) for x in fields]}), own) for fields, own in rows]


# ------------------------------------------------------------------ widening
# Whole-number types and the decimal digits they may need.
INTEGER_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}
SAME, WIDENED, CLASH = "same", "widened", "clash"


def merged_columns(columns: DataFrame, by=()) -> DataFrame:
    """Per column (and ``by``): the least type that every file's type widens
    to without loss, as (column, merged_type, status, types, files).

    Whole numbers widen to longer ones and to decimals, decimals to decimals
    with the digits of both sides (38 at most), real numbers and whole ones of
    up to 32 bits to double (up to 16 bits and float to float), dates to timestamps without time zone, void to
    anything.  Other types only equal themselves; where types do not meet,
    merged_type is NULL and the status ``clash``: such values are for the
    rescue column.  One aggregate, combined map-side: the lattice's joins are
    maxima and counts."""
    t = F.col("type")
    whole = F.lit(None).cast("int")
    for name, digits in INTEGER_DIGITS.items():
        whole = F.when(t == name, digits).otherwise(whole)
    parts = [F.try_element_at(F.split(F.regexp_extract(t, r"^decimal\((\d+,\d+)\)$", 1), ","), F.lit(k)).try_cast("int") for k in (1, 2)]
    decimal = t.rlike(r"^decimal\(")
    digits = F.when(decimal, parts[0] - parts[1]).otherwise(whole)
    real = t.isin("float", "double")
    family = (F.when(t == "void", F.lit(None)).when(decimal | whole.isNotNull(), "number").when(real, "real")
              .when(t.isin("date", "timestamp_ntz"), "time").otherwise(t))
    seen = columns.select(*by, "column", "path", "type", family.alias("family"), digits.alias("digits"), F.when(decimal, parts[1]).otherwise(0).alias("scale"),
                          decimal.alias("decimal"))
    found = seen.groupBy(*by, "column").agg(
        F.collect_set("type").alias("types"), F.collect_set("family").alias("families"), F.max("digits").alias("digits"), F.max("scale").alias("scale"),
        F.max("decimal").alias("decimal"), F.count_distinct("path").alias("files"))
    only = F.size("families") == 1
    first, kinds = F.get("families", F.lit(0)), F.array_sort("types")
    integer = F.lit(None).cast("string")
    for name, most in reversed(INTEGER_DIGITS.items()):
        integer = F.when(F.col("digits") <= most, name).otherwise(integer)
    number = (F.when(~F.col("decimal"), integer)
              .when(F.col("digits") + F.col("scale") <= 38, F.concat(F.lit("decimal("), F.col("digits") + F.col("scale"), F.lit(","), F.col("scale"), F.lit(")"))))
    exact_in_double = F.array_contains("families", "real") & (F.size(F.array_except("families", F.array(F.lit("real"), F.lit("number")))) == 0) \
        & ~F.col("decimal") & (F.col("digits") <= 10)
    merged = (F.when(F.size("families") == 0, F.lit("void"))
              .when(only & (first == "number"), number)
              .when(only & (first == "real"), F.when(F.array_contains("types", "double"), "double").otherwise("float"))
              .when(only & (first == "time"), F.when(F.array_contains("types", "timestamp_ntz"), "timestamp_ntz").otherwise("date"))
              .when(only, first)
              .when(exact_in_double, F.when(F.array_contains("types", "double") | (F.col("digits") > 5), "double").otherwise("float")))
    status = F.when(merged.isNull(), CLASH).when(F.size("types") == 1, SAME).otherwise(WIDENED)
    return found.select(*by, "column", merged.alias("merged_type"), status.alias("status"), F.array_join(kinds, ", ").alias("types"), "files")
