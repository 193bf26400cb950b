"""What the text operators share: reading the documents table, walking Arrow
batches inside tasks, and writing intermediate tables to the shared folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewright.session import scratch_path

#: Text handed to one step of a Python task at once; a longer document is a step of its own.
STEP_BYTES = 2 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns the operators need, as (doc_id long, text string); a
    null text counts as empty.  Other columns, whatever their names, are left
    behind here, so they cannot clash with an operator's own."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the folder that driver and executors share, and
    read back: lineage ends here and lost executors cost nothing."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{label}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one, that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def rows_that_stay(docs: DataFrame, stay: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` that ``stay`` (doc_id, sha: 32 bytes) names, one for
    each name, all columns as they were.  Id and hash make one key that is never
    null; the join and the choice among repeated rows share its one exchange."""
    def key(doc_id: Column, sha: Column) -> Column:
        return F.concat(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"), F.lit("/").cast("binary"), sha)

    own = free_name(docs, "stay_key")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    keyed = docs.withColumn(own, key(F.col(f"`{id_col}`").cast("long"), F.unhex(F.sha2(text, 256))))
    wanted = stay.select(key(F.col("doc_id"), F.col("sha")).alias(own))
    return keyed.join(wanted, own, "left_semi").dropDuplicates([own]).select(*[F.col(f"`{c}`") for c in docs.columns])


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def beside_group(df: DataFrame, keys: list[str], spread: Column,
                 values: dict[str, tuple[Column, Callable[[str], Column]]]) -> DataFrame:
    """``df`` with each group's values beside its rows.

    ``values`` maps a name to an aggregate and to what joins partial aggregates
    of it.  A group is dealt by ``spread`` over as many salts as there are
    shuffle partitions: each salt's rows are aggregated map-side, one row per
    (group, salt) meets in a window, and rows get their values by joining on
    group and salt.  So a group of a third of all rows loads no task more than
    the others.  Keys must not be null."""
    salted = df.withColumn("__salt", F.pmod(F.xxhash64(spread), F.lit(shuffle_partitions(df.sparkSession))))
    some = salted.groupBy(*keys, "__salt").agg(*[agg.alias(n) for n, (agg, _) in values.items()])
    group = Window.partitionBy(*keys)
    whole = some.select(*keys, "__salt", *[merge(n).over(group).alias(n) for n, (_, merge) in values.items()])
    return salted.join(whole, [*keys, "__salt"]).drop("__salt")


def steps(batches: Iterator[pa.RecordBatch], column: str = "text",
          step_bytes: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Zero-copy slices of ``batches`` with about ``step_bytes`` of text each,
    so what a task holds does not follow the Arrow batch size."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        col = batch.column(batch.schema.get_field_index(column))
        sizes = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False)
        lo, size = 0, 0
        for i, k in enumerate(sizes):
            if size and size + k > step_bytes:
                yield batch.slice(lo, i - lo)
                lo, size = i, 0
            size += int(k)
        yield batch.slice(lo)


def as_binary(arr) -> pa.Array:
    """Text or binary Arrow column as plain binary, without copying."""
    return arr.cast(pa.binary()) if arr.type != pa.binary() else arr


def raw(arr) -> tuple[memoryview, list[int]]:
    """The bytes of a text column and the row boundaries within them."""
    import numpy as np

    arr = as_binary(arr)
    _, offsets, data = arr.buffers()
    at = np.frombuffer(offsets, np.int32)[arr.offset:arr.offset + len(arr) + 1].tolist()
    return (memoryview(data) if data is not None else memoryview(b"")), at


def fixed_binary(rows) -> pa.Array:
    """A numpy array of shape (n, width) and type uint8 as a binary column."""
    import numpy as np

    rows = np.ascontiguousarray(rows, np.uint8)
    n, width = rows.shape
    ends = np.arange(n + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(rows)])
