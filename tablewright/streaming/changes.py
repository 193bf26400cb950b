"""Streaming ingestion and change application.

``stream_apply_changes`` keeps a change log instead of rewriting the target
each micro-batch.  Last-writer-wins by (sequence, tiebreak) is associative,
commutative and idempotent, so:

* micro-batch ``i`` is reduced to its newest row per key and written to
  ``<log>/__log_version=<i>/__log_run=<run>`` with overwrite - a retried batch
  replaces its own directory and nothing else, which makes the sink idempotent
  under Structured Streaming's at-least-once batch replay.  The run is the id
  that Structured Streaming keeps in the checkpoint, so several streams, or one
  started over with a fresh checkpoint, add to a log and never overwrite each
  other's versions;
* deletes stay in the log as ordinary rows (tombstones), so a late older
  upsert cannot revive a deleted key;
* the current table is the newest row per key over base + log, minus
  deletes; ``compact_log`` folds versions into a new base directory.

Per batch the cost is O(batch); readers pay the fold.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType, StringType, StructField, StructType

from ..functions import casts
from ..operators import cdc, digests, quality
from ..operators.reconcile import union_all
from ..session import list_names, path_exists, put_if_absent, read_text, scratch_path
from ..sources import footers
from ..sources.files import rescue_unexpected
from ..util import DEFAULT_BROADCAST_BYTES, DEFAULT_BROADCAST_ROWS, as_list, fits_broadcast, qcol

# Reserved names: the partition columns of a log.  A table may not use them.
VERSION_COL = "__log_version"
RUN_COL = "__log_run"
BUCKET_COL = "__log_bucket"
# How a log is cut into buckets; Spark does not list names that begin so.
BUCKETING = "_bucketing.json"
SOURCE_FILE_COL = "_source_file"


def _check_reserved(columns) -> None:
    taken = {VERSION_COL, RUN_COL, BUCKET_COL} & set(columns)
    if taken:
        raise ValueError(f"columns {sorted(taken)} are reserved for change logs")


def version_path(log_path: str, version: int, run: str) -> str:
    return f"{log_path}/{VERSION_COL}={version}/{RUN_COL}={run}"


def bucket_log(spark: SparkSession, log_path: str, keys, buckets: int) -> None:
    """Have a log that is not begun yet keep every version, and every base
    compacted from it, in ``buckets`` directories by a hash of the key, so that
    ``lookup_state`` reads only those of the keys it is asked for.  Whoever
    writes to the log finds this in the log itself.  Each version then has a
    file a bucket at least: choose few for small versions.  Calling it again
    with the same arguments changes nothing; with others it is an error."""
    keys = as_list(keys)
    if any(n.startswith(f"{VERSION_COL}=") for n in list_names(spark, log_path)) and bucketing(spark, log_path) is None:
        raise ValueError(f"the log is begun without buckets: {log_path}")
    if buckets < 1:
        raise ValueError("buckets must be positive")
    put_if_absent(spark, f"{log_path}/{BUCKETING}", json.dumps({"keys": keys, "buckets": buckets}))
    if bucketing(spark, log_path) != (keys, buckets):
        raise ValueError(f"the log has other buckets: {log_path}")


def bucketing(spark: SparkSession, log_path: str) -> tuple[list[str], int] | None:
    """(keys, buckets) of a log kept in buckets."""
    path = f"{log_path}/{BUCKETING}"
    if not path_exists(spark, path):
        return None
    cut = json.loads(read_text(spark, path))
    return cut["keys"], cut["buckets"]


def _bucket(schema: StructType, keys: list[str], buckets: int) -> Column:
    """A key's bucket, the same whatever the width of a whole number."""
    whole = (ByteType, ShortType, IntegerType, LongType)
    return F.pmod(F.xxhash64(*[qcol(k).cast("long") if isinstance(schema[k].dataType, whole) else qcol(k) for k in keys]), F.lit(buckets)).cast("int")


def _write_rows(rows: DataFrame, path: str, cut: tuple[list[str], int] | None) -> None:
    if cut is None:
        rows.write.mode("overwrite").parquet(path)
        return
    keys, buckets = cut
    # rebalancing splits a bucket with very many rows over several tasks
    placed = rows.withColumn(BUCKET_COL, _bucket(rows.schema, keys, buckets)).hint("rebalance", F.col(BUCKET_COL))
    placed.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(BUCKET_COL).parquet(path)


def _run_of(batch: DataFrame) -> str:
    """The id of the streaming query that runs this batch: kept in its
    checkpoint over restarts, new with a fresh checkpoint."""
    run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not run:
        raise RuntimeError("not inside a streaming batch")
    return run


def write_version(rows: DataFrame, log_path: str, version: int, run: str, replace: bool = True) -> str:
    """Write one version of a log.  ``replace`` is for retries by the same
    run; without it a complete version is left alone and the write fails."""
    _check_reserved(rows.columns)
    path = version_path(log_path, version, run)
    if not replace and path_exists(rows.sparkSession, f"{path}/_SUCCESS"):
        raise FileExistsError(f"log version {version} of run {run} is already written")
    _write_rows(rows, path, bucketing(rows.sparkSession, log_path))
    return path


def stream_files(spark: SparkSession, path: str, schema: StructType, max_files: int | None = None,
                 with_source: bool = False, expected: StructType | None = None) -> DataFrame:
    """Incremental, exactly-once discovery of parquet files under ``path``
    (a directory or a glob such as ``stage/drop_*/*.parquet``).  The source
    records processed files in the query checkpoint, so a restart reads only
    new files.  ``with_source`` adds the file path of each row.  With
    ``expected``, the rows read with the files' ``schema`` are fitted to the
    expected schema and whatever does not fit is kept as JSON in
    ``_rescued_data`` (``sources.files.rescue_unexpected``)."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    df = reader.parquet(path)
    if with_source:
        df = df.withColumn(SOURCE_FILE_COL, F.col("_metadata.file_path"))
    if expected is not None:
        keep = StructType(list(expected.fields) + ([StructField(SOURCE_FILE_COL, StringType())]
                                                   if with_source else []))
        df = rescue_unexpected(df, keep)
    return df


def stream_append(stream: DataFrame, path: str, checkpoint: str, wait: bool = True) -> StreamingQuery:
    """Land a stream as an append-only parquet table; processes everything
    available now, then stops."""
    q = (stream.writeStream.format("parquet").option("path", path)
         .option("checkpointLocation", checkpoint).outputMode("append")
         .trigger(availableNow=True).start())
    if wait:
        q.awaitTermination()
    return q


def stream_apply_changes(stream: DataFrame, log_path: str, checkpoint: str, keys, sequence_by,
                         apply_as_deletes=None, tiebreak=None, wait: bool = True,
                         target_schema: StructType | None = None, ignore=(),
                         expectations: dict | None = None, after_batch=None) -> StreamingQuery:
    """Apply a change stream continuously (SCD type 1): each micro-batch is
    folded to one row per key and written to its own log version.

    ``target_schema`` stops the stream before it starts when its columns
    (minus ``ignore``) do not match by name and position;
    ``expectations`` ({name: SQL rule}) fail the running query on the first
    row that breaks a rule, before anything of that batch is written.
    ``after_batch(batch_id)`` runs after a batch's log version is written
    (metrics, notifications).  To hold the arriving files' own schemas against
    the target's, use ``stream_apply_drops``."""
    keys = as_list(keys)
    _check_reserved(stream.columns)
    if target_schema is not None:
        quality.schema_gate(stream, target_schema, ignore=ignore, ordered=True)
    if expectations:
        stream = quality.expect_all_or_fail(stream, expectations)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        folded = cdc.fold_changes(batch, keys, sequence_by, apply_as_deletes, tiebreak)
        write_version(folded, log_path, batch_id, _run_of(batch))
        if after_batch is not None:
            after_batch(batch_id)

    q = (stream.writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    if wait:
        q.awaitTermination()
    return q


def stream_drops(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The names of parquet files as they arrive under ``path`` (a glob of
    files): one row (``path``) each, whatever their schemas; no content is read."""
    reader = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.load(path).select("path")


def read_drops(spark: SparkSession, paths, expected: StructType, on_unexpected: str = "rescue",
               rescue_col: str = "_rescued_data") -> DataFrame:
    """Files of possibly different schemas in the ``expected`` one, its types
    included.  Footers are read by tasks, and files that agree are read
    together, so the number of jobs does not grow with the files.

    ``fail`` stops on columns that are not the expected ones and on types whose
    values cannot be theirs (``quality.schema_gate``); types that widen are
    cast, and a number that its column cannot hold fails the job that reads it.
    ``rescue`` keeps what does not fit as JSON in ``rescue_col``."""
    if on_unexpected not in ("rescue", "fail"):
        raise ValueError("on_unexpected must be 'rescue' or 'fail'")
    out = []
    for schema, own in footers.files_by_schema(footers.file_columns(spark, list(paths))):
        df = spark.read.schema(schema).parquet(*own)
        if on_unexpected == "fail":
            out.append(casts.fit(quality.schema_gate(df, expected, ordered=False, fitting=True), expected))
        else:
            out.append(rescue_unexpected(df, expected, rescue_col))
    if not out:
        empty = spark.createDataFrame([], expected)
        return rescue_unexpected(empty, expected, rescue_col) if on_unexpected == "rescue" else empty
    return union_all(*out)


def _each_batch(spark: SparkSession, path: str, checkpoint: str, expected: StructType, on_unexpected: str,
                max_files: int | None, wait: bool, handle) -> StreamingQuery:
    def run(batch: DataFrame, batch_id: int) -> None:
        names = [r["path"] for r in batch.collect()]  # at most the files of one trigger
        handle(read_drops(batch.sparkSession, sorted(names), expected, on_unexpected), batch_id, _run_of(batch))

    q = (stream_drops(spark, path, max_files).writeStream.foreachBatch(run)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    if wait:
        q.awaitTermination()
    return q


def stream_land_drops(spark: SparkSession, path: str, out_path: str, checkpoint: str, expected: StructType,
                      on_unexpected: str = "rescue", max_files: int | None = 1000, wait: bool = True) -> StreamingQuery:
    """Land parquet files as they arrive, each read by its own schema and
    fitted to the ``expected`` one; read the result with ``read_log``."""
    return _each_batch(spark, path, checkpoint, expected, on_unexpected, max_files, wait,
                       lambda rows, i, run: write_version(rows, out_path, i, run))


def stream_apply_drops(spark: SparkSession, path: str, log_path: str, checkpoint: str, expected: StructType, keys,
                       sequence_by, apply_as_deletes=None, tiebreak=None, on_unexpected: str = "fail",
                       expectations: dict | None = None, max_files: int | None = 1000, wait: bool = True) -> StreamingQuery:
    """``stream_apply_changes`` over files whose schemas are not known before
    they arrive.  Each batch's files are held against ``expected`` before
    anything of the batch is written: a file with other columns or with types
    that do not fit stops the stream (``fail``), or what does not fit is
    rescued.  Versions are written in the expected types, so a log reads
    whatever arrived."""
    keys = as_list(keys)

    def handle(rows: DataFrame, batch_id: int, run: str) -> None:
        if expectations:
            rows = quality.expect_all_or_fail(rows, expectations)
        write_version(cdc.fold_changes(rows, keys, sequence_by, apply_as_deletes, tiebreak), log_path, batch_id, run)

    return _each_batch(spark, path, checkpoint, expected, on_unexpected, max_files, wait, handle)


def read_log(spark: SparkSession, log_path: str, schema: StructType | None = None,
             min_version: int | None = None, buckets: list[int] | None = None) -> DataFrame:
    """All log versions of all runs (the partition columns removed).
    ``min_version`` prunes older version directories at planning time,
    ``buckets`` those of other buckets (``bucket_log``).
    Without a ``schema``, the versions' schemas are merged: a column that only
    some have is NULL in the others.  A log with no version yet - a directory
    that is not there, below one that is, or an empty one - reads as an empty
    table when ``schema`` is given.  Anything else that cannot be read is an
    error."""
    reader = spark.read.option("mergeSchema", "true")
    if schema is not None:
        _check_reserved(schema.names)
        cut = [StructField(BUCKET_COL, IntegerType())] if bucketing(spark, log_path) else []
        reader = spark.read.schema(StructType([*schema.fields, StructField(VERSION_COL, LongType()),
                                               StructField(RUN_COL, StringType()), *cut]))
        if not any(n != BUCKETING for n in list_names(spark, log_path)):
            parent = log_path.rstrip("/").rpartition("/")[0]
            if not path_exists(spark, log_path) and not path_exists(spark, parent):
                raise FileNotFoundError(f"no change log, nor a place for one: {log_path}")
            return spark.createDataFrame([], schema)
    df = reader.parquet(log_path)
    if min_version is not None:
        df = df.where(F.col(VERSION_COL) >= min_version)
    if buckets is not None:
        df = df.where(F.col(BUCKET_COL).isin(buckets))
    return df.drop(VERSION_COL, RUN_COL, BUCKET_COL)


def current_state(spark: SparkSession, log_path: str, keys, sequence_by, apply_as_deletes=None,
                  except_columns=(), tiebreak=None, base: DataFrame | None = None,
                  schema: StructType | None = None, since_version: int | None = None,
                  broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS,
                  broadcast_bytes: int | None = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """The table as of the latest log version: newest row per key over base
    and log, deletes removed, ``except_columns`` dropped.

    ``base`` is a compaction (``compact_log`` output: one row per key,
    tombstones kept) of the versions below ``since_version``, which are then
    not read.  When the log's distinct keys are proven small, only base rows
    of keys the log touches are folded with it: the rest of the base passes
    through a broadcast anti join, so reading the table does not shuffle
    the base."""
    keys = as_list(keys)
    rows = read_log(spark, log_path, schema, min_version=since_version)
    if base is None:
        latest = cdc.fold_changes(rows, keys, sequence_by, apply_as_deletes, tiebreak)
    else:
        latest = cdc.fold_into_base(base.drop(BUCKET_COL), rows, keys, sequence_by, apply_as_deletes, tiebreak,
                                    broadcast_rows, broadcast_bytes)
    return cdc.current_rows(latest, apply_as_deletes, except_columns)


def lookup_state(spark: SparkSession, log_path: str, wanted: DataFrame, sequence_by, apply_as_deletes=None, except_columns=(),
                 tiebreak=None, base_path: str | None = None, schema: StructType | None = None, since_version: int | None = None,
                 broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS, broadcast_bytes: int | None = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``current_state`` for the keys in ``wanted`` alone, of a log kept in
    buckets (``bucket_log``): only the directories of their buckets are read,
    in the log and in the base at ``base_path`` (``compact_log``), and only
    rows of wanted keys are folded.  A NULL key is looked up like any other;
    keys that the log does not know give no row, keys wanted twice give one.
    The buckets' numbers, at most as many as the log has, pass the driver."""
    cut = bucketing(spark, log_path)
    if cut is None:
        raise ValueError(f"the log has no buckets: {log_path}")
    keys, buckets = cut
    whole = read_log(spark, log_path, schema, since_version)
    keys_of = wanted.select(*[qcol(k).cast(whole.schema[k].dataType).alias(k) for k in keys]).distinct()
    numbers = [r["b"] for r in keys_of.select(_bucket(keys_of.schema, keys, buckets).alias("b")).distinct().collect()]
    rows = read_log(spark, log_path, schema, since_version, buckets=sorted(numbers))
    if base_path is not None:
        base = spark.read.parquet(base_path)
        if BUCKET_COL not in base.columns:
            raise ValueError(f"the base has no buckets: {base_path}")
        rows = base.where(F.col(BUCKET_COL).isin(sorted(numbers))).drop(BUCKET_COL).unionByName(rows, allowMissingColumns=True)
    own = keys_of.select(*[qcol(k).alias(f"__w{i}") for i, k in enumerate(keys)])
    if fits_broadcast(own, broadcast_rows, broadcast_bytes):
        own = F.broadcast(own)
    rows = rows.join(own, [qcol(k).eqNullSafe(F.col(f"__w{i}")) for i, k in enumerate(keys)], "left_semi")
    return cdc.current_rows(cdc.fold_changes(rows, keys, sequence_by, apply_as_deletes, tiebreak), apply_as_deletes, except_columns)


def compact_log(spark: SparkSession, log_path: str, out_path: str, keys, sequence_by,
                apply_as_deletes=None, tiebreak=None, base: DataFrame | None = None) -> str:
    """Fold base + every log version into one row per key (tombstones kept)
    and write it to a new base directory.  The log versions can be removed
    once the new base is complete (it carries a _SUCCESS marker).  The base of
    a log kept in buckets is kept in the same ones."""
    rows = read_log(spark, log_path)
    if base is not None:
        rows = base.drop(BUCKET_COL).unionByName(rows, allowMissingColumns=True)
    _write_rows(cdc.fold_changes(rows, keys, sequence_by, apply_as_deletes, tiebreak), out_path, bucketing(spark, log_path))
    return out_path


SNAPSHOT_SEQ = "__snapshot_version"
SNAPSHOT_OP = "__snapshot_op"


def snapshot_to_log(spark: SparkSession, log_path: str, previous: DataFrame | None, snapshot: DataFrame,
                    keys, version: int) -> str:
    """Continuous SCD type 1 from snapshots: append the difference between
    ``previous`` (None for the first snapshot) and ``snapshot`` to the change
    log as version ``version`` (I/U rows carry the new values, D rows are
    tombstones).  Only changed keys are written; read the table with
    ``snapshot_state``.  A key that occurs twice in a snapshot fails the job,
    and so does a version that is already complete."""
    if previous is None:
        rows = cdc.unique_by_key(snapshot, keys).withColumn("_change", F.lit("I"))
    else:
        rows = cdc.snapshot_diff(previous, snapshot, keys, change_col="_change")
    out = (rows.withColumn(SNAPSHOT_SEQ, F.lit(version).cast("long"))
               .withColumnRenamed("_change", SNAPSHOT_OP))
    return write_version(out, log_path, version, "snapshot", replace=False)


def _snapshot_versions(spark: SparkSession, log_path: str) -> list[int]:
    """Complete versions of a snapshot log, in order."""
    found = [int(n.partition("=")[2]) for n in list_names(spark, log_path) if n.startswith(f"{VERSION_COL}=")]
    return sorted(v for v in found if path_exists(spark, f"{version_path(log_path, v, 'snapshot')}/_SUCCESS"))


def snapshot_to_log_by_digests(spark: SparkSession, log_path: str, digest_path: str, snapshot: DataFrame, keys, version: int,
                               broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS,
                               broadcast_bytes: int | None = DEFAULT_BROADCAST_BYTES) -> str:
    """``snapshot_to_log`` without the previous state: every version keeps a
    side table of its keys and row digests under ``digest_path``, and the next
    snapshot is compared with that - a key and 16 bytes a row - instead of the
    whole state folded from the log.  Rows of ``snapshot`` move only where
    their key changed, and where the changed keys may be broadcast not even
    those.  Read the table with ``snapshot_state``.

    Versions are added in order.  The side table is written before the log
    version, and used only if that is complete, so a job killed anywhere is
    called again with the same version.  The newest version of a log that was
    begun without digests is folded once to make them.  ``snapshot`` is read
    twice and must give the same rows.  D rows hold the key, other columns are
    NULL.  A key that occurs twice in the snapshot (NULL counts as one) fails
    the job; so does a version that is not newer than the log."""
    keys = as_list(keys)
    taken = {SNAPSHOT_SEQ, SNAPSHOT_OP, digests.D0, digests.D1, "__side", "__n"} & set(snapshot.columns)
    if taken:
        raise ValueError(f"columns {sorted(taken)} are reserved for snapshot logs")
    versions = _snapshot_versions(spark, log_path)
    if versions and versions[-1] >= version:
        raise FileExistsError(f"the log is at version {versions[-1]}")

    def side_path(v):
        return f"{digest_path}/version={v}"

    def write_side(df, v):
        df.write.mode("overwrite").parquet(side_path(v))
        return spark.read.schema(df.schema).parquet(side_path(v))
    new = write_side(digests.keyed(snapshot, keys), version)
    values = [f for f in snapshot.schema.fields if f.name not in keys]
    if not versions:
        rows = cdc.unique_by_key(snapshot, keys).withColumn(SNAPSHOT_OP, F.lit("I"))
    else:
        last = versions[-1]
        if path_exists(spark, f"{side_path(last)}/_SUCCESS"):
            old = spark.read.parquet(side_path(last))
        else:
            old = write_side(digests.keyed(snapshot_state(spark, log_path, keys), keys), last)
        found = digests.changed_keys(old, new, keys, SNAPSHOT_OP, cdc.DUPLICATE_KEY_ERROR)
        path = scratch_path(spark, "changed-keys")
        found.write.parquet(path)
        changed = spark.read.schema(found.schema).parquet(path)
        written = changed.where(F.col(SNAPSHOT_OP) != "D").select(*[qcol(k).alias(f"__k{i}") for i, k in enumerate(keys)], SNAPSHOT_OP)
        if fits_broadcast(written, broadcast_rows, broadcast_bytes):
            written = F.broadcast(written)
        same = [qcol(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
        rows = (snapshot.join(written, same, "inner").select(*[qcol(c) for c in snapshot.columns], SNAPSHOT_OP)
                .unionByName(changed.where(F.col(SNAPSHOT_OP) == "D")
                             .select(*[qcol(k) for k in keys], *[F.lit(None).cast(f.dataType).alias(f.name) for f in values], SNAPSHOT_OP)))
    return write_version(rows.withColumn(SNAPSHOT_SEQ, F.lit(version).cast("long")), log_path, version, "snapshot", replace=False)


def snapshot_state(spark: SparkSession, log_path: str, keys, base: DataFrame | None = None,
                   since_version: int | None = None) -> DataFrame:
    """The table after the latest snapshot written by ``snapshot_to_log``;
    ``base`` / ``since_version`` as in ``current_state`` (a compaction of
    the older versions, see ``compact_snapshot_log``)."""
    return current_state(spark, log_path, keys, SNAPSHOT_SEQ, f"{SNAPSHOT_OP} = 'D'",
                         except_columns=[SNAPSHOT_SEQ, SNAPSHOT_OP], base=base,
                         since_version=since_version)


def compact_snapshot_log(spark: SparkSession, log_path: str, out_path: str, keys) -> str:
    """Fold every version of a snapshot log into a new base directory."""
    return compact_log(spark, log_path, out_path, keys, SNAPSHOT_SEQ, f"{SNAPSHOT_OP} = 'D'")
