"""File ledger for incremental batch loads.

The ledger is a small table with one row per arrived drop:
``file_name, file_arrival_timestamp, file_number_of_rows,
file_processed_timestamp, file_loaded``.  Times are UTC wall-clock values
(``timestamp_ntz``), so every session and client reads the same value
whatever its time zone.  Functions return the new ledger as a DataFrame;
``apply_pending`` commits target and ledger together as a new version.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, LongType, StringType, StructField, StructType,
                               TimestampNTZType)

from ..functions import casts
from ..functions.casts import cast_by_type
from ..sources import footers
from ..util import qcol
from . import aggregates, cdc, dml, quality, versions
from .reconcile import union_all

LEDGER_SCHEMA = StructType([
    StructField("file_name", StringType()),
    StructField("file_arrival_timestamp", TimestampNTZType()),
    StructField("file_number_of_rows", LongType()),
    StructField("file_processed_timestamp", TimestampNTZType()),
    StructField("file_loaded", BooleanType()),
])


def empty_ledger(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LEDGER_SCHEMA)


def utc_wall_clock(ts: F.Column) -> F.Column:
    """An instant (``timestamp``) as UTC wall-clock ``timestamp_ntz``."""
    return F.convert_timezone(None, F.lit("UTC"), ts)


def _ts(now) -> F.Column:
    """``now`` as UTC wall-clock time: None is the current time; text or a
    naive datetime is taken as UTC wall-clock already."""
    if now is None:
        return utc_wall_clock(F.current_timestamp())
    if isinstance(now, F.Column):
        return now
    if isinstance(now, (dt.datetime, dt.date)):
        now = now.isoformat(sep=" ") if isinstance(now, dt.datetime) else now.isoformat()
    return F.lit(now).cast("timestamp_ntz")


def drop_name(path_col: F.Column, level: str = "dir") -> F.Column:
    """Name of the drop a data file belongs to: its parent directory (drops
    are directories named like files), or the file name itself.  ``path_col``
    is the file's plain (not URL-encoded) path."""
    parts = F.split(path_col, "/")
    return F.element_at(parts, -2) if level == "dir" else F.element_at(parts, -1)


def decoded_path(uri: F.Column) -> F.Column:
    """A file URI's path as it is written in the store."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def drop_counts(spark: SparkSession, path, level: str = "dir") -> DataFrame:
    """Rows per drop under ``path`` (a directory of drops, or a glob): the
    drops of the file listing, those without rows included (0), with their
    rows from one scan that reads no data columns, combined map-side."""
    paths = [path] if isinstance(path, str) else list(path)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    listed = files.select(drop_name(F.col("path"), level).alias("file_name")).distinct()
    # no column is read, so any schema will do for drops of all schemas
    counts = (spark.read.schema("__none int").option("recursiveFileLookup", "true").parquet(*paths)
              .select(drop_name(decoded_path(F.col("_metadata.file_path")), level).alias("__name"))
              .groupBy("__name").agg(F.count(F.lit(1)).alias("__n")))
    return (listed.join(counts, listed["file_name"] == counts["__name"], "left")
            .select("file_name", F.coalesce("__n", F.lit(0)).cast("long").alias("file_number_of_rows")))


def _arrival(counts: DataFrame) -> F.Column:
    c = F.col("file_arrival_timestamp")
    t = counts.schema["file_arrival_timestamp"].dataType.typeName()
    if t == "timestamp":
        return utc_wall_clock(c)
    return c.cast("timestamp_ntz")


def register_files(ledger: DataFrame, counts: DataFrame, now=None) -> DataFrame:
    """Add one ledger row per drop in ``counts`` (file_name,
    file_number_of_rows), not loaded yet.  Registering a name again replaces
    its row (INSERT ... REPLACE WHERE file_name = ...)."""
    rows = counts.select(
        F.col("file_name").cast("string"),
        (_arrival(counts) if "file_arrival_timestamp" in counts.columns else _ts(now))
        .alias("file_arrival_timestamp"),
        F.col("file_number_of_rows").cast("long"),
        F.lit(None).cast("timestamp_ntz").alias("file_processed_timestamp"),
        F.lit(False).alias("file_loaded"))
    kept = ledger.join(rows.select("file_name"), "file_name", "left_anti")
    return kept.unionByName(rows)


def pending_files(ledger: DataFrame, arrived: DataFrame | None = None) -> DataFrame:
    """Drops not marked loaded, oldest arrival first (then by name).  With
    ``arrived`` (a file_name column), arrived names missing from the loaded
    set (an anti join against the loaded rows)."""
    loaded = ledger.where(F.col("file_loaded"))
    base = ledger if arrived is None else arrived
    pend = base.join(loaded.select("file_name"), "file_name", "left_anti")
    order = [c for c in ("file_arrival_timestamp", "file_name") if c in pend.columns]
    return pend.orderBy(*order)


def mark_loaded(ledger: DataFrame, files, now=None) -> DataFrame:
    """Set ``file_loaded`` and the processed time for the named drops: a
    name, a list of names, or a DataFrame with a ``file_name`` column
    (applied with a join, so any number of drops)."""
    if isinstance(files, DataFrame):
        hit = files.select(F.col("file_name"), F.lit(True).alias("__hit")).distinct()
        marked = ledger.join(hit, "file_name", "left")
        out = dml.update_where(marked, F.col("__hit"),
                               {"file_loaded": True, "file_processed_timestamp": _ts(now)})
        return out.select(*ledger.columns)
    names = [files] if isinstance(files, str) else list(files)
    return dml.update_where(ledger, F.col("file_name").isin(names),
                            {"file_loaded": True, "file_processed_timestamp": _ts(now)})


def stage_drop(df: DataFrame, stage_dir: str, name: str, ledger: DataFrame, now=None,
               flag_from: str | None = "newline", flag: str = "delta_flg",
               cast_map: dict | None = None) -> tuple[DataFrame, int, str]:
    """Stage one drop: rename the control column ``flag_from`` to ``flag``,
    apply ``cast_map`` type changes (e.g. ``{'double': 'bigint'}``), write it
    to ``<stage_dir>/<name>`` and register it in the ledger.  Returns (new
    ledger, row count, distinct flags joined by ', ')."""
    out = df.withColumnRenamed(flag_from, flag) if flag_from and flag_from in df.columns else df
    if cast_map:
        out = cast_by_type(out, cast_map)
    path = f"{stage_dir}/{name}"
    out.write.mode("overwrite").parquet(path)
    written = df.sparkSession.read.parquet(path)
    stats = written.agg(F.count(F.lit(1)).alias("n")).first()
    flags = aggregates.distinct_flags(written, flag).first()
    counts = df.sparkSession.createDataFrame([(name, int(stats["n"]))],
                                             "file_name string, file_number_of_rows long")
    return register_files(ledger, counts, now), int(stats["n"]), (flags["flags"] if flags else "")


def write_ledger(ledger: DataFrame, path: str) -> DataFrame:
    """The ledger written once and read back: a table, not a plan that scans
    the drops again with every use."""
    ledger.write.mode("overwrite").parquet(path)
    return ledger.sparkSession.read.schema(ledger.schema).parquet(path)


# ------------------------------------------------------------------ loads
def _joined_ledgers(old: DataFrame, new: DataFrame) -> DataFrame:
    """One row per drop: the later arrival (a drop registered again is pending
    again), of equal arrivals the one already loaded."""
    both = old.unionByName(new)
    order = F.struct(F.col("file_arrival_timestamp"), F.coalesce("file_loaded", F.lit(False)))
    row = F.struct(*[F.col(c) for c in old.columns])
    return both.groupBy("file_name").agg(F.max_by(row, order).alias("r")).select("r.*")


def _fold_drops(spark: SparkSession, target: DataFrame, drops: DataFrame, pk: list[str], flag: str,
                load_type: str, label: str) -> DataFrame:
    """What merging the drops one after the other gives, in one pass.

    ``drops`` holds the change rows with their drop's place ``__seq``.  Per key,
    what a drop can do is one of few things, so an aggregate per (key, drop)
    (map-side combined) and then per key (one entry for each drop that names
    it) is enough to know, for a key the target has and for one it lacks: is it
    there in the end, which drop's inserted rows make it (0: the target's own),
    and which later update gave its values.  Target and change rows then pick
    that up by one join each."""
    keyed = drops.where(cdc._all_not_null(pk))
    fl = qcol(flag)
    hit = fl.isin(cdc.FLAG_UPDATE, cdc.FLAG_DELETE)
    can_insert = F.lit(True) if load_type == cdc.INITIAL else F.coalesce(fl == cdc.FLAG_INSERT, F.lit(False))
    values = [f.name for f in target.schema.fields if f.name not in pk]
    payload = F.struct(*[qcol(c).cast(target.schema[c].dataType).alias(c) for c in values]) if values else F.struct(F.lit(0).alias("__none"))
    per_drop = keyed.groupBy(*[qcol(k) for k in pk], "__seq").agg(
        F.count(F.when(hit, 1)).alias("__hits"), F.max(F.when(hit, fl)).alias("__flag"),
        F.max_by(payload, F.when(fl == cdc.FLAG_UPDATE, 1)).alias("__payload"),
        F.max(can_insert).alias("__inserts"))
    entries = per_drop.groupBy(*[qcol(k) for k in pk]).agg(
        F.array_sort(F.collect_list(F.struct("__seq", "__hits", "__flag", "__inserts", "__payload"))).alias("__e"))

    def outcome(there: bool):
        start = F.struct(F.lit(there).alias("there"), F.lit(0).cast("long").alias("made"), F.lit(0).cast("long").alias("update"),
                         F.lit(False).alias("broken"))

        def step(acc, x):
            gone = acc["there"] & (x["__flag"] == cdc.FLAG_DELETE)
            made = ~acc["there"] & x["__inserts"]
            updated = acc["there"] & (x["__flag"] == cdc.FLAG_UPDATE)
            return F.struct(
                F.when(acc["there"], ~F.coalesce(gone, F.lit(False))).otherwise(x["__inserts"]).alias("there"),
                F.when(made, x["__seq"]).otherwise(acc["made"]).alias("made"),
                F.when(made, F.lit(0).cast("long")).when(F.coalesce(updated, F.lit(False)), x["__seq"]).otherwise(acc["update"]).alias("update"),
                (acc["broken"] | (acc["there"] & (x["__hits"] > 1))).alias("broken"))
        return F.aggregate("__e", start, step)

    def with_values(o):
        chosen = F.filter("__e", lambda x: x["__seq"] == o["update"])
        return F.struct(o["there"].alias("there"), o["made"].alias("made"), o["broken"].alias("broken"),
                        F.get(chosen, F.lit(0))["__payload"].alias("payload"))

    both = entries.withColumn("__a", outcome(True)).withColumn("__b", outcome(False))
    both = both.select(*[qcol(k) for k in pk], with_values(F.col("__a")).alias("__old"), with_values(F.col("__b")).alias("__new"))
    # plain tables on both sides of the joins below, so adaptive execution can split a hot key
    both = cdc._written(both, f"{label}-outcome")
    o = F.when(F.col("__o.broken"), F.raise_error(F.lit(cdc.MULTI_MATCH_ERROR)))

    def out(columns_from):
        return [qcol(f.name) if f.name in pk else
                F.when(F.col("__o.payload").isNotNull(), F.col("__o.payload")[f.name]).otherwise(columns_from(f)).alias(f.name)
                for f in target.schema.fields]

    kept = (target.join(both.withColumnRenamed("__old", "__o"), pk, "left")
            .where(F.coalesce(o, F.col("__o").isNull() | (F.col("__o.there") & (F.col("__o.made") == 0))))
            .select(*out(lambda f: qcol(f.name))))
    own_keys = target.select(*[qcol(k) for k in pk]).where(cdc._all_not_null(pk)).distinct().withColumn("__has", F.lit(True))
    chosen = both.join(own_keys, pk, "left").select(
        *[qcol(k) for k in pk], F.when(F.col("__has"), F.col("__old")).otherwise(F.col("__new")).alias("__o"))
    chosen = cdc._written(chosen.where("__o.there AND __o.made > 0 OR __o.broken"), f"{label}-made")
    made = (keyed.where(can_insert).join(chosen, pk)
            .where(F.coalesce(o, F.col("__o.made") == F.col("__seq")))
            .select(*[c.cast(f.dataType).alias(f.name) for c, f in zip(out(lambda f: qcol(f.name)), target.schema.fields)]))
    unkeyed = drops.where(~cdc._all_not_null(pk)).where(can_insert).select(
        *[qcol(f.name).cast(f.dataType).alias(f.name) for f in target.schema.fields])
    return kept.unionByName(made).unionByName(unkeyed)


def pending_changes(spark: SparkSession, stage_dir: str, names: list[str], schema: StructType, flag: str = "delta_flg",
                    expectations: dict | None = None) -> DataFrame:
    """The rows of staged drops in the columns and types of ``schema``, with
    their flag and their drop's place in ``names`` (``__seq``, from 1).

    Footers are read by tasks, and drops of equal schema by one scan, so a
    thousand drops cost no more jobs than two.  A drop must have the table's
    columns, in any order, in types that hold no other values: narrower ones
    widen, a number that its column cannot hold fails the job, and any other
    type is a ``SchemaMismatch``."""
    place = {f"{stage_dir}/{n}": i for i, n in enumerate(names, start=1)}
    wanted = StructType([*schema.fields, StructField(flag, StringType()), StructField("__file", StringType())])
    root_of = footers.root_finder(list(place))
    out = []
    for own, paths in footers.files_by_schema(footers.file_columns(spark, list(place))):
        rows = spark.read.schema(own).parquet(*paths)
        if flag not in rows.columns:
            raise quality.SchemaMismatch(f"{root_of(paths[0])}: no column {flag}")
        quality.schema_gate(rows, schema, ignore=[flag], ordered=False, fitting=True)
        rows = rows.withColumn("__file", footers.plain_path_col(decoded_path(F.col("_metadata.file_path")))).withColumn(flag, qcol(flag).cast("string"))
        # file names, as listed above
        seq = spark.createDataFrame([(footers.plain_path(p), place[root_of(p)]) for p in paths], "__file string, __seq long")
        out.append(casts.fit(rows, wanted).join(F.broadcast(seq), "__file").drop("__file"))
    if not out:
        return spark.createDataFrame([], StructType([*schema.fields, StructField(flag, StringType()), StructField("__seq", LongType())]))
    changes = union_all(*out)
    return quality.expect_all_or_fail(changes, expectations) if expectations else changes


def _touched(changes: DataFrame, pk: list[str], schema: StructType, flag: str, load_type: str, ranges: list[versions.Range]) -> dict[int, int]:
    """Places of the ranges that some change can act on - a row to insert whose
    key has none, a row to update or delete whose key has one - and how many
    rows may be inserted there.  ``changes`` carry their range's place."""
    places = [r[0] for r in changes.select(versions.RANGE).distinct().collect()]  # at most as many as there are ranges
    named = versions.with_presence(changes, pk, schema, [ranges[p] for p in places if p < len(ranges)], "__has")
    f = qcol(flag)
    inserts = F.lit(True) if load_type == cdc.INITIAL else F.coalesce(f == cdc.FLAG_INSERT, F.lit(False))
    acts = (inserts & ~F.col("__has")) | (F.coalesce(f.isin(cdc.FLAG_UPDATE, cdc.FLAG_DELETE), F.lit(False)) & F.col("__has"))
    per_range = named.where(acts).groupBy(versions.RANGE).agg(F.count_if(inserts & ~F.col("__has")).alias("n"))
    return {r[0]: r["n"] for r in per_range.collect()}


def _load(spark: SparkSession, ledger: DataFrame, target: DataFrame, stage_dir: str, out_root: str, pk: list[str], flag: str, load_type: str,
          now, table, name_filter, expectations, range_rows: int) -> tuple[DataFrame, DataFrame] | None:
    """One attempt of ``apply_pending``; None if another load committed first."""
    schema, at, ranges = target.schema, versions.committed(spark, out_root), []
    if at is not None:
        ledger = _joined_ledgers(spark.read.schema(LEDGER_SCHEMA).parquet(f"{at[1]}/ledger"), ledger)
        ranges = versions.read_list(spark, out_root, at[1])
    pend = pending_files(ledger)
    if table is not None:
        pend = pend.where(F.split("file_name", "[.]")[0] == table)
    if name_filter is not None:
        pend = pend.where(F.expr(name_filter) if isinstance(name_filter, str) else name_filter)
    listed = pend.select("file_name", "file_number_of_rows", "file_arrival_timestamp").collect()
    names, more = [r["file_name"] for r in listed], sum(r["file_number_of_rows"] or 0 for r in listed)
    if at is not None and not names:
        return versions.read_ranges(spark, schema, ranges), ledger
    version = versions.new_version(out_root, (at[0] if at else 0) + 1)
    changes = pending_changes(spark, stage_dir, names, schema, flag, expectations)
    if at is None:
        merged = _fold_drops(spark, target, changes, pk, flag, load_type, "pending") if names else target
        after = versions.write_ranges(merged.withColumn(versions.RANGE, F.lit(0)), pk, version, versions.parts_of(target.count() + more, range_rows))
    else:
        changes = cdc._written(changes.withColumn(versions.RANGE, versions.range_of(pk, schema, ranges)), "pending-changes")
        touched = _touched(changes, pk, schema, flag, load_type, ranges)
        own = [ranges[p] for p in sorted(touched) if p < len(ranges)]
        new: list[versions.Range] = []
        if touched:
            acting = changes.where(F.col(versions.RANGE).isin(list(touched))).drop(versions.RANGE)
            sizes = [n + (ranges[p].rows if p < len(ranges) else 0) for p, n in touched.items()]
            merged = _fold_drops(spark, versions.read_ranges(spark, schema, own), acting, pk, flag, load_type, "pending")
            new = versions.write_ranges(merged.withColumn(versions.RANGE, versions.range_of(pk, schema, ranges)), pk, version,
                                        sum(versions.parts_of(n, range_rows) for n in sizes))
        after = versions.joined([(i, r) for i, r in enumerate(ranges) if i not in touched], new, [versions.place_of(r) for r in new])
    versions.write_list(spark, out_root, version, after)
    done = mark_loaded(ledger, spark.createDataFrame([(n,) for n in names], "file_name string"), now) if names else ledger
    done.write.parquet(f"{version.path}/ledger")
    if not versions.commit(spark, out_root, version):
        return None
    return versions.read_ranges(spark, schema, after), spark.read.schema(LEDGER_SCHEMA).parquet(f"{version.path}/ledger")


def apply_pending(spark: SparkSession, ledger: DataFrame, target: DataFrame, stage_dir: str,
                  out_root: str, pk, flag: str = "delta_flg", load_type: str = cdc.INCREMENTAL,
                  now=None, table: str | None = None, name_filter=None, expectations: dict | None = None,
                  range_rows: int = versions.RANGE_ROWS, attempts: int = 10) -> tuple[DataFrame, DataFrame]:
    """Load every pending drop, in arrival order, into the table kept under
    ``out_root``, and mark it loaded.  Returns (target, ledger).

    Call it as often as drops arrive.  The first call starts from ``target``,
    every later one from the version the last call committed; ``ledger``
    brings drops registered since (one registered again with a later arrival
    is loaded again).  All pending drops are gated and folded in one pass
    (``pending_changes``, ``_fold_drops``; a D / U / I flag has the meaning of
    ``cdc.merge_flagged`` at its place in the order).

    The table is kept in key ranges (``operators.versions``).  After the first
    load only ranges that a change can act on are read and written; the new
    version names the others where they are.  A range that grows past twice
    ``range_rows`` is cut.

    Nothing is overwritten, and a version's number is taken by one load only.
    A load that fails before that leaves the previous version current, and the
    next call does its work; one that another load has overtaken reads the new
    version and folds its drops again, ``attempts`` times at most.

    ``table`` takes the drops whose name up to the first dot equals it;
    ``name_filter`` (SQL text or Column on ``file_name``) selects a kind of
    drop; ``expectations`` ({name: SQL rule}) fail the load on a row that
    breaks a rule."""
    pk = [pk] if isinstance(pk, str) else list(pk)
    for _ in range(attempts):
        done = _load(spark, ledger, target, stage_dir, out_root, pk, flag, load_type, now, table, name_filter, expectations, range_rows)
        if done is not None:
            return done
    raise RuntimeError(f"other loads have committed to {out_root} {attempts} times meanwhile; call again")


committed = versions.committed
