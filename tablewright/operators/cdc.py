"""Change application: flagged MERGE (M1), sequenced SCD1 change feeds (M2),
snapshot comparison and application (M4, M5) and change-batch generation
(M7).

Parquet has no row-level DML, so every operator returns the new table as a
DataFrame; callers write it to a *new* directory (never over their input).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timefmt import shift_seconds
from ..session import scratch_path
from ..util import DEFAULT_BROADCAST_BYTES, DEFAULT_BROADCAST_ROWS, as_list, fits_broadcast, qcol
from . import rank

# The change flags of a flagged drop (insert, update, delete)
# and the two load types of the flagged merge.
FLAG_INSERT, FLAG_UPDATE, FLAG_DELETE = "I", "U", "D"
INCREMENTAL = "Incremental"
INITIAL = "Initial"

_HIT_FLAGS = (FLAG_UPDATE, FLAG_DELETE)
MULTI_MATCH_ERROR = ("merge_flagged: more than one change row with flag U or D "
                     "matches the same target row")


def _all_not_null(keys) -> Column:
    return reduce(lambda a, b: a & b, [qcol(k).isNotNull() for k in keys])


def _target_projection(target: DataFrame, source_cols: list[str], pick) -> list[Column]:
    """One column per target column, in target order and type."""
    out = []
    for f in target.schema.fields:
        out.append(pick(f.name, f.dataType, f.name in source_cols).alias(f.name))
    return out


def merge_flagged(target: DataFrame, changes: DataFrame, pk, flag: str = "delta_flg",
                  load_type: str = INCREMENTAL,
                  broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS,
                  broadcast_bytes: int | None = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Apply a flagged change drop to ``target`` the way
    ``MERGE ... ON target.pk = source.pk`` does with the clauses

    * matched and flag 'U' -> replace every non-flag column,
    * matched and flag 'D' -> delete,
    * not matched -> insert, only when flag = 'I' for ``Incremental``,
      always (even 'D' or NULL) for ``Initial``.

    Matched rows with any other flag (I, NULL, unknown) keep the target row.
    A NULL key never matches.  Two U/D rows hitting one target row raise an
    error (MERGE cardinality rule); duplicated unmatched rows all insert.  A
    change column that the target lacks is an error, as in a MERGE that names
    it; a target column that the changes lack keeps its value.

    Plan: when the change set is proven small (at most ``broadcast_rows``
    rows and ``broadcast_bytes`` bytes, checked by one aggregation pass) it is
    broadcast and the target is never shuffled.  Otherwise the U/D change rows
    are aggregated per key (map-side first) and written to the shared folder;
    the target is left-joined with that table - two plain exchanges, so AQE
    splits a hot target key - and
    unmatched change keys come from the distinct change keys anti-joined
    with the target's distinct keys; only the target's key column is
    shuffled a second time."""
    pk = as_list(pk)
    if load_type not in (INCREMENTAL, INITIAL):
        raise ValueError(f"load_type must be {INCREMENTAL!r} or {INITIAL!r}, got {load_type!r}")
    src_cols = [c for c in changes.columns if c != flag]
    for k in pk:
        if k not in src_cols or k not in target.columns:
            raise ValueError(f"key column {k!r} missing from target or changes")
    unknown = [c for c in src_cols if c not in target.columns]
    if unknown:
        raise ValueError(f"merge_flagged: the target lacks the change columns {unknown}")
    value_cols = [c for c in src_cols if c not in pk]

    fl = qcol(flag)
    keyed = changes.where(_all_not_null(pk))
    insertable = changes if load_type == INITIAL else changes.where(fl == F.lit(FLAG_INSERT))

    # per change key with U/D rows: how many there are, and the row (only
    # these can act on a matched target row; more than one is an error)
    hit_payload = F.struct(fl.alias("__flag"), *[qcol(c).alias(c) for c in value_cols])
    hits = (keyed.where(fl.isin(*_HIT_FLAGS)).groupBy(*pk).agg(F.count(F.lit(1)).alias("__hits"), F.any_value(hit_payload).alias("__hit")))

    hit_flag = F.col("__hit.__flag")
    keep_cond = F.when(F.col("__hits") > 1, F.raise_error(F.lit(MULTI_MATCH_ERROR))) \
                 .otherwise(hit_flag.isNull() | (hit_flag == F.lit(FLAG_UPDATE)))

    def updated(name, dtype, in_source):
        if name in pk or not in_source:
            return qcol(name)
        return F.when(hit_flag == F.lit(FLAG_UPDATE), F.col("__hit")[name].cast(dtype)).otherwise(qcol(name))

    def inserted(name, dtype, in_source):
        return qcol(name).cast(dtype) if in_source else F.lit(None).cast(dtype)

    small = fits_broadcast(changes, broadcast_rows, broadcast_bytes)
    if small:
        # (a) keep / update / delete: target probes the broadcast U/D table
        kept = target.join(F.broadcast(hits), pk, "left").where(keep_cond)
        # (b) target keys that some change row names, de-duplicated map-side:
        #     at most one row per change key, so bounded like the changes
        matched = target.select(*pk).join(F.broadcast(keyed.select(*pk)), pk, "left_semi").distinct()
        # (c) inserts: change rows whose key is not matched (NULL keys never match)
        inserts = insertable.join(F.broadcast(matched), pk, "left_anti")
    else:
        # kept / updated / deleted target rows: a left outer join with the
        # written U/D table, unique by key (an aggregate above its own exchange
        # would keep AQE from splitting a hot target key across tasks)
        kept = target.join(_written(hits, "merge-hits"), pk, "left").where(keep_cond)
        # change keys with no target row: distinct change keys anti-joined
        # with the target's distinct keys (hot keys collapse map-side)
        target_keys = target.select(*pk).where(_all_not_null(pk)).distinct()
        unmatched = keyed.select(*pk).distinct().join(target_keys, pk, "left_anti")
        inserts = (insertable.where(_all_not_null(pk)).join(unmatched, pk, "left_semi")
                   .unionByName(insertable.where(~_all_not_null(pk))))

    return (kept.select(*_target_projection(target, src_cols, updated))
                .unionByName(inserts.select(*_target_projection(target, src_cols, inserted))))


def apply_changes(changes: DataFrame, keys, sequence_by, apply_as_deletes: str | Column | None = None,
                  except_columns=(), tiebreak=None, log: DataFrame | None = None,
                  base: DataFrame | None = None) -> DataFrame:
    """SCD type 1 from a change feed: per key the row with the greatest
    ``sequence_by`` (then ``tiebreak``) wins, whatever order rows arrive in;
    when that row satisfies ``apply_as_deletes`` the key is absent from the
    result.  Every other row (I, U, NULL or unknown flag) is an upsert.

    ``log`` is an earlier change log (raw rows, deletes included) to fold in;
    keeping deletes there as tombstones stops a late, older upsert from
    reviving a deleted key.  ``base`` is an already folded state (one row per
    key, tombstones kept); only its keys that the changes touch are folded
    again (``fold_into_base``).  On equal sequence a delete wins."""
    log_rows = changes if log is None else log.unionByName(changes, allowMissingColumns=True)
    if base is not None:
        latest = fold_into_base(base, log_rows, keys, sequence_by, apply_as_deletes, tiebreak)
    else:
        latest = fold_changes(log_rows, keys, sequence_by, apply_as_deletes, tiebreak)
    return current_rows(latest, apply_as_deletes, except_columns)


def _delete_col(apply_as_deletes) -> Column | None:
    if apply_as_deletes is None:
        return None
    cond = F.expr(apply_as_deletes) if isinstance(apply_as_deletes, str) else apply_as_deletes
    return F.coalesce(cond, F.lit(False))


def flag_rank(flag_col: str = "delta_flg") -> Column:
    """Tiebreak for change rows with equal sequence: D > U > I > anything
    else (pass as ``tiebreak`` to ``apply_changes`` / ``fold_changes``)."""
    f = qcol(flag_col)
    return (F.when(f == F.lit(FLAG_DELETE), 3).when(f == F.lit(FLAG_UPDATE), 2)
             .when(f == F.lit(FLAG_INSERT), 1).otherwise(0))


def fold_into_base(base: DataFrame, rows: DataFrame, keys, sequence_by, apply_as_deletes=None, tiebreak=None,
                   broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS,
                   broadcast_bytes: int | None = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Fold new change ``rows`` into a ``base`` that is already folded (one
    row per key, tombstones kept - e.g. ``fold_changes`` or a compacted
    log).  When the distinct keys of ``rows`` are proven small, only the
    base rows of those keys are folded with them and the rest of the base
    passes through a broadcast anti join: the base is never shuffled.
    Otherwise one fold over both."""
    keys = as_list(keys)
    row_keys = rows.select(*[qcol(k) for k in keys]).distinct()
    if not fits_broadcast(row_keys, broadcast_rows, broadcast_bytes):
        return fold_changes(base.unionByName(rows, allowMissingColumns=True), keys, sequence_by,
                            apply_as_deletes, tiebreak)
    bk = F.broadcast(row_keys.select(*[qcol(k).alias(f"__rk{i}") for i, k in enumerate(keys)]))
    cond = reduce(lambda a, b: a & b, [qcol(k).eqNullSafe(F.col(f"__rk{i}")) for i, k in enumerate(keys)])
    untouched = base.join(bk, cond, "left_anti")
    touched = base.join(bk, cond, "left_semi")
    folded = fold_changes(touched.unionByName(rows, allowMissingColumns=True), keys, sequence_by,
                          apply_as_deletes, tiebreak)
    # like the one fold over both: a column that only the new rows have is added
    return untouched.unionByName(folded, allowMissingColumns=True)


def fold_changes(rows: DataFrame, keys, sequence_by, apply_as_deletes=None, tiebreak=None) -> DataFrame:
    """Newest row per key, deletes kept (the compacted change log)."""
    order = as_list(sequence_by) + as_list(tiebreak)
    dcol = _delete_col(apply_as_deletes)
    if dcol is not None:
        order = order + [dcol]
    return rank.latest_per_key(rows, keys, order)


def current_rows(latest: DataFrame, apply_as_deletes=None, except_columns=()) -> DataFrame:
    dcol = _delete_col(apply_as_deletes)
    out = latest if dcol is None else latest.where(~dcol)
    drop = [c for c in as_list(except_columns) if c in out.columns]
    return out.drop(*drop)


def _written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


DUPLICATE_KEY_ERROR = "snapshot key occurs more than once on one side"


def pair_by_key(left: DataFrame, right: DataFrame, keys, cols, left_col: str = "__old",
                right_col: str = "__new", report: bool = False) -> DataFrame:
    """Line up two keyed tables: one row per key with the ``cols`` of each
    side as a struct (NULL when the side lacks the key).  Built as a union,
    one shuffle by key and one per-key aggregate, so no pair of rows is ever
    emitted; a key present twice on one side fails the job instead of
    multiplying rows.  With ``report`` it does not fail: the counts of the
    key's rows are added as ``__nl`` and ``__nr`` (and combined map-side, as
    keys may repeat)."""
    keys = as_list(keys)
    side = "__side"
    payload = "__payload"
    tag = lambda df, i: df.select(*[qcol(k) for k in keys],
                                  F.struct(*[qcol(c) for c in cols]).alias(payload),
                                  F.lit(i).alias(side))
    # hash-partition by key first: with unique keys a map-side combine saves
    # nothing, and this way both aggregate phases run after the shuffle on
    # one sort (the cost of a sort-merge join) instead of sorting map-side too
    both = tag(left, 0).unionByName(tag(right, 1))
    if not report:
        both = both.repartition(*[qcol(k) for k in keys])
    is_left, is_right = F.col(side) == 0, F.col(side) == 1
    g = both.groupBy(*[qcol(k) for k in keys]).agg(
        F.count_if(is_left).alias("__nl"), F.count_if(is_right).alias("__nr"),
        F.max_by(F.col(payload), is_left).alias("__l"), F.max_by(F.col(payload), is_right).alias("__r"))
    if report:
        return g.select(*[qcol(k) for k in keys], F.col("__l").alias(left_col), F.col("__r").alias(right_col), "__nl", "__nr")
    dup = (F.col("__nl") > 1) | (F.col("__nr") > 1)
    guard = F.when(dup, F.raise_error(F.lit(DUPLICATE_KEY_ERROR)))
    return g.select(
        *[qcol(k) for k in keys],
        F.coalesce(guard, F.when(F.col("__nl") > 0, F.col("__l"))).alias(left_col),
        F.when(F.col("__nr") > 0, F.col("__r")).alias(right_col))


def unique_by_key(df: DataFrame, keys) -> DataFrame:
    """``df`` unchanged; running it fails when a key occurs twice, whichever
    columns are read.  Only keys are shuffled for the check, combined map-side;
    it is a filter of the keys' counts, which no projection removes."""
    keys = as_list(keys)
    twice = df.groupBy(*[qcol(k) for k in keys]).agg(F.count(F.lit(1)).alias("__n"))
    broken = twice.where(F.when(F.col("__n") > 1, F.raise_error(F.lit(DUPLICATE_KEY_ERROR)).cast("boolean")).otherwise(F.lit(False)))
    return df.unionByName(broken.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields]))


def snapshot_diff(old: DataFrame, new: DataFrame, keys, change_col: str = "_change") -> DataFrame:
    """Rows that differ between two snapshots of a keyed table: 'I' for keys
    only in ``new``, 'D' for keys only in ``old`` (old values), 'U' for keys
    whose other columns differ (null-safe).  Unchanged keys are omitted.
    Keys must be unique within each snapshot (a duplicate fails the job)."""
    keys = as_list(keys)
    vals = [c for c in new.columns if c not in keys]
    j = pair_by_key(old, new, keys, vals)
    change = (F.when(F.col("__old").isNull(), F.lit(FLAG_INSERT))
               .when(F.col("__new").isNull(), F.lit(FLAG_DELETE))
               .when(~F.equal_null(F.col("__old"), F.col("__new")), F.lit(FLAG_UPDATE)))
    side = F.when(F.col("__new").isNull(), F.col("__old")).otherwise(F.col("__new"))
    return (j.withColumn(change_col, change)
             .where(F.col(change_col).isNotNull())
             .select(*[qcol(c) if c in keys else side[c].alias(c) for c in new.columns],
                     F.col(change_col)))


def apply_snapshot(target: DataFrame, snapshot: DataFrame, keys) -> DataFrame:
    """SCD type 1 from a full snapshot, batch form: afterwards the target
    holds, per key, exactly the snapshot's row and no key the snapshot lacks
    - i.e. the snapshot itself, conformed to the target's column order and
    types.  A key that occurs twice (NULL counts as one) fails the job, as in
    ``streaming.changes.snapshot_to_log``.  No join is needed for the
    table; incremental maintenance that writes only changed keys is
    ``streaming.changes.snapshot_to_log`` (diff appended to the change log),
    and ``snapshot_diff`` gives the I/U/D rows."""
    keys = as_list(keys)
    missing = [k for k in keys if k not in snapshot.columns]
    if missing:
        raise ValueError(f"apply_snapshot: key columns {missing} missing from the snapshot")
    snapshot = unique_by_key(snapshot, keys)
    present = set(snapshot.columns)
    cols = [(qcol(f.name).cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in target.schema.fields]
    return snapshot.select(*cols)


def change_batch(df: DataFrame, flag: str, tiles: int, tile: int, order, ts_col: str | None = None,
                 seconds: int = 10, key_col: str | None = None, start_key: int | None = None,
                 id_col: str | None = None, id_value=None, flag_col: str = "delta_flg",
                 drop=("newline",), n_ranges: int | None = None) -> DataFrame:
    """Change rows made from existing rows: tile ``tile`` of ``tiles`` in
    ``order``.  'D' keeps the row, 'U' also overwrites ``id_col`` with
    ``id_value``; both move ``ts_col`` by ``seconds`` (sub-second part
    truncated).  'I' gives the rows new keys ``start_key + 1 ...`` in order.
    The flag column is appended last."""
    if flag not in ("I", "U", "D"):
        raise ValueError("flag must be I, U or D")
    base = df.drop(*[c for c in as_list(drop) if c in df.columns])
    if flag == "I" and key_col is None:
        raise ValueError("flag I needs key_col")
    # ranks within a tile are consecutive: one ranking gives the tile and the new keys
    total = base.count()
    first, last = rank.tile_bounds(total, tiles, tile)
    part = (rank.global_rank(base, as_list(order), n_ranges=n_ranges, rank_col="__rank", total=total)
            .where(F.col("__rank").between(first, last)))
    if flag in ("U", "D") and ts_col:
        ntz = part.schema[ts_col].dataType.typeName() == "timestamp_ntz"
        part = part.withColumn(ts_col, shift_seconds(qcol(ts_col), seconds, ntz))
    if flag == "U" and id_col:
        part = part.withColumn(id_col, F.lit(id_value).cast(part.schema[id_col].dataType))
    if flag == "I":
        new_key = F.lit((start_key or 0) - first + 1).cast("long") + F.col("__rank")
        part = part.withColumn(key_col, new_key)
    return part.drop("__rank").withColumn(flag_col, F.lit(flag))
