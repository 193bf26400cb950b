"""Edge semantics of the change operators on hand-made rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tablewright.operators import cdc, reconcile

T_SCHEMA = "id bigint, name string, v int"
C_SCHEMA = "id bigint, name string, v int, delta_flg string"


def rows(df, *cols):
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


@pytest.fixture
def target(spark):
    return spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, "c", 3), (None, "n", 0)], T_SCHEMA)


@pytest.mark.parametrize("broadcast_rows", [None, 0, 1000])
def test_merge_incremental_clauses(spark, target, broadcast_rows):
    changes = spark.createDataFrame([
        (1, "a2", 10, "U"),      # matched U -> update
        (2, "b2", 20, "D"),      # matched D -> delete
        (3, "c2", 30, "I"),      # matched I -> keep target
        (4, "d", 40, "I"),       # unmatched I -> insert
        (5, "e", 50, "U"),       # unmatched U -> ignored
        (6, "f", 60, "D"),       # unmatched D -> ignored
        (7, "g", 70, None),      # unmatched NULL flag -> ignored
        (None, "z", 99, "I"),    # NULL key never matches -> insert
        (8, "h1", 1, "I"),       # duplicated unmatched inserts all go in
        (8, "h2", 2, "I"),
    ], C_SCHEMA)
    out = cdc.merge_flagged(target, changes, "id", load_type="Incremental", broadcast_rows=broadcast_rows)
    assert out.columns == target.columns
    got = rows(out.fillna(-1, ["id"]))
    assert got == sorted([(1, "a2", 10), (3, "c", 3), (-1, "n", 0), (4, "d", 40), (-1, "z", 99),
                          (8, "h1", 1), (8, "h2", 2)])


@pytest.mark.parametrize("broadcast_rows", [0, 1000])
def test_merge_initial_inserts_every_unmatched_row(spark, target, broadcast_rows):
    changes = spark.createDataFrame([
        (2, "b2", 20, "D"), (5, "e", 50, "U"), (6, "f", 60, "D"), (7, "g", 70, None), (3, "c2", 0, None),
    ], C_SCHEMA)
    out = cdc.merge_flagged(target, changes, "id", load_type="Initial", broadcast_rows=broadcast_rows)
    assert rows(out.fillna(-1, ["id"])) == sorted([
        (1, "a", 1), (3, "c", 3), (-1, "n", 0), (5, "e", 50), (6, "f", 60), (7, "g", 70)])


@pytest.mark.parametrize("broadcast_rows", [0, 1000])
def test_merge_two_hits_on_one_target_row_fail(spark, target, broadcast_rows):
    changes = spark.createDataFrame([(1, "x", 1, "U"), (1, "y", 2, "D")], C_SCHEMA)
    with pytest.raises(Exception) as e:
        cdc.merge_flagged(target, changes, "id", broadcast_rows=broadcast_rows).collect()
    assert "more than one change row" in str(e.value)


def test_merge_one_hit_plus_ignored_rows_is_fine(spark, target):
    changes = spark.createDataFrame([(1, "x", 1, "U"), (1, "y", 2, "I"), (1, "z", 3, None)], C_SCHEMA)
    out = cdc.merge_flagged(target, changes, "id", broadcast_rows=0)
    assert ("x", 1) in [(r.name, r.v) for r in out.collect()]
    assert out.count() == 4


def test_merge_empty_changes(spark, target):
    empty = spark.createDataFrame([], C_SCHEMA)
    for b in (0, 10):
        assert rows(cdc.merge_flagged(target, empty, "id", broadcast_rows=b).fillna(-1, ["id"])) == \
            rows(target.fillna(-1, ["id"]))


E_SCHEMA = "k int, seq int, op string, val string"


def test_apply_changes_newest_wins_and_deletes(spark):
    ch = spark.createDataFrame([
        (1, 1, "I", "a"), (1, 3, "U", "c"), (1, 2, "U", "b"),   # out of order: seq 3 wins
        (2, 1, "I", "x"), (2, 2, "D", None),                    # deleted
        (3, 5, None, "n"),                                      # NULL flag is an upsert
    ], E_SCHEMA)
    out = cdc.apply_changes(ch, "k", "seq", "op = 'D'", except_columns=["op"])
    assert out.columns == ["k", "seq", "val"]
    assert rows(out) == [(1, 3, "c"), (3, 5, "n")]


def test_late_upsert_after_delete_does_not_revive(spark):
    first = spark.createDataFrame([(1, 1, "I", "a"), (1, 5, "D", None)], E_SCHEMA)
    late = spark.createDataFrame([(1, 3, "U", "late")], E_SCHEMA)
    out = cdc.apply_changes(late, "k", "seq", "op = 'D'", log=first)
    assert out.count() == 0


def test_equal_sequence_delete_wins(spark):
    ch = spark.createDataFrame([(1, 2, "U", "u"), (1, 2, "D", None)], E_SCHEMA)
    assert cdc.apply_changes(ch, "k", "seq", "op = 'D'").count() == 0


def test_equal_sequence_upserts_pick_is_deterministic(spark):
    data = [(1, 2, "U", "p"), (1, 2, "U", "q"), (1, 2, "U", "r")]
    picks = set()
    for seed in range(3):
        random.Random(seed).shuffle(data)
        ch = spark.createDataFrame(data, E_SCHEMA).repartition(3)
        picks.add(cdc.apply_changes(ch, "k", "seq", "op = 'D'").first().val)
    assert len(picks) == 1


def test_apply_changes_empty(spark):
    assert cdc.apply_changes(spark.createDataFrame([], E_SCHEMA), "k", "seq", "op = 'D'").count() == 0


def test_batches_in_any_order_give_one_state(spark):
    """Random permutation and regrouping of a change log into batches, each
    folded into a growing log, ends in the state of the whole log."""
    rng = random.Random(7)
    log_rows = [(rng.randrange(6), s, rng.choice(["I", "U", "D", None]), f"v{s}") for s in range(40)]
    whole = rows(cdc.apply_changes(spark.createDataFrame(log_rows, E_SCHEMA), "k", "seq", "op = 'D'"))
    for trial in range(3):
        shuffled = log_rows[:]
        rng.shuffle(shuffled)
        cuts = sorted(rng.sample(range(1, len(shuffled)), 3))
        parts = [shuffled[a:b] for a, b in zip([0] + cuts, cuts + [len(shuffled)])]
        log = None
        for p in parts:
            batch = cdc.fold_changes(spark.createDataFrame(p, E_SCHEMA), "k", "seq", "op = 'D'")
            log = batch if log is None else log.unionByName(batch)
        state = cdc.current_rows(cdc.fold_changes(log, "k", "seq", "op = 'D'"), "op = 'D'")
        assert rows(state) == whole, trial


S_SCHEMA = "sk bigint, vip int, ts timestamp"


def test_snapshot_scenarios(spark):
    """Update, delete, delete + re-insert with a new timestamp, and insert,
    replayed through apply_snapshot and checked with reconcile."""
    t0, t1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    bronze0 = spark.createDataFrame([(411, 0, t0), (52, 0, t0),
                                     (-630, 0, t0), (-744, 1, t0)],
                                    S_SCHEMA)
    bronze1 = spark.createDataFrame([(411, 1, t1),       # update
                                     (-630, 0, t1),      # delete + re-insert
                                     (-744, 1, t0),
                                     (88000000001, 1, t1)],  # insert
                                    S_SCHEMA)
    diff = cdc.snapshot_diff(bronze0, bronze1, "sk")
    assert sorted((r.sk, r._change) for r in diff.collect()) == sorted([
        (411, "U"), (52, "D"), (-630, "U"),
        (88000000001, "I")])
    silver = cdc.apply_snapshot(bronze0, bronze1, "sk")
    rec = reconcile.reconcile_counts(bronze1, silver, "sk")
    assert {r.status: r.n for r in rec.collect()} == {"equal": 4}
    assert silver.where("sk = 411").first().vip == 1


def test_change_batch_flags(spark):
    base = spark.range(0, 23).select(F.col("id").alias("k"), F.col("id").cast("string").alias("name"),
                                     F.lit(dt.datetime(2024, 1, 1, 0, 0, 0, 700000)).cast("timestamp_ntz")
                                     .alias("ts"), F.lit("x").alias("newline"))
    d = cdc.change_batch(base, "D", 5, 5, ["k"], ts_col="ts")
    assert d.columns == ["k", "name", "ts", "delta_flg"]
    assert sorted(r.k for r in d.collect()) == [19, 20, 21, 22]     # 23 rows: tiles 5,5,5,4,4
    assert d.first().ts == dt.datetime(2024, 1, 1, 0, 0, 10)
    u = cdc.change_batch(base, "U", 5, 1, ["k"], ts_col="ts", id_col="name", id_value="loader")
    assert {r.name for r in u.collect()} == {"loader"} and u.count() == 5
    i = cdc.change_batch(base, "I", 5, 2, ["k"], key_col="k", start_key=100)
    assert sorted(r.k for r in i.collect()) == [101, 102, 103, 104, 105]


def test_snapshot_duplicate_key_fails(spark):
    old = spark.createDataFrame([(1, "a", 1), (1, "b", 2)], T_SCHEMA)
    new = spark.createDataFrame([(1, "a", 1)], T_SCHEMA)
    with pytest.raises(Exception, match="more than once"):
        cdc.snapshot_diff(old, new, "id").collect()


def test_fits_broadcast_counts_bytes(spark):
    from tablewright.util import fits_broadcast
    df = spark.createDataFrame([(i, "x" * 1000) for i in range(50)], "k int, s string")
    assert fits_broadcast(df, 100, 10 ** 6)
    assert not fits_broadcast(df, 10, 10 ** 6)          # too many rows
    assert not fits_broadcast(df, 100, 20_000)          # too many bytes
    assert not fits_broadcast(df, 0)


def test_flag_rank_breaks_equal_sequence(spark):
    ch = spark.createDataFrame([(1, 5, "I", "i"), (1, 5, "U", "u"), (2, 5, "U", "u"), (2, 5, "D", None)],
                               "k int, seq int, delta_flg string, val string")
    out = cdc.apply_changes(ch, "k", "seq", "delta_flg = 'D'", tiebreak=cdc.flag_rank())
    assert [(r.k, r.val) for r in out.collect()] == [(1, "u")]


def test_reconcile_rows_unkeyed(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (3, "z")], "k int, v string")
    got = sorted((r.k, r.side) for r in reconcile.reconcile_rows(a, b).collect())
    assert got == [(1, "source_only"), (2, "source_only"), (3, "target_only")]


def test_snapshot_scenarios_through_the_log(spark):
    from tablewright.session import scratch_path
    from tablewright.streaming import changes as stream
    t0, t1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    b0 = spark.createDataFrame([(1, 0, t0), (2, 0, t0), (3, 0, t0), (4, 1, t0)], S_SCHEMA)
    b1 = spark.createDataFrame([(1, 1, t1), (3, 0, t1), (4, 1, t0), (5, 1, t1)], S_SCHEMA)
    log = scratch_path(spark, "t-snap-log")
    stream.snapshot_to_log(spark, log, None, b0, "sk", 1)
    stream.snapshot_to_log(spark, log, b0, b1, "sk", 2)
    v2 = spark.read.parquet(f"{log}/__log_version=2/__log_run=snapshot")
    assert sorted((r.sk, r[stream.SNAPSHOT_OP]) for r in v2.collect()) == [(1, "U"), (2, "D"), (3, "U"), (5, "I")]
    state = stream.snapshot_state(spark, log, "sk")
    assert state.columns == b1.columns
    assert sorted(tuple(r) for r in state.collect()) == sorted(tuple(r) for r in b1.collect())


@pytest.mark.parametrize("broadcast_rows", [0, 1000])
def test_merge_composite_key_and_column_mismatch(spark, broadcast_rows):
    target = spark.createDataFrame([(1, 1, "a", "keep"), (1, 2, "b", "keep"), (2, 1, "c", "keep")],
                                   "k1 int, k2 int, v string, extra_t string")
    changes = spark.createDataFrame([(1, 2, "B", "x", "U"), (2, 1, None, "x", "D"), (3, 3, "new", "x", "I"),
                                     (1, None, "nullkey", "x", "I")],
                                    "k1 int, k2 int, v string, extra_c string, delta_flg string")
    with pytest.raises(ValueError, match="extra_c"):  # a change column must not vanish
        cdc.merge_flagged(target, changes, ["k1", "k2"], broadcast_rows=broadcast_rows)
    out = cdc.merge_flagged(target, changes.drop("extra_c"), ["k1", "k2"], broadcast_rows=broadcast_rows)
    assert out.columns == target.columns
    got = sorted((r.k1, r.k2 if r.k2 is not None else -1, r.v, r.extra_t) for r in out.collect())
    assert got == [(1, -1, "nullkey", None), (1, 1, "a", "keep"), (1, 2, "B", "keep"), (3, 3, "new", None)]


def test_apply_changes_into_a_folded_base(spark):
    base_rows = spark.createDataFrame([(1, 1, "I", "a"), (2, 1, "I", "b"), (3, 4, "D", None), (4, 1, "I", "d")],
                                      E_SCHEMA)
    base = cdc.fold_changes(base_rows, "k", "seq", "op = 'D'")
    ch = spark.createDataFrame([(1, 2, "U", "a2"), (2, 3, "D", None), (3, 2, "U", "late"), (5, 1, "I", "e")], E_SCHEMA)
    fast = cdc.apply_changes(ch, "k", "seq", "op = 'D'", base=base)
    full = cdc.apply_changes(base_rows.unionByName(ch), "k", "seq", "op = 'D'")
    assert rows(fast) == rows(full) == [(1, 2, "U", "a2"), (4, 1, "I", "d"), (5, 1, "I", "e")]


def test_snapshot_log_compaction(spark):
    from tablewright.session import scratch_path
    from tablewright.streaming import changes as stream
    t0 = dt.datetime(2024, 1, 1)
    s1 = spark.createDataFrame([(1, 0, t0), (2, 0, t0), (3, 0, t0)], S_SCHEMA)
    s2 = spark.createDataFrame([(1, 1, t0), (3, 0, t0)], S_SCHEMA)
    s3 = spark.createDataFrame([(1, 1, t0), (2, 5, t0), (4, 4, t0)], S_SCHEMA)
    log = scratch_path(spark, "t-snap-compact")
    stream.snapshot_to_log(spark, log, None, s1, "sk", 1)
    stream.snapshot_to_log(spark, log, s1, s2, "sk", 2)
    base = spark.read.parquet(stream.compact_snapshot_log(spark, log, scratch_path(spark, "t-snap-base"), "sk"))
    stream.snapshot_to_log(spark, log, s2, s3, "sk", 3)
    state = stream.snapshot_state(spark, log, "sk", base=base, since_version=3)
    assert sorted(tuple(r) for r in state.collect()) == sorted(tuple(r) for r in s3.collect())
