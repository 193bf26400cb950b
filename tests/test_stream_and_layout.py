"""Streams (restart, late files, compaction) and physical layout."""

import glob
import os

from pyspark.sql import functions as F

from tablewright.operators import cdc, ledger as led
from tablewright.session import local_path, scratch_path
from tablewright.sinks import tables as sink
from tablewright.streaming import changes as stream

KEYS, SEQ, DEL = "user_id", ["ts", "event_id"], "event_type = 'error'"


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_stream_restart_and_late_file(spark, sf_small):
    ev = spark.read.parquet(f"{sf_small}/events.parquet")
    stage = scratch_path(spark, "t-stage")
    log = scratch_path(spark, "t-log")
    ckpt = scratch_path(spark, "t-ckpt")
    ev.where("event_id % 3 = 0").write.parquet(f"{stage}/drop_a")
    ev.where("event_id % 3 = 1").write.parquet(f"{stage}/drop_b")
    glob_path = f"{stage}/drop_*/*.parquet"

    def run():
        s = stream.stream_files(spark, glob_path, ev.schema, max_files=1)
        stream.stream_apply_changes(s, log, ckpt, KEYS, SEQ, DEL)

    run()
    versions = sorted(os.listdir(local_path(log)))
    run()                                  # same checkpoint, nothing new: no new version
    assert sorted(os.listdir(local_path(log))) == versions
    ev.where("event_id % 3 = 2").write.parquet(f"{stage}/drop_c")   # a late drop
    run()
    state = stream.current_state(spark, log, KEYS, SEQ, DEL, schema=ev.schema)
    expected = cdc.apply_changes(ev, KEYS, SEQ, DEL)
    assert _rows(state) == _rows(expected)
    # folding the log into a new base gives the same table
    base_path = stream.compact_log(spark, log, scratch_path(spark, "t-base"), KEYS, SEQ, DEL)
    base = spark.read.parquet(base_path)
    assert _rows(cdc.current_rows(base, DEL)) == _rows(expected)


def test_stream_append_lands_everything(spark, sf_small):
    ev = spark.read.parquet(f"{sf_small}/events.parquet")
    stage = scratch_path(spark, "t-stage2")
    ev.write.parquet(f"{stage}/drop_0")
    out = scratch_path(spark, "t-out")
    s = stream.stream_files(spark, f"{stage}/drop_*/*.parquet", ev.schema, with_source=True)
    stream.stream_append(s, out, scratch_path(spark, "t-ckpt2"))
    landed = spark.read.parquet(out)
    assert landed.count() == ev.count()
    assert landed.where(F.col(stream.SOURCE_FILE_COL).contains("drop_0")).count() == ev.count()


def test_cluster_write_ranges_do_not_overlap(spark, sf_small):
    li = spark.read.parquet(f"{sf_small}/lineitem.parquet")
    path = sink.cluster_write(li, ["l_orderkey"], scratch_path(spark, "t-clustered"), files=4)
    stats = sorted((r.min_v, r.max_v) for r in sink.file_stats(spark, path, "l_orderkey").collect())
    assert len(stats) >= 2
    for (a_min, a_max), (b_min, b_max) in zip(stats, stats[1:]):
        assert a_max <= b_min


def test_compact_reduces_files(spark, sf_small):
    small = scratch_path(spark, "t-small")
    spark.read.parquet(f"{sf_small}/orders.parquet").repartition(16).write.parquet(small)
    out = sink.compact(spark, small, scratch_path(spark, "t-compacted"), 2)
    files = glob.glob(os.path.join(local_path(out), "*.parquet"))
    assert 1 <= len(files) <= 2
    assert spark.read.parquet(out).count() == spark.read.parquet(small).count()


def test_create_empty_like_casts_and_drops(spark):
    tpl = scratch_path(spark, "t-template")
    spark.createDataFrame([(1.5, "a", "I")], "x double, s string, newline string").write.parquet(tpl)
    target = scratch_path(spark, "t-empty")
    schema = sink.create_empty_like(spark, tpl, target, cast_map={"double": "bigint"})
    back = spark.read.parquet(target)
    assert back.count() == 0
    assert [(f.name, f.dataType.simpleString()) for f in back.schema.fields] == [("x", "bigint"), ("s", "string")]
    assert schema == back.schema


def test_ledger_register_replaces_and_pending_order(spark):
    counts = spark.createDataFrame([("b", 2, "2024-01-02"), ("a", 1, "2024-01-01")],
                                   "file_name string, file_number_of_rows long, file_arrival_timestamp string")
    ledger = led.register_files(led.empty_ledger(spark), counts)
    again = spark.createDataFrame([("a", 5, "2024-01-03")],
                                  "file_name string, file_number_of_rows long, file_arrival_timestamp string")
    ledger = led.register_files(ledger, again)
    assert sorted((r.file_name, r.file_number_of_rows) for r in ledger.collect()) == [("a", 5), ("b", 2)]
    assert [r.file_name for r in led.pending_files(ledger).collect()] == ["b", "a"]
    marked = led.mark_loaded(ledger, "b", now="2024-02-01 00:00:00")
    assert [r.file_name for r in led.pending_files(marked).collect()] == ["a"]


def test_stream_gates(spark, sf_small):
    import pytest
    from tablewright.operators import quality
    ev = spark.read.parquet(f"{sf_small}/events.parquet")
    stage = scratch_path(spark, "t-stage3")
    ev.write.parquet(f"{stage}/drop_0")
    s = stream.stream_files(spark, f"{stage}/drop_*/*.parquet", ev.schema)
    moved = ev.select(*reversed(ev.columns)).schema
    with pytest.raises(quality.SchemaMismatch):
        stream.stream_apply_changes(s, scratch_path(spark, "t-log3"), scratch_path(spark, "t-ck3"),
                                    KEYS, SEQ, DEL, target_schema=moved)
    with pytest.raises(Exception, match="expectation failed: small_value"):
        stream.stream_apply_changes(s, scratch_path(spark, "t-log4"), scratch_path(spark, "t-ck4"),
                                    KEYS, SEQ, DEL, expectations={"small_value": "value < 0"})
    log = scratch_path(spark, "t-log5")
    stream.stream_apply_changes(s, log, scratch_path(spark, "t-ck5"), KEYS, SEQ, DEL,
                                target_schema=ev.schema, expectations={"has_user": "user_id IS NOT NULL"})
    assert stream.current_state(spark, log, KEYS, SEQ, DEL).count() == cdc.apply_changes(ev, KEYS, SEQ, DEL).count()


def test_schema_drift_report(spark):
    from tablewright.operators import quality
    a = scratch_path(spark, "t-drift-a")
    b = scratch_path(spark, "t-drift-b")
    spark.createDataFrame([(1, "x")], "k int, s string").write.parquet(a)
    spark.createDataFrame([("x", 1, 2.0)], "s string, k int, extra double").write.parquet(b)
    target = spark.createDataFrame([], "k int, s string").schema
    rep = {(r.drop == b, r.column): r.status for r in quality.schema_drift(spark, [a, b], target).collect()}
    assert rep == {(False, "k"): "ok", (False, "s"): "ok", (True, "k"): "moved", (True, "s"): "moved",
                   (True, "extra"): "source_only"}


def test_ledger_now_is_utc_wall_clock(spark):
    import datetime as dt
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        counts = spark.createDataFrame([("a", 1)], "file_name string, file_number_of_rows long")
        got = led.register_files(led.empty_ledger(spark), counts).first().file_arrival_timestamp
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    utc_now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    assert abs((got - utc_now).total_seconds()) < 120


def test_stage_drop_counts_and_flags(spark):
    raw = spark.createDataFrame([(1, 2.9, "I"), (2, -1.5, "U"), (3, 7.0, "I")], "k int, x double, newline string")
    stage = scratch_path(spark, "t-stage-drop")
    ledger, n, flags = led.stage_drop(raw, stage, "t.parquet_U_1", led.empty_ledger(spark),
                                      cast_map={"double": "bigint"})
    assert (n, flags) == (3, "I, U")
    back = spark.read.parquet(f"{stage}/t.parquet_U_1")
    assert back.columns == ["k", "x", "delta_flg"] and sorted(r.x for r in back.collect()) == [-1, 2, 7]
    assert [(r.file_name, r.file_number_of_rows, r.file_loaded) for r in ledger.collect()] == [("t.parquet_U_1", 3, False)]


def test_scan_table_reads_a_named_table(spark, sf_small):
    from tablewright.sources import files as src
    spark.read.parquet(f"{sf_small}/nation.parquet").createOrReplaceTempView("nation_t")
    assert src.scan_table(spark, "nation_t").count() == 25


def test_current_state_of_an_empty_log_and_since_version(spark, sf_small):
    ev = spark.read.parquet(f"{sf_small}/events.parquet")
    empty = stream.current_state(spark, scratch_path(spark, "t-nolog"), KEYS, SEQ, DEL, schema=ev.schema)
    assert empty.count() == 0 and empty.columns == ev.columns
    log = scratch_path(spark, "t-log6")
    stream.write_version(ev.where("event_id % 2 = 0"), log, 0, "t")
    stream.write_version(ev.where("event_id % 2 = 1"), log, 1, "t")
    base = spark.read.parquet(stream.compact_log(spark, log, scratch_path(spark, "t-base6"), KEYS, SEQ, DEL))
    state = stream.current_state(spark, log, KEYS, SEQ, DEL, base=base, since_version=2)
    assert _rows(state) == _rows(cdc.apply_changes(ev, KEYS, SEQ, DEL))


def test_scale_conf():
    from tablewright.session import scale_conf
    assert scale_conf(10)["spark.sql.shuffle.partitions"] == "200"
    assert scale_conf(100 * 1024 ** 4)["spark.sql.shuffle.partitions"] == "200000"
    assert scale_conf(1024 ** 4)["spark.sql.shuffle.partitions"] == "2048"


def test_apply_pending_expectation_stops_the_load(spark):
    import pytest
    stage = scratch_path(spark, "t-pend-stage")
    out = scratch_path(spark, "t-pend-out")
    spark.createDataFrame([(1, "a", "I"), (2, None, "I")], "k int, s string, delta_flg string") \
        .write.parquet(f"{stage}/t.parquet_I_1")
    counts = led.drop_counts(spark, f"{stage}/*")
    ledger = led.register_files(led.empty_ledger(spark), counts)
    target = spark.createDataFrame([], "k int, s string")
    with pytest.raises(Exception, match="expectation failed: s_present"):
        led.apply_pending(spark, ledger, target, stage, out, "k", expectations={"s_present": "s IS NOT NULL"})
    final, new_ledger = led.apply_pending(spark, ledger, target, stage, out, "k",
                                          expectations={"k_positive": "k > 0"})
    assert sorted(r.k for r in final.collect()) == [1, 2]
    assert [r.file_loaded for r in new_ledger.collect()] == [True]


def test_stream_batch_replayed_after_failure_gives_the_same_state(spark, sf_small):
    """A batch fails after writing its log version; the restart replays it
    (overwriting its own version), then a late drop arrives."""
    import pytest
    ev = spark.read.parquet(f"{sf_small}/events.parquet")
    stage = scratch_path(spark, "t-fail-stage")
    log = scratch_path(spark, "t-fail-log")
    ckpt = scratch_path(spark, "t-fail-ckpt")
    for i in range(3):
        ev.where(f"event_id % 4 = {i}").write.parquet(f"{stage}/drop_{i}")
    seen = []

    def fail_once(batch_id):
        seen.append(batch_id)
        if batch_id == 1 and seen.count(1) == 1:
            raise RuntimeError("injected failure after the write")

    def run():
        s = stream.stream_files(spark, f"{stage}/drop_*/*.parquet", ev.schema, max_files=1)
        stream.stream_apply_changes(s, log, ckpt, KEYS, SEQ, DEL, after_batch=fail_once)

    with pytest.raises(Exception):
        run()
    run()
    ev.where("event_id % 4 = 3").write.parquet(f"{stage}/drop_3")
    run()
    assert seen == [0, 1, 1, 2, 3]
    state = stream.current_state(spark, log, KEYS, SEQ, DEL, schema=ev.schema)
    assert _rows(state) == _rows(cdc.apply_changes(ev, KEYS, SEQ, DEL))


def test_stream_rescues_unexpected_columns(spark, sf_small):
    from pyspark.sql.types import IntegerType, LongType, StructField, StructType
    ev = spark.read.parquet(f"{sf_small}/events.parquet")
    stage = scratch_path(spark, "t-rescue-stage")
    ev.write.parquet(f"{stage}/drop_0")
    expected = StructType([StructField("event_id", LongType()), StructField("event_type", IntegerType())])
    s = stream.stream_files(spark, f"{stage}/drop_*/*.parquet", ev.schema, expected=expected)
    out = scratch_path(spark, "t-rescue-out")
    stream.stream_append(s, out, scratch_path(spark, "t-rescue-ckpt"))
    landed = spark.read.parquet(out)
    assert landed.columns == ["event_id", "event_type", "_rescued_data"]
    assert landed.count() == ev.count() and landed.where("event_type IS NOT NULL").count() == 0
    r = landed.orderBy("event_id").first()
    assert '"ts":' in r._rescued_data and '"event_type":' in r._rescued_data and '"props":' in r._rescued_data


def test_current_state_with_base_touches_only_logged_keys(spark, sf_small):
    ev = spark.read.parquet(f"{sf_small}/events.parquet")
    old_log = scratch_path(spark, "t-base-log")
    stream.write_version(ev.where("event_id % 3 <> 0"), old_log, 0, "t")
    base = spark.read.parquet(stream.compact_log(spark, old_log, scratch_path(spark, "t-base7"), KEYS, SEQ, DEL))
    log = scratch_path(spark, "t-new-log")
    stream.write_version(ev.where("event_id % 3 = 0 AND user_id % 4 = 0"), log, 1, "t")
    expected = cdc.apply_changes(ev.where("event_id % 3 <> 0 OR user_id % 4 = 0"), KEYS, SEQ, DEL)
    fast = stream.current_state(spark, log, KEYS, SEQ, DEL, base=base, since_version=1)
    full = stream.current_state(spark, log, KEYS, SEQ, DEL, base=base, since_version=1, broadcast_rows=0)
    assert _rows(fast) == _rows(expected) == _rows(full)
    plan = fast._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "BroadcastHashJoin" in plan


def test_checkpoint_root_falls_back_when_the_session_names_none(tmp_path):
    """In a session without spark.checkpoint.dir (no spark-defaults read), a
    local folder is created and registered as the checkpoint dir."""
    import subprocess
    import sys
    script = tmp_path / "probe.py"
    script.write_text(
        "import sys; sys.path.insert(0, %r)\n"
        "from pyspark.sql import SparkSession\n"
        "from tablewright.session import checkpoint_root, scratch_path\n"
        "s = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "root = checkpoint_root(s)\n"
        "p = scratch_path(s, 'fallback'); s.range(3).write.parquet(p)\n"
        "print('ROOT', root, s.read.parquet(p).count(), s.sparkContext.getCheckpointDir() == root)\n"
        % os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    conf_dir = tmp_path / "conf"
    conf_dir.mkdir()
    env = dict(os.environ, SPARK_CONF_DIR=str(conf_dir))
    out = subprocess.run([sys.executable, str(script)], env=env, capture_output=True, text=True, timeout=300)
    line = [x for x in out.stdout.splitlines() if x.startswith("ROOT")]
    assert line, out.stderr[-2000:]
    _, root, n, same = line[0].split()
    assert "tablewright-" in root and n == "3" and same == "True"
