"""Inputs that operators must not lose, and operations that run again."""

import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, LongType, StringType, StructField, StructType

from tablewright.functions import text as tx
from tablewright.operators import cdc, dml, ledger as led, quality, rank, reconcile
from tablewright.plans import fixtures as fx
from tablewright.session import checkpoint_root, scratch_path
from tablewright.sources import files as src
from tablewright.streaming import changes as stream


def rows(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


def test_lines_that_look_like_headers_and_spare_fields(spark):
    lines = spark.createDataFrame([("Catherine^Ay^A",), ("category^Az^A",), ("",), ("short",)], "value string")
    got = src.parse_delimited(lines, "^A", ["a", "b"]).collect()
    assert sorted((r.a, r.b) for r in got if r.b) == [("Catherine", "y"), ("category", "z")] and len(got) == 3
    spare = spark.createDataFrame([("1^Ax^Aextra^A",)], "value string")
    with pytest.raises(Exception, match=src.EXTRA_FIELDS_ERROR):
        src.parse_delimited(spare, "^A", ["a", "b"]).collect()
    assert src.parse_delimited(spare, "^A", ["a", "b"], rescue_col="more").first().more == "extra^A"


def test_rescue_of_values_that_narrow(spark):
    df = spark.sql("""SELECT 1 AS id, 2.7D AS i, timestamp_ntz'2024-01-02 03:04:05' AS d, '2024-01-02 03:04:05' AS s
                      UNION ALL SELECT 2, 3.0D, timestamp_ntz'2024-01-02 00:00:00', '2024-01-02'""")
    want = StructType([StructField("id", IntegerType()), StructField("i", IntegerType()), StructField("d", DateType()), StructField("s", DateType())])
    one, two = src.rescue_unexpected(df, want).orderBy("id").collect()
    assert (one.i, one.d, one.s) == (None, None, None)
    assert all(x in one._rescued_data for x in ('"i":"2.7"', '"d":"2024-01-02 03:04:05"', '"s":"2024-01-02 03:04:05"'))
    assert two.i == 3 and str(two.d) == str(two.s) == "2024-01-02" and two._rescued_data is None


def test_text_that_begins_like_an_expression(spark):
    df = spark.createDataFrame([(1, "a")], "k int, n string")
    assert dml.update_where(df, "k = 1", {"n": "expr:upper(n)"}).first().n == "expr:upper(n)"
    assert dml.update_where(df, "k = 1", {"n": F.upper("n")}).first().n == "A"


def test_log_names_are_reserved_and_runs_kept_apart(spark):
    log = scratch_path(spark, "t-names")
    with pytest.raises(ValueError, match="reserved"):
        stream.write_version(spark.createDataFrame([(1, 1)], "k int, __log_run int"), log, 0, "a")
    stream.write_version(spark.createDataFrame([(1, "x")], "k int, v string"), log, 0, "a")
    stream.write_version(spark.createDataFrame([(2, "y", 5)], "k int, v string, later int"), log, 0, "b")
    assert rows(stream.read_log(spark, log)) == ["(1, 'x', None)", "(2, 'y', 5)"]
    with pytest.raises(FileExistsError):
        stream.write_version(spark.createDataFrame([(3, "z")], "k int, v string"), log, 0, "a", replace=False)


def test_snapshots_with_a_key_twice_fail_alike(spark):
    twice = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(Exception, match=cdc.DUPLICATE_KEY_ERROR):
        cdc.apply_snapshot(twice, twice, "k").collect()
    with pytest.raises(Exception, match=cdc.DUPLICATE_KEY_ERROR):
        stream.snapshot_to_log(spark, scratch_path(spark, "t-twice"), None, twice, "k", 1)
    once = twice.limit(1)
    log = scratch_path(spark, "t-once")
    stream.snapshot_to_log(spark, log, None, once, "k", 1)
    with pytest.raises(FileExistsError):
        stream.snapshot_to_log(spark, log, None, once, "k", 1)


def test_snapshot_log_with_a_column_added_later(spark):
    log = scratch_path(spark, "t-added")
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(1, "a", 7), (3, "c", 8)], "k int, v string, more int")
    stream.snapshot_to_log(spark, log, None, old, "k", 1)
    stream.snapshot_to_log(spark, log, old.withColumn("more", F.lit(None).cast("int")), new, "k", 2)
    assert rows(stream.snapshot_state(spark, log, "k").select("k", "v", "more")) == ["(1, 'a', 7)", "(3, 'c', 8)"]


def test_reconcile_reports_duplicates_and_null_keys(spark):
    a = spark.createDataFrame([(1, "x"), (1, "y"), (None, "p"), (None, "q"), (2, "z"), (3, None)], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, "z"), (4, "w"), (3, None)], "k int, v string")
    got = {r.k: (r.status, r.n_source, r.n_target) for r in reconcile.reconcile(a, b, "k", counts=True).collect()}
    assert got == {1: ("duplicate", 2, 1), None: ("duplicate", 2, 0), 2: ("equal", 1, 1), 3: ("equal", 1, 1), 4: ("extra", 0, 1)}


def test_both_ranking_methods_number_alike_without_a_unique_order(spark):
    df = spark.range(1500).select((F.col("id") % 3).alias("g"), "id", (F.col("id") % 2).alias("h"))
    for keys in ((), ("h",)):
        a, b = (rows(rank.ranked(df, ["g"], keys, n_ranges=9, method=m).select("g", "id", "h", "rank")) for m in ("bounds", "range_write"))
        assert a == b


def test_change_batch_ranks_once(spark, sf_small):
    c = fx.table(spark, sf_small, "customer")
    tracker, sc = spark.sparkContext.statusTracker(), spark.sparkContext
    sc.setJobGroup("t-batch", "")
    out = cdc.change_batch(c, "I", 4, 2, ["c_custkey"], key_col="c_custkey", start_key=1000)
    got = sorted(r.c_custkey for r in out.collect())
    assert got == list(range(1001, 1001 + len(got)))
    assert len(tracker.getJobIdsForGroup("t-batch")) <= 8
    sc.setLocalProperty("spark.jobGroup.id", None)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [row_number") <= 1


def test_scratch_needs_a_shared_folder_off_local_masters():
    class Context(SimpleNamespace):
        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]", "k8s://x"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            checkpoint_root(SimpleNamespace(sparkContext=Context(master=master)))


def test_hot_target_key_is_split_in_a_large_merge(spark):
    keys = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        target = spark.range(0, 60_000, 1, 8).select(F.when(F.col("id") % 2 == 0, -1).otherwise(F.col("id")).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
        path = scratch_path(spark, "t-hot")
        target.write.parquet(path)
        changes = spark.range(1, 4001, 2).select(F.col("id").alias("k"), F.lit("new").alias("v"), F.lit("U").alias("delta_flg"))
        out = cdc.merge_flagged(spark.read.parquet(path), changes, "k", broadcast_rows=0)
        assert out.count() == 60_000
        out.collect()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


SCHEMA = "k int, a string, b int"


def drop_frames(rng, n):
    frames = []
    for _ in range(n):
        data, used = [], set()
        for _ in range(rng.randint(1, 8)):
            k, f = rng.choice([1, 2, 3, 4, None]), rng.choice(["I", "U", "D", None, "X"])
            if f in ("U", "D"):
                if k in used:
                    continue
                used.add(k)
            data.append((k, f"a{rng.randint(0, 99)}", rng.randint(0, 99), f))
        frames.append(data)
    return frames


@pytest.mark.parametrize("seed", range(5))
def test_one_pass_load_equals_merges_one_after_the_other(spark, seed):
    rng = random.Random(seed)
    stage, load_type = scratch_path(spark, "t-fold"), rng.choice([cdc.INCREMENTAL, cdc.INITIAL])
    target = spark.createDataFrame([(k, f"t{i}", i) for i, k in enumerate([1, 1, 2, None])], SCHEMA)
    step, counts = target, []
    for i, data in enumerate(drop_frames(rng, 4)):
        name = f"t.parquet_{i}"
        df = spark.createDataFrame(data, SCHEMA + ", delta_flg string")
        df.write.parquet(f"{stage}/{name}")
        counts.append((name, len(data), f"2024-01-0{i + 1}"))
        step = spark.createDataFrame(cdc.merge_flagged(step, df, "k", load_type=load_type).collect(), SCHEMA)
    arrived = spark.createDataFrame(counts, "file_name string, file_number_of_rows long, file_arrival_timestamp string")
    ledger = led.register_files(led.empty_ledger(spark), arrived)
    final, done = led.apply_pending(spark, ledger, target, stage, scratch_path(spark, "t-fold-out"), "k", load_type=load_type)
    assert rows(final) == rows(step)
    assert all(r.file_loaded for r in done.collect())


def test_one_pass_load_keeps_the_cardinality_error(spark):
    stage = scratch_path(spark, "t-card")
    spark.createDataFrame([(1, "x", 1, "U"), (1, "y", 2, "U")], SCHEMA + ", delta_flg string").write.parquet(f"{stage}/t.p_1")
    ledger = led.register_files(led.empty_ledger(spark), led.drop_counts(spark, stage))
    target = spark.createDataFrame([(1, "t", 0)], SCHEMA)
    with pytest.raises(Exception, match="more than one change row"):
        led.apply_pending(spark, ledger, target, stage, scratch_path(spark, "t-card-out"), "k")
    other, _ = led.apply_pending(spark, ledger, target.where("k = 9"), stage, scratch_path(spark, "t-card-out"), "k")
    assert other.count() == 0


def test_load_again_after_a_failure_between_the_two_writes(spark, monkeypatch):
    stage, out = scratch_path(spark, "t-again"), scratch_path(spark, "t-again-out")
    flagged = SCHEMA + ", delta_flg string"
    spark.createDataFrame([(1, "x", 1, "I"), (2, "y", 2, "I")], flagged).write.parquet(f"{stage}/patient.p_1")
    spark.createDataFrame([(7, "other", 1, "I")], flagged).write.parquet(f"{stage}/patient_ins.p_1")
    empty = spark.createDataFrame([], SCHEMA)

    def load():
        ledger = led.register_files(led.empty_ledger(spark), led.drop_counts(spark, stage), now="2024-01-01 00:00:00")
        return led.apply_pending(spark, ledger, empty, stage, out, "k", table="patient")

    target, _ = load()
    assert rows(target) == ["(1, 'x', 1)", "(2, 'y', 2)"]
    before = led.committed(spark, out)
    spark.createDataFrame([(1, "z", 9, "U")], flagged).write.parquet(f"{stage}/patient.p_2")

    def broken(*_):
        raise RuntimeError("killed after the target was written")
    monkeypatch.setattr(led, "mark_loaded", broken)
    with pytest.raises(RuntimeError, match="killed"):
        load()
    monkeypatch.undo()
    assert led.committed(spark, out) == before
    target, ledger = load()
    assert rows(target) == ["(1, 'z', 9)", "(2, 'y', 2)"]
    assert {r.file_name: r.file_loaded for r in ledger.collect()} == {"patient.p_1": True, "patient.p_2": True, "patient_ins.p_1": False}
    again, _ = load()  # nothing pending
    assert rows(again) == rows(target) and led.committed(spark, out)[0] == 2


def test_stream_gate_sees_the_arriving_files(spark):
    stage = scratch_path(spark, "t-gate")
    spark.createDataFrame([(1, 1)], "k long, s long").write.parquet(f"{stage}/good")
    expected = StructType([StructField("k", LongType()), StructField("s", LongType())])
    log, ckpt = scratch_path(spark, "t-gate-log"), scratch_path(spark, "t-gate-ckpt")

    def run(path, **more):
        stream.stream_apply_drops(spark, f"{path}/*/*.parquet", log, ckpt, expected, "k", "s", **more)
    run(stage)
    spark.createDataFrame([(2, 2, "new")], "k long, s long, extra string").write.parquet(f"{stage}/more")
    with pytest.raises(Exception, match="extra: source_only"):
        run(stage)
    assert stream.current_state(spark, log, "k", "s").count() == 1
    out = scratch_path(spark, "t-gate-out")
    stream.stream_land_drops(spark, f"{stage}/*/*.parquet", out, scratch_path(spark, "t-gate-ckpt2"), expected)
    assert sorted((r.k, r._rescued_data) for r in stream.read_log(spark, out).collect()) == [(1, None), (2, '{"extra":"new"}')]


def test_index_text(spark):
    texts = ["CREATE INDEX i ON public.visit USING btree (patient_id, note text_pattern_ops)", 'create unique index x on "Site" (a)', "no index"]
    df = spark.createDataFrame([(t,) for t in texts], StructType([StructField("t", StringType())]))
    table, cols = tx.index_columns("t")
    assert [tuple(r) for r in df.select(table, cols).collect()] == [("visit", "patient_id,note"), ("site", "a"), ("", "")]


def test_conform_still_gates(spark):
    with pytest.raises(quality.SchemaMismatch):
        quality.conform(spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([], "y int"))
