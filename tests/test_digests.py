"""Comparison by digests (reconcile, snapshots) and references by bitmaps."""

import random

import pytest
from pyspark.sql import functions as F

from tablewright.operators import digests, quality, reconcile
from tablewright.session import path_exists, scratch_path
from tablewright.streaming import changes as stream

SCHEMA = "k long, a int, b int, c string"


def rows(df):
    return sorted(map(repr, df.collect()))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def both_ways(s, t, **how):
    return rows(reconcile.reconcile_by_digests(s, t, "k", counts=True, **how)), rows(reconcile.reconcile(s, t, "k", counts=True))


def test_same_rows_as_reconcile_on_random_tables(spark):
    rng = random.Random(5)
    base = [(i, rng.choice([None, 0, 1]), rng.choice([None, 0, 1]), rng.choice([None, "", "x"])) for i in range(400)]
    for faults in (0, 1, 5, 60):
        other = list(base)
        for _ in range(faults):
            i = rng.randrange(len(other))
            k, a, b, c = other[i]
            other[i:i + 1] = rng.choice([[], [(k, b, a, c)], [(k, a, b, c)] * 2, [(k + 1000, a, b, c)], [(None, a, b, c)], [(k, a, b, "y")]])
        s, t = spark.createDataFrame(base, SCHEMA), spark.createDataFrame(other, SCHEMA)
        for how in ({}, {"level_bits": 4, "few_rows": 5}, {"level_bits": 5, "levels": 1}, {"level_bits": 6, "broadcast_rows": 2}):
            got, want = both_ways(s, t, **how)
            assert got == want, (faults, how)


def test_values_that_change_places_or_types(spark):
    s = spark.createDataFrame([(1, None, 5, "x"), (2, 7, None, None), (3, 1, 1, "z")], SCHEMA)
    t = spark.createDataFrame([(1, 5, None, "x"), (2, 7, None, None), (3, 1, 1, "z")], "k int, a long, b int, c string")
    got, want = both_ways(s, t)
    assert got == want and sum("different" in r for r in got) == 1


def test_repeated_keys_alike_on_both_sides_and_rows_that_cancel(spark):
    twice = spark.createDataFrame([(1, 1, 1, "x")] * 2 + [(i, 0, 0, "y") for i in range(10, 40)], SCHEMA)
    got, want = both_ways(twice, twice)
    assert got == want and sum("duplicate" in r for r in got) == 1
    other = spark.createDataFrame([(2, 1, 1, "x")] * 2 + [(i, 0, 0, "y") for i in range(10, 40)], SCHEMA)
    assert len(set(map(tuple, both_ways(twice, other)))) == 1


def test_empty_sides(spark):
    some, none = spark.createDataFrame([(1, 1, 1, "x"), (None, 2, 2, "y")], SCHEMA), spark.createDataFrame([], SCHEMA)
    for s, t in ((some, none), (none, some), (none, none), (some, some)):
        got, want = both_ways(s, t)
        assert got == want


def test_equal_tables_are_not_shuffled(spark):
    path = scratch_path(spark, "t-equal")
    spark.range(5_000).select(F.col("id").alias("k"), (F.col("id") * 3).alias("v")).write.parquet(path)
    t = spark.read.parquet(path)
    same = reconcile.reconcile_by_digests(t, t, "k", unique_keys=True)
    assert "Exchange" not in plan(same) and "Join" not in plan(same)
    assert same.groupBy("status").count().collect() == [("equal", 5_000)]


def test_only_rows_of_unlike_buckets_are_shuffled(spark):
    t = spark.range(20_000).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    s = t.withColumn("v", F.when(F.col("k") == 77, 2).otherwise(1))
    found = reconcile.reconcile_by_digests(s, t, "k", unique_keys=True, level_bits=6, few_rows=10)
    assert found.where("status <> 'equal'").collect() == [(77, "different")] and found.count() == 20_000
    seen = []
    plain = reconcile.reconcile

    def counted(a, b, *more):
        seen.append(a.count() + b.count())
        return plain(a, b, *more)
    reconcile.reconcile = counted
    try:
        reconcile.reconcile_by_digests(s, t, "k", unique_keys=True, level_bits=6, few_rows=10)
    finally:
        reconcile.reconcile = plain
    assert seen and seen[0] <= 40  # of 40,000: the second level cut the first one's bucket


def test_digests_ignore_order_and_columns_that_are_null(spark):
    df = spark.createDataFrame([(1, 2, None, "x")], SCHEMA).withColumn("later", F.lit(None).cast("date"))
    one = df.select(*digests.row_digest(["a", "b", "c"])).first()
    assert tuple(one) == tuple(df.select(*digests.row_digest(["later", "c", "a", "b"])).first())
    assert tuple(one) != tuple(df.withColumn("b", F.lit(2)).withColumn("a", F.lit(None).cast("int")).select(*digests.row_digest(["a", "b", "c"])).first())


def snapshots(spark):
    first = [(i, f"v{i}") for i in range(30)] + [(None, "none")]
    second = [(i, f"v{i}" if i % 5 else "changed") for i in range(4, 33)] + [(None, "none")]
    third = [(i, None if i == 9 else f"v{i}") for i in range(2, 20)]
    return [spark.createDataFrame(r, "k int, v string") for r in (first, second, third)]


def test_three_snapshots_never_fold_the_log(spark, monkeypatch):
    for bound in (2_000_000, 0):
        log, side = scratch_path(spark, "t-dlog"), scratch_path(spark, "t-side")
        with monkeypatch.context() as m:
            m.setattr(stream, "read_log", lambda *a, **k: pytest.fail("the log was folded"))
            for v, s in enumerate(snapshots(spark), 1):
                stream.snapshot_to_log_by_digests(spark, log, side, s, "k", v, broadcast_rows=bound)
        assert rows(stream.snapshot_state(spark, log, "k")) == rows(snapshots(spark)[-1])
        plain = scratch_path(spark, "t-plain")
        previous = None
        for v, s in enumerate(snapshots(spark), 1):
            stream.snapshot_to_log(spark, plain, previous, s, "k", v)
            previous = s
        for v in (1, 2, 3):
            def flags(path):
                return rows(spark.read.parquet(stream.version_path(path, v, "snapshot")).select("k", stream.SNAPSHOT_OP))
            assert flags(log) == flags(plain)
    assert spark.read.parquet(f"{side}/version=2").columns == ["k", digests.D0, digests.D1]


def test_snapshot_digests_restart_order_duplicates_and_new_columns(spark):
    log, side = scratch_path(spark, "t-dlog"), scratch_path(spark, "t-side")
    a, b, c = snapshots(spark)
    stream.snapshot_to_log(spark, log, None, a, "k", 1)  # begun without digests
    twice = b.unionByName(b.where("k = 7"))
    with pytest.raises(Exception, match="more than once"):
        stream.snapshot_to_log_by_digests(spark, log, side, twice, "k", 2)
    assert path_exists(spark, f"{side}/version=2/_SUCCESS")  # left by the failed job, and not used
    stream.snapshot_to_log_by_digests(spark, log, side, b, "k", 3)
    assert rows(stream.snapshot_state(spark, log, "k")) == rows(b)
    with pytest.raises(FileExistsError):
        stream.snapshot_to_log_by_digests(spark, log, side, a, "k", 3)
    wider = b.withColumn("more", F.when(F.col("k") == 6, 1))
    stream.snapshot_to_log_by_digests(spark, log, side, wider, "k", 4)
    assert spark.read.parquet(stream.version_path(log, 4, "snapshot")).count() == 1  # NULL in a new column is no change
    assert rows(stream.snapshot_state(spark, log, "k").select("k", "v", "more")) == rows(wider)
    with pytest.raises(ValueError):
        stream.snapshot_to_log_by_digests(spark, log, side, b.withColumn("__d0", F.lit(1)), "k", 5)
    empty = b.limit(0)
    stream.snapshot_to_log_by_digests(spark, log, side, empty, "k", 5)
    assert stream.snapshot_state(spark, log, "k").count() == 0


def test_references_by_bitmap(spark):
    path = scratch_path(spark, "t-child")
    spark.range(3_000).select(F.when(F.col("id") % 10 > 0, F.col("id") - 500).alias("k"), F.col("id").alias("v")).write.parquet(path)
    child = spark.read.parquet(path)
    parents = [spark.createDataFrame([(i,) for i in ids], "p int") for ids in
               ([], [None], [None, *range(-400, 2_000, 3)], [5] * 50 + [70_000, -70_000, -32_768, 32_767, 0], range(-500, 2_500))]
    for parent in parents:
        assert rows(quality.fk_violations_by_bitmap(child, "k", parent, "p")) == rows(quality.fk_violations(child, "k", parent, "p"))
    p = plan(quality.fk_violations_by_bitmap(child, "k", parents[-1], "p"))
    lines = p[p.index("Initial Plan") if "Initial Plan" in p else 0:].splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan parquet" in line)
    above = [line for line in lines[:scan] if "Exchange" in line and "LeftAnti" not in line]
    assert not any("hashpartitioning(k" in line for line in above) and "BroadcastHashJoin" in p and "SortMergeJoin" not in p
    far = spark.createDataFrame([(1,), (1 << 60,)], "p long")  # too wide for bitmaps
    text = child.withColumn("k", F.col("k").cast("string"))
    assert quality.fk_violations_by_bitmap(child, "k", far, "p").count() == quality.fk_violations(child, "k", far, "p").count()
    assert quality.fk_violations_by_bitmap(text, "k", far.withColumn("p", F.col("p").cast("string")), "p").count() == 2_699
