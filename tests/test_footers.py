"""Schemas of arriving files: footers read by tasks, types that widen, gates
that look at types, checks that no projection removes."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablewright.functions import casts
from tablewright.operators import cdc, quality
from tablewright.session import local_path, scratch_path
from tablewright.sources import files as src, footers
from tablewright.streaming import changes as stream

ALL = ["tinyint", "smallint", "int", "bigint", "decimal(5,2)", "decimal(20,0)", "decimal(38,10)", "float", "double", "date",
       "timestamp_ntz", "timestamp", "string", "boolean", "binary", "void"]


def of(ddl):
    return StructType.fromDDL(f"x {ddl}")["x"].dataType


def test_merged_types_are_least_upper_bounds(spark):
    pairs = [(a, b) for a in ALL for b in ALL]
    rows = [("", f"{i}/{k}", 1, f"c{i}", t, "") for i, p in enumerate(pairs) for k, t in enumerate(p)]
    got = {r["column"]: (r["merged_type"], r["status"]) for r in footers.merged_columns(spark.createDataFrame(rows, footers.FILE_COLUMNS)).collect()}
    for i, (a, b) in enumerate(pairs):
        merged, status = got[f"c{i}"]
        bounds = [t for t in ALL if casts.lossless(of(a), of(t)) and casts.lossless(of(b), of(t))]
        if merged is None:
            assert status == footers.CLASH
            assert not bounds, (a, b, bounds)
        else:
            assert casts.lossless(of(a), of(merged)) and casts.lossless(of(b), of(merged)), (a, b, merged)
            assert all(casts.lossless(of(merged), of(t)) for t in bounds), (a, b, merged, bounds)
            assert status == (footers.SAME if a == b else footers.WIDENED)


def jobs_of(spark, run):
    sc = spark.sparkContext
    group = scratch_path(spark, "jobs").rpartition("/")[2]
    sc.setJobGroup(group, group)
    try:
        out = run()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return len(sc.statusTracker().getJobIdsForGroup(group)), out


def test_two_thousand_files_take_as_many_jobs_as_two_hundred(spark):
    expected = StructType.fromDDL("k bigint, v int")
    counts = []
    for n in (200, 2000):  # both past the size from which Spark lists files in a job
        root = local_path(scratch_path(spark, "many-files"))
        import os
        os.makedirs(root)
        for i in range(n):
            kind = (pa.int64(), pa.int32())[i % 2]
            pq.write_table(pa.table({"k": pa.array([i], kind), "v": pa.array([i % 7], pa.int32())}), f"{root}/f{i:05d}.parquet")
        names = [f"{root}/f{i:05d}.parquet" for i in range(n)]
        used, rows = jobs_of(spark, lambda names=names: stream.read_drops(spark, names, expected, "fail").agg(F.count("*"), F.sum("k")).first())
        assert tuple(rows) == (n, n * (n - 1) // 2)
        counts.append(used)
    assert counts[1] == counts[0] < 20


def test_schemas_of_files_written_elsewhere(spark):
    root = local_path(scratch_path(spark, "arrow-files"))
    import datetime as dt
    import os
    os.makedirs(root)
    pq.write_table(pa.table({"t": pa.array([dt.datetime(2024, 1, 1)], pa.timestamp("us")), "d": pa.array([1], pa.int16()), "s": ["x"]}), f"{root}/a.parquet")
    spark.range(2).select(F.col("id").cast("int").alias("d"), F.array(F.struct("id")).alias("n")).coalesce(1).write.parquet(f"{root}/b")
    got = {(r["path"].rpartition("/")[2] == "a.parquet", r["column"]): (r["position"], r["type"]) for r in footers.file_columns(spark, root).collect()}
    assert got == {(True, "t"): (1, "timestamp_ntz"), (True, "d"): (2, "smallint"), (True, "s"): (3, "string"),
                   (False, "d"): (1, "int"), (False, "n"): (2, "array<struct<id:bigint>>")}
    assert footers.file_columns(spark, []).count() == 0
    with open(f"{root}/c.parquet", "w") as f:
        f.write("not parquet")
    with pytest.raises(PySparkException):
        footers.file_columns(spark, root).count()


def test_a_file_of_a_wrong_type_stops_the_stream_and_the_log_still_reads(spark):
    expected = StructType.fromDDL("k bigint, v int, seq int")
    stage, log, ckpt = (scratch_path(spark, f"poison-{x}") for x in ("stage", "log", "ckpt"))

    def apply():
        stream.stream_apply_drops(spark, f"{stage}/*/*.parquet", log, ckpt, expected, "k", "seq", max_files=1)

    spark.sql("SELECT 1L AS k, 5 AS v, 1 AS seq").write.parquet(f"{stage}/a")
    apply()
    for name, sql in (("wrong", "SELECT 1L AS k, 'five' AS v, 2 AS seq"), ("lossy", "SELECT 1L AS k, 2.7D AS v, 2 AS seq")):
        spark.sql(sql).write.parquet(f"{stage}/{name}")
        with pytest.raises(Exception):
            apply()
        for schema in (expected, None):
            assert [tuple(r) for r in stream.current_state(spark, log, "k", "seq", schema=schema).collect()] == [(1, 5, 1)]
    fits, whole = scratch_path(spark, "fits"), scratch_path(spark, "whole")
    spark.sql("SELECT CAST(1 AS INT) AS k, 7.0D AS v, CAST(3 AS TINYINT) AS seq").write.parquet(f"{fits}/a")
    stream.stream_apply_drops(spark, f"{fits}/*/*.parquet", log, whole, expected, "k", "seq")
    assert [tuple(r) for r in stream.current_state(spark, log, "k", "seq").collect()] == [(1, 7, 3)]
    assert spark.read.parquet(log).schema["v"].dataType.simpleString() == "int"


def test_read_log_of_a_wrong_path(spark):
    schema = StructType.fromDDL("k int")
    place = scratch_path(spark, "place")
    spark.range(1).write.parquet(place)
    assert stream.read_log(spark, f"{place}/log", schema).count() == 0
    with pytest.raises(FileNotFoundError):
        stream.read_log(spark, f"{place}-mistyped/deep/log", schema)
    with pytest.raises(PySparkException):
        stream.read_log(spark, f"{place}/log")


def test_checks_stay_when_columns_are_pruned(spark):
    lines = spark.createDataFrame([("1;2;3;4",), ("1;2;3",)], "value string")
    cut = src.parse_delimited(lines, ";", ["a", "b", "c"])
    for run in (lambda: cut.select("b").collect(), cut.count, lambda: cut.agg(F.count("*")).collect()):
        with pytest.raises(PySparkException, match="more fields"):
            run()
    snap = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    applied = cdc.apply_snapshot(snap.limit(0), snap, "k")
    for run in (applied.count, lambda: applied.select("v").collect(), lambda: applied.agg(F.max("v")).collect()):
        with pytest.raises(PySparkException, match="more than once"):
            run()
    assert cdc.apply_snapshot(snap.limit(0), snap.where("v <> 'b'"), "k").count() == 2
    doubles = spark.createDataFrame([(1.5, "x")], "v double, w string")
    fitted = casts.fit(doubles, StructType.fromDDL("v int, w string"))
    for run in (fitted.count, lambda: fitted.select("w").collect()):
        with pytest.raises(PySparkException, match="does not fit"):
            run()


def test_gate_with_fitting_types(spark):
    df = spark.sql("SELECT CAST(1 AS INT) AS a, 2.0D AS b, 'x' AS c")
    quality.schema_gate(df, StructType.fromDDL("a bigint, b int, c string"), fitting=True)
    for wrong in ("a bigint, b int, c int", "a date, b int, c string"):
        with pytest.raises(quality.SchemaMismatch):
            quality.schema_gate(df, StructType.fromDDL(wrong), fitting=True)
    with pytest.raises(quality.SchemaMismatch):
        quality.schema_gate(df, StructType.fromDDL("a bigint, b double, c string"), check_types=True)


def test_drift_of_drops_with_several_files(spark):
    root = scratch_path(spark, "drift")
    spark.sql("SELECT 1 AS a, 'x' AS b").write.parquet(f"{root}/one")
    spark.sql("SELECT 1L AS a, 'x' AS b").write.mode("append").parquet(f"{root}/one")
    spark.sql("SELECT 'y' AS b, 1 AS a, 2 AS z").write.parquet(f"{root}/two")
    got = {(r["drop"].rpartition("/")[2], r["column"]): (r["src_type"], r["status"])
           for r in quality.schema_drift(spark, [f"{root}/one", f"{root}/two"], StructType.fromDDL("a int, b string, m int")).collect()}
    assert got == {("one", "a"): ("bigint", "type"), ("one", "b"): ("string", "ok"), ("one", "m"): (None, "target_only"),
                   ("two", "a"): ("int", "moved"), ("two", "b"): ("string", "moved"), ("two", "z"): ("int", "source_only"), ("two", "m"): (None, "target_only")}
