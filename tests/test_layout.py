"""Clustering on several columns and compaction of small files alone."""

import os

from pyspark.sql import functions as F

from tablewright.session import local_path, scratch_path
from tablewright.sinks import tables as sink


def met(spark, path, col, low, high):
    files = sink.file_stats(spark, path, col).collect()
    return sum(f["max_v"] is not None and f["max_v"] >= low and f["min_v"] <= high for f in files) / len(files)


def test_every_clustering_column_skips_files(spark):
    df = spark.range(20_000).select(((F.col("id") * 7919) % 20_011).alias("a"), F.format_string("common prefix %05d", (F.col("id") * 104_729) % 20_021).alias("b"),
                                    F.when(F.col("id") % 50 > 0, F.col("id")).alias("c"))
    path = sink.cluster_write(df, ["a", "b"], scratch_path(spark, "two-columns"), 64)
    assert spark.read.parquet(path).exceptAll(df).isEmpty() and spark.read.parquet(path).count() == 20_000
    assert met(spark, path, "a", 9_000, 9_500) <= 0.3 and met(spark, path, "b", "common prefix 09000", "common prefix 09500") <= 0.3
    plain = sink.cluster_write(df, ["a", "b"], scratch_path(spark, "lexicographic"), 64, interleave=False)
    assert met(spark, plain, "b", "common prefix 09000", "common prefix 09500") > 0.9


def test_frequent_values_nulls_and_empty_tables(spark):
    df = spark.range(6_000).select(F.when(F.col("id") % 3 > 0, F.lit(5)).alias("a"), F.col("id").alias("b"), F.lit("x").alias("c"))
    path = sink.cluster_write(df, ["a", "b", "c"], scratch_path(spark, "frequent"), 16)
    sizes = [f["rows"] for f in sink.file_stats(spark, path, "b").collect()]
    assert sum(sizes) == 6_000 and max(sizes) < 1_500
    empty = sink.cluster_write(df.limit(0), ["a", "b"], scratch_path(spark, "none"), 4)
    assert spark.read.parquet(empty).count() == 0


def test_large_files_are_left_alone(spark):
    path, out = scratch_path(spark, "mixed"), scratch_path(spark, "merged")
    df = spark.range(60_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"))
    df.where("id < 50000").coalesce(1).write.parquet(path)
    df.where("id >= 50000").repartition(30).write.mode("append").parquet(path)
    sizes = {f"{path}/{f}": os.path.getsize(f"{local_path(path)}/{f}") for f in os.listdir(local_path(path)) if f.endswith(".parquet")}
    large = max(sizes, key=sizes.get)
    files = sink.compact_small(spark, path, out, file_bytes=1 << 20)
    assert len(files) == 2 and sum(f.endswith(large.rpartition("/")[2]) for f in files) == 1
    assert spark.read.parquet(*files).exceptAll(df).isEmpty() and spark.read.parquet(*files).count() == 60_000
    assert sorted(sizes) == sorted(f"{path}/{f}" for f in os.listdir(local_path(path)) if f.endswith(".parquet"))
    again = sink.compact_small(spark, out, scratch_path(spark, "again"), file_bytes=1 << 20)
    assert len(again) == 1 and again[0] in files


def seen_calls(monkeypatch, df, method):
    """The frames that a DataFrame method returns from here on."""
    seen, real = [], getattr(type(df), method)

    def called(self, *args):
        seen.append(real(self, *args))
        return seen[-1]

    monkeypatch.setattr(type(df), method, called)
    return seen


def test_files_are_sorted_by_stored_keys(spark, monkeypatch):
    df = spark.range(3_000).select((F.col("id") * 7919 % 3_001).alias("a"), (F.col("id") % 50).alias("b"), F.lit("kept").alias("__Cluster_Key"))
    seen = seen_calls(monkeypatch, df, "sortWithinPartitions")
    for rows in (df.drop("__Cluster_Key"), df):
        path = sink.cluster_write(rows, ["a", "b"], scratch_path(spark, "stored-keys"), 4)
        written = spark.read.parquet(path)
        assert written.columns == rows.columns and written.count() == 3_000 and written.exceptAll(rows).isEmpty()
    for sort in (x._jdf.queryExecution().analyzed() for x in seen):
        order = [sort.order().apply(i).child().getClass().getSimpleName() for i in range(sort.order().size())]
        assert order == ["AttributeReference"] * 3


def test_codes_count_the_bounds_reached(spark):
    df = spark.createDataFrame([(float(x),) for x in range(-3, 70)] + [(None,), (float("nan"),), (float("-inf"),)], "v double")
    for n in (0, 1, 2, 7, 8, 63, 64):
        bounds = [2.0 * i for i in range(n)]
        code = sink._code(F.col("v"), df.schema["v"].dataType, bounds)
        for r in df.select("v", code.alias("c")).collect():
            assert r.c == (0 if r.v is None else n if r.v != r.v else sum(b <= r.v for b in bounds))
    many_nan = df.union(df.where("isnan(v)").crossJoin(spark.range(30)).select("v"))
    assert many_nan.select(sink.interleaved_key(many_nan, ["v"], 3).alias("k")).where("isnan(v) AND k < 6").isEmpty()
    words = df.select("v", F.col("v").cast("string").alias("w"))
    plan = words.select(sink.interleaved_key(words, ["v", "w"]).alias("k"))._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan


def test_a_frequent_text_is_spread_over_the_cells(spark, monkeypatch):
    df = spark.range(6_400).select(F.when(F.col("id") % 8 > 0, F.lit("often")).otherwise(F.format_string("x%05d", "id")).alias("w"), F.col("id").alias("n"))
    seen = seen_calls(monkeypatch, df, "repartitionByRange")
    sink.interleaved_key(df, ["w", "n"])
    [spread] = seen
    assert max(r["count"] for r in spread.groupBy(F.spark_partition_id()).count().collect()) <= 6_400 // 16
    monkeypatch.undo()
    [few, same, none] = sink._bounds(df.select(F.concat(F.lit("p"), (F.col("n") % 5).cast("string")).alias("few"), F.lit("one").alias("same"), F.lit(None).cast("string").alias("none")), ["few", "same", "none"], 64)
    assert few == ["p1", "p2", "p3", "p4"] and same == none == []
