"""Change logs in buckets of keys: state of wanted keys read by pruning."""

import re

import pytest
from pyspark.sql import functions as F

from tablewright.session import scratch_path
from tablewright.streaming import changes as stream

KEYS = ["k"]


def rows(df):
    return sorted(map(repr, df.collect()))


def versions(spark):
    one = spark.range(300).select(F.when(F.col("id") > 0, F.col("id")).cast("int").alias("k"), F.lit(1).alias("s"), F.lit("a").alias("v"), F.lit(False).alias("gone"))
    two = spark.range(0, 300, 7).select(F.col("id").alias("k"), F.lit(2).alias("s"), F.lit("b").alias("v"), (F.col("id") % 2 == 0).alias("gone"))
    return one.withColumn("k", F.col("k").cast("long")), two


def test_lookup_equals_state_and_prunes(spark):
    one, two = versions(spark)
    log, plain = scratch_path(spark, "t-buckets"), scratch_path(spark, "t-no-buckets")
    stream.bucket_log(spark, log, "k", 16)
    stream.bucket_log(spark, log, "k", 16)
    for path in (log, plain):
        for i, df in enumerate((one, two)):
            stream.write_version(df, path, i, "a")
    whole = stream.current_state(spark, log, "k", "s", "gone")
    assert whole.columns == ["k", "s", "v", "gone"] and rows(whole) == rows(stream.current_state(spark, plain, "k", "s", "gone"))
    wanted = spark.createDataFrame([(7,), (14,), (15,), (15,), (None,), (10_000,)], "k int")
    for bound in (2_000_000, 0):
        found = stream.lookup_state(spark, log, wanted, "s", "gone", broadcast_rows=bound)
        assert rows(found) == rows(whole.where("k IN (7, 14, 15) OR k IS NULL")) and found.count() == 3
    p = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*__log_bucket", p)
    read = stream.read_log(spark, log, buckets=[3]).select(F.input_file_name().alias("f")).distinct().collect()
    assert read and all("__log_bucket=3/" in r["f"] for r in read)


def test_base_in_the_same_buckets(spark):
    one, two = versions(spark)
    older, log = scratch_path(spark, "t-older"), scratch_path(spark, "t-newer")
    for path in (older, log):
        stream.bucket_log(spark, path, KEYS, 8)
    stream.write_version(one, older, 0, "a")
    stream.write_version(two, log, 1, "a")
    base = stream.compact_log(spark, older, scratch_path(spark, "t-base"), "k", "s", "gone")
    whole = stream.current_state(spark, log, "k", "s", "gone", base=spark.read.parquet(base), since_version=1)
    assert whole.count() == 300 - 22 + 1 and stream.BUCKET_COL not in whole.columns  # key 0 is new and gone, NULL stays
    wanted = spark.range(0, 60).select(F.col("id").alias("k"))
    assert rows(stream.lookup_state(spark, log, wanted, "s", "gone", base_path=base)) == rows(whole.where("k < 60"))
    again = stream.compact_log(spark, log, scratch_path(spark, "t-base"), "k", "s", "gone", base=spark.read.parquet(base))
    assert rows(spark.read.parquet(again).drop(stream.BUCKET_COL).where("NOT gone")) == rows(whole)


def test_buckets_are_settled_before_the_log_begins(spark):
    one, _ = versions(spark)
    log, other = scratch_path(spark, "t-begun"), scratch_path(spark, "t-empty")
    stream.write_version(one, log, 0, "a")
    with pytest.raises(ValueError):
        stream.bucket_log(spark, log, "k", 4)
    with pytest.raises(ValueError):
        stream.lookup_state(spark, log, one, "s")
    stream.bucket_log(spark, other, "k", 4)
    with pytest.raises(ValueError):
        stream.bucket_log(spark, other, "k", 8)
    assert stream.read_log(spark, other, one.schema).count() == 0
    assert stream.lookup_state(spark, other, one, "s", schema=one.schema).count() == 0
    with pytest.raises(ValueError):
        stream.write_version(one.withColumn(stream.BUCKET_COL, F.lit(1)), other, 0, "a")
    text = one.select(F.concat(F.lit("é"), F.col("k").cast("string")).alias("k"), "s", F.col("v"))
    named = scratch_path(spark, "t-text")
    stream.bucket_log(spark, named, "k", 4)
    stream.write_version(text, named, 0, "a")
    assert [r.k for r in stream.lookup_state(spark, named, text.where("k = 'é5'"), "s").collect()] == ["é5"]
