"""Merged profiles, and index definitions read into clustered tables."""

import pytest
from pyspark.sql import functions as F

from tablewright.functions import text as tx
from tablewright.operators import aggregates as agg
from tablewright.session import scratch_path
from tablewright.sinks import tables as sink


def test_merged_profiles(spark):
    df = spark.range(40_000).select((F.col("id") % 9_000).alias("a"), F.when(F.col("id") % 4 > 0, F.col("id").cast("string")).alias("b"),
                                    (F.col("id") % 3).cast("int").alias("c"), (F.col("id") % 50).cast("decimal(9,2)").alias("d"), F.lit(None).cast("string").alias("e"))
    cols = df.columns
    parts = [agg.profile_drop(p, cols) for p in (df.where("a < 3000"), df.where("a >= 2000"), df.limit(0), df.withColumn("a", F.col("a").cast("int")).where("a < 5"))]
    merged = agg.merge_profiles(agg.merge_profiles(parts[0].union(parts[1])).union(parts[2]).union(parts[3]))
    got = {r.column: r for r in agg.profile_counts(merged).collect()}
    whole = {r.column: r for r in agg.profile_counts(agg.profile_drop(df, cols)).collect()}
    for c, exact in {"a": 9_000, "b": 30_000, "c": 3, "d": 50, "e": 0}.items():
        assert abs(got[c].distinct_estimate - exact) <= 0.05 * exact and abs(whole[c].distinct_estimate - exact) <= 0.05 * exact
    n = df.where("a < 3000").count() + df.where("a >= 2000").count() + df.where("a < 5").count()
    assert {r.n_rows for r in got.values()} == {n} and got["e"].n_nulls == n and got["a"].n_nulls == 0


CASES = [
    ("CREATE INDEX ix ON public.patient USING btree (a, b text_pattern_ops)", "patient", ["a", "b"]),
    ("create index i on t (lower(a), b)", "t", ["b"]),
    ("create index i on t (a DESC, b NULLS FIRST, c asc nulls last)", "t", ["a", "b", "c"]),
    ('create index i on t ("A, b" , "x""y" COLLATE "de_DE" DESC)', "t", ["a, b", 'x"y']),
    ("create index i on t (coalesce(a, '),('), b) include (z) where c > (1)", "t", ["b"]),
    ("-- note (x\ncreate unique index concurrently if not exists i\n on only s.t\n using gin (a gin_trgm_ops(siglen=32), (b + c), d)", "t", ["a", "d"]),
    ('create index "odd on x (y)" on "My Schema"."T" (a)', "t", ["a"]),
    ("create index on t (a)", "t", ["a"]),
    ("create index i on t (a, (b)", "t", []),
    ("drop index i", "", []), ("", "", []), ("comment on table t is 'create'", "", []),
]


def test_index_definitions(spark):
    df = spark.createDataFrame([(i, s) for i, (s, _, _) in enumerate(CASES)] + [(len(CASES), None)], "i int, s string")
    table, columns = tx.index_column_list("s")
    got = [(r.t, r.c) for r in df.select("i", table.alias("t"), columns.alias("c")).orderBy("i").collect()]
    assert got[:-1] == [(t, c) for _, t, c in CASES]
    assert got[-1][0] is None and not got[-1][1]
    items = df.select(tx.index_items("s").alias("x")).collect()
    assert items[1].x == ["lower(a)", "b"] and items[4].x == ["coalesce(a, '),(')", "b"] and items[8].x is None


def test_clustering_by_index_text(spark):
    text, out = scratch_path(spark, "t-index"), scratch_path(spark, "t-clustered")
    statements = "create index a on s.one (v desc, lower(w));\ndrop index x;\ncreate index b on s.one (k, v);\ncreate index c on s.two (k)"
    spark.range(1).select(F.lit(statements).alias("value")).write.text(text)
    one = spark.range(900).select(F.col("id").alias("K"), (F.col("id") * 37 % 901).alias("v"), F.lit("w").alias("w"))
    assert sink.cluster_by_indexes(spark, text, {"one": one, "three": one}, out, 9) == {"one": ["v", "k"]}
    assert spark.read.parquet(f"{out}/one").exceptAll(one).isEmpty() and spark.read.parquet(f"{out}/one").count() == 900
    with pytest.raises(ValueError, match="lacks"):
        sink.cluster_by_indexes(spark, text, {"two": one.drop("K")}, scratch_path(spark, "t-none"), 2)
