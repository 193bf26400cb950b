"""Quality gates, typing, text functions and ranking on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tablewright.functions import casts, text as tx, timefmt
from tablewright.operators import aggregates as agg, dml, quality, rank, shape
from tablewright.sources import files as src


def test_schema_gate_names_and_positions(spark):
    t = spark.createDataFrame([], "a int, b string, c double")
    ok = spark.createDataFrame([], "a int, b string, c double, delta_flg string")
    assert quality.schema_gate(ok, t, ignore=["delta_flg"]) is ok
    moved = spark.createDataFrame([], "b string, a int, c double")
    with pytest.raises(quality.SchemaMismatch, match="position"):
        quality.schema_gate(moved, t)
    assert quality.schema_gate(moved, t, ordered=False) is moved
    extra = spark.createDataFrame([], "a int, b string, c double, d int")
    with pytest.raises(quality.SchemaMismatch, match="source_only"):
        quality.schema_gate(extra, t)
    rep = {r[0]: r[-1] for r in quality.schema_report_rows(moved, t)}
    assert rep == {"a": "moved", "b": "moved", "c": "ok"}


def test_expect_all_or_fail(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    assert quality.expect_all_or_fail(df.where("x is not null"), {"pos": "x > 0"}).count() == 2
    with pytest.raises(Exception, match="expectation failed: pos"):
        quality.expect_all_or_fail(df, {"pos": "x > 0"}).collect()
    rep = {r.rule: r.failed_rows for r in quality.expect_report(df, {"pos": "x > 0", "big": "x > 1"}).collect()}
    assert rep == {"pos": 1, "big": 2}


def test_pk_and_fk(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, v string")
    got = sorted((r.k if r.k is not None else -1, r.n) for r in quality.pk_violations(df, "k").collect())
    assert got == [(-1, 1), (1, 2)]
    parent = spark.createDataFrame([(1,)], "pk int")
    orphans = quality.fk_violations(df, "k", parent, "pk")
    assert sorted(r.v for r in orphans.collect()) == ["c"]       # NULL key is not an orphan


def test_not_null_violations(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b string")
    got = {r.column_name: r.null_rows for r in quality.not_null_violations(df, ["a", "b"]).collect()}
    assert got == {"a": 1, "b": 2}


def test_dml_null_condition(spark):
    df = spark.createDataFrame([(1, "x"), (2, None), (3, "y")], "k int, s string")
    up = dml.update_where(df, "s = 'x'", {"k": 0})
    assert sorted(r.k for r in up.collect()) == [0, 2, 3]
    assert sorted(r.k for r in dml.delete_where(df, "s <> 'x'").collect()) == [1, 2]   # NULL kept
    rep = dml.replace_where(df, "k = 1", spark.createDataFrame([(9, "z")], "k int, s string"))
    assert sorted(r.k for r in rep.collect()) == [2, 3, 9]


def test_casts(spark):
    df = spark.createDataFrame([(2.7, -2.7, "5", "2.5", "x")], "a double, b double, c string, d string, e string")
    out = casts.cast_by_type(df, {"double": "bigint"}).first()
    assert (out.a, out.b) == (2, -2)
    nan = spark.createDataFrame([(float("nan"), 1e30)], "a double, b double")
    assert tuple(casts.cast_by_type(nan, {"double": "bigint"}).first()) == (None, None)
    typed = casts.cast_to_schema(df.select("c", "d", "e"), "c int, d int, e int").first()
    assert tuple(typed) == (5, None, None)


def test_parse_delimited_and_headers(spark, tmp_path):
    p = tmp_path / "t.txt"
    p.write_text("CAT header^Aa^Ab^A\n1^Ax^A\n\ncat again\n2^Ay^Az^A\n3\n")
    lines = src.scan_text_records(spark, str(p))
    out = src.parse_delimited(lines, "^A", ["k", "v"], skip_pattern="cat%", rescue_col="more")
    assert sorted(map(str, (tuple(r) for r in out.collect()))) == ["('1', 'x', None)", "('2', 'y', 'z^A')", "('3', None, None)"]
    assert src.parse_delimited(lines.where("value LIKE 'cat%'"), "^A", ["k", "v"]).first().k == "cat again"


def test_text_records_custom_separator(spark, tmp_path):
    p = tmp_path / "s.sql"
    p.write_text("create table a (x int);\nalter table a add x;\ncreate index i on s.t using btree (a, b)")
    recs = [r.value for r in src.scan_text_records(spark, str(p), record_sep=";").collect()]
    assert len(recs) == 3 and recs[-1].startswith("\ncreate index")


def test_index_columns(spark):
    df = spark.createDataFrame([("CREATE INDEX ix ON public.patient USING btree (a, b text_pattern_ops)",)], "s string")
    table, cols = tx.index_columns("s")
    r = df.select(table.alias("t"), cols.alias("c")).first()
    assert (r.t, r.c) == ("patient", "a,b")


def test_path_functions(spark):
    df = spark.createDataFrame([("/vol/data/insert_patient_default.sql",)], "p string")
    r = df.select(tx.path_stem("p").alias("stem"),
                  tx.strip_affixes(tx.path_stem("p"), ["insert_", "_default"]).alias("t")).first()
    assert (r.stem, r.t) == ("insert_patient_default", "patient")


def test_replace_chain_order_matters(spark):
    df = spark.createDataFrame([("int8 text",)], "s string")
    r = df.select(tx.replace_chain("s", [("int8", "bigint"), ("text", "string")]).alias("a"),
                  tx.replace_chain("s", [("t", "T"), ("text", "string")]).alias("b")).first()
    assert (r.a, r.b) == ("bigint string", "inT8 TexT")


def test_pg_format(spark):
    assert timefmt.pg_format("YYYY-MM-DD HH24:MI:SS") == "yyyy-MM-dd HH:mm:ss"
    assert timefmt.pg_format("DD/MM/YYYY HH12:MI") == "dd/MM/yyyy hh:mm"
    df = spark.createDataFrame([("2024-03-05 00:07:09",), ("bad",)], "s string")
    got = [r.t for r in df.select(timefmt.parse_ts("s", "YYYY-MM-DD HH24:MI:SS").alias("t")).collect()]
    assert got == [dt.datetime(2024, 3, 5, 0, 7, 9), None]


def test_global_rank_and_tiles(spark):
    df = spark.range(0, 1003).select((F.col("id") * 7 % 1003).alias("k"))
    ranked = rank.global_rank(df, ["k"], n_ranges=7)
    assert sorted((r.k, r["rank"]) for r in ranked.collect()) == [(i, i + 1) for i in range(1003)]
    tiles = rank.ntile_split(df, 10, ["k"], n_ranges=5)
    sizes = sorted(r["count"] for r in tiles.groupBy("tile").count().collect())
    assert sizes == [100] * 7 + [101] * 3
    few = rank.ntile_split(spark.range(0, 3).withColumnRenamed("id", "k"), 5, ["k"])
    assert sorted(r.tile for r in few.collect()) == [1, 2, 3]


def test_global_rank_with_nulls_first(spark):
    df = spark.createDataFrame([(None,), (5,), (1,)], "k int")
    got = sorted(((r.k if r.k is not None else -1), r["rank"]) for r in rank.global_rank(df, ["k"], 2).collect())
    assert got == [(-1, 1), (1, 2), (5, 3)]


def test_aggregates(spark):
    df = spark.createDataFrame([("U",), ("D",), ("U",), (None,)], "f string")
    assert agg.distinct_flags(df, "f").first().flags == "D, U"
    assert agg.max_key(spark.createDataFrame([], "k bigint"), "k").first().max_key == 0
    g = spark.createDataFrame([(1, "b", 2), (1, "a", 1), (1, "a", 3)], "t int, c string, o int")
    assert agg.group_collect(g, "t", "c", "o", sep=",").first()["values"] == "a,b,a"
    assert [r.pos for r in agg.group_positions(g, "t", "c", "o").orderBy("pos").collect()] == [1, 2, 3]


def test_select_except_and_key_text(spark):
    df = spark.createDataFrame([(9204691118228220899, "x")], "k bigint, s string")
    out = shape.select_except(df, k=F.col("k") + 1)
    assert out.columns == ["k", "s"]
    assert shape.filter_key_text(df, "k", "9204691118228220899").count() == 1
    assert shape.filter_key_text(df, "k", "9204691118228220898").count() == 0


def test_rescue(spark):
    from pyspark.sql.types import IntegerType, StructField, StructType
    df = spark.createDataFrame([("1", "x"), ("z", None)], "a string, extra string")
    out = src.rescue_unexpected(df, StructType([StructField("a", IntegerType())])).collect()
    assert [(r.a, r._rescued_data) for r in out] == [(1, '{"extra":"x"}'), (None, '{"a":"z"}')]


def test_group_positions_hot_group_is_split_and_exact(spark):
    # key 0 holds 60 % of the rows
    df = spark.range(0, 2000).select(F.when(F.col("id") % 10 < 6, 0).otherwise(F.col("id") % 7 + 1).alias("k"),
                                     ((F.col("id") * 7919) % 2000).alias("o"))
    out = agg.group_positions(df, "k", "o", "o", n_ranges=8)
    got = sorted((r.k, r.pos, r.o) for r in out.collect())
    exp = []
    for k, vals in sorted({k: sorted(r.o for r in df.where(F.col("k") == k).collect())
                           for k in [r.k for r in df.select("k").distinct().collect()]}.items()):
        exp += [(k, i + 1, v) for i, v in enumerate(vals)]
    assert got == sorted(exp)
    from tablewright.operators.rank import _sample_bounds
    bounds = _sample_bounds(df, ["k", "o"], 8, 2000)
    assert sum(1 for b in bounds if b[0] == 0) >= 3        # the hot key spans several ranges


def test_global_rank_timestamp_ntz_order(spark):
    df = spark.range(0, 50).select(F.col("id"),
                                   F.timestamp_add("SECOND", F.col("id"), F.lit("2024-01-01 00:00:00")
                                                   .cast("timestamp_ntz")).alias("ts"))
    got = sorted((r.id, r["rank"]) for r in rank.global_rank(df, ["ts"], n_ranges=4).collect())
    assert got == [(i, i + 1) for i in range(50)]


def test_ranked_by_written_ranges(spark):
    joined = spark.range(0, 300).join(spark.range(0, 300).withColumnRenamed("id", "k"),
                                      F.col("id") == F.col("k")).select("id")
    got = sorted((r.id, r["rank"]) for r in rank.global_rank(joined, ["id"], 4, method="range_write").collect())
    assert got == [(i, i + 1) for i in range(300)]


def test_grouped_written_ranges_hot_group_and_nulls(spark):
    df = spark.range(0, 3000).select(
        F.when(F.col("id") % 10 < 6, F.lit(0)).when(F.col("id") % 10 == 6, F.lit(None))
         .otherwise(F.col("id") % 5).alias("g"),
        F.when(F.col("id") % 97 == 0, F.lit(None)).otherwise((F.col("id") * 7919) % 3000).alias("o"),
        F.col("id"))
    a = sorted((r.id, r.pos) for r in rank.ranked(df, ["o", "id"], ["g"], "pos", 16, method="range_write").collect())
    b = sorted((r.id, r.pos) for r in rank.ranked(df, ["o", "id"], ["g"], "pos", 16, method="bounds").collect())
    assert a == b
    first = [r for r in rank.ranked(df, ["o", "id"], ["g"], "pos", 16, method="range_write").collect()
             if r.g is None and r.pos == 1]
    assert len(first) == 1 and first[0].o is None


def test_check_constraints_counts_each_kind(spark):
    df = spark.createDataFrame([(1, "a", 10), (1, None, 20), (None, "c", 99), (3, "d", None)],
                               "k int, s string, p int")
    parent = spark.createDataFrame([(10,), (20,)], "pk int")
    rep = {r.constraint: (r.kind, r.violations) for r in quality.check_constraints(
        df, primary_key="k", not_null=["s"], foreign_keys={"p_fk": ("p", parent, "pk")}).collect()}
    assert rep == {"s_not_null": ("not_null", 1), "k_pk": ("primary_key", 3), "p_fk": ("foreign_key", 1)}


def test_drop_and_rename_columns(spark):
    df = spark.createDataFrame([(1, "I", "x")], "k int, newline string, dummy string")
    out = shape.drop_columns(shape.rename_column(df, "newline", "delta_flg"), ["dummy", "absent"])
    assert out.columns == ["k", "delta_flg"] and out.first().delta_flg == "I"
