"""Loads into a table of key ranges: work in proportion to the change, and
commits of which one wins."""

import os
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablewright.operators import cdc, ledger as led, quality, versions
from tablewright.session import local_path, put_if_absent, read_text, scratch_path

NOW = "2024-01-01 00:00:00"


class Table:
    """Drops and loads of one table, under scratch folders of their own."""

    def __init__(self, spark, ddl, pk, **load):
        self.spark, self.pk, self.load_args, self.schema, self.n = spark, pk, load, StructType.fromDDL(ddl), 0
        self.stage, self.root = scratch_path(spark, "t-stage"), scratch_path(spark, "t-root")
        self.ledger = led.empty_ledger(spark)

    def drop(self, rows, schema=None):
        self.n += 1
        name = f"t.parquet_{self.n:03d}"
        df = rows if not isinstance(rows, list) else self.spark.createDataFrame(rows, schema or StructType([*self.schema.fields, *StructType.fromDDL("delta_flg string").fields]))
        df.write.parquet(f"{self.stage}/{name}")
        counts = self.spark.createDataFrame([(name, df.count())], "file_name string, file_number_of_rows long")
        arrived = led.register_files(self.ledger, counts, now=f"2024-01-01 00:{self.n // 60:02d}:{self.n % 60:02d}")
        self.ledger = led.write_ledger(arrived, scratch_path(self.spark, "t-ledger"))

    def load(self, **more):
        return led.apply_pending(self.spark, self.ledger, self.spark.createDataFrame([], self.schema), self.stage, self.root, self.pk, now=NOW,
                                 **(self.load_args | more))

    def ranges(self):
        return versions.read_list(self.spark, self.root, versions.committed(self.spark, self.root)[1])


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(local_path(path)) for f in fs if f.endswith(".parquet"))


def test_a_load_that_touches_one_range_in_a_hundred_writes_one_in_a_hundred(spark):
    t = Table(spark, "k bigint, v string", "k", range_rows=200)
    t.drop(spark.range(20_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v")).toDF("k", "v").withColumn("delta_flg", F.lit("I")))
    t.load()
    first, before = versions.committed(spark, t.root)[1], t.ranges()
    assert 90 <= len(before) <= 110
    times = {r.at: os.path.getmtime(local_path(r.at)) for r in before}
    # updates and deletes within one range, and many rows that change nothing: keys that are there, keys that are not
    lo = int(before[40].lower[0])
    t.drop([(lo + 1, "new", "U"), (lo + 2, "", "D"), *[(k, "x", "I") for k in range(0, 20_000, 97)], *[(30_000 + k, "x", "U") for k in range(50)]])
    after, ledger = t.load()
    second, now = versions.committed(spark, t.root)[1], t.ranges()
    assert ledger.where("file_loaded").count() == 2
    assert size(f"{second}/rows") <= size(f"{first}/rows") / 80
    assert sum(r not in before for r in now) == 1 and len(set(now) & set(before)) == len(before) - 1
    assert all(os.path.getmtime(local_path(at)) == m for at, m in times.items())
    got = dict(rows_of(after))
    assert len(got) == 19_999 and got[lo + 1] == "new" and lo + 2 not in got and 30_001 not in got and got[97] != "x"
    # only files of the ranges named are read
    assert {local_path(f).rpartition("/")[0] for f in after.inputFiles()} == {local_path(r.at) for r in now}


@pytest.mark.parametrize("ddl, pk, key", [
    ("k bigint, v string", ["k"], lambda n: (n - 30,)), ("k string, v string", ["k"], lambda n: (f"key {n:03d}",)),
    ("a date, b int, v string", ["a", "b"], lambda n: (__import__("datetime").date(2024, 1, 1 + n % 9), n))])
def test_loads_give_what_merging_gives(spark, ddl, pk, key):
    rng = random.Random(str(pk))
    t = Table(spark, ddl, pk, range_rows=7)
    expect = spark.createDataFrame([], t.schema)
    for i in range(3):
        names = rng.sample(range(60), 25)
        rows = [(*key(n), f"v{i}", "I" if i == 0 else rng.choice(["I", "U", "D", None])) for n in names]
        if i:
            rows.append((*[None] * len(pk), "no key", "I"))
        t.drop(rows)
        changes = spark.createDataFrame(rows, StructType([*t.schema.fields, *StructType.fromDDL("delta_flg string").fields]))
        expect = spark.createDataFrame(cdc.merge_flagged(expect, changes, pk).collect(), t.schema)
        got, _ = t.load()
        assert rows_of(got) == rows_of(expect)
        low = [r.lower for r in t.ranges()]
        assert len(low) > 2
        assert sum(r.rows for r in t.ranges()) == expect.count()


def test_all_rows_deleted_and_inserted_again(spark):
    t = Table(spark, "k int, v string", "k", range_rows=5)
    t.drop([(k, "a", "I") for k in range(20)])
    t.load()
    t.drop([(k, "a", "D") for k in range(20)])
    assert t.load()[0].count() == 0 and t.ranges() == []
    t.drop([(k, "b", "I") for k in range(12)])
    assert rows_of(t.load()[0]) == [(k, "b") for k in sorted(range(12), key=lambda k: repr((k, "b")))]


def test_of_two_loads_from_one_version_both_are_applied(spark, monkeypatch):
    t = Table(spark, "k int, v string", "k", range_rows=5)
    t.drop([(k, "a", "I") for k in range(20)])
    t.load()
    base = t.ledger
    t.drop([(3, "one", "U")])
    ours = t.ledger
    t.ledger = base
    t.drop([(3, "two", "U"), (50, "two", "I")])
    theirs = t.ledger
    commit, calls = versions.commit, []

    def other_first(spark_, root, version):
        if not calls:
            calls.append(1)
            t.ledger = theirs
            t.load()
        return commit(spark_, root, version)
    monkeypatch.setattr(versions, "commit", other_first)
    t.ledger = ours
    target, ledger = t.load()
    assert versions.committed(spark, t.root)[0] == 3
    got = dict(rows_of(target))
    assert got[50] == "two" and got[3] == "one" and len(got) == 21
    assert ledger.where("file_loaded").count() == 3
    monkeypatch.setattr(versions, "commit", lambda *a: False)
    t.drop([(4, "x", "U")])
    with pytest.raises(RuntimeError, match="meanwhile"):
        t.load(attempts=2)


def test_put_if_absent(spark):
    path = scratch_path(spark, "marker") + "/1"
    assert put_if_absent(spark, path, "first") and not put_if_absent(spark, path, "second")
    assert read_text(spark, path) == "first"
    assert [f for f in os.listdir(os.path.dirname(local_path(path))) if not f.endswith(".crc")] == ["1"]


def test_types_of_drops_are_gated(spark):
    t = Table(spark, "k int, v int", "k")
    for sql, error in (("SELECT 1 AS k, 2.7D AS v, 'I' AS delta_flg", PySparkException), ("SELECT 1 AS k, '5' AS v, 'I' AS delta_flg", quality.SchemaMismatch),
                       ("SELECT 1 AS k, 5 AS v", quality.SchemaMismatch), ("SELECT 1 AS k, 5 AS w, 'I' AS delta_flg", quality.SchemaMismatch)):
        t = Table(spark, "k int, v int", "k")
        t.drop(spark.sql(sql))
        with pytest.raises(error):
            t.load()
        assert versions.committed(spark, t.root) is None
    t = Table(spark, "k int, v int", "k")
    t.drop(spark.sql("SELECT 1L AS k, 2.0D AS v, 'I' AS delta_flg"))
    t.drop(spark.sql("SELECT CAST(7 AS TINYINT) AS v, 1 AS k, 'U' AS delta_flg"))
    assert rows_of(t.load()[0]) == [(1, 7)]


def test_key_search_against_bisect(spark):
    import bisect
    lows = sorted(random.Random(5).sample(range(-500, 500), 37))
    ranges = [versions.Range((str(x),), 1, "", None) for x in lows]
    df = spark.range(-520, 520).select(F.col("id").alias("k"))
    got = {r["k"]: r["p"] for r in df.withColumn("p", versions.range_of(["k"], df.schema, ranges)).collect()}
    assert all(p == max(0, bisect.bisect_right(lows, k) - 1) for k, p in got.items())
