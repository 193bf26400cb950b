"""Physical plan shape of the operators whose cost matters at scale."""

import re

from tablewright.operators import cdc, quality, rank
from tablewright.plans import catalog, fixtures as fx


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_small_merge_never_shuffles_the_target(spark, sf_small):
    cust = fx.table(spark, sf_small, "customer")
    p = plan(cdc.merge_flagged(cust, fx.customer_changes(cust), "c_custkey"))
    assert "SortMergeJoin" not in p and "ShuffledHashJoin" not in p
    assert p.count("BroadcastHashJoin") >= 3
    # the full-width target scan feeds the left join directly, with no exchange above it
    lines = p.splitlines()
    i = next(n for n, l in enumerate(lines) if re.search(r"FileScan parquet \[c_custkey#\d+L,c_name#", l)
             and "DataFilters: []" in l)
    depth = len(lines[i]) - len(lines[i].lstrip(" :+-"))
    parents = []
    for l in reversed(lines[:i]):
        d = len(l) - len(l.lstrip(" :+-"))
        if d < depth:
            parents.append(l.strip(" :+-"))
            depth = d
    assert parents[0].startswith("BroadcastHashJoin") and "LeftOuter" in parents[0], parents
    assert not any(x.startswith("Exchange") for x in parents), parents


def test_large_merge_uses_distinct_target_keys(spark, sf_small):
    cust = fx.table(spark, sf_small, "customer")
    p = plan(cdc.merge_flagged(cust, fx.customer_changes(cust), "c_custkey", broadcast_rows=0))
    assert "LeftAnti" in p and "LeftSemi" in p
    assert "FullOuter" not in p


def test_latest_per_key_combines_map_side(spark, sf_small):
    ev = fx.table(spark, sf_small, "events")
    p = plan(rank.latest_per_key(ev, "user_id", ["ts", "event_id"]))
    assert "partial_max_by" in p
    assert "Window" not in p


def test_filters_and_columns_reach_the_scan(spark, sf_small):
    p = plan(catalog.QUERIES["filter_predicate"](spark, sf_small))
    assert re.search(r"PushedFilters: \[.*In\(o_orderstatus", p), p
    p = plan(quality.pk_violations(fx.table(spark, sf_small, "lineitem"), ["l_orderkey", "l_linenumber"]))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in p
    assert "partial_count" in p


def test_numbering_is_range_partitioned(spark, sf_small):
    o = fx.table(spark, sf_small, "orders")
    p = plan(rank.global_rank(o, ["o_orderkey"], n_ranges=4))
    assert re.search(r"Exchange hashpartitioning\(__range#\d+, ", p), p
    p = plan(rank.ranked(o, ["o_orderdate", "o_orderkey"], ["o_custkey"], n_ranges=4))
    assert re.search(r"Exchange hashpartitioning\(__range#\d+, o_custkey#\d+L", p), p


def test_snapshot_diff_emits_no_pairs(spark, sf_small):
    o = fx.table(spark, sf_small, "orders")
    p = plan(cdc.snapshot_diff(fx.orders_old(o), fx.orders_new(o), "o_orderkey"))
    assert "Join" not in p
    assert "partial_max_by" in p


def test_fold_into_base_keeps_the_base_unshuffled(spark, sf_small):
    o = fx.table(spark, sf_small, "orders").selectExpr("*", "0 AS seq", "'I' AS op")
    ch = fx.table(spark, sf_small, "orders").where("o_orderkey % 50 = 0").selectExpr("*", "1 AS seq", "'U' AS op")
    fast = plan(cdc.fold_into_base(o, ch, "o_orderkey", "seq", "op = 'D'"))
    # the base is split by broadcast joins; only its touched rows and the changes are shuffled
    assert fast.count("BroadcastHashJoin") >= 2 and "LeftAnti" in fast and "SortMergeJoin" not in fast
    slow = plan(cdc.fold_into_base(o, ch, "o_orderkey", "seq", "op = 'D'", broadcast_rows=0))
    assert "LeftAnti" not in slow and "partial_max_by" in slow
