"""The registered queries: one per operator of the inventory, each built from
the driver's tables at ``sf_dir``.  ``oracle.SQL`` holds the matching SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, IntegerType, LongType, StructField, StructType,
                               TimestampNTZType)

from ..functions import casts, text as tx, timefmt
from ..operators import aggregates as agg, cdc, dml, ledger as led, quality, rank, reconcile as rec, shape
from ..session import scratch_path
from ..sinks import tables as sink
from ..sources import files as src, footers
from ..streaming import changes as stream
from . import fixtures as fx, staging

Query = Callable[[SparkSession, str], DataFrame]


def q_latest_per_key(spark, sf):
    ev = fx.table(spark, sf, "events")
    return rank.latest_per_key(ev, "user_id", ["ts", "event_id"])


def q_apply_changes(spark, sf):
    ev = fx.table(spark, sf, "events")
    return cdc.apply_changes(ev, "user_id", ["ts", "event_id"], "event_type = 'error'")


def _merge(load_type):
    def q(spark, sf):
        cust = fx.table(spark, sf, "customer")
        return cdc.merge_flagged(cust, fx.customer_changes(cust), "c_custkey", "delta_flg", load_type)
    return q


def q_snapshot_diff(spark, sf):
    o = fx.table(spark, sf, "orders")
    return cdc.snapshot_diff(fx.orders_old(o), fx.orders_new(o), "o_orderkey")


def q_apply_snapshot(spark, sf):
    o = fx.table(spark, sf, "orders")
    return cdc.apply_snapshot(fx.orders_old(o), fx.orders_new(o), "o_orderkey")


def q_apply_snapshot_log(spark, sf):
    """Two snapshots through the change log: the first as version 1, then
    only the keys that changed as version 2."""
    o = fx.table(spark, sf, "orders")
    old, new = fx.orders_old(o), fx.orders_new(o)
    log = scratch_path(spark, "orders-snapshot-log")
    stream.snapshot_to_log(spark, log, None, old, "o_orderkey", 1)
    stream.snapshot_to_log(spark, log, stream.snapshot_state(spark, log, "o_orderkey"), new, "o_orderkey", 2)
    return stream.snapshot_state(spark, log, "o_orderkey")


def q_apply_snapshot_digests(spark, sf):
    """Three snapshots into a change log, each compared with the key and row
    digests of the one before; the log's state is the third."""
    o = fx.table(spark, sf, "orders")
    log, side = scratch_path(spark, "orders-digest-log"), scratch_path(spark, "orders-digests")
    for version, snapshot in enumerate((fx.orders_old(o), fx.orders_new(o), fx.orders_old(o).where("o_orderkey % 11 <> 0")), 1):
        stream.snapshot_to_log_by_digests(spark, log, side, snapshot, "o_orderkey", version)
    return stream.snapshot_state(spark, log, "o_orderkey")


def q_reconcile(spark, sf):
    o = fx.table(spark, sf, "orders")
    return rec.reconcile(fx.orders_new(o), fx.orders_old(o), "o_orderkey")


def q_reconcile_counts(spark, sf):
    o = fx.table(spark, sf, "orders")
    return rec.reconcile_counts(fx.orders_new(o), fx.orders_old(o), "o_orderkey")


QUERIES: dict[str, Query] = {
    "latest_per_key": q_latest_per_key,
    "apply_changes": q_apply_changes,
    "merge_flagged_incremental": _merge(cdc.INCREMENTAL),
    "merge_flagged_initial": _merge(cdc.INITIAL),
    "snapshot_diff": q_snapshot_diff,
    "apply_snapshot": q_apply_snapshot,
    "apply_snapshot_log": q_apply_snapshot_log,
    "apply_snapshot_digests": q_apply_snapshot_digests,
    "reconcile": q_reconcile,
    "reconcile_counts": q_reconcile_counts,
}


# ---------------------------------------------------------------- typing


def q_cast_to_schema(spark, sf):
    ev = fx.table(spark, sf, "events")
    k = F.col("event_id")
    as_text = ev.select(
        F.when(k % 3 == 0, k.cast("string")).when(k % 3 == 1, F.lit("abc")).otherwise(F.lit(""))
         .alias("event_id"),
        F.col("ts").cast("string").alias("ts"),
        F.col("value").cast("string").alias("value"))
    return casts.cast_to_schema(as_text, "event_id bigint, ts timestamp_ntz, value double")


def q_cast_by_type(spark, sf):
    return casts.cast_by_type(fx.table(spark, sf, "lineitem"), {"double": "bigint"})


RESCUE_SCHEMA = StructType([
    StructField("event_id", LongType()), StructField("ts", TimestampNTZType()),
    StructField("user_id", LongType()), StructField("event_type", IntegerType()),
    StructField("value", DoubleType())])


def q_rescue_unexpected(spark, sf):
    return src.rescue_unexpected(fx.table(spark, sf, "events"), RESCUE_SCHEMA)


# ---------------------------------------------------------------- text and shaping
REPLACE_PAIRS = [("a", "4"), ("4", "four"), ("e", "3"), ("the", "THE")]


def q_filter_ilike(spark, sf):
    d = fx.table(spark, sf, "documents")
    return shape.filter_ilike(d, "text", ["%licen%", "the%"]).select("doc_id", "lang", "n_chars")


def q_filter_not_ilike(spark, sf):
    d = fx.table(spark, sf, "documents")
    return shape.filter_ilike(d, "text", ["%the%"], negate=True).select("doc_id", "lang", "n_chars")


def q_replace_chain(spark, sf):
    d = fx.table(spark, sf, "documents")
    return d.select("doc_id", tx.replace_chain("text", REPLACE_PAIRS).alias("text"))


def q_select_except(spark, sf):
    o = fx.table(spark, sf, "orders")
    out = shape.select_except(o, drop=["o_totalprice"],
                              o_orderkey=F.col("o_orderkey") + F.lit(fx.NEW_KEY))
    return shape.with_literal(shape.rename_column(out, "o_orderstatus", "status"),
                              "record_insert_id", "loader")


def q_filter_predicate(spark, sf):
    o = fx.table(spark, sf, "orders")
    return shape.filter_predicate(
        o, "o_orderstatus IN ('F', 'O') AND o_orderpriority <> '' AND NOT (o_totalprice > 200000)")


def q_filter_key_text(spark, sf):
    o = fx.table(spark, sf, "orders")
    return shape.filter_key_text(o, "o_orderkey", "42")


def q_union_all(spark, sf):
    c, s = fx.table(spark, sf, "customer"), fx.table(spark, sf, "supplier")
    return rec.union_all(c.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name")),
                         s.select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("key")))


def q_sort_limit(spark, sf):
    o = fx.table(spark, sf, "orders")
    return shape.sample_rows(o, 100, [F.col("o_totalprice").desc(), F.col("o_orderkey")])


def q_path_stem(spark, sf):
    p = fx.table(spark, sf, "pages")
    host = tx.split_part("url", "/", 3)
    return p.select("page_id", tx.path_stem("url").alias("stem"), host.alias("host"),
                    tx.split_part(host, ".", 1).alias("host_head"),
                    F.size(tx.split_fields("url", "/")).alias("n_parts"))


def q_split_text(spark, sf):
    p = fx.table(spark, sf, "pages")
    words = tx.word_list(F.regexp_replace(F.lower(F.col("url")), r"[/?#&=.:]", " "),
                         strip_chars="()")
    return p.select("page_id", F.array_join(words, ",").alias("words"),
                    tx.tail_after("url", "://").alias("after_scheme"),
                    tx.strip_affixes("url", ["https://", "http://", ".example"]).alias("stripped"))


PG_FMT = "YYYY-MM-DD HH24:MI:SS"


def q_parse_ts(spark, sf):
    o = fx.table(spark, sf, "orders")
    txt = o.select("o_orderkey", timefmt.format_ts("o_orderdate", PG_FMT).alias("txt"))
    return txt.select("o_orderkey", "txt", timefmt.parse_ts("txt", PG_FMT).alias("parsed"))


# ---------------------------------------------------------------- DML
DML_COND = "nullif(c_mktsegment, 'BUILDING') <> 'AUTOMOBILE'"


def q_update_where(spark, sf):
    c = fx.table(spark, sf, "customer")
    return dml.update_where(c, DML_COND, {"c_acctbal": 0.0,
                                          "c_name": F.concat(F.col("c_name"), F.lit("*"))})


def q_delete_where(spark, sf):
    return dml.delete_where(fx.table(spark, sf, "customer"), DML_COND)


def q_replace_where(spark, sf):
    c = fx.table(spark, sf, "customer")
    rows = c.where("c_nationkey = 3").withColumn("c_name", F.concat(F.col("c_name"), F.lit("#r")))
    return dml.replace_where(c, "c_nationkey = 3", rows)


# ---------------------------------------------------------------- quality
def q_fk_violations(spark, sf):
    o = fx.table(spark, sf, "orders")
    c = fx.table(spark, sf, "customer").where("c_acctbal > 0")
    return quality.fk_violations(o, "o_custkey", c, "c_custkey")


def q_fk_violations_bitmap(spark, sf):
    """Line items whose order is gone, by bitmaps of the orders' keys: the line items do not move."""
    o = fx.table(spark, sf, "orders").where("o_totalprice > 50000")
    return quality.fk_violations_by_bitmap(fx.table(spark, sf, "lineitem"), "l_orderkey", o, "o_orderkey")


def q_pk_violations(spark, sf):
    return quality.pk_violations(fx.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_not_null_violations(spark, sf):
    d = fx.table(spark, sf, "documents").join(fx.table(spark, sf, "labels"), "doc_id", "left")
    return quality.not_null_violations(d, ["doc_id", "lang", "quality", "toxic"])


def q_check_constraints(spark, sf):
    o = fx.table(spark, sf, "orders")
    paying = fx.table(spark, sf, "customer").where("c_acctbal > 0")
    return quality.check_constraints(o, primary_key="o_orderkey",
                                     not_null=["o_custkey", "o_orderdate", "o_orderpriority"],
                                     foreign_keys={"orders_customer_fk1": ("o_custkey", paying, "c_custkey")})


def q_schema_gate(spark, sf):
    o = fx.table(spark, sf, "orders")
    shuffled = o.select(*reversed(o.columns))
    return quality.conform(shuffled, o.schema)


LINEITEM_RULES = {
    "qty_positive": "l_quantity > 0",
    "discount_small": "l_discount <= 0.05",
    "flag_known": "l_returnflag IN ('A', 'N')",
    "tax_below_price": "l_tax < l_extendedprice",
}


def q_expect_report(spark, sf):
    return quality.expect_report(fx.table(spark, sf, "lineitem"), LINEITEM_RULES)


def q_expect_pass(spark, sf):
    li = fx.table(spark, sf, "lineitem")
    return quality.expect_all_or_fail(li, {"qty_positive": "l_quantity > 0"})


# ---------------------------------------------------------------- aggregates (A1-A5)
def q_row_count(spark, sf):
    return agg.row_count(fx.table(spark, sf, "events"), by="event_type")


def q_distinct_flags(spark, sf):
    return agg.distinct_flags(fx.table(spark, sf, "events"), "event_type")


def q_max_key(spark, sf):
    return agg.max_key(fx.table(spark, sf, "orders"), "o_orderkey")


def q_distinct_profile(spark, sf):
    return agg.distinct_profile(fx.table(spark, sf, "orders"),
                                ["o_custkey", "o_orderstatus", "o_orderdate"])


def q_group_collect(spark, sf):
    return agg.group_collect(fx.table(spark, sf, "nation"), "n_regionkey", "n_name",
                             "n_nationkey", sep=",")


def q_group_positions(spark, sf):
    return agg.group_positions(fx.table(spark, sf, "orders"), "o_custkey", "o_orderkey",
                               ["o_orderdate", "o_orderkey"])


# ---------------------------------------------------------------- ranking (N1, N2) and M7
def q_group_positions_written(spark, sf):
    """group_positions through Spark's range partitioner and written positions."""
    o = fx.table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey")
    out = rank.ranked(o, ["o_orderdate", "o_orderkey"], ["o_custkey"], "pos", method="range_write")
    return out.select("o_custkey", "pos", "o_orderkey")


def q_ntile_split_written(spark, sf):
    o = fx.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    total = o.count()
    r = rank.ranked(o, ["o_orderkey"], (), "__rank", total=total, method="range_write")
    return r.withColumn("tile", rank.tile_of(F.col("__rank") - 1, total, 5)).drop("__rank")


def q_ntile_split(spark, sf):
    o = fx.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return rank.ntile_split(o, 5, ["o_orderkey"])


def q_assign_keys(spark, sf):
    o = fx.table(spark, sf, "orders")
    start = agg.max_key_value(o, "o_orderkey")
    return rank.assign_surrogate_keys(o, "o_orderkey", ["o_custkey", "o_orderdate", "o_orderkey"],
                                      start=start)


def q_change_batch_u(spark, sf):
    return cdc.change_batch(fx.table(spark, sf, "orders"), "U", 5, 2, ["o_orderkey"],
                            ts_col="o_orderdate", seconds=10, id_col="o_orderpriority",
                            id_value="changed")


def q_change_batch_d(spark, sf):
    return cdc.change_batch(fx.table(spark, sf, "events"), "D", 5, 3, ["event_id"],
                            ts_col="ts", seconds=10)


def q_change_batch_i(spark, sf):
    c = fx.table(spark, sf, "customer")
    return cdc.change_batch(c, "I", 4, 1, ["c_custkey"], key_col="c_custkey",
                            start_key=agg.max_key_value(c, "c_custkey"))


QUERIES.update({
    "cast_to_schema": q_cast_to_schema,
    "cast_by_type": q_cast_by_type,
    "rescue_unexpected": q_rescue_unexpected,
    "filter_ilike": q_filter_ilike,
    "filter_not_ilike": q_filter_not_ilike,
    "replace_chain": q_replace_chain,
    "select_except": q_select_except,
    "filter_predicate": q_filter_predicate,
    "filter_key_text": q_filter_key_text,
    "union_all": q_union_all,
    "sort_limit": q_sort_limit,
    "path_stem": q_path_stem,
    "split_text": q_split_text,
    "parse_ts": q_parse_ts,
    "update_where": q_update_where,
    "delete_where": q_delete_where,
    "replace_where": q_replace_where,
    "fk_violations": q_fk_violations,
    "fk_violations_bitmap": q_fk_violations_bitmap,
    "pk_violations": q_pk_violations,
    "not_null_violations": q_not_null_violations,
    "schema_gate": q_schema_gate,
    "check_constraints": q_check_constraints,
    "expect_report": q_expect_report,
    "expect_all_or_fail": q_expect_pass,
    "row_count": q_row_count,
    "distinct_flags": q_distinct_flags,
    "max_key": q_max_key,
    "distinct_profile": q_distinct_profile,
    "group_collect": q_group_collect,
    "group_positions": q_group_positions,
    "ntile_split": q_ntile_split,
    "ntile_split_written": q_ntile_split_written,
    "group_positions_written": q_group_positions_written,
    "assign_keys": q_assign_keys,
    "change_batch_u": q_change_batch_u,
    "change_batch_d": q_change_batch_d,
    "change_batch_i": q_change_batch_i,
})


# ---------------------------------------------------------------- text ingestion
def q_parse_delimited(spark, sf):
    cust = fx.table(spark, sf, "customer")
    path = staging.stage_text(spark, staging.render_delimited(cust, key="c_custkey"), "customer-text")
    lines = src.scan_text_records(spark, path)
    fields = src.parse_delimited(lines, staging.CARET_A, cust.columns, skip_pattern="cat%")
    return casts.cast_to_schema(fields, cust.schema)


def q_load_delimited(spark, sf):
    """Delimited text -> empty table made from the customer footer ->
    positional typed load, read back."""
    cust = fx.table(spark, sf, "customer")
    path = staging.stage_text(spark, staging.render_delimited(cust, key="c_custkey"), "customer-text")
    target = scratch_path(spark, "customer-loaded")
    sink.create_empty_like(spark, f"{sf}/customer.parquet", target)
    sink.load_delimited(spark, path, target, staging.CARET_A, skip_pattern="cat%")
    return spark.read.parquet(target)


def q_scan_text_records(spark, sf):
    cust = fx.table(spark, sf, "customer")
    recs = cust.select(F.concat_ws(",", F.col("c_custkey").cast("string"), "c_name").alias("value"))
    path = staging.stage_text(spark, recs, "customer-records", line_sep=";")
    rows = src.scan_text_records(spark, path, record_sep=";").where(F.col("value") != "")
    parts = tx.split_fields("value", ",")
    return rows.select(F.try_element_at(parts, F.lit(1)).cast("bigint").alias("c_custkey"),
                       F.try_element_at(parts, F.lit(2)).alias("c_name"))


# ---------------------------------------------------------------- streams
EVENT_KEYS, EVENT_SEQ, EVENT_DELETE = "user_id", ["ts", "event_id"], "event_type = 'error'"


def q_stream_append(spark, sf):
    schema = fx.table(spark, sf, "events").schema
    root, _ = staging.stage_event_drops(spark, sf)
    out = scratch_path(spark, "events-landed")
    s = stream.stream_files(spark, f"{root}/drop_*/*.parquet", schema, max_files=2)
    stream.stream_append(s, out, scratch_path(spark, "ckpt-append"))
    return spark.read.schema(schema).parquet(out)


def q_stream_apply_flagged(spark, sf):
    """Flagged drops arriving newest first, applied as a change stream:
    sequence by order date, 'D' deletes, every other flag upserts, flag
    column left out of the table."""
    o = fx.table(spark, sf, "orders")
    stage = scratch_path(spark, "orders-flagged")
    for name, drop in staging.orders_flagged_drops(o):
        sink.write_drop(drop, f"{stage}/{name}")
    schema = spark.read.parquet(f"{stage}/*").schema
    log = scratch_path(spark, "orders-flagged-log")
    s = stream.stream_files(spark, f"{stage}/*/*.parquet", schema, max_files=1)
    stream.stream_apply_changes(s, log, scratch_path(spark, "ckpt-flagged"), "o_orderkey", "o_orderdate",
                                "delta_flg = 'D'", tiebreak=cdc.flag_rank())
    return stream.current_state(spark, log, "o_orderkey", "o_orderdate", "delta_flg = 'D'",
                                except_columns=["delta_flg"], tiebreak=cdc.flag_rank(), schema=schema)


def q_compacted_state(spark, sf):
    """A change log whose older versions are compacted into a base: the
    current state is read from base + newer versions, folding only the keys
    those versions touch."""
    ev = fx.table(spark, sf, "events")
    log = scratch_path(spark, "events-compacting-log")
    older = scratch_path(spark, "events-older")
    for i, to in ((0, log), (1, log), (0, older)):
        part = ev.where(F.col("event_id") % 3 != 0) if i == 0 else ev.where(F.col("event_id") % 3 == 0)
        stream.write_version(part, to, i, "a")
    base = spark.read.parquet(stream.compact_log(spark, older, scratch_path(spark, "events-base"),
                                                 EVENT_KEYS, EVENT_SEQ, EVENT_DELETE))
    return stream.current_state(spark, log, EVENT_KEYS, EVENT_SEQ, EVENT_DELETE, base=base, since_version=1)


def q_lookup_keys(spark, sf):
    """A change log in 64 buckets of keys with a base compacted from its first
    version: the state of the users of the ten newest events, read from the
    buckets of these users alone."""
    ev = fx.table(spark, sf, "events")
    log, older = scratch_path(spark, "events-bucket-log"), scratch_path(spark, "events-bucket-older")
    for path, versions in ((older, (0,)), (log, (1, 2))):
        stream.bucket_log(spark, path, EVENT_KEYS, 64)
        for i in versions:
            stream.write_version(ev.where(F.col("event_id") % 3 == i), path, i, "a")
    base = stream.compact_log(spark, older, scratch_path(spark, "events-bucket-base"), EVENT_KEYS, EVENT_SEQ, EVENT_DELETE)
    newest = ev.orderBy(F.desc("event_id")).limit(10).select("user_id")
    return stream.lookup_state(spark, log, newest, EVENT_SEQ, EVENT_DELETE, base_path=base)


def q_stream_rescue(spark, sf):
    """Drops of three schemas, none known beforehand, streamed into the
    expected one: one as expected, one with a column more, one with values
    that narrow.  Whatever does not fit lands in _rescued_data."""
    root = staging.stage_mixed_drops(spark, sf)
    out = scratch_path(spark, "events-rescued")
    stream.stream_land_drops(spark, f"{root}/*/*.parquet", out, scratch_path(spark, "ckpt-rescue"),
                             staging.MIXED_EXPECTED, max_files=2)
    return stream.read_log(spark, out).select("event_id", "value", F.col("_rescued_data").alias("rescued"))


def q_stream_apply_changes(spark, sf):
    schema = fx.table(spark, sf, "events").schema
    root, _ = staging.stage_event_drops(spark, sf)
    log = scratch_path(spark, "events-log")
    s = stream.stream_files(spark, f"{root}/drop_*/*.parquet", schema, max_files=1)
    stream.stream_apply_changes(s, log, scratch_path(spark, "ckpt-apply"), EVENT_KEYS, EVENT_SEQ,
                                EVENT_DELETE)
    return stream.current_state(spark, log, EVENT_KEYS, EVENT_SEQ, EVENT_DELETE, schema=schema)


# ---------------------------------------------------------------- ledger
LEDGER_NOW = "2024-02-01 00:00:00"
LOADED_NOW = "2024-02-02 00:00:00"


def _daily_ledger(spark, sf):
    root = staging.stage_daily_drops(spark, sf)
    counts = led.drop_counts(spark, root)
    ledger = led.register_files(led.empty_ledger(spark), counts, now=LEDGER_NOW)
    return led.write_ledger(ledger, scratch_path(spark, "daily-ledger"))


def _odd_days(ledger):
    return (ledger.where(F.substring("file_name", -2, 2).cast("int") % 2 == 1)
                  .select("file_name"))


def q_ledger_complete(spark, sf):
    """Drops whose names need encoding in a URI, and one without rows."""
    c = fx.table(spark, sf, "customer")
    stage = scratch_path(spark, "named-drops")
    for name, drop in (("a b+c%20.parquet_I_1", c), ("empty.parquet_U_2", c.limit(0)), ("plain.parquet_D_3", c.select("c_custkey"))):
        sink.write_drop(drop, f"{stage}/{name}")
    return led.register_files(led.empty_ledger(spark), led.drop_counts(spark, stage), now=LEDGER_NOW)


def q_load_twice(spark, sf):
    """Three drops loaded, two more registered, loaded again from the version
    that the first load committed; drops of another table stay where they are."""
    cust = fx.table(spark, sf, "customer")
    stage, root = scratch_path(spark, "customer-drops"), scratch_path(spark, "customer-table")
    first = staging.customer_flagged_drops(cust)
    for name, drop in [*first, ("customer_old.parquet_I_9", cust.withColumn("delta_flg", F.lit("I")))]:
        sink.write_drop(drop, f"{stage}/{name}")

    def load():
        arrived = F.timestamp_seconds(F.lit(1_700_000_000) + F.element_at(F.split("file_name", "_"), -1).cast("long"))
        counts = led.drop_counts(spark, f"{stage}/*").withColumn("file_arrival_timestamp", arrived)
        ledger = led.register_files(led.empty_ledger(spark), counts)
        return led.apply_pending(spark, ledger, spark.createDataFrame([], cust.schema), stage, root, "c_custkey",
                                 now=LOADED_NOW, table="customer")

    load()
    for name, drop in staging.customer_later_drops(cust):
        sink.write_drop(drop, f"{stage}/{name}")
    target, ledger = load()
    loaded = ledger.select(F.concat(F.lit("ledger:"), "file_name").alias("name"), F.col("file_loaded").cast("long").alias("key"))
    return target.select(F.col("c_name").alias("name"), F.col("c_custkey").alias("key")).unionByName(loaded)


def q_ledger_register(spark, sf):
    return _daily_ledger(spark, sf)


def q_ledger_mark(spark, sf):
    ledger = _daily_ledger(spark, sf)
    return led.mark_loaded(ledger, _odd_days(ledger), now=LOADED_NOW)


def q_ledger_pending(spark, sf):
    ledger = _daily_ledger(spark, sf)
    marked = led.mark_loaded(ledger, _odd_days(ledger), now=LOADED_NOW)
    return led.pending_files(marked).select("file_name", "file_number_of_rows")


def q_apply_pending(spark, sf):
    cust = fx.table(spark, sf, "customer")
    stage = scratch_path(spark, "customer-drops")
    for name, drop in staging.customer_flagged_drops(cust):
        sink.write_drop(drop, f"{stage}/{name}")
    counts = led.drop_counts(spark, f"{stage}/*").withColumn(
        "file_arrival_timestamp",
        F.timestamp_seconds(F.lit(1_700_000_000) + F.element_at(F.split("file_name", "_"), -1).cast("long")))
    # the drop name's suffix orders the arrivals
    ledger = led.register_files(led.empty_ledger(spark), counts)
    target = spark.createDataFrame([], cust.schema)
    final, _ = led.apply_pending(spark, ledger, target, stage, scratch_path(spark, "customer-load"),
                                 "c_custkey", load_type=cdc.INCREMENTAL, now=LOADED_NOW)
    return final


def q_stage_drop(spark, sf):
    """Raw drop with a 'newline' control column -> staged drop (flag renamed,
    doubles to bigint) registered in the ledger; returns the staged rows."""
    o = fx.table(spark, sf, "orders")
    raw = o.withColumn("newline", F.when(F.col("o_orderstatus") == "F", "U").otherwise("I"))
    stage = scratch_path(spark, "orders-stage")
    ledger, _, _ = led.stage_drop(raw, stage, "orders.parquet", led.empty_ledger(spark), now=LEDGER_NOW,
                                  cast_map={"double": "bigint"})
    names = [r.file_name for r in led.pending_files(ledger).collect()]
    return src.scan_parquet(spark, [f"{stage}/{n}" for n in names])


# ---------------------------------------------------------------- writes and layout
def q_cluster_write(spark, sf):
    path = sink.cluster_write(fx.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"],
                              scratch_path(spark, "lineitem-clustered"), files=8)
    return spark.read.parquet(path)


def q_compact(spark, sf):
    small = scratch_path(spark, "orders-small")
    fx.table(spark, sf, "orders").repartition(32).write.parquet(small)
    out = sink.compact(spark, small, scratch_path(spark, "orders-compact"), 4,
                       cluster_cols=["o_orderkey"])
    return spark.read.parquet(out)


def q_create_table_as(spark, sf):
    path = scratch_path(spark, "customer-ctas")
    sink.create_table_as(fx.table(spark, sf, "customer"), path)
    return spark.read.parquet(path)


def q_insert_positional(spark, sf):
    """Empty table from a template's footer, then a positional insert of
    the same rows rendered as text (cast back on the way in)."""
    cust_path = f"{sf}/customer.parquet"
    target = scratch_path(spark, "customer-empty")
    sink.create_empty_like(spark, cust_path, target)
    cust = fx.table(spark, sf, "customer")
    as_text = cust.select(*[F.col(c).cast("string").alias(f"col{i}") for i, c in enumerate(cust.columns)])
    sink.insert_positional(as_text, target, mode="append")
    return spark.read.parquet(target)


def q_truncate_load(spark, sf):
    target = scratch_path(spark, "customer-truncate")
    cust = fx.table(spark, sf, "customer")
    sink.create_table_as(cust, target)
    sink.truncate_load(cust.withColumn("c_name", F.concat("c_name", F.lit("!"))), target)
    return spark.read.parquet(target)


def q_append_select(spark, sf):
    target = scratch_path(spark, "orders-append")
    o = fx.table(spark, sf, "orders")
    sink.create_table_as(o.where("o_orderstatus = 'F'"), target)
    rest = o.where("o_orderstatus IS DISTINCT FROM 'F'").withColumn("o_totalprice", F.col("o_totalprice").cast("string"))
    sink.append_select(rest.select(*reversed(o.columns)), target)
    return spark.read.parquet(target)


def q_parse_delimited_rescue(spark, sf):
    """Lines whose first field begins with 'cat', some with fields to spare."""
    c = fx.table(spark, sf, "customer")
    k = F.col("c_custkey")
    line = F.concat_ws(staging.CARET_A, F.concat(F.when(k % 7 == 0, F.lit("category ")).otherwise(F.lit("")), "c_name"),
                       k.cast("string"), F.when(k % 11 == 0, F.lit("spare")), F.when(k % 22 == 0, F.lit("more")), F.lit(""))
    path = staging.stage_text(spark, c.select(line.alias("value")), "customer-spare")
    return src.parse_delimited(src.scan_text_records(spark, path), staging.CARET_A, ["name", "key"], rescue_col="spare")


def _fold_new_column(broadcast_rows):
    def q(spark, sf):
        """A base folded before, and later changes that bring a column."""
        ev = fx.table(spark, sf, "events")
        old, new = ev.where("event_id % 3 <> 0"), ev.where("event_id % 3 = 0").withColumn("note", F.concat(F.lit("n"), "event_id"))
        base = cdc.fold_changes(old, EVENT_KEYS, EVENT_SEQ, EVENT_DELETE)
        out = cdc.fold_into_base(base, new, EVENT_KEYS, EVENT_SEQ, EVENT_DELETE, broadcast_rows=broadcast_rows)
        return cdc.current_rows(out, EVENT_DELETE)
    return q


def q_stream_two_runs(spark, sf):
    """A table with a column v; two streams, and one of them once more with a
    fresh checkpoint, into one log."""
    ev = fx.table(spark, sf, "events").withColumnRenamed("user_id", "v")
    stage, log = scratch_path(spark, "two-streams"), scratch_path(spark, "two-streams-log")
    for i in range(3):
        ev.where(F.col("event_id") % 3 == i).write.parquet(f"{stage}/part_{i}/drop")
    for i, n in ((0, 0), (1, 1), (0, 2), (2, 3)):
        s = stream.stream_files(spark, f"{stage}/part_{i}/*/*.parquet", ev.schema)
        stream.stream_apply_changes(s, log, scratch_path(spark, f"two-streams-ckpt{n}"), "v", EVENT_SEQ, EVENT_DELETE)
    return stream.current_state(spark, log, "v", EVENT_SEQ, EVENT_DELETE)


def q_stream_apply_drops(spark, sf):
    """Files held against the target's columns as they arrive, then applied."""
    schema = fx.table(spark, sf, "events").schema
    root, _ = staging.stage_event_drops(spark, sf)
    log = scratch_path(spark, "events-gated-log")
    stream.stream_apply_drops(spark, f"{root}/drop_*/*.parquet", log, scratch_path(spark, "ckpt-gated"), schema,
                              EVENT_KEYS, EVENT_SEQ, EVENT_DELETE, max_files=2)
    return stream.current_state(spark, log, EVENT_KEYS, EVENT_SEQ, EVENT_DELETE, schema=schema)


def q_reconcile_by_digests(spark, sf):
    """orders against a table loaded from it with few faults: only the buckets
    of keys whose digests differ are compared row by row."""
    o = fx.table(spark, sf, "orders")
    return rec.reconcile_by_digests(o, fx.orders_loaded(o), "o_orderkey", counts=True)


def q_reconcile_duplicates(spark, sf):
    """lineitem by a key that repeats, against itself with a price changed and
    one flag's rows left out."""
    li = fx.table(spark, sf, "lineitem")
    changed = li.where("l_returnflag IS DISTINCT FROM 'R'").withColumn(
        "l_extendedprice", F.col("l_extendedprice") + F.when(F.col("l_orderkey") % 10 == 0, 1.0).otherwise(0.0))
    return rec.reconcile(li, changed, ["l_orderkey", "l_linenumber"], ["l_extendedprice"], counts=True)


def _ranked_ties(method):
    def q(spark, sf):
        """Ranking by a column with few values: how the ranks spread over them."""
        o = fx.table(spark, sf, "orders")
        r = rank.ranked(o, ["o_orderstatus"], (), "r", n_ranges=6, method=method)
        return r.groupBy("o_orderstatus").agg(F.min("r").alias("first"), F.max("r").alias("last"),
                                              F.countDistinct("r").alias("ranks"))
    return q


def q_named_tables(spark, sf):
    """The writes on catalog tables: as select, positional, by name, truncate."""
    cust = fx.table(spark, sf, "customer")
    names = [f"tw_{uuid.uuid4().hex[:12]}" for _ in range(2)]
    texts = cust.select(*[F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(cust.columns)])
    try:
        for name in names:
            sink.create_table_as(cust, name)
        sink.insert_positional(texts, names[0])
        sink.append_select(cust.select(*reversed(cust.columns)), names[0])
        sink.truncate_load(texts, names[1])
        found = src.scan_table(spark, names[0]).unionByName(src.scan_table(spark, names[1]))
        path = scratch_path(spark, "named-tables")
        found.write.parquet(path)
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    return spark.read.parquet(path)


def q_schema_drift(spark, sf):
    """Drops of three schemas against the expected one, by footers."""
    root = staging.stage_mixed_drops(spark, sf)
    drift = quality.schema_drift(spark, [f"{root}/{n}" for n in staging.MIXED_DROPS], staging.MIXED_EXPECTED)
    rows = [spark.read.parquet(f"{root}/{n}").agg(F.lit(n).alias("drop"), F.count(F.lit(1)).alias("n")) for n in staging.MIXED_DROPS]
    return drift.withColumn("drop", F.element_at(F.split("drop", "/"), -1)).join(rec.union_all(*rows), "drop")


def _file_ranges(write):
    def q(spark, sf):
        """Rows of a rewritten table, and whether its files' key ranges meet."""
        path = write(spark, sf)
        stats = sink.file_stats(spark, path, "o_orderkey")
        a, b = stats.alias("a"), stats.alias("b")
        # a handful of files: their number is the writer's parameter
        meet = a.join(F.broadcast(b), (F.col("a.file") < F.col("b.file")) & (F.col("a.min_v") < F.col("b.max_v"))
                      & (F.col("b.min_v") < F.col("a.max_v")))
        many = stats.agg((F.count(F.lit(1)) > 1).cast("long").alias("key"), F.lit("several files").alias("name"))
        return (spark.read.parquet(path).select(F.col("o_orderkey").alias("key"), F.col("o_orderpriority").alias("name"))
                .unionByName(many).unionByName(meet.agg(F.count(F.lit(1)).alias("key"), F.lit("overlaps").alias("name"))))
    return q


def _clustered_orders(spark, sf):
    return sink.cluster_write(fx.table(spark, sf, "orders"), ["o_orderkey"], scratch_path(spark, "orders-ranges"), files=6)


def _compacted_orders(spark, sf):
    small = scratch_path(spark, "orders-many")
    fx.table(spark, sf, "orders").repartition(24).write.parquet(small)
    return sink.compact(spark, small, scratch_path(spark, "orders-few"), 3, cluster_cols=["o_orderkey"])


def q_sort_by(spark, sf):
    o = shape.drop_columns(fx.table(spark, sf, "orders"), ["o_totalprice", "no_such_column"])
    return shape.sort_by(o, ["o_custkey", F.col("o_orderdate").desc(), "o_orderkey"])


def q_merged_types(spark, sf):
    """Columns of drops whose types differ, and the types they widen to."""
    return footers.merged_columns(footers.file_columns(spark, staging.stage_typed_drops(spark, sf)))


def q_stream_typed_drops(spark, sf):
    """Drops whose types are narrower, wider and of another kind than the
    table's, applied as they arrive; the log's state afterwards."""
    schema = fx.table(spark, sf, "customer").schema
    root, log = staging.stage_typed_drops(spark, sf), scratch_path(spark, "customer-typed-log")
    stream.stream_apply_drops(spark, f"{root}/*/*.parquet", log, scratch_path(spark, "ckpt-typed"), schema, "c_custkey", "c_custkey",
                              on_unexpected="rescue", max_files=2)
    return stream.current_state(spark, log, "c_custkey", "c_custkey").withColumnRenamed("_rescued_data", "rescued")


def q_load_ranges(spark, sf):
    """orders kept in key ranges, then a drop that touches few of them: the
    rows, and whether the second load wrote less than a fifth of the table."""
    o = fx.table(spark, sf, "orders")
    stage, root = scratch_path(spark, "orders-drops"), scratch_path(spark, "orders-ranges")
    total = o.count()

    def load(name, drop):
        sink.write_drop(drop, f"{stage}/{name}")
        ledger = led.register_files(led.empty_ledger(spark), led.drop_counts(spark, f"{stage}/{name}"), now=LEDGER_NOW)
        return led.apply_pending(spark, ledger, o.limit(0), stage, root, "o_orderkey", now=LOADED_NOW, range_rows=max(1, total // 40))[0]

    load("orders.parquet_I_1", o.withColumn("delta_flg", F.lit("I")))
    k, half = F.col("o_orderkey"), o.agg(F.max("o_orderkey")).first()[0] // 2
    near = o.where((k > half) & (k <= half + 30))
    after = load("orders.parquet_U_2", near.withColumn("o_orderpriority", F.lit("changed")).withColumn("delta_flg", F.when(k % 3 == 0, "D").when(k % 3 == 1, "U").otherwise("I")))
    _, path = led.committed(spark, root)
    written = spark.read.schema(o.schema).parquet(f"{path}/rows").agg(F.count(F.lit(1)).alias("n"))
    share = written.select(F.when(F.col("n") * 5 < total, F.lit("few rows written")).otherwise(F.lit("many rows written")).alias("o_orderpriority"), F.lit(-1).cast("long").alias("o_orderkey"))
    return after.select("o_orderpriority", "o_orderkey").unionByName(share)


INDEX_TEXT = """CREATE INDEX o_cust ON public.orders USING btree (o_custkey DESC NULLS LAST, lower(o_orderstatus), o_orderpriority text_pattern_ops);
drop index if exists old_one;
create unique index concurrently "o,date" on only "public"."orders" ("o_orderdate", o_custkey) where o_orderkey > (0);
CREATE INDEX ON public.customer (coalesce(c_name, '),('), c_nationkey ASC) INCLUDE (c_acctbal)"""


def q_cluster_by_indexes(spark, sf):
    """orders and customer clustered by the columns that index definitions
    name: the rows, and the columns found for each table."""
    text, out = scratch_path(spark, "index-text"), scratch_path(spark, "index-clustered")
    spark.range(1).select(F.lit(INDEX_TEXT).alias("value")).write.text(text)
    tables = {t: fx.table(spark, sf, t) for t in ("orders", "customer")}
    found = sink.cluster_by_indexes(spark, text, tables, out, 8)
    rows = [spark.read.parquet(f"{out}/{t}").select(F.lit(t).alias("table"), F.col(k).alias("key"), F.col(n).alias("name"))
            for t, k, n in (("orders", "o_orderkey", "o_orderpriority"), ("customer", "c_custkey", "c_name"))]
    columns = [(t, i, c) for t, cols in found.items() for i, c in enumerate(cols)]
    return rec.union_all(*rows, spark.createDataFrame(columns, "table string, key long, name string"))


def q_profile_drops(spark, sf):
    """Profile of events kept drop by drop (by day) and merged: rows, nulls,
    and whether the distinct estimate is within 5 % of the exact count."""
    ev = fx.table(spark, sf, "events")
    cols = ["event_id", "user_id", "event_type", "value", "ts"]
    path = scratch_path(spark, "event-profiles")
    for i in range(3):
        agg.profile_drop(ev.where(F.col("event_id") % 3 == i), cols).write.parquet(f"{path}/drop={i}")
    merged = agg.profile_counts(agg.merge_profiles(spark.read.parquet(path)))
    exact = agg.distinct_profile(ev, cols)
    long = exact.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"{c}_distinct").alias("n")) for c in cols])))
    near = F.abs(F.col("distinct_estimate") - F.col("n")) <= 0.05 * F.col("n")
    return merged.join(F.broadcast(long), "column").select("column", "n_rows", "n_nulls", near.alias("near"))  # one row for each column


def _files_met(spark, path, col):
    """Whether a filter on a tenth of the column's rows meets at most half of the files."""
    table = spark.read.parquet(path)
    low, high = (F.lit(str(x)).cast(table.schema[col].dataType) for x in table.agg(F.percentile_approx(col, [0.3, 0.4], 10_000)).first()[0])
    stats = sink.file_stats(spark, path, col).agg(F.count(F.lit(1)).alias("n"), F.count_if((F.col("max_v") >= low) & (F.col("min_v") <= high)).alias("met"))
    return stats.select((F.col("met") * 2 <= F.col("n")).cast("long").alias("key"), F.lit(f"{col} prunes").alias("name"))


def q_cluster_columns(spark, sf):
    """orders clustered on two columns: the rows, and that a filter on either
    of them skips files."""
    cols = ["o_custkey", "o_orderdate"]
    path = sink.cluster_write(fx.table(spark, sf, "orders"), cols, scratch_path(spark, "orders-interleaved"), files=64)
    rows = spark.read.parquet(path).select(F.col("o_orderkey").alias("key"), F.col("o_orderpriority").alias("name"))
    return rec.union_all(rows, *[_files_met(spark, path, c) for c in cols])


def q_compact_small(spark, sf):
    """orders as two large files and many small ones, the small ones merged:
    the rows, how many large files kept their names, and the files there are."""
    o = fx.table(spark, sf, "orders")
    path = scratch_path(spark, "orders-mixed-files")
    third = F.col("o_orderkey") % 3
    for part, n in ((o.where(third > 0), 2), (o.where(third == 0), 24)):
        part.repartition(n).write.mode("append").parquet(path)
    before = {r["path"]: r["length"] for r in spark.read.format("binaryFile").load(path).select("path", "length").collect()}
    large = sorted(before, key=before.get)[-2:]
    files = sink.compact_small(spark, path, scratch_path(spark, "orders-merged"), ["o_orderkey"], file_bytes=before[large[0]])
    counts = spark.createDataFrame([(len(set(files) & set(large)), "large kept"), (int(len(files) < 14), "few files")], "key long, name string")
    return spark.read.parquet(*files).select(F.col("o_orderkey").alias("key"), F.col("o_orderpriority").alias("name")).unionByName(counts)


QUERIES.update({
    "cluster_columns": q_cluster_columns,
    "compact_small": q_compact_small,
    "cluster_by_indexes": q_cluster_by_indexes,
    "profile_drops": q_profile_drops,
    "load_ranges": q_load_ranges,
    "merged_types": q_merged_types,
    "stream_typed_drops": q_stream_typed_drops,
    "parse_delimited_rescue": q_parse_delimited_rescue,
    "fold_new_column": _fold_new_column(2_000_000),
    "fold_new_column_large": _fold_new_column(0),
    "stream_two_runs": q_stream_two_runs,
    "stream_apply_drops": q_stream_apply_drops,
    "reconcile_duplicates": q_reconcile_duplicates,
    "reconcile_by_digests": q_reconcile_by_digests,
    "ranked_ties": _ranked_ties("bounds"),
    "ranked_ties_written": _ranked_ties("range_write"),
    "named_tables": q_named_tables,
    "schema_drift": q_schema_drift,
    "cluster_ranges": _file_ranges(_clustered_orders),
    "compact_ranges": _file_ranges(_compacted_orders),
    "sort_by": q_sort_by,
    "ledger_complete": q_ledger_complete,
    "load_twice": q_load_twice,
    "parse_delimited": q_parse_delimited,
    "load_delimited": q_load_delimited,
    "scan_text_records": q_scan_text_records,
    "stream_append": q_stream_append,
    "stream_apply_changes": q_stream_apply_changes,
    "stream_rescue": q_stream_rescue,
    "compacted_state": q_compacted_state,
    "lookup_keys": q_lookup_keys,
    "stream_apply_flagged": q_stream_apply_flagged,
    "ledger_register": q_ledger_register,
    "ledger_mark": q_ledger_mark,
    "ledger_pending": q_ledger_pending,
    "apply_pending": q_apply_pending,
    "stage_drop": q_stage_drop,
    "cluster_write": q_cluster_write,
    "compact": q_compact,
    "create_table_as": q_create_table_as,
    "insert_positional": q_insert_positional,
    "truncate_load": q_truncate_load,
    "append_select": q_append_select,
})
