"""Quality gates.

Reports are DataFrames computed in one pass; gates pass the data through
unchanged and fail the job when a rule is broken.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType, StructType

from ..functions.casts import lossless, narrows
from ..sources import footers
from ..util import DEFAULT_BROADCAST_BYTES, as_list, bit_of, qcol


class SchemaMismatch(ValueError):
    """A drop or stream does not fit the target schema."""


def _stack(names: list[str], name_col: str, value_col: str) -> Column:
    pairs = ", ".join(f"'{n.replace(chr(39), chr(39) * 2)}', `__v{i}`" for i, n in enumerate(names))
    return F.expr(f"stack({len(names)}, {pairs}) AS (`{name_col}`, `{value_col}`)")


def _one_pass_report(df: DataFrame, names: list[str], counts: list[Column],
                     name_col: str, value_col: str) -> DataFrame:
    """One aggregate row (partial + final), then one row per rule."""
    agg = df.agg(*[c.alias(f"__v{i}") for i, c in enumerate(counts)])
    return agg.select(_stack(names, name_col, value_col))


def not_null_violations(df: DataFrame, cols) -> DataFrame:
    """Per column of ``cols``: number of NULL rows (column_name, null_rows)."""
    cols = as_list(cols)
    return _one_pass_report(df, cols, [F.count_if(qcol(c).isNull()) for c in cols],
                            "column_name", "null_rows")


def pk_violations(df: DataFrame, key) -> DataFrame:
    """Key values that are NULL (any part) or occur more than once, with
    their row count.  The count is combined map-side, so a hot key costs one
    row per task in the shuffle."""
    key = as_list(key)
    any_null = reduce(lambda a, b: a | b, [qcol(k).isNull() for k in key])
    return (df.groupBy(*[qcol(k) for k in key]).agg(F.count(F.lit(1)).alias("n"))
              .where((F.col("n") > 1) | any_null))


def fk_violations(child: DataFrame, key, parent: DataFrame, parent_key=None) -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent row (NOT EXISTS).
    A left anti join against the parent's distinct keys: a hot parent key
    collapses map-side, AQE splits a hot child key, and Spark broadcasts the
    parent keys only when its size estimate is under the broadcast
    threshold."""
    key = as_list(key)
    parent_key = as_list(parent_key) or key
    pk = parent.select(*[qcol(p).alias(f"__pk{i}") for i, p in enumerate(parent_key)]).distinct()
    cond = reduce(lambda a, b: a & b,
                  [qcol(k) == F.col(f"__pk{i}") for i, k in enumerate(key)])
    not_null = reduce(lambda a, b: a & b, [qcol(k).isNotNull() for k in key])
    return child.where(not_null).join(pk, cond, "left_anti")


#: Keys and bytes of one bitmap of Spark's bitmap aggregates.
BITMAP_KEYS, BITMAP_BYTES = 32_768, 4_096


def fk_violations_by_bitmap(child: DataFrame, key: str, parent: DataFrame, parent_key: str | None = None,
                            broadcast_bytes: int | None = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """The rows of ``fk_violations`` for one whole-number key, without moving
    the child: the parent's keys become bitmaps, one bit a key in buckets of
    32,768, and the child is filtered against them where it is read.

    The bitmaps are broadcast if the parent's lowest and highest key prove
    that they fit ``broadcast_bytes`` (256 MiB hold a range of two billion
    keys); that pass runs when this is called.  A wider range, another key
    type or no bound goes to ``fk_violations``.  The parent's keys are made
    distinct before they meet in buckets, so a frequent one does no harm."""
    parent_key = parent_key or key
    whole = (ByteType, ShortType, IntegerType, LongType)
    if not (isinstance(child.schema[key].dataType, whole) and isinstance(parent.schema[parent_key].dataType, whole)):
        return fk_violations(child, key, parent, parent_key)
    keys = parent.select(qcol(parent_key).cast("long").alias("__pk")).where("__pk IS NOT NULL")
    ends = keys.agg(F.min("__pk").alias("low"), F.max("__pk").alias("high")).first()
    if ends["low"] is None:
        return child.where(qcol(key).isNotNull())
    if ((ends["high"] - ends["low"]) // BITMAP_KEYS + 2) * BITMAP_BYTES > (broadcast_bytes or 0):
        return fk_violations(child, key, parent, parent_key)
    k = qcol(key).cast("long")
    bits = (keys.distinct().withColumn("__bucket", F.bitmap_bucket_number("__pk")).repartition("__bucket")
            .groupBy("__bucket").agg(F.bitmap_construct_agg(F.bitmap_bit_position("__pk")).alias("__bits")))
    hit = (F.bitmap_bucket_number(k) == F.col("__bucket")) & bit_of(F.col("__bits"), k)
    return child.where(qcol(key).isNotNull()).join(F.broadcast(bits), hit, "left_anti")


def check_constraints(df: DataFrame, primary_key=None, not_null=(), foreign_keys: dict | None = None
                      ) -> DataFrame:
    """A table's declared contract checked as one report, one row per
    constraint: (constraint, kind, violations).

    * ``not_null``: rows with NULL in each column (one aggregation pass);
    * ``primary_key``: rows whose key is NULL or occurs more than once;
    * ``foreign_keys``: {name: (child key, parent DataFrame, parent key)} -
      child rows whose non-NULL key has no parent row."""
    parts = []
    nn = as_list(not_null)
    if nn:
        parts.append(not_null_violations(df, nn).select(
            F.concat(F.col("column_name"), F.lit("_not_null")).alias("constraint"),
            F.lit("not_null").alias("kind"), F.col("null_rows").alias("violations")))
    if primary_key:
        pk = as_list(primary_key)
        parts.append(pk_violations(df, pk).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations"))
                     .select(F.lit("_".join(pk) + "_pk").alias("constraint"),
                             F.lit("primary_key").alias("kind"), F.col("violations").cast("long")))
    for name, (key, parent, parent_key) in (foreign_keys or {}).items():
        parts.append(fk_violations(df, key, parent, parent_key)
                     .agg(F.count(F.lit(1)).alias("violations"))
                     .select(F.lit(name).alias("constraint"), F.lit("foreign_key").alias("kind"),
                             F.col("violations")))
    if not parts:
        raise ValueError("check_constraints: nothing to check")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _fields(schema: StructType | DataFrame, ignore) -> list[tuple[str, str]]:
    if isinstance(schema, DataFrame):
        schema = schema.schema
    ig = set(as_list(ignore))
    return [(f.name, f.dataType.simpleString()) for f in schema.fields if f.name not in ig]


def schema_report_rows(df: DataFrame, target: StructType | DataFrame, ignore=()) -> list[tuple]:
    """Per column: (column, src_pos, tgt_pos, src_type, tgt_type, status) with
    status one of ok, moved, type, source_only, target_only.  Positions are
    1-based after removing ``ignore`` columns."""
    src = _fields(df, ignore)
    tgt = _fields(target, ignore)
    s_pos = {n: (i + 1, t) for i, (n, t) in enumerate(src)}
    t_pos = {n: (i + 1, t) for i, (n, t) in enumerate(tgt)}
    rows = []
    for n in list(t_pos) + [n for n in s_pos if n not in t_pos]:
        sp, st = s_pos.get(n, (None, None))
        tp, tt = t_pos.get(n, (None, None))
        if sp is None:
            status = "target_only"
        elif tp is None:
            status = "source_only"
        elif st != tt:
            status = "type"
        elif sp != tp:
            status = "moved"
        else:
            status = "ok"
        rows.append((n, sp, tp, st, tt, status))
    return rows


def schema_report(spark: SparkSession, df: DataFrame, target, ignore=()) -> DataFrame:
    """``schema_report_rows`` as a DataFrame (one row per column)."""
    return spark.createDataFrame(
        schema_report_rows(df, target, ignore),
        "column string, src_pos int, tgt_pos int, src_type string, tgt_type string, status string")


def schema_gate(df: DataFrame, target, ignore=(), ordered: bool = True,
                check_types: bool = False, fitting: bool = False) -> DataFrame:
    """Stop a drop or stream whose columns do not match the target: the same
    names (symmetric difference empty), and with ``ordered`` the same
    positions.  ``check_types`` asks for the same types; with ``fitting``, a
    type will do that the target's widens, or a number type whose values may
    fit (``casts.fit`` then looks at each).  Returns ``df`` unchanged when it
    passes."""
    own = {f.name: f.dataType for f in df.schema.fields}
    wanted = {f.name: f.dataType for f in (target.schema if isinstance(target, DataFrame) else target).fields}
    bad = []
    for n, sp, tp, st, tt, status in schema_report_rows(df, target, ignore):
        if status in ("source_only", "target_only"):
            bad.append((n, status))
        elif status == "moved" and ordered:
            bad.append((n, f"position {sp} != {tp}"))
        if sp and tp and st != tt and (check_types or fitting):
            if not (fitting and (lossless(own[n], wanted[n]) or narrows(own[n], wanted[n]))):
                bad.append((n, f"type {st} != {tt}"))
    if bad:
        raise SchemaMismatch("schema_gate: " + ", ".join(f"{n}: {s}" for n, s in bad))
    return df


def schema_drift(spark: SparkSession, drops, target, ignore=()) -> DataFrame:
    """Per drop and column: the ``schema_report`` status against the target
    (drop, column, src_pos, tgt_pos, src_type, tgt_type, status).

    Footers are read by tasks (``sources.footers``), of every file of every
    drop; a column that a drop's files hold in several types has the one they
    widen to, or the listed types if they meet in none.  Positions are those of
    the drop's columns without the ignored ones."""
    tgt = [(n, i + 1, t) for i, (n, t) in enumerate(_fields(target, ignore))]
    seen = footers.file_columns(spark, list(drops)).where(~F.col("column").isin(as_list(ignore)) if as_list(ignore) else F.lit(True))
    kinds = footers.merged_columns(seen, by=["root"])
    place = Window.partitionBy("root").orderBy("first")  # one drop's columns
    first = seen.groupBy("root", "column").agg(F.min("position").alias("first")).withColumn("src_pos", F.row_number().over(place))
    src = kinds.join(first, ["root", "column"]).select("root", "column", "src_pos", F.coalesce("merged_type", "types").alias("src_type"))
    roots = spark.createDataFrame([(d,) for d in drops], "root string")
    wanted = spark.createDataFrame(tgt, "column string, tgt_pos int, tgt_type string")
    # the drops' names and the target's columns: schema lists, every drop beside every column of the target
    grid = roots.select("root", F.explode(F.array(*[F.lit(n) for n, _, _ in tgt])).alias("column")).join(F.broadcast(wanted), "column") if tgt \
        else roots.limit(0).select("root", F.lit("").alias("column"), F.lit(0).alias("tgt_pos"), F.lit("").alias("tgt_type"))
    both = grid.join(src, ["root", "column"], "full")
    status = (F.when(F.col("src_pos").isNull(), "target_only").when(F.col("tgt_pos").isNull(), "source_only")
              .when(F.col("src_type") != F.col("tgt_type"), "type").when(F.col("src_pos") != F.col("tgt_pos"), "moved").otherwise("ok"))
    return both.select(F.col("root").alias("drop"), "column", "src_pos", "tgt_pos", "src_type", "tgt_type", status.alias("status"))


def conform(df: DataFrame, target, ignore=()) -> DataFrame:
    """Gate by names only, then reorder ``df`` to the target's column order
    (ignored columns kept at the end)."""
    schema_gate(df, target, ignore, ordered=False)
    names = [n for n, _ in _fields(target, ignore)]
    rest = [c for c in df.columns if c not in names]
    return df.select(*[qcol(c) for c in names + rest])


def _rule(expr) -> Column:
    return F.expr(expr) if isinstance(expr, str) else expr


def expect_all_or_fail(df: DataFrame, rules: dict) -> DataFrame:
    """Pass rows through; the job fails on the first row for which a rule is
    false or NULL, naming the rule.  Works on batch and streaming frames."""
    cond = None
    for name, r in rules.items():
        check = F.assert_true(F.coalesce(_rule(r), F.lit(False)), F.lit(f"expectation failed: {name}"))
        cond = check.isNull() if cond is None else (cond & check.isNull())
    return df if cond is None else df.where(cond)


def expect_report(df: DataFrame, rules: dict) -> DataFrame:
    """Per rule: rows for which it is false or NULL (rule, failed_rows);
    one aggregation pass for all rules."""
    names = list(rules)
    counts = [F.count_if(~F.coalesce(_rule(rules[n]), F.lit(False))) for n in names]
    return _one_pass_report(df, names, counts, "rule", "failed_rows")


def expect_drop(df: DataFrame, rules: dict) -> DataFrame:
    """Keep only rows passing every rule (false or NULL drops the row)."""
    cond = reduce(lambda a, b: a & b, [F.coalesce(_rule(r), F.lit(False)) for r in rules.values()])
    return df.where(cond)
