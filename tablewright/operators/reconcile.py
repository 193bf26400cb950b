"""Source-to-target reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from ..util import DEFAULT_BROADCAST_BYTES, DEFAULT_BROADCAST_ROWS, as_list, fits_broadcast, qcol
from . import digests
from .cdc import pair_by_key

MISSING = "missing"      # in source, not in target
EXTRA = "extra"          # in target, not in source
DIFFERENT = "different"  # both, some compared column differs
EQUAL = "equal"
DUPLICATE = "duplicate"  # the key occurs more than once on one side


def union_all(*dfs: DataFrame, allow_missing: bool = False) -> DataFrame:
    """UNION ALL by column name."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=allow_missing)
    return out


def reconcile(source: DataFrame, target: DataFrame, keys, cols=None,
              status_col: str = "status", counts: bool = False) -> DataFrame:
    """Per key: ``missing`` / ``extra`` / ``different`` / ``equal`` between
    a source and the table loaded from it, or ``duplicate`` when the key (NULL
    counts as one) occurs more than once on a side.  ``cols`` (default: all
    non-key columns of the source) are compared null-safely.  ``counts`` adds
    n_source and n_target, the key's rows on each side.  Keys are lined up by
    one per-key aggregate (``cdc.pair_by_key``): no pairs are emitted, and a
    key with very many rows is combined before rows move."""
    keys = as_list(keys)
    cols = [c for c in (as_list(cols) or source.columns) if c not in keys]
    j = pair_by_key(source, target, keys, cols, "__s", "__t", report=True)
    status = (F.when((F.col("__nl") > 1) | (F.col("__nr") > 1), F.lit(DUPLICATE))
               .when(F.col("__nr") == 0, F.lit(MISSING))
               .when(F.col("__nl") == 0, F.lit(EXTRA))
               .when(F.equal_null(F.col("__s"), F.col("__t")), F.lit(EQUAL))
               .otherwise(F.lit(DIFFERENT)))
    more = [F.col("__nl").alias("n_source"), F.col("__nr").alias("n_target")] if counts else []
    return j.select(*[qcol(k) for k in keys], status.alias(status_col), *more)


#: Bits of the bucket number that each level of digests adds.
LEVEL_BITS = 16
#: Levels at most.
LEVELS = 3
#: So few rows in unlike buckets are not worth another pass over both tables.
FEW_ROWS = 1_000_000


def reconcile_by_digests(source: DataFrame, target: DataFrame, keys, cols=None, status_col: str = "status", counts: bool = False,
                         unique_keys: bool = False, level_bits: int = LEVEL_BITS, levels: int = LEVELS, few_rows: int = FEW_ROWS,
                         broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS, broadcast_bytes: int | None = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """The rows of ``reconcile``, for tables that are mostly alike: only rows in
    buckets of keys whose digests differ are shuffled and compared.

    Level by level, keys are cut into 2^level_bits times as many buckets by
    their hash; per bucket and side, rows are counted and their digests
    (``digests.row_digest``) summed, combined map-side.  A level looks only at
    rows of the buckets that differed in the one before.  Levels end when at
    most ``few_rows`` rows are left, when most rows are, when more unlike
    buckets are found than may be broadcast, or after ``levels``.  Keys of the
    buckets that agree are ``equal`` as they are, straight from the source's
    scan; the others go through ``reconcile``.  If most rows lie in unlike
    buckets, or their list is too large, everything does.

    Sums cannot tell that a key occurs twice alike on both sides.  Unless the
    caller knows that keys are unique (``unique_keys``, for instance a checked
    primary key), hashes of the keys, 8 bytes a row, are counted, and buckets
    of repeated ones count as unlike.  With ``unique_keys``, a key that does
    repeat alike on both sides is reported ``equal`` once per row.

    The passes for the digests run when this is called; they read both inputs
    once a level."""
    keys = as_list(keys)
    cols = [c for c in (as_list(cols) or source.columns) if c not in keys]
    spark = source.sparkSession
    d0, d1 = digests.row_digest([*keys, *cols])

    def sided(df, side):
        return df.select(*[qcol(c) for c in [*keys, *cols]], F.lit(side).alias("__side"))
    both = (sided(source, 0).unionByName(sided(target, 1))  # the union gives both sides one type
            .select("*", digests.key_hash(keys).alias("__hash"), d0.alias(digests.D0), d1.alias(digests.D1)))

    def everything():
        return reconcile(source, target, keys, cols, status_col, counts)

    def kept(df, label):
        path = scratch_path(spark, label)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    twice = None
    if not unique_keys:
        twice = kept(both.groupBy("__side", "__hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("__hash"), "repeated-keys")
        if not fits_broadcast(twice, broadcast_rows, broadcast_bytes):
            return everything()

    bits, unlike = 0, None
    for level in range(1, levels + 1):
        next_bits = level * level_bits
        rows = both if unlike is None else both.join(F.broadcast(unlike), digests.bucket_of(F.col("__hash"), bits) == F.col("__unlike"), "left_semi")
        sign = F.when(F.col("__side") == 0, F.lit(1)).otherwise(F.lit(-1))
        sums = digests.bucket_sums(rows, "__hash", next_bits, ["__side"])
        against = sums.groupBy("__bucket").agg(F.sum("__n").alias("__rows"), *[F.sum(F.col(c) * sign).alias(c)
                                                                               for c in ("__n", "__s0", "__s1", "__s2", "__s3")])
        if twice is not None:
            at = twice.select(digests.bucket_of(F.col("__hash"), next_bits).alias("__bucket")).distinct().withColumn("__twice", F.lit(True))
            against = against.join(F.broadcast(at), "__bucket", "left")
        differs = F.coalesce(F.col("__twice"), F.lit(False)) if twice is not None else F.lit(False)
        for c in ("__n", "__s0", "__s1", "__s2", "__s3"):
            differs = differs | (F.col(c) != 0)
        found = kept(against.select("__bucket", "__rows", differs.alias("__differs")), "bucket-digests")
        seen = found.agg(F.coalesce(F.sum("__rows"), F.lit(0)).alias("all"),
                         F.coalesce(F.sum(F.when(F.col("__differs"), F.col("__rows"))), F.lit(0)).alias("left")).first()
        new = found.where("__differs").select(F.col("__bucket").alias("__unlike"))
        if not fits_broadcast(new, broadcast_rows, broadcast_bytes):
            break  # the level before, if any, still holds
        bits, unlike = next_bits, new
        if seen["left"] <= few_rows or 2 * seen["left"] > seen["all"]:
            if level == 1 and seen["left"] and 2 * seen["left"] > seen["all"]:
                return everything()
            break
    if unlike is None:
        return everything()

    one = [F.lit(1).cast("long").alias(c) for c in ("n_source", "n_target")] if counts else []

    def equal(rows):
        return rows.where(F.col("__side") == 0).select(*[qcol(k) for k in keys], F.lit(EQUAL).alias(status_col), *one)
    if unlike.isEmpty():
        return equal(both)
    in_unlike = digests.bucket_of(F.col("__hash"), bits) == F.col("__unlike")
    alike = equal(both.join(F.broadcast(unlike), in_unlike, "left_anti"))
    suspects = both.join(F.broadcast(unlike), in_unlike, "left_semi").select(*[qcol(c) for c in [*keys, *cols]], "__side")
    compared = reconcile(suspects.where("__side = 0").drop("__side"), suspects.where("__side = 1").drop("__side"), keys, cols, status_col, counts)
    return alike.unionByName(compared)


def reconcile_counts(source: DataFrame, target: DataFrame, keys, cols=None) -> DataFrame:
    """Row count per reconciliation status."""
    return (reconcile(source, target, keys, cols)
            .groupBy("status").agg(F.count(F.lit(1)).alias("n")))


def reconcile_rows(source: DataFrame, target: DataFrame, side_col: str = "side") -> DataFrame:
    """Unkeyed form: rows (with multiplicity) present on one side only,
    labelled ``source_only`` / ``target_only``."""
    return (source.exceptAll(target).withColumn(side_col, F.lit("source_only"))
            .unionByName(target.exceptAll(source).withColumn(side_col, F.lit("target_only"))))
