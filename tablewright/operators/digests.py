"""Order-free digests of rows and of buckets of keys.

A row's digest is two 64-bit numbers, each the exclusive or of one hash per
column that is not NULL, seeded by the column's name.  It depends neither on
the order of the columns nor on columns that are NULL, so a column added later
does not change the digests of rows that lack it.  That two unlike rows agree
in both numbers is as likely as a clash of 128 random bits; the hash is not a
cryptographic one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..util import qcol

D0, D1 = "__d0", "__d1"
_HALF = 0xFFFFFFFF


def row_digest(cols: list[str]) -> tuple[Column, Column]:
    """Two 64-bit numbers that stand for the values of ``cols``; NULL is like
    an absent column, and with no columns both are zero."""
    def one(seed: int) -> Column:
        parts = [F.when(qcol(c).isNotNull(), F.xxhash64(F.lit(seed), F.lit(c), qcol(c))).otherwise(F.lit(0).cast("long")) for c in cols]
        return reduce(lambda a, b: a.bitwiseXOR(b), parts, F.lit(0).cast("long"))
    return one(0), one(1)


def key_hash(keys: list[str]) -> Column:
    """A 64-bit hash of a key, whose top bits choose its bucket; NULL in one
    part differs from NULL in another."""
    return row_digest(keys)[0]


def bucket_of(hashed: Column, bits: int) -> Column:
    """The bucket, of 2^bits, that a key hash belongs to: its top bits, so that
    each bucket is cut evenly by more of them."""
    return F.shiftright(hashed, 64 - bits)


def bucket_sums(rows: DataFrame, hashed: str, bits: int, by: list[str]) -> DataFrame:
    """Per bucket and ``by``: number of rows and the sums of the digests'
    32-bit halves (columns ``__n``, ``__s0`` to ``__s3``).  Sums see repeated
    rows, which an exclusive or would cancel; they are exact up to 2^31 rows of
    a bucket, and beyond that overflow is an error, not a wrong sum.  Combined
    map-side: a task sends one row per bucket, whatever the rows."""
    def low(c):
        return F.col(c).bitwiseAND(F.lit(_HALF))

    def high(c):
        return F.shiftrightunsigned(F.col(c), 32)
    halves = [low(D0), high(D0), low(D1), high(D1)]
    return rows.groupBy(*by, bucket_of(F.col(hashed), bits).alias("__bucket")).agg(
        F.count(F.lit(1)).alias("__n"), *[F.sum(h).alias(f"__s{i}") for i, h in enumerate(halves)])


def keyed(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of ``df`` and the digest of its other columns: 16 bytes a row beside the key."""
    d0, d1 = row_digest([c for c in df.columns if c not in keys])
    return df.select(*[qcol(k) for k in keys], d0.alias(D0), d1.alias(D1))


def changed_keys(old: DataFrame, new: DataFrame, keys: list[str], change_col: str, duplicate_error: str) -> DataFrame:
    """From two tables of ``keyed``: keys only in ``new`` ('I'), only in ``old``
    ('D') or with another digest ('U').  One shuffle of keys and digests.  A
    key that occurs twice in ``new`` (NULL counts as one) fails the job."""
    sides = old.withColumn("__side", F.lit(0)).unionByName(new.withColumn("__side", F.lit(1)))

    def of(side, c):
        return F.max(F.when(F.col("__side") == side, F.col(c)))
    g = sides.groupBy(*[qcol(k) for k in keys]).agg(
        F.count_if(F.col("__side") == 1).alias("__n"), *[of(side, c).alias(f"{c}_{side}") for side in (0, 1) for c in (D0, D1)])
    change = (F.when(F.col(f"{D0}_0").isNull(), "I").when(F.col("__n") == 0, "D")
              .when((F.col(f"{D0}_0") != F.col(f"{D0}_1")) | (F.col(f"{D1}_0") != F.col(f"{D1}_1")), "U"))
    keep = F.when(F.col("__n") > 1, F.raise_error(F.lit(duplicate_error)).cast("boolean")).otherwise(change.isNotNull())
    return g.where(keep).select(*[qcol(k) for k in keys], change.alias(change_col))
