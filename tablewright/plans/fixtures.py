"""Inputs derived from the driver's tables, so the Spark plan and its SQL
oracle read the same data and the work grows with the tables.

Keys of the driver tables are non-negative, so ``k % m`` is well defined and
``k + OFFSET`` never collides with an existing key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import scan_parquet

NEW_KEY = 1_000_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return scan_parquet(spark, f"{sf_dir}/{name}.parquet")


def customer_changes(customer: DataFrame, flag_col: str = "delta_flg") -> DataFrame:
    """A flagged change drop against ``customer``, by ``c_custkey % 10``:
    0 D, 1 U (name and segment changed), 2 I with a new key, 3 I on an
    existing key, 4 U on a missing key, 5 D on a missing key, 6 NULL flag on
    a missing key, 7 NULL flag on an existing key, 8 I with a NULL key,
    9 absent."""
    k = F.col("c_custkey")
    m = k % 10
    key = (F.when(m == 2, k + NEW_KEY).when(m == 4, k + 2 * NEW_KEY).when(m == 5, k + 3 * NEW_KEY)
            .when(m == 6, k + 4 * NEW_KEY).when(m == 8, F.lit(None).cast("bigint")).otherwise(k))
    name = (F.when(m == 1, F.concat(F.col("c_name"), F.lit("#u")))
             .when(m == 3, F.concat(F.col("c_name"), F.lit("#i"))).otherwise(F.col("c_name")))
    seg = (F.when(m == 1, F.lit("UPDATED")).when(m == 7, F.lit("NULLFLAG"))
            .otherwise(F.col("c_mktsegment")))
    flag = (F.when(m.isin(0, 5), F.lit("D")).when(m.isin(1, 4), F.lit("U"))
             .when(m.isin(2, 3, 8), F.lit("I")).otherwise(F.lit(None).cast("string")))
    return customer.where(m != 9).select(
        key.alias("c_custkey"), name.alias("c_name"), F.col("c_nationkey"),
        F.col("c_acctbal"), seg.alias("c_mktsegment"), flag.alias(flag_col))


def orders_old(orders: DataFrame) -> DataFrame:
    """Earlier snapshot: ``o_orderpriority`` NULL for keys % 7 in (3, 4)."""
    k = F.col("o_orderkey")
    pr = F.when((k % 7).isin(3, 4), F.lit(None).cast("string")).otherwise(F.col("o_orderpriority"))
    return orders.select(*[pr.alias(c) if c == "o_orderpriority" else F.col(c) for c in orders.columns])


def orders_new(orders: DataFrame) -> DataFrame:
    """Later snapshot: % 7 = 0 removed, = 1 priority changed, = 2 also copied
    under a new key, = 3 still NULL (unchanged), = 4 back to its value."""
    k = F.col("o_orderkey")
    m = k % 7
    pr = (F.when(m == 1, F.concat(F.col("o_orderpriority"), F.lit("*")))
           .when(m == 3, F.lit(None).cast("string")).otherwise(F.col("o_orderpriority")))
    kept = orders.where(m != 0).select(*[pr.alias(c) if c == "o_orderpriority" else F.col(c)
                                         for c in orders.columns])
    copies = orders.where(m == 2).select(*[(k + NEW_KEY).alias(c) if c == "o_orderkey" else F.col(c)
                                           for c in orders.columns])
    return kept.unionByName(copies)


def orders_loaded(orders: DataFrame) -> DataFrame:
    """A table loaded from orders with few faults: keys % 997 = 0 left out,
    = 1 with another status, = 2 also under a new key, = 3 twice."""
    k = F.col("o_orderkey")
    m = k % 997
    status = F.when(m == 1, F.concat(F.col("o_orderstatus"), F.lit("?"))).otherwise(F.col("o_orderstatus"))
    kept = orders.where(m != 0).select(*[status.alias(c) if c == "o_orderstatus" else F.col(c) for c in orders.columns])
    copies = orders.where(m == 2).select(*[(k + NEW_KEY).alias(c) if c == "o_orderkey" else F.col(c) for c in orders.columns])
    return kept.unionByName(copies).unionByName(orders.where(m == 3))
