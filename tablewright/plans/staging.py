"""Stage files derived from the driver's tables (text renderings, change
drops, daily drops) under the session's checkpoint root, for the queries
that exercise file sources, streams, the ledger and table writes.  Every
staging step is a distributed write of data Spark derives from the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ..session import scratch_path
from . import fixtures as fx

# Fixed value: the two-character field separator of the delimited text drops
# (a caret followed by A, as written by the source system).
CARET_A = "^A"


def render_delimited(df: DataFrame, sep: str = CARET_A, header_every: int = 500,
                     blank_every: int = 50, key: str | None = None) -> DataFrame:
    """Text lines ``v1<sep>v2<sep>...<sep>`` (one trailing empty field), plus
    a header line beginning 'Cat' and a blank line every ``header_every`` /
    ``blank_every`` rows of ``key``."""
    key = key or df.columns[0]
    line = F.concat_ws(sep, *[F.col(c).cast("string") for c in df.columns], F.lit(""))
    data = df.select(line.alias("value"))
    k = F.col(key)
    header = F.concat_ws(sep, F.lit("Catalog header"), *[F.lit(c) for c in df.columns], F.lit(""))
    headers = df.where(k % header_every == 0).select(header.alias("value"))
    blanks = df.where(k % blank_every == 0).select(F.lit("").alias("value"))
    return data.unionByName(headers).unionByName(blanks)


def stage_text(spark: SparkSession, lines: DataFrame, label: str, line_sep: str | None = None) -> str:
    path = scratch_path(spark, label)
    w = lines.write.mode("overwrite")
    if line_sep is not None:
        w = w.option("lineSep", line_sep)
    w.text(path)
    return path


def stage_event_drops(spark: SparkSession, sf_dir: str, n: int = 4) -> tuple[str, list[str]]:
    """``events`` cut into ``n`` drops by ``event_id % n``, written in the
    order n-1, ..., 0; every drop spans the whole time range, so later drops
    carry older changes than earlier ones (out-of-order arrival)."""
    ev = fx.table(spark, sf_dir, "events")
    root = scratch_path(spark, "event-drops")
    names = []
    for i in reversed(range(n)):
        name = f"drop_{n - 1 - i:03d}"
        ev.where(F.col("event_id") % n == i).write.mode("overwrite").parquet(f"{root}/{name}")
        names.append(name)
    return root, names


def stage_daily_drops(spark: SparkSession, sf_dir: str) -> str:
    """``events`` cut into one drop directory per day (``day=YYYY-MM-DD``)."""
    ev = fx.table(spark, sf_dir, "events")
    root = scratch_path(spark, "daily-drops")
    (ev.withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
       .repartition("day").write.mode("overwrite").partitionBy("day").parquet(root))
    return root


def customer_flagged_drops(customer: DataFrame, flag: str = "delta_flg") -> list[tuple[str, DataFrame]]:
    """Three flagged drops against an empty customer table, in arrival order:
    1 every customer as 'I'; 2 'U' for key % 5 = 1 (name changed); 3 'D' for
    key % 5 = 2 and 'I' copies of key % 5 = 3 under new keys."""
    k = F.col("c_custkey")
    cols = customer.columns
    d1 = customer.withColumn(flag, F.lit("I"))
    d2 = (customer.where(k % 5 == 1)
          .withColumn("c_name", F.concat(F.col("c_name"), F.lit("#2"))).withColumn(flag, F.lit("U")))
    d3 = (customer.where(k % 5 == 2).withColumn(flag, F.lit("D"))
          .unionByName(customer.where(k % 5 == 3)
                       .select(*[(k + fx.NEW_KEY).alias(c) if c == "c_custkey" else F.col(c) for c in cols])
                       .withColumn(flag, F.lit("I"))))
    return [("customer.parquet_I_1", d1), ("customer.parquet_U_2", d2), ("customer.parquet_D_3", d3)]


def orders_flagged_drops(orders: DataFrame, flag: str = "delta_flg") -> list[tuple[str, DataFrame]]:
    """Flagged change drops for ``orders`` with the order date as sequence,
    listed in *reverse* arrival order (deletes first): 'I' for every order;
    'U' one day later for key % 5 = 1 (priority changed); 'D' two days
    later for key % 5 = 2."""
    k = F.col("o_orderkey")
    day = F.expr("INTERVAL 1 DAY")
    ins = orders.withColumn(flag, F.lit("I"))
    upd = (orders.where(k % 5 == 1)
           .withColumn("o_orderdate", F.col("o_orderdate") + day)
           .withColumn("o_orderpriority", F.concat(F.col("o_orderpriority"), F.lit("+")))
           .withColumn(flag, F.lit("U")))
    dele = (orders.where(k % 5 == 2)
            .withColumn("o_orderdate", F.col("o_orderdate") + day + day)
            .withColumn(flag, F.lit("D")))
    return [("orders.parquet_D_3", dele), ("orders.parquet_U_2", upd), ("orders.parquet_I_1", ins)]


def customer_later_drops(customer: DataFrame, flag: str = "delta_flg") -> list[tuple[str, DataFrame]]:
    """Two drops that arrive after ``customer_flagged_drops``: 4 'U' for key %
    5 = 3 and 'I' again for the deleted key % 5 = 2; 5 'D' for key % 10 = 4 and
    'U' for key % 10 = 2 (rows that drop 4 inserted)."""
    k = F.col("c_custkey")

    def named(rows, mark, f):
        return rows.withColumn("c_name", F.concat(F.col("c_name"), F.lit(mark))).withColumn(flag, F.lit(f))
    d4 = named(customer.where(k % 5 == 3), "#4", "U").unionByName(named(customer.where(k % 5 == 2), "#back", "I"))
    d5 = named(customer.where(k % 10 == 4), "", "D").unionByName(named(customer.where(k % 10 == 2), "#5", "U"))
    return [("customer.parquet_U_4", d4), ("customer.parquet_D_5", d5)]


# The expected columns of the mixed drops, and the drops' names.
MIXED_EXPECTED = StructType([StructField("event_id", LongType()), StructField("value", IntegerType())])
MIXED_DROPS = ("as_expected", "column_more", "narrowing")


def stage_mixed_drops(spark: SparkSession, sf_dir: str) -> str:
    """``events`` as three drops of different schemas: the expected one, one
    with a column more, and one whose values an int cannot hold."""
    ev = fx.table(spark, sf_dir, "events").select("event_id", "event_type", F.round("value", 2).cast("decimal(18,2)").alias("value"))
    root = scratch_path(spark, "mixed-drops")
    whole = F.floor("value").cast("int").alias("value")
    parts = (ev.select("event_id", whole), ev.select("event_id", whole, "event_type"), ev.select("event_id", "value"))
    for i, (name, part) in enumerate(zip(MIXED_DROPS, parts)):
        part.where(F.col("event_id") % 3 == i).write.parquet(f"{root}/{name}")
    return root


def stage_typed_drops(spark: SparkSession, sf_dir: str) -> str:
    """``customer`` as three drops of one file whose types differ: a key that
    is an int, a nation that is a bigint, and a balance that is text, for some
    rows with a currency behind the number."""
    c = fx.table(spark, sf_dir, "customer").withColumn("c_acctbal", F.round("c_acctbal", 2).cast("decimal(18,2)").cast("double"))
    k = F.col("c_custkey")
    money = F.concat(F.col("c_acctbal").cast("decimal(18,2)").cast("string"), F.when(k % 2 == 0, F.lit(" EUR")).otherwise(F.lit("")))
    root = scratch_path(spark, "typed-drops")
    for i, (name, typed) in enumerate((("narrowed", c.withColumn("c_custkey", k.cast("int"))), ("widened", c.withColumn("c_nationkey", F.col("c_nationkey").cast("bigint"))),
                                       ("clashing", c.withColumn("c_acctbal", money)))):
        typed.where(k % 3 == i).coalesce(1).write.parquet(f"{root}/{name}")
    return root
