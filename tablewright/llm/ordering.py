"""Positions in a global order, without putting all rows into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import shuffle_partitions, written


def positions(df: DataFrame, *order: Column, name: str = "position") -> DataFrame:
    """``df`` with each row's place, from 0, in the order given.

    Spark cuts the order into ranges by sampling; rows are sorted within each
    range, written once together with range and place, and the ranges' counts
    (one number for each range) give what comes before.  Rows equal in ``order``
    are told apart by their place in the input, so many of them span ranges."""
    ranges = 4 * shuffle_partitions(df.sparkSession)
    order = (*order, F.col("__row"))
    spread = (df.withColumn("__row", F.monotonically_increasing_id()).repartitionByRange(ranges, *order).sortWithinPartitions(*order).drop("__row")
              .withColumn("__range", F.spark_partition_id())
              .withColumn("__place", F.monotonically_increasing_id()))
    spread = written(spread, "ordered")
    # monotonically_increasing_id counts up by one within a partition
    counts = spread.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"), F.min("__place").alias("__first"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    starts = counts.select("__range", "__first", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    return (spread.join(F.broadcast(starts), "__range")  # as many rows as there are ranges
            .withColumn(name, F.col("__before") + F.col("__place") - F.col("__first"))
            .drop("__range", "__place", "__first", "__before"))
