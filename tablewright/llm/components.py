"""Connected components of edges between binary ids, in Spark."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import beside_group, written

#: Edges that a task joins before it hands on what connects them.
LOCAL_EDGES = 500_000


class Forest:
    """Union-find over hashable ids; a root is the smallest id of its tree."""

    def __init__(self):
        self.parent: dict = {}

    def find(self, x):
        parent = self.parent
        root = x
        while (up := parent.get(root, root)) != root:
            root = up
        while x != root:
            parent[x], x = root, parent.get(x, x)
        return root

    def join(self, x, y) -> bool:
        """Whether this joined two trees."""
        x, y = self.find(x), self.find(y)
        if x == y:
            return False
        parent = self.parent
        lo, hi = (x, y) if x < y else (y, x)
        parent[hi] = lo
        parent.setdefault(lo, lo)
        return True


def _shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges from each id to the smallest id that a task's edges connect it with."""
    forest = Forest()

    def out() -> pa.RecordBatch:
        u = [x for x in forest.parent if forest.find(x) != x]
        return pa.RecordBatch.from_arrays([pa.array(u, pa.binary()), pa.array([forest.find(x) for x in u], pa.binary())], ["u", "v"])

    for b in batches:
        for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            forest.join(x, y)
        if len(forest.parent) > LOCAL_EDGES:
            yield out()
            forest = Forest()
    yield out()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every id in the edges (its first two columns,
    binary), where component is the smallest id that edges lead to.

    Tasks shrink their edges to trees, then rounds of large and small stars
    (each id's neighbours are linked with the smallest of them) flatten the
    trees until nothing changes; every round is written to the shared folder.
    An id with very many neighbours is spread over tasks."""
    u, v = edges.columns[:2]
    trees = edges.select(F.col(u).alias("u"), F.col(v).alias("v")).where("u != v").mapInArrow(_shrink, "u binary, v binary")
    current, before = written(trees, "edges"), None
    while True:
        state = current.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("s")).first()
        if not state["n"] or state == before:
            break
        before = state
        both = current.union(current.select("v", "u"))
        large = (beside_group(both, ["u"], F.col("v"), {"m": (F.min("v"), F.min)})
                 .where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())
        down = beside_group(large, ["u"], F.col("v"), {"m": (F.min("v"), F.min)})
        small = down.select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")),
                                              F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        current = written(small.select("e.u", "e.v").where("u != v").distinct(), "edges")
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
