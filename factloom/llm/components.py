"""Connected components of a graph given as edges, by alternating stars."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from factloom.llm.common import cut, lean

#: Nodes of edges that a task holds at once, about 200 bytes each.
NODES = 300_000


class Forest:
    """Union-find over any hashable items; the root of a tree is its smallest item."""

    def __init__(self):
        self.up: dict = {}

    def find(self, x):
        up = self.up
        root = x
        while (y := up.get(root, root)) != root:
            root = y
        while x != root:
            up[x], x = root, up.get(x, x)
        return root

    def union(self, a, b) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        if b < a:
            a, b = b, a
        self.up.setdefault(a, a)
        self.up[b] = a
        return True


def spanning(edges: DataFrame) -> DataFrame:
    """Each partition's edges as stars with the same components: (a, b) with b < a."""
    kind = edges.schema["a"].dataType
    item = to_arrow_type(kind)

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()

        def told() -> Iterator[pa.RecordBatch]:
            nodes = [x for x in forest.up if forest.find(x) != x]
            for i in range(0, len(nodes), 50_000):
                part = nodes[i : i + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(part, item), pa.array([forest.find(x) for x in part], item)], names=["a", "b"])

        for batch in found:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                forest.union(a, b)
            if len(forest.up) > NODES:
                yield from told()
                forest.up.clear()
        yield from told()

    return edges.select("a", "b").mapInArrow(lean(run), f"a {kind.simpleString()}, b {kind.simpleString()}")


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node with an edge other than to itself; root: the component's smallest node.
    Nodes may be of any type that has an order.

    Rounds of large and small stars: each links what is left to its smallest neighbour, until all edges
    point from a node to its root. An edge table is written each round, so lineage stays short.
    """

    def links(e: DataFrame, both: bool) -> DataFrame:
        ends = e.select(F.col("a").alias("u"), F.col("b").alias("v"))
        return ends.unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v"))) if both else ends

    def state(e: DataFrame):
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now = cut(edges.filter(F.col("a") != F.col("b")).select("a", "b"), "edges")  # the task that made them ends before the next worker starts
    now = cut(spanning(now), "edges")
    seen = state(now)
    if not seen[0]:
        return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    for _ in range(rounds):
        # large star: neighbours above u go to the smallest of u and its neighbours
        e = links(now, True)
        low = e.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = e.filter("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        # small star: u and its smaller neighbours go to the smallest of them
        e = links(large, False)
        low = e.groupBy("u").agg(F.min("v").alias("m"))
        small = e.join(low, "u").filter("v != m").select(F.col("v").alias("a"), F.col("m").alias("b"))
        now = cut(small.unionByName(low.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct(), "edges")
        if (new := state(now)) == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = new
    raise RuntimeError("components did not settle")
