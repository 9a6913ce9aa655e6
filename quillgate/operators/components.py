"""Connected components: local contraction, then alternating large-star and small-star rounds.

Every partition first ties its own edges together by union-find and hands on one edge per node (a combine before the shuffle). What is left is finished in one
task if it has at most ONE_TASK edges, which is checked; otherwise by rounds over the cluster. Either way gives the same components. Each round costs a constant number of shuffles of the edge table and the number of rounds grows with the logarithm of the graph's size. Nothing but two
counters per round reaches the driver. Hub nodes (a value held by a third of all records) are handled by attach_by_key: their rows are never gathered.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import Scratch
from .skew import attach_by_key

#: Edges finished in one task (some 100 MB), and nodes a partition ties at once.
ONE_TASK, HELD = 1_000_000, 500_000


def _tied(parent: dict) -> tuple[list, list]:
    """Each node beside the least node of its tree."""
    nodes, roots = list(parent), []
    for x in nodes:
        r = x
        while parent[r] != r:
            r = parent[r]
        while parent[x] != r:
            parent[x], x = r, parent[x]
        roots.append(r)
    return nodes, roots


def _contract(batches: Iterator[pa.RecordBatch], held: int = HELD) -> Iterator[pa.RecordBatch]:
    """Edges (a, b) to (node, least node it is tied to in this partition); nodes on their own stay as loops."""
    parent: dict = {}
    schema = None

    def given():
        nodes, roots = _tied(parent)
        return pa.RecordBatch.from_arrays([pa.array(nodes, schema.field(0).type), pa.array(roots, schema.field(0).type)], names=["a", "b"])

    for batch in batches:
        schema = batch.schema
        for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            x, y = parent.setdefault(x, x), parent.setdefault(y, y)
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            while parent[y] != y:
                parent[y] = y = parent[parent[y]]
            if x < y:
                parent[y] = x
            elif y < x:
                parent[x] = y
        if len(parent) > held:
            yield given()
            parent = {}
    if parent:
        yield given()


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The whole of at most ONE_TASK edges."""
    for b in _contract(batches, 2 * ONE_TASK):
        yield b.rename_columns(["node", "component"])


def _star(pairs: DataFrame) -> DataFrame:
    """pairs (u, v): for each u the least of u and all its v as m, and the number of its rows."""
    return pairs.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of an edge; component is the least node of its component.

    Null ends and self-loops tie nothing: a row with a null end is dropped, a self-loop still lists its node. Repeated edges count once. An empty table gives
    an empty result. Node type: any orderable type, the same for both ends.
    """
    spark = edges.sparkSession
    scratch = Scratch(spark)
    e = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a is not null and b is not null")
    kind = e.schema["a"].dataType.simpleString()
    near, seen = scratch.counted(e.mapInArrow(_contract, f"a {kind}, b {kind}"))
    if seen["n"] <= ONE_TASK:
        return near.coalesce(1).mapInArrow(_finish, f"node {kind}, component {kind}")
    first, seen = scratch.counted(near.distinct(), ties=F.count_if(F.expr("a <> b")))
    loops = first.where("a = b").select(F.col("a").alias("node"))
    now, before, total = first.where("a <> b"), None, seen["ties"]
    old = None
    for _ in range(max_rounds):
        if not total:
            break
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = attach_by_key(both.where("v > u"), _star(both), "u", "m", "n", 2 * total).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large, seen = scratch.counted(large)
        least = _star(large)
        small = attach_by_key(large, least, "u", "m", "n", seen["n"]).where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).where("a <> b").distinct()
        following, seen = scratch.counted(small, mark=F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
        scratch.drop(large, old)
        now = old = following
        if before == (seen["n"], seen["mark"]):
            break
        before, total = (seen["n"], seen["mark"]), seen["n"]
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    lone = loops.join(stars.select("node").union(roots.select("node")), "node", "left_anti").select("node", F.col("node").alias("component"))
    return stars.union(roots).union(lone)


def hub_edges(held: DataFrame, node: str, *key: str) -> DataFrame:
    """Edges (src, dst) that tie all nodes holding one key: each to the least node of the key. One edge per row, never the pairs of a group.

    Rows with a null node or a null in any key column tie nothing.
    """
    rows = held.select(F.col(node).alias("_n"), F.sha2(F.to_json(F.struct(*key)), 256).alias("u"), F.greatest(F.lit(0), *[F.col(k).isNull().cast("int") for k in key]).alias("_z"))
    rows, seen = Scratch(held.sparkSession).counted(rows.where("_n is not null and _z = 0").select("_n", "u").distinct())
    total = seen["n"]
    least = rows.groupBy("u").agg(F.min("_n").alias("m"), F.count("*").alias("n"))
    return attach_by_key(rows, least, "u", "m", "n", total).select(F.col("_n").alias("src"), F.col("m").alias("dst"))
