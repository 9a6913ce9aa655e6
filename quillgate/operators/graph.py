"""Graph operators over scoped edge tables (scope, src, dst)."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import Scratch
from .hierarchy import Levels
from .skew import salted_join

#: Edges of a scope that one task takes.
SCOPE_EDGES = 200_000


def cones(edges: DataFrame, roots: DataFrame, stops: DataFrame) -> DataFrame:
    """(scope, root, node, depth): nodes reached from each root against the edges (fan-in), breadth first; depth of the root is 0.

    A stop node other than the root is reached but not expanded. All roots advance together, one join per level; (scope, root, node) is the key of the anti join
    that keeps visited nodes out, so loops end. edges: (scope, src, dst); roots and stops: (scope, node).
    """
    scratch = Scratch(edges.sparkSession)
    e = scratch.save(edges.select("scope", "src", "dst").where("scope is not null and src is not null and dst is not null and src <> dst").distinct().join(stops.select("scope", F.col("node").alias("src"), F.lit(True).alias("stop")).distinct(), ["scope", "src"], "left").select("scope", "src", "dst", F.coalesce("stop", F.lit(False)).alias("stop")))
    levels = Levels(scratch, roots.select("scope", F.col("node").alias("root"), "node", F.lit(0).alias("depth"), F.lit(False).alias("stop")).distinct())
    while True:
        front = levels.last.where("not stop").select("scope", "root", F.col("node").alias("dst"), "depth")
        new = salted_join(front, e, ["scope", "dst"], levels.n).select("scope", "root", F.col("src").alias("node"), (F.col("depth") + 1).alias("depth"), "stop").distinct()
        if not levels.add(new.join(levels.all().select("scope", "root", "node"), ["scope", "root", "node"], "left_anti")):
            return levels.all().select("scope", "root", "node", "depth")


def tarjan(edges: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """(node, least node of its component) of the nodes on a loop; a node with an edge to itself only is its own. Depth first without recursion."""
    out: dict[str, list[str]] = {}
    for a, b in edges:
        out.setdefault(a, []).append(b)
    index: dict[str, int] = {}
    low: dict[str, int] = {}
    path, open_ = [], set()
    found = []
    for start in sorted(out):
        if start in index:
            continue
        index[start] = low[start] = len(index)
        path.append(start)
        open_.add(start)
        work = [(start, iter(out[start]))]
        while work:
            node, rest = work[-1]
            for nxt in rest:
                if nxt not in index:
                    index[nxt] = low[nxt] = len(index)
                    path.append(nxt)
                    open_.add(nxt)
                    work.append((nxt, iter(out.get(nxt, ()))))
                    break
                if nxt in open_:
                    low[node] = min(low[node], index[nxt])
            else:
                work.pop()
                if work:
                    low[work[-1][0]] = min(low[work[-1][0]], low[node])
                if low[node] == index[node]:
                    group = []
                    while True:
                        x = path.pop()
                        open_.discard(x)
                        group.append(x)
                        if x == node:
                            break
                    if len(group) > 1 or node in out.get(node, ()):
                        least = min(group)
                        found += [(x, least) for x in group]
    return found


def _tarjan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [(s, *r) for s, e in zip(b.column("scope").to_pylist(), b.column("e").to_pylist()) for r in tarjan([(x["src"], x["dst"]) for x in e])]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.string()) for k in range(3)], names=["scope", "node", "component"])


def _spread(edges: DataFrame, start: DataFrame, along: tuple[str, str]) -> DataFrame:
    """(scope, node, mark): the least mark that reaches each node along the edges, marks of start (scope, node, mark) included."""
    scratch = Scratch(edges.sparkSession)
    now = scratch.save(start)
    front = now
    while True:
        step = front.select("scope", F.col("node").alias(along[0]), "mark").join(edges, ["scope", along[0]]).groupBy("scope", F.col(along[1]).alias("node")).agg(F.min("mark").alias("mark"))
        better, seen = scratch.counted(step.join(now.withColumnRenamed("mark", "old"), ["scope", "node"]).where("mark < old").select("scope", "node", "mark"))
        if not seen["n"]:
            return now
        nxt = scratch.save(now.join(better.withColumnRenamed("mark", "new"), ["scope", "node"], "left").select("scope", "node", F.coalesce("new", "mark").alias("mark")))
        scratch.drop(now)
        now, front = nxt, better


def coloured_components(edges: DataFrame) -> DataFrame:
    """(scope, node, component) of nodes on a loop, for graphs of any size: every node takes the least node that reaches it as its colour, nodes of a colour that
    lead back to the node it is named after are its component, and what is left goes on. One row per node and edge at any time, no pairs of nodes."""
    scratch = Scratch(edges.sparkSession)
    e = scratch.save(edges.select("scope", "src", "dst").where("scope is not null and src is not null and dst is not null").distinct())
    out = None
    while True:
        while True:  # nodes without a way in or out are on no loop
            live = e.select("scope", F.col("src").alias("node")).intersect(e.select("scope", F.col("dst").alias("node")))
            kept, seen = scratch.counted(e.join(live.withColumnRenamed("node", "src"), ["scope", "src"], "left_semi").join(live.withColumnRenamed("node", "dst"), ["scope", "dst"], "left_semi").select("scope", "src", "dst"))
            before = e.count()
            e = kept
            if seen["n"] == before:
                break
        if not seen["n"]:
            return out if out is not None else e.select("scope", F.col("src").alias("node"), F.col("dst").alias("component"))
        nodes = e.select("scope", F.col("src").alias("node")).distinct()
        colour = _spread(e, nodes.select("scope", "node", F.col("node").alias("mark")), ("src", "dst"))
        x = e.join(colour.select("scope", F.col("node").alias("src"), F.col("mark").alias("cs")), ["scope", "src"]).join(colour.select("scope", F.col("node").alias("dst"), F.col("mark").alias("cd")), ["scope", "dst"])
        inside = scratch.save(x.where("cs = cd").select("scope", "src", "dst", F.col("cs").alias("colour")))
        back = _spread(inside.select("scope", "src", "dst"), colour.select("scope", "node", F.when(F.col("node") == F.col("mark"), F.lit(0)).otherwise(F.lit(1)).alias("mark")), ("dst", "src"))
        hit = scratch.save(back.where("mark = 0").select("scope", "node").join(colour, ["scope", "node"]).select("scope", "node", F.col("mark").alias("component")))
        size = hit.groupBy("scope", "component").agg(F.count("*").alias("n"))
        own = inside.where("src = dst").select("scope", F.col("src").alias("component"), F.lit(True).alias("self")).distinct()
        got = hit.join(size, ["scope", "component"]).join(own, ["scope", "component"], "left").where("n > 1 or self").select("scope", "node", "component")
        out = got if out is None else out.union(got)
        gone = hit.select("scope", "node")
        e = scratch.save(e.join(gone.withColumnRenamed("node", "src"), ["scope", "src"], "left_anti").join(gone.withColumnRenamed("node", "dst"), ["scope", "dst"], "left_anti").select("scope", "src", "dst"))


def strong_components(edges: DataFrame) -> DataFrame:
    """(scope, node, component) of nodes on a loop: nodes that reach each other, named by the least; a node with an edge to itself only is its own.

    Scopes of at most SCOPE_EDGES edges (a module's signals) are solved each in one task, by depth first search; larger ones over the cluster
    (``coloured_components``). Rows with a null are no edges; repeated edges count once.
    """
    scratch = Scratch(edges.sparkSession)
    e = scratch.save(edges.select("scope", "src", "dst").where("scope is not null and src is not null and dst is not null").distinct())
    sizes, seen = scratch.counted(e.groupBy("scope").agg(F.count("*").alias("n")), large=F.count_if(F.col("n") > SCOPE_EDGES))
    if seen["large"]:
        large = sizes.where(F.col("n") > SCOPE_EDGES).select("scope")
        rest = e.join(large, "scope", "left_anti")
    else:
        rest = e
    small = rest.groupBy("scope").agg(F.collect_list(F.struct("src", "dst")).alias("e")).mapInArrow(_tarjan, "scope string, node string, component string")
    return small.union(coloured_components(e.join(large, "scope", "left_semi"))) if seen["large"] else small


def degrees(edges: DataFrame) -> DataFrame:
    """(scope, node, fan_in, fan_out): distinct neighbours on either side."""
    e = edges.select("scope", "src", "dst").distinct()
    both = e.select("scope", F.col("dst").alias("node"), F.lit(1).alias("i"), F.lit(0).alias("o")).union(e.select("scope", F.col("src").alias("node"), F.lit(0).alias("i"), F.lit(1).alias("o")))
    return both.groupBy("scope", "node").agg(F.sum("i").alias("fan_in"), F.sum("o").alias("fan_out"))


def merged(edges: DataFrame, *key: str) -> DataFrame:
    """Edges with one row per key: direct only if all are, partial if any is, the kinds as a sorted set, the number of rows."""
    return edges.groupBy(*key).agg(F.bool_and("direct").alias("direct"), F.bool_or("partial").alias("partial"), F.array_join(F.sort_array(F.collect_set("kind")), ",").alias("kinds"), F.count("*").alias("n"))
