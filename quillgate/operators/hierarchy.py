"""Parent-child rows to full hierarchies by level-wise frontier joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import Scratch, clean
from .skew import salted_join


class Levels:
    """The levels a search has found so far, each written once; every COMPACT levels they become one table again, so plans stay short however deep it goes."""

    COMPACT = 12

    def __init__(self, scratch: Scratch, first: DataFrame):
        self.scratch = scratch
        frame, seen = scratch.counted(first)
        self.frames, self.last, self.n = [frame], frame, seen["n"]

    def add(self, level: DataFrame) -> bool:
        """Whether the level has any row."""
        frame, seen = self.scratch.counted(level)
        if not seen["n"]:
            return False
        self.n = seen["n"]
        if len(self.frames) >= self.COMPACT:
            old = self.frames
            self.frames = [self.scratch.save(self.all())]
            self.scratch.drop(*old)
        self.frames.append(frame)
        self.last = frame
        return True

    def all(self) -> DataFrame:
        out = self.frames[0]
        for f in self.frames[1:]:
            out = out.union(f)
        return out


def instance_edges(docs: DataFrame) -> DataFrame:
    """(ip, parent, child, instance) of structural documents, each once; names without blanks around them.

    Null or empty ip, module or child name: no edge. A null instance name is kept as null. Null or empty lists and null entries give no edge.
    """
    rows = docs.select(clean(F.col("ip")).alias("ip"), clean(F.col("module")).alias("parent"), F.explode("instances").alias("i"))
    rows = rows.select("ip", "parent", clean(F.col("i.module")).alias("child"), clean(F.col("i.name")).alias("instance"))
    return rows.where("ip <> '' and parent <> '' and child <> ''").distinct()


def module_nodes(docs: DataFrame) -> DataFrame:
    """(ip, module) of structural documents, each once, with or without instances. Null or empty names: no node."""
    return docs.select(clean(F.col("ip")).alias("ip"), clean(F.col("module")).alias("module")).where("ip <> '' and module <> ''").distinct()


def descendants(edges: DataFrame, scope: str = "ip", parent: str = "parent", child: str = "child") -> DataFrame:
    """(scope, ancestor, descendant), distinct: descendant is reached from ancestor through one edge or more.

    A node on a loop is its own descendant. Every round extends only the pairs the last round found and only at nodes that have children: rows that end in a
    leaf (a library cell under a third of all modules) are never shuffled again, and those that end in one popular module with children are cut over tasks. Pairs already known are removed by an anti join on the whole pair, so no key
    of it is hot. Rows with a null in any of the three columns are no edges. Ends when a round finds nothing, which also ends loops.
    """
    scratch = Scratch(edges.sparkSession)
    e = edges.select(F.col(scope).alias("s"), F.col(parent).alias("p"), F.col(child).alias("c")).where("s is not null and p is not null and c is not null").distinct()
    inner = e.select("s", F.col("p").alias("c")).distinct().withColumn("open", F.lit(True))
    e = scratch.save(e.join(inner, ["s", "c"], "left").select("s", "p", "c", F.coalesce("open", F.lit(False)).alias("open")))
    levels = Levels(scratch, e.select("s", F.col("p").alias("a"), F.col("c").alias("d"), "open"))
    while True:
        front = levels.last.where("open").select("s", "a", F.col("d").alias("p"))
        found = salted_join(front, e, ["s", "p"], levels.n).select("s", "a", F.col("c").alias("d"), "open").distinct()
        if not levels.add(found.join(levels.all().select("s", "a", "d"), ["s", "a", "d"], "left_anti")):
            break
    return levels.all().select(F.col("s").alias(scope), F.col("a").alias("ancestor"), F.col("d").alias("descendant"))


def instance_paths(edges: DataFrame, scope: str = "ip", parent: str = "parent", child: str = "child", name: str = "instance", nodes: DataFrame | None = None) -> DataFrame:
    """(scope, root, module, path, depth, closes_loop): one row for each path of instances from a root, and for each root itself (depth 0).

    A root has no parent; without ``nodes`` (scope, module) only modules that have children can be one. A path that comes back to a module it already holds ends there with closes_loop; modules on a loop without a root are not reached
    and show up by the anti join in modules_report. Null instance names are written as ?. A design with shared subtrees has as many rows as elaborated
    instances: that is the result asked for and not capped.
    """
    scratch = Scratch(edges.sparkSession)
    e = scratch.save(edges.select(F.col(scope).alias("s"), F.col(parent).alias("p"), F.col(child).alias("c"), F.coalesce(F.col(name), F.lit("?")).alias("i")).where("s is not null and p is not null and c is not null").distinct())
    kids = e.select("s", F.col("c").alias("p")).distinct()
    tops = e.select("s", "p")
    if nodes is not None:
        tops = tops.union(nodes.select(F.col(scope).alias("s"), F.col("module").alias("p")).where("s is not null and p is not null"))
    roots = tops.distinct().join(kids, ["s", "p"], "left_anti")
    levels = Levels(scratch, roots.select("s", F.col("p").alias("root"), "p", F.col("p").alias("path"), F.array("p").alias("seen"), F.lit(0).alias("depth"), F.lit(False).alias("loop")))
    while True:
        front = levels.last.where("not loop")
        if not levels.add(salted_join(front, e, ["s", "p"], levels.n).select("s", "root", F.col("c").alias("p"), F.concat_ws("/", "path", "i").alias("path"), F.concat("seen", F.array("c")).alias("seen"), (F.col("depth") + 1).alias("depth"), F.expr("array_contains(seen, c)").alias("loop"))):
            break
    return levels.all().select(F.col("s").alias(scope), "root", F.col("p").alias("module"), "path", "depth", F.col("loop").alias("closes_loop"))


def shortest_paths(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """(s, m, names, depth): the path of instance names from a root to each module that is reached, the shortest (ties: the least list of names; it starts with the root).

    One row per module and level: a level keeps the least path of each module it reaches first, so shared subtrees are walked once. edges: (s, p, c, i); roots: (s, m).
    """
    scratch = Scratch(edges.sparkSession)
    levels = Levels(scratch, roots.select("s", "m", F.array("m").alias("names"), F.lit(0).alias("depth")))
    while True:
        front = levels.last.select("s", F.col("m").alias("p"), "names", "depth")
        new = front.join(edges, ["s", "p"]).groupBy("s", F.col("c").alias("m")).agg(F.min(F.concat("names", F.array("i"))).alias("names"), (F.max("depth") + 1).alias("depth"))
        if not levels.add(new.join(levels.all().select("s", "m"), ["s", "m"], "left_anti")):
            return levels.all()


def path_counts(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """(s, m, n): number of paths from the roots, summed level by level, one row per module and level. edges: (s, p, c, i) without loops. More than 10**38 is null."""
    scratch = Scratch(edges.sparkSession)
    steps = scratch.save(edges.groupBy("s", "p", "c").agg(F.count("*").cast("decimal(38,0)").alias("k")))
    levels = Levels(scratch, roots.select("s", "m", F.lit(1).cast("decimal(38,0)").alias("n")))
    while True:
        front = levels.last.select("s", F.col("m").alias("p"), "n")
        if not levels.add(front.join(steps, ["s", "p"]).groupBy("s", F.col("c").alias("m")).agg(F.expr("try_sum(cast(try_multiply(n, k) as decimal(38,0)))").alias("n"))):
            return levels.all().groupBy("s", "m").agg(F.expr("try_sum(n)").cast("decimal(38,0)").alias("n"))


def modules_report(edges: DataFrame, scope: str = "ip", parent: str = "parent", child: str = "child", name: str = "instance", nodes: DataFrame | None = None) -> DataFrame:
    """One row per module: root and path of its shortest path (ties: least list of names), depth, number of paths, number of modules below, on_loop, reached.

    The modules are the ends of the edges and ``nodes`` (scope, module): one without edges is its own root at depth 0. A module that only a loop leads to is not
    reached. n_paths counts the paths from roots that use no edge of a loop (with them there would be no end). Nothing is elaborated: every search has a row per
    module and level at most. Null instance names are written as ?.
    """
    scratch = Scratch(edges.sparkSession)
    e = scratch.save(edges.select(F.col(scope).alias("s"), F.col(parent).alias("p"), F.col(child).alias("c"), F.coalesce(F.col(name), F.lit("?")).alias("i")).where("s is not null and p is not null and c is not null").distinct())
    pairs = scratch.save(descendants(e, "s", "p", "c"))
    every = e.select("s", F.col("p").alias("m")).union(e.select("s", "c"))
    if nodes is not None:
        every = every.union(nodes.select(F.col(scope), F.col("module")).where(F.col(scope).isNotNull() & F.col("module").isNotNull()))
    every = scratch.save(every.distinct())
    roots = scratch.save(every.join(e.select("s", F.col("c").alias("m")).distinct(), ["s", "m"], "left_anti"))
    free = scratch.save(e.join(pairs.select("s", F.col("descendant").alias("p"), F.col("ancestor").alias("c")), ["s", "p", "c"], "left_anti"))
    below = pairs.groupBy("s", F.col("ancestor").alias("m")).agg(F.count("*").alias("n_below"), F.max(F.col("ancestor") == F.col("descendant")).alias("on_loop"))
    j = every.join(shortest_paths(e, roots), ["s", "m"], "left").join(path_counts(free, roots), ["s", "m"], "left").join(below, ["s", "m"], "left")
    n_paths = F.when(F.col("names").isNull(), F.lit(0)).otherwise(F.coalesce("n", F.lit(0)))
    return j.select(F.col("s").alias(scope), F.col("m").alias("module"), F.try_element_at("names", F.lit(1)).alias("root"), F.when(F.col("names").isNotNull(), F.concat_ws("/", "names")).alias("path"), "depth", n_paths.cast("decimal(38,0)").alias("n_paths"), F.coalesce("n_below", F.lit(0)).alias("n_below"), F.coalesce("on_loop", F.lit(False)).alias("on_loop"), F.col("names").isNotNull().alias("reached"))
