"""Include directives of source texts: scan, resolution, closure."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.hierarchy import descendants


def directives(files: DataFrame) -> DataFrame:
    """files (path, text): (path, line, name, conditional) of each include; conditional: under an `ifdef or `ifndef. The depth can't fall below 0."""
    depth = "aggregate(slice(ls, 1, line), 0, (d, l) -> CASE WHEN l RLIKE '^\\\\s*`ifn?def\\\\b' THEN d + 1 WHEN l RLIKE '^\\\\s*`endif\\\\b' THEN greatest(d - 1, 0) ELSE d END)"
    x = files.where("text is not null").select("path", F.split("text", "\n", -1).alias("ls"))
    x = x.select("path", "ls", F.posexplode("ls").alias("line", "l")).where(F.col("l").rlike(r'^\s*`include\s+"'))
    return x.select("path", "line", F.regexp_extract("l", r'`include\s+"([^"]+)"', 1).alias("name"), (F.expr(depth) > 0).alias("conditional"))


def resolve(found: DataFrame, files: DataFrame, incdirs: list[str]) -> DataFrame:
    """found with ``target``: the file in the same folder, else in an include folder (in order), else the only file of that base name; null if there is none."""
    base = lambda c: F.regexp_extract(c, r"([^/]+)$", 1)
    folder = F.regexp_extract("path", r"^(.*/)?[^/]*$", 1)
    tries = F.array(F.concat(folder, "name"), *[F.concat(F.lit(d.rstrip("/") + "/"), F.col("name")) for d in incdirs])
    x = found.select("path", "line", "name", "conditional", F.posexplode(tries).alias("rank", "target"))
    direct = x.join(files.select(F.col("path").alias("target")).distinct(), "target").groupBy("path", "line").agg(F.min(F.struct("rank", "target")).alias("b"))
    lone = files.select(base(F.col("path")).alias("b"), F.col("path").alias("only")).groupBy("b").agg(F.min("only").alias("only"), F.count("*").alias("n")).where("n = 1").select("b", "only")
    j = found.join(direct.select("path", "line", F.col("b.target").alias("direct")), ["path", "line"], "left").withColumn("_b", base(F.col("name"))).join(lone.withColumnRenamed("b", "_b"), "_b", "left")
    return j.select("path", "line", "name", "conditional", F.coalesce("direct", "only").alias("target"))


def closure(resolved: DataFrame) -> DataFrame:
    """(path, includes): all files that a file includes, directly or not; loops end."""
    e = resolved.where("target is not null").select(F.lit("").alias("scope"), F.col("path").alias("parent"), F.col("target").alias("child"))
    return descendants(e, "scope").select(F.col("ancestor").alias("path"), F.col("descendant").alias("includes"))


def missing(resolved: DataFrame) -> DataFrame:
    """(path, name, kind): includes nothing resolves, of a file or of any file it includes: unresolved, or conditional_external where every directive is conditional."""
    own = resolved.where("target is null").groupBy("path", "name").agg(F.bool_and("conditional").alias("c"))
    reach = closure(resolved).union(resolved.select("path", F.col("path").alias("includes")).distinct()).distinct()
    x = reach.join(own.select(F.col("path").alias("includes"), "name", "c"), "includes").groupBy("path", "name").agg(F.bool_and("c").alias("c"))
    return x.select("path", "name", F.when(F.col("c"), "conditional_external").otherwise("unresolved").alias("kind"))
