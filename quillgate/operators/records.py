"""Multi-task records: task registry, projections, prompt texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ident
from ..sources.tables import clean

# Tasks with their version and whether a projector exists (fixed values).
TASKS = (("rtl_generation", 2, True), ("rtl_understanding", 1, True), ("interface_extraction", 1, True), ("structural_extraction", 1, True), ("dependency_analysis", 1, True), ("fsm_extraction", 1, True))


def registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(TASKS), "task string, version int, populated boolean")


def planned(modules: DataFrame) -> DataFrame:
    """(ip, module, task, version, record_id): one record per module and populated task. The registry is a constant of six rows."""
    m = modules.select(clean(F.col("ip")).alias("ip"), clean(F.col("module")).alias("module")).where("ip <> '' and module <> ''").distinct()
    t = registry(modules.sparkSession).where("populated").select("task", "version")
    return m.join(F.broadcast(t)).select("ip", "module", "task", "version", ident.record_id_v2(F.col("task"), F.col("version"), ident.module_id(F.col("ip"), F.col("module"))).alias("record_id"))


def _names(col: str, field: str) -> Column:
    return F.array_sort(F.array_distinct(F.filter(F.transform(F.coalesce(F.col(col), F.expr(f"slice({col}, 1, 0)")), lambda x: clean(x[field])), lambda n: n.isNotNull())))


def structural_projection(docs: DataFrame) -> DataFrame:
    """(ip, module, registers, children): sorted names of registers and child modules; null lists are empty."""
    d = docs.select(clean(F.col("ip")).alias("ip"), clean(F.col("module")).alias("module"), "registers", "instances").distinct()
    empty = F.array().cast("array<string>")
    return d.select("ip", "module", F.coalesce(_names("registers", "name"), empty).alias("registers"), F.coalesce(_names("instances", "module"), empty).alias("children"))


def prompts(projected: DataFrame, budget: int) -> DataFrame:
    """(ip, module, prompt, n_dropped): lines of a module, its registers and its submodules within ``budget`` bytes; lines are dropped from the end, submodules first.

    A line counts its bytes and one for the line end. The first line always stays. The cut is a fold over the row's own lines: no shuffle.
    """
    head = F.array(F.concat(F.lit("Module "), "module", F.lit(" of "), "ip"))
    lines = F.concat(head, F.transform("registers", lambda x: F.concat(F.lit("register "), x)), F.transform("children", lambda x: F.concat(F.lit("submodule "), x)))
    x = projected.select("ip", "module", lines.alias("ls"))
    n = F.expr(f"aggregate(ls, struct(0 AS used, 0 AS n), (a, l) -> struct(a.used + octet_length(l) + 1 AS used, a.n + if(a.used + octet_length(l) + 1 <= {int(budget)}, 1, 0) AS n)).n")
    kept = F.greatest(F.lit(1), n)
    return x.select("ip", "module", F.array_join(F.slice("ls", F.lit(1), kept), "\n").alias("prompt"), (F.size("ls") - kept).alias("n_dropped"))
