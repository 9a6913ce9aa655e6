"""Behaviour of processes: roles, coverage of assignments, holds, enables, latches."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import clean

#: How much of its branches a statement assigns, from nothing to everything (fixed values).
NONE, PARTIAL, UNKNOWN, COND, FULL = range(5)
LEVELS = ("none", "partial", "unknown", "conditional", "full")


def process_role(keyword: Column, edges: Column) -> Column:
    """Role by keyword and number of edge events: sequential, combinational, latch or unknown."""
    return F.when((keyword == "always_ff") | (edges > 0), "sequential").when(keyword.isin("always_comb", "assign"), "combinational").when(keyword == "always_latch", "latch").when((keyword == "always") & (edges == 0), "combinational").otherwise("unknown")


def coverage(stmt: dict | None, name: str) -> int:
    """Level to which a statement tree assigns ``name``. Nodes: {"assign": name, "part": bool}, {"block": [...]}, {"if": [...branches], "else": bool},
    {"case": [...items], "default": bool}, {"loop": body}, {"opaque": true}. A block is as good as its best statement; branches count together: all full is
    full (a case without default then conditional, an if without else partial), none at all is none, an unknown one makes it unknown, the rest partial."""
    if not stmt:
        return NONE
    if "assign" in stmt:
        return NONE if stmt["assign"] != name else PARTIAL if stmt.get("part") else FULL
    if "block" in stmt:
        return max((coverage(s, name) for s in stmt["block"]), default=NONE)
    if "loop" in stmt:
        return UNKNOWN if coverage(stmt["loop"], name) else NONE
    if stmt.get("opaque"):
        return UNKNOWN
    arms = [coverage(s, name) for s in stmt.get("if", stmt.get("case", []))]
    if not any(arms):
        return NONE
    if UNKNOWN in arms:
        return UNKNOWN
    whole = all(a in (FULL, COND) for a in arms)
    if "if" in stmt:
        return (COND if COND in arms else FULL) if whole and stmt.get("else") else PARTIAL
    return PARTIAL if not whole else FULL if stmt.get("default") and COND not in arms else COND


@F.pandas_udf(T.StringType())
def coverage_level(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Level of a statement tree in JSON for a name; null where the tree can't be read."""
    import json

    for trees, names in batches:
        out = []
        for t, n in zip(trees, names):
            try:
                out.append(LEVELS[coverage(json.loads(t), n)])
            except (TypeError, ValueError, AttributeError, RecursionError):
                out.append(None)
        yield pd.Series(out, dtype="object")


def latch_status(level: Column, keyword: Column) -> Column:
    return F.when(keyword == "always_latch", "explicit").when(level == "full", "none").when(level == "partial", "inferred").when(level == "conditional", "possible").when(level == "unknown", "ambiguous").otherwise("none")


def registers(docs: DataFrame) -> DataFrame:
    """(ip, module, register, clock, edge, hold, n_enables), once per register; null lists and names are left out."""
    x = docs.select(clean(F.col("ip")).alias("ip"), clean(F.col("module")).alias("module"), F.explode("registers").alias("r"))
    enables = F.array_distinct(F.filter(F.transform("r.enables", clean), lambda e: e.isNotNull()))
    return x.select("ip", "module", clean(F.col("r.name")).alias("register"), clean(F.col("r.clock.signal")).alias("clock"), F.col("r.clock.edge").alias("edge"), F.col("r.hold").alias("hold"), F.greatest(F.size(enables), F.lit(0)).alias("n_enables")).where("register is not null").distinct()


def clock_domains(docs: DataFrame) -> DataFrame:
    """Per module and clock: registers, of which with an enable, edges used; a module with several clocks shows up with several rows."""
    return registers(docs).where("clock is not null").groupBy("ip", "module", "clock").agg(F.count("*").alias("n_registers"), F.count_if(F.col("n_enables") > 0).alias("n_enabled"), F.array_join(F.sort_array(F.collect_set("edge")), ",").alias("edges"))
