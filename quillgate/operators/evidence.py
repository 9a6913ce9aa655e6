"""Scored evidence for state registers and next-state signals, as flags and weighted sums over section rows of parsed texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What a candidate must have some of, what speaks for it beyond, what against it (fixed values).
REQUIRED = ("always_ff", "case", "enum", "feedback", "next_relation")
BONUS = ("reset", "small_width", "state_name")
#: Weight of one hit and the most a feature can give (fixed values).
WEIGHTS = {"always_ff": (60, 180), "case": (60, 180), "enum": (40, 80), "reset": (30, 60), "feedback": (50, 100), "next_relation": (50, 100), "small_width": (20, 20), "state_name": (20, 40)}
#: A score from THRESHOLD on is a candidate, from MEDIUM and HIGH on its confidence (fixed values).
THRESHOLD, MEDIUM, HIGH = 100, 160, 280
DATAPATH = r"(?i)(data|cnt|count|addr|ptr|acc|sum|fifo|mem|crc|shift)"
STATE_NAME = r"(?i)(state|fsm|_st$|^st$|^st_|_cs$)"


def register_features(rows: DataFrame) -> DataFrame:
    """(record_id, module, name, <feature>...): hits of each feature per register, from rows of read_rtl (register, leaf, statement, assign, enum, state_candidate)."""
    key = ["record_id", "module", "name"]
    reg = rows.where("section = 'register'").select(*key, F.col("width").cast("int").alias("width"), F.col("reset").isNotNull().cast("int").alias("reset"), F.size(F.from_json("detail", "array<string>")).alias("n_enables"))
    case = rows.where("section = 'statement' and kind = 'case'").select("record_id", "module", F.col("value").alias("name")).groupBy(*key).agg(F.count("*").alias("case"))
    leaf = rows.where("section = 'leaf' and kind = 'update'").select(*key, F.col("value").rlike(r"^\w+$").alias("plain"), F.expr(r"value rlike concat('\\b', name, '\\b')").alias("own"), F.col("value"))
    own = leaf.groupBy(*key).agg(F.count_if("own").alias("feedback"), F.count_if(F.expr("value rlike '[-+*]' and own")).alias("arithmetic"), F.count_if("plain").alias("next_relation"))
    enum = rows.where("section in ('enum', 'parameter')").select("record_id", "module", F.col("name").alias("value")).distinct()
    named = leaf.join(enum, ["record_id", "module", "value"]).groupBy(*key).agg(F.countDistinct("value").alias("enum"))
    j = reg.join(case, key, "left").join(own, key, "left").join(named, key, "left")
    n = lambda c: F.coalesce(c, F.lit(0))
    return j.select(*key, "width", F.lit(1).alias("always_ff"), n("case").alias("case"), n("enum").alias("enum"), "reset", n("feedback").alias("feedback"), n("next_relation").alias("next_relation"), n((F.col("width") <= 8).cast("int")).alias("small_width"), F.col("name").rlike(STATE_NAME).cast("int").alias("state_name"), F.col("name").rlike(DATAPATH).cast("int").alias("datapath_name"), n((F.col("width") > 16).cast("int")).alias("wide"), n("arithmetic").alias("arithmetic"))


def score(features: DataFrame) -> DataFrame:
    """features with the sum of weighted hits, each up to its cap, the confidence, and whether the threshold is reached."""
    total = sum((F.least(F.col(k) * w, F.lit(cap)) for k, (w, cap) in WEIGHTS.items()), F.lit(0))
    x = features.withColumn("score", total)
    return x.withColumn("confidence", F.when(F.col("score") >= HIGH, "high").when(F.col("score") >= MEDIUM, "medium").when(F.col("score") >= THRESHOLD, "low").otherwise("none")).withColumn("percent", F.least(F.greatest((F.col("score") * 100 / HIGH).cast("int"), F.lit(0)), F.lit(100)))


def verdict(features: DataFrame) -> DataFrame:
    """features with the verdict: of the required flags four or more high, three medium, two with two bonuses low; two penalties or fewer flags reject."""
    hits = lambda names: sum(((F.col(c) > 0).cast("int") for c in names), F.lit(0))
    x = features.withColumns({"required": hits(REQUIRED), "bonus": hits(BONUS), "penalty": hits(("datapath_name", "wide", "arithmetic"))})
    v: Column = F.when(F.col("penalty") >= 2, "reject").when(F.col("required") >= 4, "high").when(F.col("required") == 3, "medium").when((F.col("required") == 2) & (F.col("bonus") >= 2), "low").otherwise("reject")
    return x.withColumn("verdict", v)


def best(scored: DataFrame) -> DataFrame:
    """The register with the highest score of each module (ties: more evidence, then the lesser name)."""
    n = sum(((F.col(c) > 0).cast("int") for c in WEIGHTS), F.lit(0))
    g = scored.withColumn("n_evidence", n).groupBy("record_id", "module").agg(F.min(F.struct((-F.col("score")).alias("s"), (-F.col("n_evidence")).alias("e"), "name", "confidence")).alias("b"), F.count_if(F.col("score") >= THRESHOLD).alias("n_candidates"))
    return g.select("record_id", "module", F.col("b.name").alias("name"), (-F.col("b.s")).alias("score"), F.col("b.confidence").alias("confidence"), "n_candidates")


def self_loops(moves: DataFrame) -> DataFrame:
    """(key..., state, condition): a state with exactly one way out to another state, under a condition, stays otherwise: a loop under the negated condition.
    moves: (doc_id, machine, src, dst, condition)."""
    out = moves.where("src <> dst").groupBy("doc_id", "machine", "src").agg(F.count("*").alias("n"), F.first("condition").alias("condition"))
    return out.where("n = 1 and condition is not null and trim(condition) not in ('', '1')").select("doc_id", "machine", F.col("src").alias("state"), F.concat(F.lit("!("), "condition", F.lit(")")).alias("condition"))


def encoding_match(states: DataFrame, enums: DataFrame) -> DataFrame:
    """(machine key, enum, overlap): the list of constants that shares most names with a machine's states (default apart; ties: the first list); it must share
    max(2, min(3, n)). states: (key, state); enums: (key, enum, ord, member): the lists that are in reach of a machine."""
    s = states.where("upper(state) <> 'DEFAULT'").select("key", "state").distinct()
    n = s.groupBy("key").agg(F.count("*").alias("n"))
    o = s.join(enums.select("key", "enum", "ord", F.col("member").alias("state")).distinct(), ["key", "state"]).groupBy("key", "enum", "ord").agg(F.count("*").alias("overlap"))
    b = o.groupBy("key").agg(F.min(F.struct((-F.col("overlap")).alias("o"), "ord", "enum")).alias("b")).join(n, "key")
    return b.select("key", F.col("b.enum").alias("enum"), (-F.col("b.o")).alias("overlap"), "n").where("overlap >= greatest(2, least(3, n))").drop("n")
