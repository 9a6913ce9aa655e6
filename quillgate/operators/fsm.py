"""State machines: flat tables, quality, encodings, reachability, shapes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import clean
from .graph import cones


def machines(fsm: DataFrame) -> DataFrame:
    """(doc_id, machine, f): each machine of each document once."""
    return fsm.select("doc_id", "fsms").distinct().select("doc_id", F.posexplode("fsms").alias("machine", "f"))


def states(fsm: DataFrame) -> DataFrame:
    """(doc_id, machine, pos, state, is_reset, value): states in their order; null entries and names are left out."""
    m = machines(fsm).select("doc_id", "machine", F.posexplode("f.states").alias("pos", "s"))
    return m.select("doc_id", "machine", "pos", clean(F.col("s.name")).alias("state"), F.coalesce("s.reset", F.lit(False)).alias("is_reset"), "s.value").where("state is not null")


def transitions(fsm: DataFrame) -> DataFrame:
    """(doc_id, machine, pos, src, dst, condition, kind, status, move): move is self, unknown (an end is null or a pseudo-state) or step."""
    m = machines(fsm).select("doc_id", "machine", F.posexplode("f.transitions").alias("pos", "t"))
    t = m.select("doc_id", "machine", "pos", clean(F.col("t.from_state")).alias("src"), clean(F.col("t.to_state")).alias("dst"), F.col("t.condition").alias("condition"), F.col("t.kind").alias("kind"), F.col("t.status").alias("status"))
    odd = F.col("src").isNull() | F.col("dst").isNull() | F.col("src").startswith("*") | F.col("dst").startswith("*")
    return t.withColumn("move", F.when(odd, "unknown").when(F.col("src") == F.col("dst"), "self").otherwise("step"))


def quality(fsm: DataFrame) -> DataFrame:
    """Per machine: states, states without outgoing moves (orphans), those of them that are entered (terminal), self loops, share of states that are left, score."""
    s = states(fsm).select("doc_id", "machine", "state").distinct()
    t = transitions(fsm).where("move <> 'unknown'")
    out = t.where("move = 'step'").select("doc_id", "machine", F.col("src").alias("state")).distinct().withColumn("o", F.lit(1))
    into = t.where("move = 'step'").select("doc_id", "machine", F.col("dst").alias("state")).distinct().withColumn("i", F.lit(1))
    key = ["doc_id", "machine", "state"]
    j = s.join(out, key, "left").join(into, key, "left")
    g = j.groupBy("doc_id", "machine").agg(F.count("*").alias("n_states"), F.count_if(F.col("o").isNull()).alias("n_orphan"), F.count_if(F.col("o").isNull() & F.col("i").isNotNull()).alias("n_terminal"), F.round(100 * F.count("o") / F.count("*"), 2).alias("coverage"))
    loops = t.where("move = 'self'").groupBy("doc_id", "machine").agg(F.count("*").alias("n_self"))
    g = g.join(loops, ["doc_id", "machine"], "left").withColumn("n_self", F.coalesce("n_self", F.lit(0)))
    return g.withColumn("score", F.when((F.col("coverage") >= 90) & (F.col("n_orphan") == 0), "high").when(F.col("coverage") >= 70, "medium").otherwise("low"))


def encoding(fsm: DataFrame) -> DataFrame:
    """Per machine with values for all its states: gray (three states or more, every step flips one bit), binary (0..n-1), one_hot (two or more, one bit each), custom."""
    s = states(fsm)
    v = s.groupBy("doc_id", "machine").agg(F.sort_array(F.collect_set("value")).alias("v"), F.count("*").alias("n"), F.count("value").alias("k")).where("n = k and size(v) = n")
    val = s.select("doc_id", "machine", "state", "value").dropDuplicates(["doc_id", "machine", "state"])
    t = transitions(fsm).where("move = 'step'").select("doc_id", "machine", F.col("src"), F.col("dst")).distinct()
    a, b = val.select("doc_id", "machine", F.col("state").alias("src"), F.col("value").alias("x")), val.select("doc_id", "machine", F.col("state").alias("dst"), F.col("value").alias("y"))
    flips = t.join(a, ["doc_id", "machine", "src"]).join(b, ["doc_id", "machine", "dst"]).groupBy("doc_id", "machine").agg(F.bool_and(F.bit_count(F.expr("x ^ y")) == 1).alias("gray"))
    j = v.join(flips, ["doc_id", "machine"], "left")
    style = F.when((F.col("n") >= 3) & F.coalesce("gray", F.lit(False)), "gray").when(F.col("v") == F.transform(F.sequence(F.lit(0), F.col("n").cast("int") - 1), lambda i: i.cast("long")), "binary").when((F.col("n") >= 2) & F.forall("v", lambda x: F.bit_count(x) == 1), "one_hot").otherwise("custom")
    return j.select("doc_id", "machine", "n", style.alias("encoding"))


def reachable(fsm: DataFrame) -> DataFrame:
    """(doc_id, machine, state): states reached from the reset states over steps between named states; reset states included."""
    scope = F.concat_ws(":", "doc_id", "machine").alias("scope")
    t = transitions(fsm).where("move = 'step'").select(scope, F.col("dst").alias("src"), F.col("src").alias("dst"))
    start = states(fsm).where("is_reset").select(scope, F.col("state").alias("node")).distinct()
    got = cones(t, start, start.limit(0)).select("scope", "node").distinct()
    return got.select(F.split("scope", ":")[0].cast("long").alias("doc_id"), F.split("scope", ":")[1].cast("int").alias("machine"), F.col("node").alias("state"))


def shapes(fsm: DataFrame) -> DataFrame:
    """(doc_id, machine, shape): a digest free of names and values: style, number of states and the moves by the states' rank in their list."""
    s = states(fsm).groupBy("doc_id", "machine", "state").agg(F.min("pos").alias("pos"))
    rank = s.withColumn("r", F.row_number().over(Window.partitionBy("doc_id", "machine").orderBy("pos")))
    t = transitions(fsm).where("move <> 'unknown'")
    j = t.join(rank.select("doc_id", "machine", F.col("state").alias("src"), F.col("r").alias("a")), ["doc_id", "machine", "src"]).join(rank.select("doc_id", "machine", F.col("state").alias("dst"), F.col("r").alias("b")), ["doc_id", "machine", "dst"])
    moves = j.groupBy("doc_id", "machine").agg(F.array_join(F.sort_array(F.collect_set(F.concat_ws(">", "a", "b"))), ",").alias("moves"))
    n = s.groupBy("doc_id", "machine").agg(F.count("*").alias("n"))
    style = machines(fsm).select("doc_id", "machine", F.col("f.style").alias("style"))
    j = style.join(n, ["doc_id", "machine"]).join(moves, ["doc_id", "machine"], "left")
    return j.select("doc_id", "machine", F.sha2(F.concat_ws("\x1f", F.coalesce("style", F.lit("")), F.col("n").cast("string"), F.coalesce("moves", F.lit(""))), 256).alias("shape"))


def numbered(fsm: DataFrame) -> DataFrame:
    """(doc_id, machine, pos, state, number): implicit numbering as of an enum: a stated value holds, else the last stated one plus the distance, 0 at the start."""
    w = Window.partitionBy("doc_id", "machine").orderBy("pos")
    s = states(fsm).withColumn("last", F.last(F.when(F.col("value").isNotNull(), F.struct("value", "pos")), True).over(w)).withColumn("k", F.row_number().over(w))
    s = s.withColumn("base", F.last(F.when(F.col("value").isNotNull(), F.struct("value", "k")), True).over(w))
    number: Column = F.when(F.col("base").isNull(), F.col("k") - 1).otherwise(F.col("base.value") + F.col("k") - F.col("base.k"))
    return s.select("doc_id", "machine", "pos", "state", number.alias("number"))


def overridden(fsm: DataFrame) -> DataFrame:
    """(doc_id, machine, pos): moves that a later one without a condition from the same state overrides."""
    w = Window.partitionBy("doc_id", "machine", "src").orderBy("pos").rowsBetween(1, Window.unboundedFollowing)
    t = transitions(fsm).where("src is not null").withColumn("later", F.max(F.col("condition").isNull().cast("int")).over(w))
    return t.where("later = 1").select("doc_id", "machine", "pos")
