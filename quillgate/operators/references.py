"""Composite references with partial nulls: which point at nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import Scratch, clean


#: Merged life spans of a partial key that are broadcast; more take a shuffle join.
FEW = 50_000


def merged_spans(targets: DataFrame, key: list[str]) -> DataFrame:
    """(key..., _from, _until): the life spans of all rows of a key as disjoint ones; touching spans become one, a null end is open, a null start is no span.

    Spans are merged by key and month of their start first, so the rows of a hot key are cut over many tasks, then the months' few spans by key.
    """
    far = F.lit("9999-12-31 00:00:00").cast(targets.schema["_from"].dataType)
    x = targets.where("_from is not null").select(*key, "_from", F.coalesce("_until", far).alias("_until")).where("_until > _from").distinct()

    def islands(df: DataFrame, *by) -> DataFrame:
        w = Window.partitionBy(*key, *by).orderBy("_from", "_until")
        before = F.max("_until").over(w.rowsBetween(Window.unboundedPreceding, -1))
        at = F.sum(F.when(before >= F.col("_from"), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0))
        return df.withColumn("_b", before).withColumn("_i", at).groupBy(*key, *by, "_i").agg(F.min("_from").alias("_from"), F.max("_until").alias("_until"))

    x = islands(x.withColumn("_m", F.date_format("_from", "yyyy-MM")), "_m").select(*key, "_from", "_until")
    return islands(x).select(*key, "_from", F.when(F.col("_until") < far, F.col("_until")).alias("_until"))


def orphan_references(refs: DataFrame, keys: dict[str, str], targets: DataFrame, match: str = "partial", at: str | None = None, alive: tuple[str, str] | None = None) -> DataFrame:
    """The rows of ``refs`` whose composite key is in no row of ``targets``.

    keys: column of refs -> column of targets. ``match`` gives the meaning of nulls in a reference: "simple": a null anywhere and nothing is checked;
    "partial": the columns that are there must agree with some target; "full": all or none may be null, a mix is an orphan. A reference of nulls only is
    never an orphan. References are written once with their null mask and each mask that occurs is anti-joined on its own non-null columns, so every join stays an equi-join.
    The targets of a partial mask, among them hot keys, are reduced to their distinct keys (with ``alive``: to disjoint life spans per key) before they are joined.
    ``at`` and ``alive=(from, until)``: the target must also be alive at refs[at], from <= at and (until is null or until > at); a null ``at`` matches no target.
    Repeated references stay repeated. An empty target table makes every checked reference an orphan.
    """
    if match not in ("simple", "partial", "full"):
        raise ValueError(f"unknown match {match!r}")
    cols = list(keys)
    keep = refs.columns
    scratch = Scratch(refs.sparkSession)
    bits = F.lit(0)
    for i, c in enumerate(cols):
        bits = bits + F.when(F.col(c).isNotNull(), 1 << i).otherwise(0)
    refs = scratch.save(refs.withColumn("_mask", bits))
    masks = sorted(r["_mask"] for r in refs.select("_mask").distinct().collect())  # at most 2 ** len(keys)
    t = targets.select(*[F.col(keys[c]).alias(f"_t{i}") for i, c in enumerate(cols)], *([F.col(alive[0]).alias("_from"), F.col(alive[1]).alias("_until")] if alive else [])).distinct()
    if len(masks) > 1:
        t = scratch.save(t)
    out: DataFrame | None = None
    for mask in filter(None, masks):
        there = [i for i in range(len(cols)) if mask >> i & 1]
        whole = len(there) == len(cols)
        if match == "simple" and not whole:
            continue
        part = refs.where(F.col("_mask") == mask)
        if not (match == "full" and not whole):
            on = F.lit(True)
            for i in there:
                on = on & (F.col(cols[i]) == F.col(f"_t{i}"))
            key = [f"_t{i}" for i in there]
            if alive:
                on = on & (F.col("_from") <= F.col(at)) & (F.col("_until").isNull() | (F.col("_until") > F.col(at)))
            if whole:
                held = t.select(*key, *(["_from", "_until"] if alive else [])).distinct()
            else:  # far fewer keys than rows
                held, seen = scratch.counted(merged_spans(t, key) if alive else t.select(*key).distinct())
                held = F.broadcast(held) if seen["n"] <= FEW else held
            part = part.join(held, on, "left_anti")
        out = part if out is None else out.unionByName(part)
    return out.select(*keep) if out is not None else refs.select(*keep).limit(0)


def state_references(fsm: DataFrame) -> DataFrame:
    """(doc_id, built_at, machine, field_name, ref_name), distinct: every non-null from_state and to_state of every machine that is no pseudo-state.

    Names lose the blanks around them; a name that is empty then is a reference to nothing. Null machines, states and transitions are skipped.
    """
    rows = fsm.select("doc_id", "built_at", "fsms").select("doc_id", "built_at", F.posexplode("fsms").alias("machine", "f"))
    rows = rows.select("doc_id", "built_at", "machine", F.explode("f.transitions").alias("t"))
    rows = rows.select("doc_id", "built_at", "machine", F.explode(F.array(F.struct(F.lit("from_state").alias("field_name"), clean(F.col("t.from_state")).alias("ref_name")), F.struct(F.lit("to_state").alias("field_name"), clean(F.col("t.to_state")).alias("ref_name")))).alias("r"))
    return rows.select("doc_id", "built_at", "machine", "r.field_name", "r.ref_name").where("ref_name is not null and not startswith(ref_name, '*')").distinct()


def machine_states(fsm: DataFrame) -> DataFrame:
    """(doc_id, machine, name), distinct: the states of every machine, names without blanks around them; null machines, states and names are skipped."""
    rows = fsm.select("doc_id", F.posexplode("fsms").alias("machine", "f")).select("doc_id", "machine", F.explode("f.states").alias("s"))
    return rows.select("doc_id", "machine", clean(F.col("s.name")).alias("name")).where("name is not null").distinct()


def signal_references(dep: DataFrame) -> DataFrame:
    """(doc_id, built_at, ip, module, ref_name), distinct: every non-null source signal, names without blanks around them. Null lists and entries are skipped."""
    rows = dep.select("doc_id", "built_at", clean(F.col("ip")).alias("ip"), clean(F.col("module")).alias("module"), F.explode("targets").alias("t"))
    rows = rows.select("doc_id", "built_at", "ip", "module", F.explode("t.sources").alias("s"))
    return rows.select("doc_id", "built_at", "ip", "module", clean(F.col("s.signal")).alias("ref_name")).where("ref_name is not null").distinct()


def symbol_spans(symbols: DataFrame) -> DataFrame:
    """(ip, module, name, declared_at, removed_at), distinct; names without blanks around them."""
    return symbols.select(clean(F.col("ip")).alias("ip"), clean(F.col("module")).alias("module"), clean(F.col("name")).alias("name"), "declared_at", "removed_at").distinct()


def missing_references(fsm: DataFrame, dep: DataFrame, symbols: DataFrame) -> DataFrame:
    """(table_name, doc_id, field_name, ref_name, built_at) of all orphans of both tables, distinct."""
    states = orphan_references(state_references(fsm), {"doc_id": "doc_id", "machine": "machine", "ref_name": "name"}, machine_states(fsm), "partial")
    states = states.select(F.lit("fsm_ctrl").alias("table_name"), "doc_id", "field_name", "ref_name", "built_at")
    refs = signal_references(dep)
    lost = orphan_references(refs, {"ip": "ip", "module": "module", "ref_name": "name"}, symbol_spans(symbols), "partial", "built_at", ("declared_at", "removed_at"))
    return states.unionByName(lost.select(F.lit("dependency_ctrl").alias("table_name"), "doc_id", F.lit("signal").alias("field_name"), "ref_name", "built_at")).distinct()


def missing_by_month(fsm: DataFrame, dep: DataFrame, symbols: DataFrame) -> DataFrame:
    """Per table and month of built_at: references checked, orphans, documents with an orphan."""
    states = state_references(fsm).select(F.lit("fsm_ctrl").alias("table_name"), "doc_id", "field_name", "ref_name", "built_at").distinct()
    refs = states.unionByName(signal_references(dep).select(F.lit("dependency_ctrl").alias("table_name"), "doc_id", F.lit("signal").alias("field_name"), "ref_name", "built_at"))
    month = F.date_format("built_at", "yyyy-MM").alias("month")
    total = refs.groupBy("table_name", month).agg(F.count("*").alias("n_refs"))
    lost = missing_references(fsm, dep, symbols).groupBy("table_name", month).agg(F.count("*").alias("n_orphans"), F.countDistinct("doc_id").alias("n_docs"))
    j = total.join(lost.withColumnRenamed("month", "m").withColumnRenamed("table_name", "tn"), (F.col("table_name") == F.col("tn")) & F.col("month").eqNullSafe(F.col("m")), "left")
    return j.select("table_name", "month", "n_refs", F.coalesce("n_orphans", F.lit(0)).alias("n_orphans"), F.coalesce("n_docs", F.lit(0)).alias("n_docs"))
