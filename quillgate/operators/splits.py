"""Record groups and the deterministic greedy split by source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components, hub_edges

HARD, SOFT = ("source_rtl", "module_body", "normalized_ir", "completion"), "body_shape"
RATIOS = {"train": 0.70, "validation": 0.15, "test": 0.15}


def groups(identities: DataFrame) -> DataFrame:
    """(record_id, group_id): records that share a value of a HARD identity, or a SOFT one that stands in more than one ip. group_id: the least record_id.

    Null and empty values tie nothing; a record without ties is its own group; records delivered twice count once.
    """
    r = identities.select("record_id", "ip", *HARD, SOFT).where("record_id is not null").distinct()
    held = r.select("record_id", "ip", F.explode(F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).alias("value")) for c in (*HARD, SOFT)])).alias("x")).select("record_id", "ip", "x.kind", "x.value").where("value <> ''")
    wide = held.where(F.col("kind") == SOFT).groupBy("value").agg(F.min("ip").alias("lo"), F.max("ip").alias("hi")).where("lo <> hi").select("value")
    ties = held.where(F.col("kind") != SOFT).select("record_id", "kind", "value").union(held.where(F.col("kind") == SOFT).join(wide, "value").select("record_id", "kind", "value"))
    loops = r.select(F.col("record_id").alias("src"), F.col("record_id").alias("dst"))
    return connected_components(hub_edges(ties, "record_id", "kind", "value").union(loops)).select(F.col("node").alias("record_id"), F.col("component").alias("group_id"))


def targets(total: int) -> dict[str, int]:
    """Records wanted per split: validation and test rounded half to even, train the rest."""
    v, t = round(total * RATIOS["validation"]), round(total * RATIOS["test"])
    return {"train": total - v - t, "validation": v, "test": t}


def assign(identities: DataFrame, grouped: DataFrame) -> DataFrame:
    """(record_id, ip, group_id, split): groups of several ips go to train; the rest of each ip is a unit, and units go, largest first (ties by name), to the
    split that is furthest below its target (ties: train, validation, test).

    Only the units' sizes reach the driver: one row per ip, checked to be at most 100,000. Null ips are one unit named ''.
    """
    spark = identities.sparkSession
    ip = identities.where("record_id is not null").groupBy("record_id").agg(F.min(F.coalesce("ip", F.lit(""))).alias("ip"))
    j = grouped.join(ip, "record_id")
    multi = j.groupBy("group_id").agg((F.min("ip") != F.max("ip")).alias("multi"))
    j = j.join(multi, "group_id")
    sizes = j.groupBy("ip").agg(F.count_if(~F.col("multi")).alias("n"), F.count_if("multi").alias("m")).limit(100_001).collect()
    if len(sizes) > 100_000:
        raise ValueError("more than 100,000 sources; their sizes don't fit the driver")
    want = targets(sum(r["n"] + r["m"] for r in sizes))
    have = {"train": sum(r["m"] for r in sizes), "validation": 0, "test": 0}
    rows = []
    for n, name in sorted(((r["n"], r["ip"]) for r in sizes if r["n"]), key=lambda x: (-x[0], x[1])):
        split = max(want, key=lambda s: want[s] - have[s])
        have[split] += n
        rows.append((name, split))
    unit = spark.createDataFrame(rows, "ip string, unit string")
    return j.join(F.broadcast(unit), "ip", "left").select("record_id", "ip", "group_id", F.when(F.col("multi"), "train").otherwise(F.col("unit")).alias("split"))


def crossing(identities: DataFrame, split: DataFrame) -> DataFrame:
    """Per kind of identity: values, and values whose records stand in more than one split."""
    r = identities.select("record_id", *HARD, SOFT).distinct().join(split.select("record_id", "split").distinct(), "record_id")
    held = r.select("split", F.explode(F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).alias("value")) for c in (*HARD, SOFT)])).alias("x")).select("split", "x.kind", "x.value").where("value <> ''")
    v = held.groupBy("kind", "value").agg((F.min("split") != F.max("split")).alias("crosses"))
    return v.groupBy("kind").agg(F.count("*").alias("n_values"), F.count_if("crosses").alias("n_crossing"))
