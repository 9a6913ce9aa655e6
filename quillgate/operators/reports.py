"""Reports over machines, records and texts: summaries, selections, coverage families, and the comparison of two reports."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import fsm as machines
from .stats import coverage


def machine_rows(docs: DataFrame) -> DataFrame:
    """Per machine: ip, module, style, status, quality, states, transitions (between named states), outputs, share of states that are left."""
    m = machines.machines(docs).join(docs.select("doc_id", "ip", "module").distinct(), "doc_id")
    rows = m.select("doc_id", "machine", F.trim("ip").alias("ip"), F.trim("module").alias("module"), F.col("f.style").alias("style"), F.col("f.status").alias("status"), F.col("f.quality").alias("quality"), F.col("f.encoding.style").alias("encoding"), F.greatest(F.size("f.outputs"), F.lit(0)).alias("n_outputs"))
    t = machines.transitions(docs).where("move <> 'unknown'").groupBy("doc_id", "machine").agg(F.count("*").alias("n_transitions"))
    q = machines.quality(docs).select("doc_id", "machine", "n_states", "n_orphan", "n_terminal", "n_self", "coverage", "score")
    j = rows.join(t, ["doc_id", "machine"], "left").join(q, ["doc_id", "machine"], "left")
    return j.withColumns({"n_transitions": F.coalesce("n_transitions", F.lit(0)), "n_states": F.coalesce("n_states", F.lit(0)), "coverage": F.coalesce("coverage", F.lit(0.0))})


def machine_summary(rows: DataFrame) -> DataFrame:
    """One row: modules, machines, machines by quality, average and largest sizes; the largest machine is the one of most states (ties: least key)."""
    big = F.max_by(F.concat_ws("/", "ip", "module"), F.struct("n_states", (-F.col("doc_id")).alias("d"), (-F.col("machine")).alias("m")))
    return rows.agg(F.countDistinct("ip", "module").alias("n_modules"), F.count("*").alias("n_machines"), *[F.count_if(F.col("quality") == k).alias(f"n_{k}") for k in ("high", "medium", "low")], F.round(F.avg("n_states"), 2).alias("avg_states"), F.round(F.avg("n_transitions"), 2).alias("avg_transitions"), F.max("n_states").alias("max_states"), big.alias("largest"))


def low_confidence(rows: DataFrame) -> DataFrame:
    return rows.where("quality = 'low' or score = 'low'")


def training_candidates(rows: DataFrame) -> DataFrame:
    """Machines worth learning from: quality high or medium, three states or more, as many transitions as states."""
    return rows.where("quality in ('high', 'medium') and n_states >= 3 and n_transitions >= n_states")


def gaps(rows: DataFrame) -> DataFrame:
    """Machines with no transition at all, or four states and more but two transitions at most."""
    return rows.where("n_transitions = 0 or n_states >= 4 and n_transitions <= 2").withColumn("gap", F.when(F.col("n_transitions") == 0, "no_transitions").otherwise("few_transitions"))


def quality_report(rows: DataFrame) -> DataFrame:
    """Machines of two states or more by score: their number, orphan and terminal states, average coverage and self loops."""
    x = rows.where("n_states >= 2")
    return x.groupBy("score").agg(F.count("*").alias("n_machines"), F.sum("n_orphan").alias("n_orphan"), F.sum("n_terminal").alias("n_terminal"), F.round(F.avg("coverage"), 4).alias("avg_coverage"), F.round(F.avg("n_self"), 4).alias("avg_self"))


def encoding_share(rows: DataFrame) -> DataFrame:
    """Per style the share of machines with a known encoding."""
    known = F.count_if(F.col("encoding").isNotNull() & (F.col("encoding") != "unknown"))
    return rows.groupBy("style").agg(F.count("*").alias("n_machines"), known.alias("n_known")).withColumn("share", coverage(F.col("n_known"), F.col("n_machines"), 0.0))


def families(rows: DataFrame) -> DataFrame:
    """(family, known, total, coverage) over section rows of parsed texts: parameters and enum members with a value, instances whose module is known, connections
    whose direction is known, signals with a width, ports with a direction, symbols whose drivers are known. Coverage is null without any."""
    fam = F.when(F.col("section").isin("parameter", "enum"), F.col("section")).when(F.col("section") == "pin", "connection").when(F.col("section") == "port", "port").when(F.col("section") == "net", "type").when(F.col("section") == "signal", "symbol").when(F.col("section") == "machine", "machine")
    known = F.when(F.col("section").isin("parameter", "enum"), F.col("n").isNotNull()).when(F.col("section") == "pin", F.col("role") != "unknown").when(F.col("section") == "port", F.col("kind").isNotNull()).when(F.col("section") == "net", F.col("width").isNotNull()).when(F.col("section") == "signal", F.col("status") != "unknown").otherwise(F.col("status") == "confirmed")
    g = rows.select(fam.alias("family"), known.alias("k")).where("family is not null").groupBy("family").agg(F.count_if("k").alias("known"), F.count("*").alias("total"))
    return g.withColumn("coverage", coverage(F.col("known"), F.col("total"), None))


def variants(records: DataFrame) -> DataFrame:
    """(task, variant, n): prompts by variant, the part before the last of a dotted file name, legacy where it has fewer than three parts."""
    p = F.split("file", r"\.")
    return records.select("task", F.when(F.size(p) < 3, "legacy").otherwise(F.element_at(p, -2)).alias("variant")).groupBy("task", "variant").agg(F.count("*").alias("n"))


# Tasks by the suffix of a prompt's file name (fixed values).
TASK_OF = {"rtl": "rtl_generation", "behavior": "behavior_explanation", "interface": "interface_extraction", "fsm": "fsm_extraction", "verification": "verification"}


def task_of(file: F.Column) -> F.Column:
    """Task of <module>.<suffix>.txt; rtl_generation where the suffix says nothing."""
    suffix = F.element_at(F.split(file, r"\."), -2)
    named = F.element_at(F.create_map(*[F.lit(x) for kv in TASK_OF.items() for x in kv]), suffix)
    return F.coalesce(F.when(F.size(F.split(file, r"\.")) >= 3, named), F.lit("rtl_generation"))


def text_sizes(texts: DataFrame) -> DataFrame:
    """One row over (module, text, top): lines and characters; the largest module is the first of the most lines by name."""
    n = F.size(F.split("text", "\n", -1))
    x = texts.select("module", n.alias("lines"), F.length("text").alias("chars"), "top")
    return x.agg(F.count("*").alias("n"), F.min("lines").alias("min_lines"), F.round(F.avg("lines"), 1).alias("avg_lines"), F.max("lines").alias("max_lines"), F.round(F.avg("chars"), 0).alias("avg_chars"), F.max("chars").alias("max_chars"), F.min_by("module", F.struct((-F.col("lines")).alias("l"), "module")).alias("largest"), F.countDistinct(F.when(F.col("top"), F.col("module"))).alias("n_top"), F.countDistinct(F.when(~F.col("top"), F.col("module"))).alias("n_leaf"))


def _flat(value, prefix: str = "") -> Iterator[tuple[str, str]]:
    if isinstance(value, dict) and value:
        for k in sorted(value):
            yield from _flat(value[k], f"{prefix}.{k}" if prefix else str(k))
    else:
        yield prefix, json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def flat_keys(reports: DataFrame) -> DataFrame:
    """reports (name, value: JSON) to (name, key, value): nested objects as dotted keys; lists and scalars are values as JSON. What can't be read has no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for n, v in zip(b.column("name").to_pylist(), b.column("value").to_pylist()):
                try:
                    rows += [(n, *kv) for kv in _flat(json.loads(v))]
                except (TypeError, ValueError):
                    continue
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.string()) for k in range(3)], names=["name", "key", "value"])

    return reports.select("name", "value").mapInArrow(run, "name string, key string, value string")


def differences(expected: DataFrame, found: DataFrame) -> DataFrame:
    """(name, key, expected, found) of flat reports that disagree; a key on one side only is null on the other."""
    a, b = expected.withColumnRenamed("value", "expected"), found.withColumnRenamed("value", "found")
    return a.join(b, ["name", "key"], "full_outer").where("not (expected <=> found)").select("name", "key", "expected", "found")


def tree_digests(files: DataFrame) -> DataFrame:
    """files (layer, path, content_sha256): (layer, n_files, digest), the digest over the files' digests in the order of their paths. A layer's lines are
    hashed in 256 buckets of their path first, so no task holds a whole layer."""
    line = F.concat_ws(":", "path", "content_sha256")
    b = files.groupBy("layer", F.substring(F.sha2("path", 256), 1, 2).alias("bucket")).agg(F.sha2(F.array_join(F.sort_array(F.collect_list(line)), "\n"), 256).alias("h"), F.count("*").alias("n"))
    return b.groupBy("layer").agg(F.sum("n").alias("n_files"), F.sha2(F.array_join(F.sort_array(F.collect_list(F.concat_ws(":", "bucket", "h"))), "\n"), 256).alias("digest"))
