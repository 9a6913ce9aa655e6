"""Queries of reports, evidence, boundaries and typed tables; with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evidence, fsm, governance, reports
from ..sources import rtl
from ..sources.tables import Scratch, table
from . import hardware


def _machines(s, d):
    return reports.machine_rows(table(s, d, "fsm_ctrl"))


def machine_report(s, d):
    return _machines(s, d).select("doc_id", "machine", "ip", "module", "style", "status", "quality", "n_states", "n_transitions", "n_outputs", "coverage")


def machine_summary(s, d):
    return reports.machine_summary(_machines(s, d))


def machine_low_confidence(s, d):
    return reports.low_confidence(_machines(s, d)).select("doc_id", "machine", "quality", "score")


def machine_training(s, d):
    return reports.training_candidates(_machines(s, d)).select("doc_id", "machine", "quality", "n_states", "n_transitions")


def machine_gaps(s, d):
    return reports.gaps(_machines(s, d)).groupBy("gap").agg(F.count("*").alias("n_machines"), F.max("n_states").alias("max_states"))


def machine_quality_report(s, d):
    return reports.quality_report(_machines(s, d))


def machine_encodings(s, d):
    return reports.encoding_share(_machines(s, d))


def machine_sizes(s, d):
    """Machines by number of states."""
    return _machines(s, d).groupBy("n_states").agg(F.count("*").alias("n_machines"))


def machine_self_loops(s, d):
    """Loops that a single conditional way out implies."""
    return evidence.self_loops(fsm.transitions(table(s, d, "fsm_ctrl")).where("move <> 'unknown'"))


def state_evidence(s, d):
    rows = Scratch(s).save(hardware._rows(s, d, "register", "leaf", "statement", "enum", "parameter"))
    x = evidence.verdict(evidence.score(evidence.register_features(rows)))
    return x.select("record_id", "module", "name", "score", "confidence", "percent", "required", "bonus", "penalty", "verdict")


def state_choice(s, d):
    """The likeliest state register of each module."""
    rows = Scratch(s).save(hardware._rows(s, d, "register", "leaf", "statement", "enum", "parameter"))
    return evidence.best(evidence.score(evidence.register_features(rows)))


def coverage_families(s, d):
    return reports.families(hardware._rows(s, d, "parameter", "enum", "pin", "port", "net", "signal", "machine"))


def prompt_layer_use(s, d):
    """Records whose sources name the prompt layer, by task: only rtl_generation and rtl_understanding may."""
    r = table(s, d, "dataset_records").select("record_id", F.col("task.id").alias("task"), "sources").distinct()
    uses = F.exists("sources", lambda x: x["layer"] == "prompt_v2")
    x = r.groupBy("task").agg(F.count_if(uses).alias("n_using"), F.count("*").alias("n_records"))
    return x.withColumn("allowed", F.col("task").isin("rtl_generation", "rtl_understanding"))


def source_layers(s, d):
    """Sources of the records by layer: how many there are, with a path that isn't absolute, and with a whole digest."""
    x = table(s, d, "dataset_records").select("record_id", F.explode("sources").alias("x")).select("record_id", "x.layer", "x.path", "x.sha256").distinct()
    return x.groupBy("layer").agg(F.count("*").alias("n_sources"), F.count_if(~F.col("path").startswith("/")).alias("n_portable"), F.count_if(F.col("sha256").rlike("^[0-9a-f]{64}$")).alias("n_digests"))


def task_split_report(s, d):
    """Per task and split: records, with an empty target, and the sizes of their inputs (least, median by index, largest)."""
    r = table(s, d, "dataset_records").select("record_id", F.col("task.id").alias("task"), "split", F.coalesce(F.length("input.text"), F.lit(0)).alias("n"), (F.coalesce("target.text", "target.value", F.lit("")) == "").alias("empty")).distinct()
    return r.groupBy("task", "split").agg(F.count("*").alias("n_records"), F.count_if("empty").alias("n_empty"), F.min("n").alias("least"), F.max("n").alias("largest"), F.sum("n").alias("n_chars"))


def record_problems(s, d):
    """Records by what is wrong with their shape."""
    r = table(s, d, "dataset_records")
    checks = {
        "no module_id": F.col("module.module_id").isNull(), "no split": F.col("split").isNull() | ~F.col("split").isin("train", "validation", "test"), "no input": F.coalesce(F.length("input.text"), F.lit(0)) == 0,
        "no target": F.coalesce(F.length("target.text"), F.length("target.value"), F.lit(0)) == 0, "no sources": F.coalesce(F.size("sources"), F.lit(0)) <= 0, "record_id malformed": ~F.coalesce(F.col("record_id").rlike("^r2:[0-9a-f]{16}$"), F.lit(False)),
    }
    return governance.tally(r, "record_id", checks)


def value_shapes(s, d):
    """JSON targets by projection: whole objects, and the names their top level has."""
    r = table(s, d, "dataset_records").where("target.kind = 'json'").select("record_id", F.col("target.projection").alias("projection"), F.col("target.value").alias("v")).distinct()
    keys = F.array_join(F.sort_array(F.json_object_keys("v")), ",")
    return r.groupBy("projection", keys.alias("keys")).agg(F.count("*").alias("n_records"))


def target_keys(s, d):
    """Flat keys of all JSON targets with the number of records that have each."""
    r = table(s, d, "dataset_records").where("target.kind = 'json' and target.value is not null").select(F.col("record_id").alias("name"), F.col("target.value").alias("value")).distinct()
    return reports.flat_keys(r).groupBy("key").agg(F.count("*").alias("n"))


def projection_digests(s, d):
    """Per projection one digest over all modules' projections."""
    x = rtl.read_projections(hardware._texts(s, d)).select(F.col("projection").alias("layer"), F.concat_ws("/", "record_id", "module").alias("path"), F.sha2("value", 256).alias("content_sha256"))
    return reports.tree_digests(x)


QUERIES = {f.__name__: f for f in (machine_report, machine_summary, machine_low_confidence, machine_training, machine_gaps, machine_quality_report, machine_encodings, machine_sizes, machine_self_loops, state_evidence, state_choice, coverage_families, prompt_layer_use, source_layers, task_split_report, record_problems, value_shapes, target_keys, projection_digests)}

_B = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_M = f"""f0 AS (SELECT DISTINCT doc_id, trim(ip) AS ip, trim(module) AS module, fsms FROM fsm_ctrl), m AS (SELECT doc_id, ip, module, k - 1 AS machine, f FROM (SELECT doc_id, ip, module, unnest(fsms) AS f, generate_subscripts(fsms, 1) AS k FROM f0)),
st AS (SELECT DISTINCT doc_id, machine, trim(x.name, {_B}) AS state FROM (SELECT doc_id, machine, unnest(f.states) AS x FROM m) WHERE x.name IS NOT NULL),
tr AS (SELECT doc_id, machine, trim(x.from_state, {_B}) AS src, trim(x.to_state, {_B}) AS dst, x.condition AS condition FROM (SELECT doc_id, machine, unnest(f.transitions) AS x FROM m) WHERE x.from_state IS NOT NULL AND x.to_state IS NOT NULL AND trim(x.from_state, {_B}) NOT LIKE '*%' AND trim(x.to_state, {_B}) NOT LIKE '*%'),
nt AS (SELECT doc_id, machine, count(*) AS n_transitions, count(*) FILTER (src = dst) AS n_self FROM tr GROUP BY ALL),
ns AS (SELECT st.doc_id, st.machine, count(*) AS n_states, count(*) FILTER (o.state IS NULL) AS n_orphan, count(*) FILTER (o.state IS NULL AND i.state IS NOT NULL) AS n_terminal, round(100 * count(o.state) / count(*), 2) AS coverage FROM st LEFT JOIN (SELECT DISTINCT doc_id, machine, src AS state FROM tr WHERE src <> dst) o USING (doc_id, machine, state) LEFT JOIN (SELECT DISTINCT doc_id, machine, dst AS state FROM tr WHERE src <> dst) i USING (doc_id, machine, state) GROUP BY ALL),
r AS (SELECT doc_id, machine, ip, module, f.style AS style, f.status AS status, f.quality AS quality, f.encoding.style AS encoding, coalesce(len(f.outputs), 0) AS n_outputs, coalesce(n_transitions, 0) AS n_transitions, coalesce(n_self, 0) AS n_self, coalesce(n_states, 0) AS n_states, n_orphan, n_terminal, coalesce(coverage, 0.0) AS coverage, CASE WHEN n_states IS NULL THEN NULL WHEN coverage >= 90 AND n_orphan = 0 THEN 'high' WHEN coverage >= 70 THEN 'medium' ELSE 'low' END AS score FROM m LEFT JOIN nt USING (doc_id, machine) LEFT JOIN ns USING (doc_id, machine))"""
SQL = {
    "machine_report": f"WITH {_M} SELECT doc_id, machine, ip, module, style, status, quality, n_states, n_transitions, n_outputs, coverage FROM r",
    "machine_summary": f"WITH {_M} SELECT count(DISTINCT ip || '/' || module) AS n_modules, count(*) AS n_machines, count(*) FILTER (quality = 'high') AS n_high, count(*) FILTER (quality = 'medium') AS n_medium, count(*) FILTER (quality = 'low') AS n_low, round(avg(n_states), 2) AS avg_states, round(avg(n_transitions), 2) AS avg_transitions, max(n_states) AS max_states, (SELECT ip || '/' || module FROM r ORDER BY n_states DESC, doc_id, machine LIMIT 1) AS largest FROM r",
    "machine_low_confidence": f"WITH {_M} SELECT doc_id, machine, quality, score FROM r WHERE quality = 'low' OR score = 'low'",
    "machine_training": f"WITH {_M} SELECT doc_id, machine, quality, n_states, n_transitions FROM r WHERE quality IN ('high', 'medium') AND n_states >= 3 AND n_transitions >= n_states",
    "machine_gaps": f"WITH {_M} SELECT CASE WHEN n_transitions = 0 THEN 'no_transitions' ELSE 'few_transitions' END AS gap, count(*) AS n_machines, max(n_states) AS max_states FROM r WHERE n_transitions = 0 OR n_states >= 4 AND n_transitions <= 2 GROUP BY 1",
    "machine_quality_report": f"WITH {_M} SELECT score, count(*) AS n_machines, CAST(sum(n_orphan) AS BIGINT) AS n_orphan, CAST(sum(n_terminal) AS BIGINT) AS n_terminal, round(avg(coverage), 4) AS avg_coverage, round(avg(n_self), 4) AS avg_self FROM r WHERE n_states >= 2 GROUP BY score",
    "machine_encodings": f"WITH {_M} SELECT style, count(*) AS n_machines, count(*) FILTER (encoding <> 'unknown') AS n_known, round(100.0 * count(*) FILTER (encoding <> 'unknown') / count(*), 2) AS share FROM r GROUP BY style",
    "machine_sizes": f"WITH {_M} SELECT n_states, count(*) AS n_machines FROM r GROUP BY 1",
    "machine_self_loops": f"WITH {_M} SELECT doc_id, machine, src AS state, '!(' || min(condition) || ')' AS condition FROM tr WHERE src <> dst GROUP BY ALL HAVING count(*) = 1 AND min(condition) IS NOT NULL AND trim(min(condition)) NOT IN ('', '1')",
    "prompt_layer_use": "SELECT task, count(*) FILTER (len(list_filter(sources, lambda x: x.layer = 'prompt_v2')) > 0) AS n_using, count(*) AS n_records, task IN ('rtl_generation', 'rtl_understanding') AS allowed FROM (SELECT DISTINCT record_id, task.id AS task, sources FROM dataset_records) GROUP BY task",
    "source_layers": "SELECT layer, count(*) AS n_sources, count(*) FILTER (NOT starts_with(path, '/')) AS n_portable, count(*) FILTER (regexp_matches(sha256, '^[0-9a-f]{64}$')) AS n_digests FROM (SELECT DISTINCT record_id, x.layer AS layer, x.path AS path, x.sha256 AS sha256 FROM (SELECT record_id, unnest(sources) AS x FROM dataset_records)) GROUP BY layer",
    "task_split_report": "SELECT task, split, count(*) AS n_records, count(*) FILTER (empty) AS n_empty, min(n) AS least, max(n) AS largest, CAST(sum(n) AS BIGINT) AS n_chars FROM (SELECT DISTINCT record_id, task.id AS task, split, coalesce(length(input.text), 0) AS n, coalesce(target.text, target.value, '') = '' AS empty FROM dataset_records) GROUP BY ALL",
    "record_problems": "SELECT problem, count(DISTINCT record_id) FILTER (bad) AS n, count(DISTINCT record_id) AS n_checked FROM (SELECT record_id, unnest(['no module_id', 'no split', 'no input', 'no target', 'no sources', 'record_id malformed']) AS problem, unnest([module.module_id IS NULL, coalesce(split NOT IN ('train', 'validation', 'test'), true), coalesce(length(input.text), 0) = 0, coalesce(length(target.text), length(target.value), 0) = 0, coalesce(len(sources), 0) = 0, NOT coalesce(regexp_matches(record_id, '^r2:[0-9a-f]{16}$'), false)]) AS bad FROM dataset_records) GROUP BY problem",
    "value_shapes": "SELECT projection, array_to_string(list_sort(json_keys(v)), ',') AS keys, count(*) AS n_records FROM (SELECT DISTINCT record_id, target.projection AS projection, target.value AS v FROM dataset_records WHERE target.kind = 'json') GROUP BY ALL",
    "target_keys": "SELECT key, count(*) AS n FROM (SELECT unnest(json_keys(v)) AS key FROM (SELECT DISTINCT record_id, target.value AS v FROM dataset_records WHERE target.kind = 'json' AND target.value IS NOT NULL)) GROUP BY key",
}
