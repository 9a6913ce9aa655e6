"""Queries over the hardware texts of the records: parsed modules, their analyses and state machines; with SQL where a pattern can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import expr
from ..operators import prompts
from ..sources import rtl
from ..sources.tables import Scratch, clean, table


def _texts(s, d) -> DataFrame:
    t = F.when(F.col("input.kind") == "rtl", F.col("input.text")).otherwise(F.col("target.text"))
    return rtl.spread(table(s, d, "dataset_records").select("record_id", t.alias("text")).where("text is not null"))


def _rows(s, d, *kinds: str) -> DataFrame:
    return rtl.read_rtl(_texts(s, d), *kinds)


def _list(name: str) -> F.Column:
    return F.from_json(name, "array<string>")


def rtl_sections(s, d):
    return _rows(s, d, *rtl.PLAIN, *rtl.ANALYSED, *rtl.MACHINES).groupBy("section").agg(F.count("*").alias("n_rows"), F.countDistinct("record_id").alias("n_records"))


def rtl_interfaces(s, d):
    """Inputs and outputs of each module; parameters of its header."""
    x = _rows(s, d, "port", "parameter")
    return x.groupBy("record_id", "module").agg(F.count_if(F.col("kind") == "input").alias("n_inputs"), F.count_if(F.col("kind") == "output").alias("n_outputs"), F.count_if((F.col("kind") == "parameter") & (F.col("context") == "header")).alias("n_parameters"))


def rtl_ports(s, d):
    return _rows(s, d, "port").select("record_id", "module", "name", F.col("kind").alias("direction"), F.col("role").alias("declaration"), F.col("status").alias("type"), F.col("width").cast("int").alias("width"))


def rtl_constants(s, d):
    """Parameters, localparams and enum members with their value, null where it can't be told."""
    return _rows(s, d, "parameter", "enum").select("record_id", "module", "name", F.when(F.col("section") == "enum", "enum_member").otherwise(F.col("kind")).alias("kind"), F.col("n").alias("constant"))


def rtl_expressions(s, d):
    x = _rows(s, d, "assign").where("kind in ('continuous', 'declaration')").select("record_id", "module", "name", "value").distinct().withColumn("e", expr.expression_facts("value"))
    return x.select("record_id", "module", "name", F.col("e.nodes").alias("nodes"), F.col("e.depth").alias("depth"), F.col("e.value").alias("constant"), F.col("e.wording").alias("wording"))


def rtl_nodes(s, d):
    """Nodes of all expressions by kind, a row per kind: flattened trees."""
    x = _rows(s, d, "assign", "statement").where("value is not null").select("value")
    return x.select(F.explode(expr.node_kinds("value")).alias("kind")).groupBy("kind").agg(F.count("*").alias("n"))


def rtl_processes(s, d):
    return _rows(s, d, "process").select("record_id", "module", F.col("name").cast("int").alias("process"), F.col("kind").alias("keyword"), "role", F.col("status").alias("confidence"), "clock", "reset", F.col("n").alias("n_targets"))


def rtl_registers(s, d):
    return _rows(s, d, "register").select("record_id", "module", "name", F.col("width").cast("int").alias("width"), "clock", "edge", "reset", "kind", F.col("role").alias("update"), F.col("status").alias("hold"), F.array_join(_list("detail"), ",").alias("enables")).distinct()


def rtl_events(s, d):
    """Processes, edges they wait for and continuous assignments of each module."""
    x = _rows(s, d, "process", "assign")
    return x.groupBy("record_id", "module").agg(F.count_if(F.col("section") == "process").alias("n_processes"), F.coalesce(F.sum(F.when(F.col("section") == "process", F.col("value").cast("long"))), F.lit(0)).alias("n_edges"), F.count_if(F.col("kind") == "continuous").alias("n_assigns"))


def rtl_leaves(s, d):
    """What each register does at the end of its paths, in order of priority."""
    return _rows(s, d, "leaf").select("record_id", "module", "name", F.col("n").alias("rank"), "kind", "value", "context")


def rtl_enables(s, d):
    return _rows(s, d, "enable").select("record_id", "module", "name", F.col("value").alias("condition"), F.col("kind").alias("update_branch"), F.array_join(_list("detail"), ",").alias("signals"))


def rtl_latches(s, d):
    return _rows(s, d, "latch").groupBy("role", F.col("kind").alias("completeness"), F.col("status").alias("latch")).agg(F.count("*").alias("n"))


def rtl_read_write(s, d):
    """Signals a process reads and writes by what comes first."""
    return _rows(s, d, "read_write").groupBy(F.col("kind").alias("order_class")).agg(F.count("*").alias("n"), F.countDistinct("record_id").alias("n_records"))


def rtl_dependencies(s, d):
    x = _rows(s, d, "dependency").withColumn("f", F.from_json("detail", "direct boolean, partial boolean"))
    return x.groupBy("record_id", "module", F.col("name").alias("source"), "target", "kind").agg(F.bool_and("f.direct").alias("direct"), F.bool_or("f.partial").alias("partial"), F.count("*").alias("n"))


def rtl_drivers(s, d):
    return _rows(s, d, "driver").select("record_id", "module", "name", "kind", F.col("target").alias("unit"), "status", "context")


def rtl_loads(s, d):
    return _rows(s, d, "load").groupBy("record_id", "module", "name", "kind").agg(F.count("*").alias("n"))


def rtl_signals(s, d):
    x = _rows(s, d, "signal", "fan")
    f = x.where("section = 'fan'").select("record_id", "module", "name", F.from_json("detail", "in struct<direct: int, expression: int, control: int, drivers: int>, out struct<processes: int, signals: int, outputs: int, loads: int>").alias("f"))
    g = x.where("section = 'signal'").select("record_id", "module", "name", "status", F.col("value").alias("multiple_drivers"), F.col("n").alias("n_drivers"))
    j = g.join(f, ["record_id", "module", "name"])
    return j.select("record_id", "module", "name", "status", "multiple_drivers", "n_drivers", F.col("f.in.direct").alias("in_direct"), F.col("f.in.expression").alias("in_expression"), F.col("f.in.control").alias("in_control"), F.col("f.out.signals").alias("out_signals"), F.col("f.out.outputs").alias("out_outputs"), F.col("f.out.loads").alias("out_loads"))


def rtl_undriven_outputs(s, d):
    """Outputs nothing drives, or may not."""
    return _rows(s, d, "signal").where("role = 'output' and status in ('undriven', 'unknown')").select("record_id", "module", "name", "status")


def rtl_classes(s, d):
    return _rows(s, d, "class").groupBy(F.col("kind").alias("class"), "status").agg(F.count("*").alias("n_signals"), F.countDistinct("record_id").alias("n_records"))


def rtl_loops(s, d):
    return _rows(s, d, "loop").select("record_id", "module", "name", "status", F.array_join(_list("detail"), ",").alias("signals"))


def rtl_cones(s, d):
    x = _rows(s, d, "cone").withColumn("c", F.from_json("detail", "signals array<string>, registers array<string>, inputs array<string>, outputs array<string>"))
    return x.select("record_id", "module", F.col("name").alias("root"), F.col("kind").alias("direction"), F.col("n").alias("depth"), *[F.size(f"c.{k}").alias(f"n_{k}") for k in ("signals", "registers", "inputs", "outputs")])


def rtl_machines(s, d):
    return _rows(s, d, "machine").select("record_id", "module", "name", F.col("kind").alias("style"), "status", F.col("role").alias("quality"), F.col("width").cast("int").alias("width"), F.col("value").alias("encoding"), F.col("context").alias("hold"), F.col("reset").alias("reset_state"), F.col("n").alias("n_states"))


def rtl_states(s, d):
    return _rows(s, d, "state").select("record_id", "module", F.col("target").alias("register"), "name", F.col("n").alias("number"), F.col("status").alias("reachability"), F.col("reset").isNotNull().alias("is_reset"), F.col("kind").alias("named_by"))


def rtl_transitions(s, d):
    return _rows(s, d, "transition").select("record_id", "module", F.col("name").alias("register"), F.col("value").alias("from_state"), F.col("target").alias("to_state"), "kind", "status", F.col("context").alias("condition"), F.col("n").alias("priority")).distinct()


def rtl_outputs(s, d):
    return _rows(s, d, "output").select("record_id", "module", F.col("target").alias("register"), "name", "kind", F.col("status").alias("timing"))


def rtl_actions(s, d):
    return _rows(s, d, "action").select("record_id", "module", F.col("target").alias("register"), F.col("role").alias("state"), "name", "kind", "value", "context")


def rtl_couplings(s, d):
    return _rows(s, d, "coupling").select("record_id", "module", F.col("name").alias("from_register"), F.col("target").alias("to_register"), "kind")


def rtl_rejected(s, d):
    return _rows(s, d, "rejected").groupBy(F.col("kind").alias("reason")).agg(F.count("*").alias("n"))


def rtl_pins(s, d):
    """Pins of instances beside the ports their child has in the same ip, by status; a module is that of its last record."""
    ips = table(s, d, "dataset_records").select("record_id", clean(F.col("module.ip")).alias("ip")).distinct()
    x = _rows(s, d, "module", "port", "pin").join(ips, "record_id")
    last = rtl.last_modules(x.where("section = 'module'").select("ip", "module", "record_id"), "record_id").select("ip", "module", "record_id")
    x = x.join(last, ["ip", "module", "record_id"], "left_semi")
    ports = x.where("section = 'port'").select("ip", "module", "name", F.col("kind").alias("direction"))
    pins = x.where("section = 'pin'").select("ip", F.col("module").alias("parent"), F.col("kind").alias("instance"), F.col("target").alias("child"), F.col("name").alias("port"), F.col("value").alias("signal"))
    return rtl.linked_pins(pins, ports).groupBy("ip", "child", "status").agg(F.count("*").alias("n_pins"), F.countDistinct("parent", "instance").alias("n_instances"))


def rtl_counts(s, d):
    """Rows of the behaviour, structure and machine layers by section and kind."""
    x = _rows(s, d, *rtl.ANALYSED, *rtl.MACHINES)
    return x.where("section not in ('fan', 'cone')").groupBy("section", "kind", "status").agg(F.count("*").alias("n"))


_SPOKEN = ("port", "register", "assign", "machine", "transition", "instance")


def rtl_prompts(s, d):
    """Prompts of all modules within 32,768 bytes, by size."""
    return prompts.render(_rows(s, d, *_SPOKEN)).select("record_id", "module", "n_bytes", "n_records", "n_dropped", F.sha2("prompt", 256).alias("sha256"))


def rtl_prompt_faults(s, d):
    """Prompts by the rule they break; every rule has a row."""
    p = Scratch(s).save(prompts.render(_rows(s, d, *_SPOKEN)))
    n = p.agg(F.count("*").alias("n_prompts"))
    return prompts.faults(p).groupBy("problem").agg(F.count("*").alias("n")).unionByName(n.select(F.lit("prompts").alias("problem"), F.col("n_prompts").alias("n")))


def rtl_projections(s, d):
    """Canonical projections of every module by size and digest."""
    return rtl.read_projections(_texts(s, d)).select("record_id", "module", "projection", F.length("value").alias("n_chars"), F.sha2("value", 256).alias("sha256"))


QUERIES = {f.__name__: f for f in (rtl_sections, rtl_interfaces, rtl_ports, rtl_constants, rtl_expressions, rtl_nodes, rtl_processes, rtl_registers, rtl_events, rtl_leaves, rtl_enables, rtl_latches, rtl_read_write, rtl_dependencies, rtl_drivers, rtl_loads, rtl_signals, rtl_undriven_outputs, rtl_classes, rtl_loops, rtl_cones, rtl_machines, rtl_states, rtl_transitions, rtl_outputs, rtl_actions, rtl_couplings, rtl_rejected, rtl_pins, rtl_counts, rtl_prompts, rtl_prompt_faults, rtl_projections)}

# In the records every module has its ports in the header, one declaration per port, and its constants are numbers: patterns can say the same.
_TEXT = """t AS (SELECT DISTINCT record_id, regexp_replace(regexp_replace(CASE WHEN input.kind = 'rtl' THEN input.text ELSE target.text END, '(?s)/\\*.*?\\*/', ' ', 'g'), '//[^\\n]*', ' ', 'g') AS t FROM dataset_records),
m AS (SELECT record_id, t, regexp_extract(t, 'module\\s+(\\w+)', 1) AS module, regexp_extract(t, '(?s)module\\s+\\w+\\s*(?:#\\s*\\(.*?\\)\\s*)?\\((.*?)\\)\\s*;', 1) AS head FROM t WHERE regexp_matches(t, '(?s)module\\s+\\w+.*endmodule'))"""
SQL = {
    "rtl_interfaces": f"WITH {_TEXT} SELECT record_id, module, len(regexp_extract_all(head, '\\binput\\b')) AS n_inputs, len(regexp_extract_all(head, '\\boutput\\b')) AS n_outputs, len(regexp_extract_all(regexp_extract(t, '(?s)module\\s+\\w+\\s*#\\s*\\((.*?)\\)', 1), '=')) AS n_parameters FROM m",
    "rtl_ports": f"""WITH {_TEXT}, p AS (SELECT record_id, module, unnest(regexp_extract_all(head, '(?:input|output|inout)[^,]*')) AS p FROM m),
q AS (SELECT record_id, module, trim(p) AS p FROM p)
SELECT record_id, module, regexp_extract(p, '(\\w+)\\s*$', 1) AS name, regexp_extract(p, '^(\\w+)', 1) AS direction, CASE WHEN regexp_matches(p, '\\b(reg|logic)\\b') THEN 'variable' ELSE 'net' END AS declaration, nullif(regexp_extract(p, '\\b(reg|logic)\\b', 1), '') AS type, CASE WHEN p LIKE '%[%' THEN CAST(regexp_extract(p, '\\[(\\d+):', 1) AS INT) - CAST(regexp_extract(p, ':(\\d+)\\]', 1) AS INT) + 1 ELSE 1 END AS width FROM q""",
    "rtl_events": f"WITH {_TEXT} SELECT record_id, module, len(regexp_extract_all(t, '\\balways(_ff|_comb|_latch)?\\b')) AS n_processes, len(regexp_extract_all(t, '\\b(posedge|negedge)\\b')) AS n_edges, len(regexp_extract_all(t, '\\bassign\\b')) AS n_assigns FROM m",
    "rtl_constants": f"""WITH {_TEXT}, p AS (SELECT record_id, module, unnest(regexp_extract_all(t, '(?s)\\blocalparam\\b([^;]*);', 1)) AS p FROM m), q AS (SELECT record_id, module, unnest(string_split(p, ',')) AS p FROM p)
SELECT record_id, module, regexp_extract(p, '(\\w+)\\s*=', 1) AS name, 'localparam' AS kind, CAST(regexp_extract(p, '''d(\\d+)', 1) AS BIGINT) AS constant FROM q""",
}
