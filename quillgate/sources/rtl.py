"""Texts of the hardware language to flat section rows and to projections. One pass over each text in Arrow batches, no shuffle; comments don't count."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import expr as E
from ..rtl import machines, syntax
from ..rtl.analysis import LEVELS, Module
from .tables import ship, spread_parts

#: Columns of a section row; which of them a section fills is told in ``sections``.
COLUMNS = ("module", "name", "kind", "width", "value", "clock", "edge", "reset", "target", "status", "role", "context", "detail")
SCHEMA = "record_id string, section string, " + ", ".join(f"{c} string" for c in COLUMNS) + ", n long"
_ARROW = pa.schema([("record_id", pa.string()), ("section", pa.string())] + [(c, pa.string()) for c in COLUMNS] + [("n", pa.int64())])
#: Sections that need no analysis, only the tree.
PLAIN = ("module", "port", "parameter", "enum", "net", "assign", "instance", "pin", "typedef", "statement")
ANALYSED = ("process", "register", "leaf", "enable", "hold", "next_value", "latch", "read_write", "dependency", "driver", "load", "signal", "class", "fan", "loop", "cone", "state_candidate", "implicit_net")
MACHINES = ("machine", "state", "transition", "output", "action", "coupling", "rejected")


def _show(node) -> str | None:
    return None if node is None else E.show(node)


def sections(text: str, wanted: set[str] | None = None) -> Iterator[dict]:
    """Rows of all modules of a text, of the ``wanted`` sections or all; instances see the other modules of the text."""
    trees = syntax.modules(text)
    inventory = {t["name"]: t for t in trees}
    for tree in trees:
        m = Module(tree, inventory)
        for section, row in _rows(m, wanted):
            yield {"section": section, "module": tree["name"], **row}


_json = json.JSONEncoder(sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode


def _guards(m: Module, guards: tuple) -> str:
    """A path in words: the statement's number, branch and item."""
    return ";".join(f"{s}:{b}" + ("" if i is None else f":{i}") for s, b, i in guards)


def _rows(m: Module, wanted: set[str] | None) -> Iterator[tuple[str, dict]]:
    t = m.m
    want = lambda *s: wanted is None or bool(wanted & set(s))
    text = lambda v: None if v is None else str(v)
    if want("module"):
        yield "module", {"name": t["name"], "n": t["opaque"], "detail": _json({"subroutines": t["subroutines"], "statements": t["statements"]})}
    if want("port"):
        for p in t["ports"]:
            yield "port", {"name": p["name"], "kind": p["direction"], "width": text(m.width(p["name"])), "value": "".join(p["packed"]) or None, "role": p["kind"], "status": p["type"], "context": "signed" if p["signed"] else None}
    if want("parameter"):
        for p in t["params"]:
            yield "parameter", {"name": p["name"], "kind": "localparam" if p["local"] else "parameter", "value": _show(p["value"]), "n": _long(m.consts.get(p["name"])), "context": "header" if p["port"] else None}
    if want("enum"):
        for e in t["enums"]:
            yield "enum", {"name": e["name"], "value": _show(e["value"]), "n": _long(m.consts.get(e["name"])), "target": t["groups"][e["group"]]["name"]}
    if want("typedef"):
        for d in t["typedefs"]:
            yield "typedef", {"name": d["name"], "kind": d["kind"], "value": "".join(d["packed"]) or None}
    if want("net"):
        for s in t["signals"]:
            yield "net", {"name": s["name"], "kind": s["kind"], "status": s["type"], "width": text(m.width(s["name"])), "value": "".join(s["packed"]) or None}
    if want("assign"):
        for a in m.assigns:
            yield "assign", {"name": ",".join(a["writes"]), "kind": a["kind"], "target": E.show(a["lhs"]), "value": E.show(a["rhs"]), "context": _guards(m, a["guards"]), "n": a["line"]}
    if want("statement"):
        for sid, s in m.stmt.items():
            yield "statement", {"name": str(sid), "kind": s["k"], "value": _show(s.get("cond") or s.get("expr")), "context": _guards(m, s["guards"]), "n": len(s["guards"])}
    if want("instance"):
        for i in t["instances"]:
            yield "instance", {"name": i["name"], "target": i["module"], "n": len(i["connections"]), "detail": _json({p["port"] or str(k): _show(p["value"]) for k, p in enumerate(i["params"])})}
    if want("pin"):
        for c in m.connections:
            yield "pin", {"name": c["port"], "kind": c["instance"], "target": c["module"], "value": _show(c["value"]), "role": c["direction"], "detail": _json(c["signals"])}
    if want(*ANALYSED):
        yield from _analysed(m, want, text)
    if want(*MACHINES):
        yield from _machines(m, want, text)


def _long(v: int | None) -> int | None:
    return v if v is not None and -(2**63) <= v < 2**63 else None


def _analysed(m: Module, want, text) -> Iterator[tuple[str, dict]]:
    if want("process"):
        for p in m.processes:
            yield "process", {"name": str(p["id"]), "kind": p["keyword"], "role": p["role"], "status": p["confidence"], "clock": p["clocks"][0]["signal"] if p["clocks"] else None, "reset": p["resets"][0]["signal"] if p["resets"] else None, "context": p["sensitivity"], "value": str(sum(e["edge"] != "level" for e in p["events"])), "n": len(p["targets"]), "detail": _json({"reads": p["reads"], "writes": p["targets"], "conditional_reads": p["conditional_reads"]})}
    for r in m.registers if want("register", "leaf", "enable", "hold", "next_value") else ():
        first = r["resets"][0] if r["resets"] else None
        if want("register"):
            yield "register", {"name": r["name"], "width": text(r["width"]), "edge": r["clock"]["edge"], "clock": r["clock"]["signal"], "reset": first["signal"] if first else None, "kind": {"async": "asynchronous", "sync": "synchronous"}[first["kind"]] if first else None, "role": r["update"], "status": r["hold"], "context": first["polarity"] if first else None, "value": r["confidence"], "n": len(r["leaves"]), "detail": _json(sorted({n for e in r["enables"] for n in e["signals"]}))}
        for rank, x in enumerate(r["leaves"]):
            a = x["assign"]
            if want("leaf"):
                yield "leaf", {"name": r["name"], "kind": x["kind"], "value": E.show(a["rhs"]) if a else None, "context": _guards(m, x["guards"]), "status": "default" if x["default"] else None, "n": rank}
            if want("hold") and x["kind"].startswith("hold"):
                yield "hold", {"name": r["name"], "kind": x["kind"][5:], "context": _guards(m, x["guards"])}
            if want("next_value") and x["kind"] == "update":
                yield "next_value", {"name": r["name"], "kind": "constant" if m.is_constant(a["rhs"]) else "expression", "value": E.show(a["rhs"]), "context": _guards(m, x["guards"]), "detail": _json(a["data"])}
        if want("enable"):
            for e in r["enables"]:
                yield "enable", {"name": r["name"], "kind": e["update"], "target": e["hold"], "value": E.show(m.stmt[e["stmt"]]["cond"]), "detail": _json(e["signals"])}
    if want("latch"):
        for p in m.processes:
            for n in p["completeness"]:
                yield "latch", {"name": n, "kind": p["completeness"][n], "status": m.latch_status(p, n), "role": p["role"], "context": LEVELS[m.cover(p["body"], n)]}
    if want("read_write"):
        for x in m.read_write:
            yield "read_write", {"name": x["signal"], "kind": x["order"], "context": str(x["process"])}
    if want("dependency"):
        for d in m.dependencies:
            yield "dependency", {"name": d["source"], "target": d["target"], "kind": d["kind"], "context": d["context"], "role": d["boundary"], "status": d["status"], "value": d["via"], "detail": _json({"direct": d["direct"], "partial": d["partial"]}), "n": d["n"]}
    if want("driver"):
        for d in m.drivers:
            yield "driver", {"name": d["signal"], "kind": d["kind"], "target": d["unit"], "status": d["status"], "context": "whole" if d["whole"] else "partial"}
    if want("load"):
        for d in m.loads:
            yield "load", {"name": d["signal"], "kind": d["kind"], "target": d["consumer"], "detail": _json(d["targets"])}
    for s in m.signal_facts if want("signal", "class", "fan") else ():
        if want("signal"):
            yield "signal", {"name": s["name"], "kind": s["declaration"], "role": s["direction"], "width": text(s["width"]), "status": s["driver_status"], "value": s["multiple"], "n": s["driver_units"], "detail": _json(s["reasons"])}
        if want("class"):
            for c, st in s["classes"].items():
                yield "class", {"name": s["name"], "kind": c, "status": st}
        if want("fan"):
            yield "fan", {"name": s["name"], "detail": _json({"in": s["fan_in"], "out": s["fan_out"]}), "n": s["fan_in"]["signals"]}
    if want("loop"):
        for x in m.loops:
            yield "loop", {"name": x["name"], "status": x["status"], "n": len(x["signals"]), "detail": _json(x["signals"])}
    if want("cone"):
        for c in m.cones:
            yield "cone", {"name": c["root"], "kind": c["direction"], "n": c["depth"], "detail": _json({k: c[k] for k in ("signals", "registers", "inputs", "outputs")})}
    if want("state_candidate"):
        for r, via in m.state_candidates.items():
            yield "state_candidate", {"name": r, "kind": "one_process" if r == via else "two_process", "target": via}
    if want("implicit_net"):
        for n in m.implicit_nets:
            yield "implicit_net", {"name": n}


def _machines(m: Module, want, text) -> Iterator[tuple[str, dict]]:
    x = machines.Extractor(m, want("action"))
    for f in x.machines:
        reg = f["register"]
        if want("machine"):
            yield "machine", {"name": reg, "target": f["next"], "kind": f["style"], "status": f["status"], "role": f["quality"], "width": text(f["width"]), "edge": f["clock"]["edge"], "clock": f["clock"]["signal"], "reset": f["reset"]["state"], "value": f["encoding"]["style"], "context": f["hold"], "n": len(f["states"]), "detail": _json({"unknowns": f["unknowns"], "evidence": f["evidence"], "encoding": f["encoding"], "reset": f["reset"], "reachability": f["reachability"]})}
        if want("state"):
            for s in f["states"]:
                yield "state", {"name": s["name"], "target": reg, "status": s["reachability"], "kind": "declared" if s["declared"] else "literal", "reset": "reset" if s["reset"] else None, "context": "observed" if s["observed"] else None, "n": _long(s["value"])}
        if want("transition"):
            for t in f["transitions"]:
                yield "transition", {"name": reg, "kind": t["kind"], "value": t["from"], "target": t["to"], "status": t["status"], "context": t["condition"], "n": t["priority"], "detail": _json(t["asks"])}
        if want("output"):
            for o in f["outputs"]:
                yield "output", {"name": o["name"], "target": reg, "kind": o["kind"], "status": "registered" if o["registered"] else "combinational", "detail": _json({"other": o["other_sources"], "sampled": o["sampled"]})}
        if want("action"):
            for a in f["actions"]:
                yield "action", {"name": a["signal"], "target": reg, "kind": a["kind"], "role": a["state"], "value": a["value"], "context": a["condition"]}
    if want("coupling"):
        for c in x.couplings():
            yield "coupling", {"name": c["from"], "target": c["to"], "kind": c["kind"]}
    if want("rejected"):
        for r in x.rejected:
            yield "rejected", {"name": r["register"], "kind": r["reason"], "detail": _json(r["evidence"])}


def spread(texts: DataFrame) -> DataFrame:
    """texts, each row once, over spread_parts tasks. The repeats are dropped in the same shuffle."""
    return texts.repartition(spread_parts(texts.sparkSession), "record_id").distinct()


def read_rtl(texts: DataFrame, *wanted: str) -> DataFrame:
    """texts (record_id, text) to section rows, of the sections named or all. Null texts and texts without a whole module give no rows; a module that breaks off is left out."""
    ship(texts.sparkSession)
    only = set(wanted) or None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: dict[str, list] = {f.name: [] for f in _ARROW}
            ids, rest = cols["record_id"], [(k, c.append) for k, c in cols.items() if k != "record_id"]
            for rid, t in zip(b.column("record_id").to_pylist(), b.column("text").to_pylist()):
                for row in sections(t, only) if t else ():
                    ids.append(rid)
                    for k, add in rest:
                        add(row.get(k))
            yield pa.RecordBatch.from_arrays([pa.array(cols[f.name], f.type) for f in _ARROW], schema=_ARROW)

    return texts.select("record_id", "text").mapInArrow(run, SCHEMA)


#: Projections of a module by name.
PROJECTIONS = {"interface-v1": Module.interface, "structural-v1": Module.structure, "dependency-v1": Module.dependency, "fsm-v1": lambda m: machines.Extractor(m).projection()}


def read_projections(texts: DataFrame, *names: str) -> DataFrame:
    """texts (record_id, text) to (record_id, module, projection, value): canonical JSON of each projection named (or all) of each module."""
    ship(texts.sparkSession)
    chosen = names or tuple(PROJECTIONS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for rid, t in zip(b.column("record_id").to_pylist(), b.column("text").to_pylist()):
                trees = syntax.modules(t) if t else []
                inventory = {x["name"]: x for x in trees}
                for tree in trees:
                    m = Module(tree, inventory)
                    rows += [(rid, tree["name"], n, _json(PROJECTIONS[n](m))) for n in chosen]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.string()) for k in range(4)], names=["record_id", "module", "projection", "value"])

    return texts.select("record_id", "text").mapInArrow(run, "record_id string, module string, projection string, value string")


def last_modules(rows: DataFrame, order: str) -> DataFrame:
    """Of modules (ip, module, ...) that several files of an ip declare, the one of the last file; ``replaced`` counts the others."""
    w = Window.partitionBy("ip", "module")
    return rows.withColumn("_k", F.row_number().over(w.orderBy(F.desc(order)))).withColumn("replaced", F.count("*").over(w) - 1).where("_k = 1").drop("_k")


def linked_pins(pins: DataFrame, ports: DataFrame) -> DataFrame:
    """Pins (ip, parent, instance, child, port, signal) with the direction their child's port has in the same ip: status is resolved, no_such_port, or no_module."""
    p = ports.select("ip", F.col("module").alias("child"), F.col("name").alias("port"), "direction").distinct()
    have = ports.select("ip", F.col("module").alias("child"), F.lit(True).alias("known")).distinct()
    j = pins.join(p, ["ip", "child", "port"], "left").join(have, ["ip", "child"], "left")
    return j.select("ip", "parent", "instance", "child", "port", "signal", "direction", F.when(F.col("direction").isNotNull(), "resolved").when(F.col("known"), "no_such_port").otherwise("no_module").alias("status"))
