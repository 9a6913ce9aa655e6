"""Queries p2, p4 and p5: hierarchies, nested records, references; with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import hierarchy, nested, references
from ..sources.tables import table


def _edges(s, d):
    return hierarchy.instance_edges(table(s, d, "structural_wrap"))


def p2_found(s, d):
    return hierarchy.descendants(_edges(s, d))


def p2_paths(s, d):
    return hierarchy.instance_paths(_edges(s, d), nodes=hierarchy.module_nodes(table(s, d, "structural_wrap")))


def p2_modules(s, d):
    return hierarchy.modules_report(_edges(s, d), nodes=hierarchy.module_nodes(table(s, d, "structural_wrap")))


def p2_cycles(s, d):
    """Modules that contain themselves."""
    return hierarchy.descendants(_edges(s, d)).where("ancestor = descendant").select("ip", F.col("ancestor").alias("module"))


def p4_found(s, d):
    return nested.flatten_payloads(table(s, d, "raw_docs"), "state", "transition", "signal").select("raw_id", "item_kind", "pos1", "pos2", "pos3")


def _flat(kind, *cols):
    def run(s, d):
        return nested.flatten_payloads(table(s, d, "raw_docs"), kind).selectExpr("raw_id", *cols)

    return run


def _three(s, d):
    return table(s, d, "fsm_ctrl"), table(s, d, "dependency_ctrl"), table(s, d, "symbols")


def p5_found(s, d):
    return references.missing_references(*_three(s, d)).select("table_name", "doc_id", "field_name", "ref_name").distinct()


def p5_by_month(s, d):
    return references.missing_by_month(*_three(s, d))


QUERIES = {
    "p2_found": p2_found,
    "p2_paths": p2_paths,
    "p2_modules": p2_modules,
    "p2_cycles": p2_cycles,
    "p4_found": p4_found,
    "p4_machines": _flat("machine", "pos1 as machine", "state_register", "style", "status", "quality", "width"),
    "p4_states": _flat("state", "pos1 as machine", "pos2 as state", "name", "reset", "value"),
    "p4_transitions": _flat("transition", "pos1 as machine", "pos2 as transition", "condition", "kind", "status", "from_state", "to_state"),
    "p4_instances": _flat("instance", "pos1 as instance", "name", "module", "status"),
    "p4_connections": _flat("connection", "pos1 as instance", "pos2 as connection", "port", "direction"),
    "p4_signals": _flat("signal", "pos1 as instance", "pos2 as connection", "pos3 as position", "signal"),
    "p5_found": p5_found,
    "p5_by_month": p5_by_month,
}

_B = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_EDGES = f"""
ins AS (SELECT DISTINCT doc_id, trim(ip, {_B}) AS ip, trim(module, {_B}) AS parent, unnest(instances) AS i FROM structural_wrap),
e AS (SELECT DISTINCT ip, parent, trim(i.module, {_B}) AS child, coalesce(trim(i.name, {_B}), '?') AS inst FROM ins WHERE i IS NOT NULL AND trim(i.module, {_B}) <> '')"""
_CLOSURE = f"""WITH RECURSIVE {_EDGES},
r AS (SELECT ip, parent AS ancestor, child AS descendant FROM e UNION SELECT r.ip, r.ancestor, e.child FROM r JOIN e ON e.ip = r.ip AND e.parent = r.descendant)"""
_ROOTS = f"""ev AS (SELECT ip, parent AS module FROM e UNION SELECT ip, child FROM e UNION SELECT trim(ip, {_B}), trim(module, {_B}) FROM structural_wrap WHERE trim(ip, {_B}) <> '' AND trim(module, {_B}) <> ''),
rt AS (SELECT ip, module FROM ev WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.ip = ev.ip AND e.child = ev.module))"""
_REFS = f"""
f AS (SELECT DISTINCT doc_id, built_at, fsms FROM fsm_ctrl),
m AS (SELECT doc_id, built_at, unnest(range(len(fsms))) AS k, fsms FROM f),
st AS (SELECT DISTINCT doc_id, k, trim(x.name, {_B}) AS name FROM (SELECT doc_id, k, unnest(fsms[k + 1].states) AS x FROM m) WHERE x.name IS NOT NULL),
tr AS (SELECT doc_id, built_at, k, unnest(fsms[k + 1].transitions) AS x FROM m),
fr AS (SELECT DISTINCT doc_id, built_at, k, field_name, ref_name FROM (
  SELECT doc_id, built_at, k, 'from_state' AS field_name, trim(x.from_state, {_B}) AS ref_name FROM tr UNION ALL SELECT doc_id, built_at, k, 'to_state', trim(x.to_state, {_B}) FROM tr) WHERE ref_name IS NOT NULL AND ref_name NOT LIKE '*%'),
lostf AS (SELECT DISTINCT 'fsm_ctrl' AS table_name, doc_id, field_name, ref_name, built_at FROM fr WHERE NOT EXISTS (SELECT 1 FROM st WHERE st.doc_id = fr.doc_id AND st.k = fr.k AND st.name = fr.ref_name)),
tg AS (SELECT doc_id, built_at, trim(ip, {_B}) AS ip, trim(module, {_B}) AS module, unnest(targets) AS t FROM dependency_ctrl),
sr AS (SELECT doc_id, built_at, ip, module, unnest(t.sources) AS s FROM tg WHERE t IS NOT NULL),
dr AS (SELECT DISTINCT doc_id, built_at, ip, module, trim(s.signal, {_B}) AS ref_name FROM sr WHERE s.signal IS NOT NULL),
sy AS (SELECT DISTINCT trim(ip, {_B}) AS ip, trim(module, {_B}) AS module, trim(name, {_B}) AS name, declared_at, removed_at FROM symbols),
lostd AS (SELECT DISTINCT 'dependency_ctrl' AS table_name, doc_id, 'signal' AS field_name, ref_name, built_at FROM dr WHERE NOT EXISTS (
  SELECT 1 FROM sy WHERE sy.ip = dr.ip AND sy.module = dr.module AND sy.name = dr.ref_name AND sy.declared_at <= dr.built_at AND (sy.removed_at IS NULL OR sy.removed_at > dr.built_at))),
lost AS (SELECT * FROM lostf UNION ALL SELECT * FROM lostd)"""



def _items(x: str) -> str:
    """The items of a JSON value as a list: of an array, of a list or object written as text, or the value itself; null has none."""
    many = lambda v: f"CASE WHEN json_type({v}) = 'ARRAY' THEN CAST({v} AS JSON[]) WHEN json_type({v}) = 'NULL' THEN [] ELSE [{v}] END"
    inner = f"CAST(json_extract_string({x}, '$') AS JSON)"
    return f"CASE WHEN {x} IS NULL OR json_type({x}) = 'NULL' THEN [] WHEN json_type({x}) = 'VARCHAR' AND regexp_matches(json_extract_string({x}, '$'), '^\\s*[\\[{{]') THEN (CASE WHEN json_valid(json_extract_string({x}, '$')) THEN {many(inner)} ELSE [] END) ELSE {many(x)} END"


def _step(name: str, of: str, keep: str, value: str, at: str) -> str:
    """A table of the items of one member, each with its position; null items count as positions only."""
    return f"{name}0 AS (SELECT {keep}, {_items(value)} AS l FROM {of}), {name} AS (SELECT * FROM (SELECT {keep}, unnest(l) AS v, generate_subscripts(l, 1) - 1 AS {at} FROM {name}0) WHERE json_type(v) <> 'NULL')"


_RAW = f"""pl AS (SELECT DISTINCT raw_id, ltrim(payload, chr(65279)) AS t FROM raw_docs WHERE payload IS NOT NULL AND raw_id IS NOT NULL), jv AS (SELECT raw_id, CAST(t AS JSON) AS v FROM pl WHERE json_valid(t)),
{_step("dc", "jv", "raw_id", "v", "n")}, bx AS (SELECT raw_id, CASE WHEN json_type(v) = 'OBJECT' AND coalesce(json_type(json_extract(v, 'document')), 'NULL') <> 'NULL' THEN json_extract(v, 'document') ELSE v END AS v FROM dc),
{_step("dd", "bx", "raw_id", "v", "n")},
{_step("ma", "dd", "raw_id", "json_extract(v, 'fsms')", "pos1")}, {_step("sx", "ma", "raw_id, pos1", "json_extract(v, 'states')", "pos2")}, {_step("tx", "ma", "raw_id, pos1", "json_extract(v, 'transitions')", "pos2")},
{_step("ia", "dd", "raw_id", "json_extract(v, 'instances')", "pos1")}, {_step("cx", "ia", "raw_id, pos1", "json_extract(v, 'connections')", "pos2")}, {_step("gx", "cx", "raw_id, pos1, pos2", "json_extract(v, 'signals')", "pos3")}"""


def _field(name: str, alias: str | None = None) -> str:
    return f"CASE WHEN json_type(json_extract(v, '{name}')) IN ('OBJECT', 'ARRAY') THEN NULL ELSE json_extract_string(v, '{name}') END AS {alias or name}"


def _fields(*names: str) -> str:
    return ", ".join(_field(n) for n in names)


SQL = {
    "p4_found": f"WITH {_RAW} SELECT raw_id, 'state' AS item_kind, CAST(pos1 AS INT) AS pos1, CAST(pos2 AS INT) AS pos2, -1 AS pos3 FROM sx UNION ALL SELECT raw_id, 'transition', pos1, pos2, -1 FROM tx UNION ALL SELECT raw_id, 'signal', pos1, pos2, pos3 FROM gx",
    "p4_machines": f"WITH {_RAW} SELECT raw_id, pos1 AS machine, {_fields('state_register', 'style', 'status', 'quality', 'width')} FROM ma",
    "p4_states": f"WITH {_RAW} SELECT raw_id, pos1 AS machine, pos2 AS state, CASE WHEN json_type(v) = 'OBJECT' THEN json_extract_string(v, 'name') WHEN json_type(v) = 'ARRAY' THEN NULL ELSE json_extract_string(v, '$') END AS name, {_fields('reset', 'value')} FROM sx",
    "p4_transitions": f"WITH {_RAW} SELECT raw_id, pos1 AS machine, pos2 AS transition, {_fields('condition', 'kind', 'status')}, {_field('from', 'from_state')}, {_field('to', 'to_state')} FROM tx",
    "p4_instances": f"WITH {_RAW} SELECT raw_id, pos1 AS instance, {_fields('name', 'module', 'status')} FROM ia",
    "p4_connections": f"WITH {_RAW} SELECT raw_id, pos1 AS instance, pos2 AS connection, {_fields('port', 'direction')} FROM cx",
    "p4_signals": f"WITH {_RAW} SELECT raw_id, pos1 AS instance, pos2 AS connection, pos3 AS position, CASE WHEN json_type(v) IN ('OBJECT', 'ARRAY') THEN NULL ELSE json_extract_string(v, '$') END AS signal FROM gx",
    "p2_found": f"{_CLOSURE} SELECT ip, ancestor, descendant FROM r",
    "p2_cycles": f"{_CLOSURE} SELECT ip, ancestor AS module FROM r WHERE ancestor = descendant",
    "p2_paths": f"""WITH RECURSIVE {_EDGES}, {_ROOTS},
p AS (SELECT ip, module AS root, module, module AS path, 0 AS depth, false AS closes_loop, [module] AS seen FROM rt
 UNION ALL SELECT p.ip, p.root, e.child, p.path || '/' || e.inst, p.depth + 1, list_contains(p.seen, e.child), list_append(p.seen, e.child) FROM p JOIN e ON e.ip = p.ip AND e.parent = p.module WHERE NOT p.closes_loop)
SELECT ip, root, module, path, depth, closes_loop FROM p""",
    "p2_modules": f"""{_CLOSURE}, {_ROOTS},
el AS (SELECT e.*, EXISTS (SELECT 1 FROM r WHERE r.ip = e.ip AND r.ancestor = e.child AND r.descendant = e.parent) AS looped FROM e),
p AS (SELECT ip, module, [module] AS names, [module] AS seen, true AS free, 0 AS depth FROM rt
 UNION ALL SELECT p.ip, el.child, list_append(p.names, el.inst), list_append(p.seen, el.child), p.free AND NOT el.looped, p.depth + 1 FROM p JOIN el ON el.ip = p.ip AND el.parent = p.module AND NOT list_contains(p.seen, el.child)),
b AS (SELECT ip, module, min({{'d': depth, 'n': names}}) AS b, count(*) FILTER (free) AS n FROM p GROUP BY ALL),
w AS (SELECT ip, ancestor AS module, count(*) AS n_below, bool_or(ancestor = descendant) AS on_loop FROM r GROUP BY ALL)
SELECT a.ip, a.module, b.b.n[1] AS root, array_to_string(b.b.n, '/') AS path, b.b.d AS depth, CAST(coalesce(b.n, 0) AS DECIMAL(38,0)) AS n_paths, coalesce(n_below, 0) AS n_below, coalesce(on_loop, false) AS on_loop, b.b IS NOT NULL AS reached FROM ev a LEFT JOIN b USING (ip, module) LEFT JOIN w USING (ip, module)""",
    "p5_found": f"WITH {_REFS} SELECT DISTINCT table_name, doc_id, field_name, ref_name FROM lost",
    "p5_by_month": f"""WITH {_REFS},
allr AS (SELECT DISTINCT 'fsm_ctrl' AS table_name, doc_id, field_name, ref_name, built_at FROM fr UNION ALL SELECT 'dependency_ctrl', doc_id, 'signal', ref_name, built_at FROM dr),
a AS (SELECT table_name, strftime(built_at, '%Y-%m') AS month, count(*) AS n_refs FROM allr GROUP BY ALL),
b AS (SELECT table_name, strftime(built_at, '%Y-%m') AS month, count(*) AS n_orphans, count(DISTINCT doc_id) AS n_docs FROM lost GROUP BY ALL)
SELECT a.table_name, a.month, n_refs, coalesce(n_orphans, 0) AS n_orphans, coalesce(n_docs, 0) AS n_docs FROM a LEFT JOIN b USING (table_name, month)""",
}
