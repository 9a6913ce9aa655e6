"""Queries over designs: graphs, state machines, RTL, symbols, gates, streams; with their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import behavior, fsm, governance, graph, hierarchy, records, references, stats
from ..sources.tables import clean, table
from ..streaming import jobs


def _fsm(s, d):
    return table(s, d, "fsm_ctrl")


def _wrap(s, d):
    return table(s, d, "structural_wrap")


def _targets(s, d):
    t = table(s, d, "dependency_ctrl").select(clean(F.col("ip")).alias("ip"), clean(F.col("module")).alias("module"), "targets").distinct()
    return t.select(F.concat_ws("/", "ip", "module").alias("scope"), F.explode("targets").alias("t"))


def _edges(s, d):
    """(scope, src, dst, kind, role) of dependencies: source signal to target."""
    x = _targets(s, d).select("scope", clean(F.col("t.name")).alias("dst"), F.col("t.role").alias("role"), F.explode("t.sources").alias("x"))
    return x.select("scope", clean(F.col("x.signal")).alias("src"), "dst", F.col("x.kind").alias("kind"), "role").where("src is not null and dst is not null").distinct()


def hierarchy_edges(s, d):
    """Instances by whether their child module has a document in the same ip."""
    e = hierarchy.instance_edges(_wrap(s, d))
    have = _wrap(s, d).select(clean(F.col("ip")).alias("ip"), clean(F.col("module")).alias("child"), F.lit("resolved").alias("st")).distinct()
    return e.join(have, ["ip", "child"], "left").select("ip", "parent", "child", "instance", F.coalesce("st", F.lit("no_document")).alias("status"))


def top_modules(s, d):
    """Per ip the module that nothing instantiates with the most instances (ties: least name)."""
    e = hierarchy.instance_edges(_wrap(s, d))
    n = e.groupBy("ip", F.col("parent").alias("module")).agg(F.count("*").alias("n"))
    top = n.join(e.select("ip", F.col("child").alias("module")).distinct(), ["ip", "module"], "left_anti")
    return top.groupBy("ip").agg(F.min(F.struct((-F.col("n")).alias("k"), "module")).alias("b"), F.count("*").alias("n_roots")).select("ip", F.col("b.module").alias("top"), (-F.col("b.k")).alias("n_instances"), "n_roots")


def signal_degrees(s, d):
    return graph.degrees(_edges(s, d))


def fan_in_by_kind(s, d):
    return _edges(s, d).groupBy("scope", "dst", "kind").agg(F.countDistinct("src").alias("n_sources"))


def dependency_merge(s, d):
    e = _edges(s, d).select("scope", "src", "dst", "kind", F.col("kind").isin("data", "control").alias("direct"), (F.col("kind") == "hold").alias("partial"))
    return graph.merged(e, "scope", "src", "dst")


def fan_in_cones(s, d):
    """Nodes and registers in the fan-in cone of each output; registers end a cone."""
    e = _edges(s, d)
    stop = e.where("role = 'register'").select("scope", F.col("dst").alias("node")).distinct()
    roots = e.where("role = 'output'").select("scope", F.col("dst").alias("node")).distinct()
    c = graph.cones(e, roots, stop)
    return c.join(stop.withColumn("reg", F.lit(1)), ["scope", "node"], "left").groupBy("scope", "root").agg(F.count("*").alias("n_nodes"), F.count("reg").alias("n_registers"))


def signal_loops(s, d):
    """Strongly connected signals over data and control dependencies."""
    return graph.strong_components(_edges(s, d).where("kind in ('data', 'control')"))


def multiple_drivers(s, d):
    """Signals of a module that outputs of more than one instance drive."""
    i = _wrap(s, d).select(clean(F.col("ip")).alias("ip"), clean(F.col("module")).alias("module"), F.explode("instances").alias("i")).select("ip", "module", clean(F.col("i.name")).alias("inst"), F.explode("i.connections").alias("c")).where("c.direction = 'output'")
    x = i.select("ip", "module", "inst", F.explode("c.signals").alias("s")).select("ip", "module", "inst", clean(F.col("s")).alias("signal")).where("signal is not null").distinct()
    return x.groupBy("ip", "module", "signal").agg(F.countDistinct("inst").alias("n_drivers")).where("n_drivers > 1")


def fsm_transitions(s, d):
    return fsm.transitions(_fsm(s, d))


def fsm_quality(s, d):
    return fsm.quality(_fsm(s, d))


def fsm_encoding(s, d):
    return fsm.encoding(_fsm(s, d))


def fsm_unreachable(s, d):
    st = fsm.states(_fsm(s, d)).select("doc_id", "machine", "state").distinct()
    return st.join(fsm.reachable(_fsm(s, d)), ["doc_id", "machine", "state"], "left_anti")


def fsm_shapes(s, d):
    return fsm.shapes(_fsm(s, d)).groupBy("shape").agg(F.count("*").alias("n_machines"), F.countDistinct("doc_id").alias("n_docs")).where("n_machines > 1")


def fsm_numbering(s, d):
    return fsm.numbered(_fsm(s, d))


def fsm_overridden(s, d):
    """Transitions by kind: all, and those that a later one without a condition overrides."""
    t = fsm.transitions(_fsm(s, d)).where("src is not null")
    o = fsm.overridden(_fsm(s, d)).withColumn("o", F.lit(1))
    return t.join(o, ["doc_id", "machine", "pos"], "left").groupBy("kind").agg(F.count("*").alias("n"), F.count("o").alias("n_overridden"))


def fsm_styles(s, d):
    return stats.histogram(fsm.machines(_fsm(s, d)).select(F.col("f.style").alias("style")), "style")


def fsm_gaps(s, d):
    """The 50 machines with the least coverage."""
    return fsm.quality(_fsm(s, d)).orderBy("coverage", "n_states", "doc_id", "machine").limit(50).select("doc_id", "machine", "n_states", "coverage")


def register_evidence(s, d):
    """Score of each module as the sum of capped evidence: clocked registers 60 each up to 180, enables 40 each up to 120, explicit holds 30 each up to 90."""
    r = _wrap(s, d).select(clean(F.col("ip")).alias("ip"), clean(F.col("module")).alias("module"), "registers").distinct()
    n = lambda c: F.coalesce(F.size(F.filter("registers", c)), F.lit(0))
    score = F.least(n(lambda x: x["clock"].isNotNull()) * 60, F.lit(180)) + F.least(n(lambda x: F.size(x["enables"]) > 0) * 40, F.lit(120)) + F.least(n(lambda x: x["hold"] == "explicit") * 30, F.lit(90))
    x = r.select("ip", "module", score.alias("score"))
    return x.select("ip", "module", "score", F.when(F.col("score") >= 280, "high").when(F.col("score") >= 160, "medium").when(F.col("score") >= 80, "low").otherwise("none").alias("confidence"))


def symbol_resolution(s, d):
    """Per ip the share of dependency references that some symbol of their module has ever declared; 100 without references."""
    refs = references.signal_references(table(s, d, "dependency_ctrl")).select("ip", "module", F.col("ref_name").alias("name")).distinct()
    sym = references.symbol_spans(table(s, d, "symbols")).select("ip", "module", "name").distinct().withColumn("k", F.lit(1))
    ips = table(s, d, "symbols").select(clean(F.col("ip")).alias("ip")).distinct()
    g = refs.join(sym, ["ip", "module", "name"], "left").groupBy("ip").agg(F.count("*").alias("n"), F.count("k").alias("k"))
    j = ips.join(g, "ip", "left").select("ip", F.coalesce("n", F.lit(0)).alias("n_refs"), F.coalesce("k", F.lit(0)).alias("n_resolved"))
    return j.withColumn("rate", stats.coverage(F.col("n_resolved"), F.col("n_refs"), 100.0))


def scope_lookup(s, d):
    """Per module and name the innermost scope that declares it now (block, process, generate, module)."""
    rank = F.when(F.col("scope") == "block", 0).when(F.col("scope") == "process", 1).when(F.col("scope") == "generate", 2).otherwise(3)
    x = table(s, d, "symbols").where("removed_at is null").select(clean(F.col("ip")).alias("ip"), clean(F.col("module")).alias("module"), clean(F.col("name")).alias("name"), F.struct(rank.alias("r"), "scope", "kind").alias("k"))
    return x.groupBy("ip", "module", "name").agg(F.min("k").alias("k")).select("ip", "module", "name", F.col("k.scope").alias("scope"), F.col("k.kind").alias("kind"))


def symbol_coverage(s, d):
    """Per kind the share of symbols with a known width; null without symbols."""
    x = table(s, d, "symbols").select("symbol_id", "kind", "width").distinct()
    g = x.groupBy("kind").agg(F.count("*").alias("n"), F.count("width").alias("k"))
    return g.select("kind", F.col("n").alias("n_symbols"), stats.coverage(F.col("k"), F.col("n"), None).alias("known_width"))


def symbol_duplicates(s, d):
    """Names that a module declares more than once, by rows with another symbol_id."""
    x = table(s, d, "symbols").select(clean(F.col("ip")).alias("ip"), clean(F.col("module")).alias("module"), clean(F.col("name")).alias("name"), "symbol_id").distinct()
    return governance.duplicate_keys(x, "ip", "module", "name")


def order_classes(s, d):
    """Per user whether the first view comes before the first purchase."""
    t = lambda k: F.min(F.when(F.col("event_type") == k, F.struct("ts", "event_id")))
    g = table(s, d, "events").groupBy("user_id").agg(t("view").alias("v"), t("purchase").alias("p"))
    return g.groupBy(F.when(F.col("v").isNull() | F.col("p").isNull(), "unknown").when(F.col("v") < F.col("p"), "view_first").otherwise("purchase_first").alias("order_class")).agg(F.count("*").alias("n_users"))


def event_moves(s, d):
    """Moves between consecutive event types of a user."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    x = table(s, d, "events").select("event_type", F.lead("event_type").over(w).alias("next")).where("next is not null")
    return x.groupBy("event_type", "next").agg(F.count("*").alias("n")).withColumn("move", F.when(F.col("event_type") == F.col("next"), "self").otherwise("step"))


def foreign_keys(s, d):
    t = lambda n: table(s, d, n)
    out = governance.orphans(t("lineitem"), t("orders"), {"l_orderkey": "o_orderkey"}, "lineitem.orders")
    for c, p, on, name in (("lineitem", "part", {"l_partkey": "p_partkey"}, "lineitem.part"), ("lineitem", "supplier", {"l_suppkey": "s_suppkey"}, "lineitem.supplier"), ("orders", "customer", {"o_custkey": "c_custkey"}, "orders.customer")):
        out = out.union(governance.orphans(t(c), t(p), on, name))
    return out


def line_keys(s, d):
    return governance.duplicate_keys(table(s, d, "lineitem"), "l_orderkey", "l_linenumber")


def vocabulary(s, d):
    """Values of each column with a vocabulary: inside it, outside it, absent."""
    m = fsm.machines(_fsm(s, d)).select("f.style", "f.status", "f.quality")
    out = governance.inside(m, "style", ["one_process", "two_process"])
    return out.union(governance.inside(m, "status", ["confirmed", "candidate"])).union(governance.inside(m, "quality", ["high", "medium", "low"]))


def artifact_states(s, d):
    """Modules by the state of their dependency document against their structural document, and what to do about it."""
    x = _wrap(s, d).groupBy(clean(F.col("ip")).alias("ip"), clean(F.col("module")).alias("module")).agg(F.max("built_at").alias("a"))
    o = table(s, d, "dependency_ctrl").groupBy(clean(F.col("ip")).alias("ip"), clean(F.col("module")).alias("module")).agg(F.max("built_at").alias("b"))
    j = x.join(o, ["ip", "module"], "full_outer").select("ip", "module", governance.artifact_state(F.col("a"), F.col("b")).alias("state"))
    return j.withColumn("action", governance.remediation(F.col("state")))


def version_gate(s, d):
    """Records by whether the versions they state are those required."""
    return governance.version_counts(table(s, d, "dataset_records").select("record_id", "versions"), "versions", {"registry": "2", "schema": "2", "tokenizer": "sv-lex-v1"})


def table_manifest(s, d):
    keys = {"symbols": ["symbol_id"], "documents": ["doc_id"], "fsm_ctrl": ["doc_id"], "structural_wrap": ["doc_id"], "dependency_ctrl": ["doc_id"], "record_identity": ["record_id"], "dataset_records": ["record_id"], "raw_docs": ["raw_id"]}
    return governance.manifest({n: (table(s, d, n), k) for n, k in keys.items()})


def priority_styles(s, d):
    return stats.histogram(table(s, d, "orders"), "o_orderpriority")


def largest_parts(s, d):
    """The 20 parts with the most lines (ties: least key)."""
    return table(s, d, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("n_lines"), F.countDistinct("l_suppkey").alias("n_suppliers")).orderBy(F.desc("n_lines"), "l_partkey").limit(20)


def clock_domains(s, d):
    return behavior.clock_domains(_wrap(s, d))


def register_holds(s, d):
    return stats.histogram(behavior.registers(_wrap(s, d)), "hold")


def planned_records(s, d):
    return records.planned(_wrap(s, d))


def structural_projection(s, d):
    x = records.structural_projection(_wrap(s, d))
    return x.select("ip", "module", F.array_join("registers", ",").alias("registers"), F.array_join("children", ",").alias("children"))


def module_prompts(s, d):
    return records.prompts(records.structural_projection(_wrap(s, d)), 32768)


def stream_hourly(s, d):
    return jobs.drain(jobs.hourly(jobs.events(s, d)), "complete")


def stream_sliding(s, d):
    return jobs.drain(jobs.sliding(jobs.events(s, d)), "complete")


def stream_sessions(s, d):
    return jobs.drain(jobs.sessions(jobs.events(s, d)), "complete")


def stream_moves(s, d):
    """Moves between consecutive event types, summed over the users' state machines."""
    return jobs.drain_updates(jobs.moves(jobs.events(s, d)), "user_id").groupBy("event_type", "next").agg(F.sum("n").alias("n"))


def stream_once(s, d):
    return jobs.drain(jobs.once(jobs.events(s, d)))


QUERIES = {f.__name__: f for f in (hierarchy_edges, top_modules, signal_degrees, fan_in_by_kind, dependency_merge, fan_in_cones, signal_loops, multiple_drivers, fsm_transitions, fsm_quality, fsm_encoding, fsm_unreachable, fsm_shapes, fsm_numbering, fsm_overridden, fsm_styles, fsm_gaps, register_evidence, symbol_resolution, scope_lookup, symbol_coverage, symbol_duplicates, order_classes, event_moves, foreign_keys, line_keys, vocabulary, artifact_states, version_gate, table_manifest, priority_styles, largest_parts, clock_domains, register_holds, planned_records, structural_projection, module_prompts, stream_hourly, stream_sliding, stream_sessions, stream_moves, stream_once)}

_B = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_INS = f"ins AS (SELECT DISTINCT trim(ip, {_B}) AS ip, trim(module, {_B}) AS parent, unnest(instances) AS i FROM structural_wrap), e AS (SELECT DISTINCT ip, parent, trim(i.module, {_B}) AS child, trim(i.name, {_B}) AS instance FROM ins WHERE i IS NOT NULL AND trim(i.module, {_B}) <> '')"
_DEP = f"tg AS (SELECT DISTINCT trim(ip, {_B}) || '/' || trim(module, {_B}) AS scope, targets FROM dependency_ctrl), tt AS (SELECT scope, unnest(targets) AS t FROM tg), tx AS (SELECT scope, trim(t.name, {_B}) AS dst, t.role AS role, unnest(t.sources) AS x FROM tt), d AS (SELECT DISTINCT scope, trim(x.signal, {_B}) AS src, dst, x.kind AS kind, role FROM tx WHERE x.signal IS NOT NULL AND dst IS NOT NULL)"
_FSM = f"""f0 AS (SELECT DISTINCT doc_id, fsms FROM fsm_ctrl), m AS (SELECT doc_id, k - 1 AS machine, f FROM (SELECT doc_id, unnest(fsms) AS f, generate_subscripts(fsms, 1) AS k FROM f0)),
st AS (SELECT doc_id, machine, k - 1 AS pos, trim(x.name, {_B}) AS state, coalesce(x.reset, false) AS is_reset, x.value AS value FROM (SELECT doc_id, machine, unnest(f.states) AS x, generate_subscripts(f.states, 1) AS k FROM m) WHERE x.name IS NOT NULL),
tr0 AS (SELECT doc_id, machine, k - 1 AS pos, trim(x.from_state, {_B}) AS src, trim(x.to_state, {_B}) AS dst, x.condition AS condition, x.kind AS kind, x.status AS status FROM (SELECT doc_id, machine, unnest(f.transitions) AS x, generate_subscripts(f.transitions, 1) AS k FROM m)),
tr AS (SELECT *, CASE WHEN src IS NULL OR dst IS NULL OR src LIKE '*%' OR dst LIKE '*%' THEN 'unknown' WHEN src = dst THEN 'self' ELSE 'step' END AS move FROM tr0)"""
_QUAL = f"""{_FSM}, s AS (SELECT DISTINCT doc_id, machine, state FROM st),
o AS (SELECT DISTINCT doc_id, machine, src AS state, 1 AS o FROM tr WHERE move = 'step'), i AS (SELECT DISTINCT doc_id, machine, dst AS state, 1 AS i FROM tr WHERE move = 'step'),
g AS (SELECT doc_id, machine, count(*) AS n_states, count(*) FILTER (o IS NULL) AS n_orphan, count(*) FILTER (o IS NULL AND i IS NOT NULL) AS n_terminal, round(100 * count(o) / count(*), 2) AS coverage FROM s LEFT JOIN o USING (doc_id, machine, state) LEFT JOIN i USING (doc_id, machine, state) GROUP BY ALL),
l AS (SELECT doc_id, machine, count(*) AS n_self FROM tr WHERE move = 'self' GROUP BY ALL),
q AS (SELECT doc_id, machine, n_states, n_orphan, n_terminal, coverage, coalesce(n_self, 0) AS n_self, CASE WHEN coverage >= 90 AND n_orphan = 0 THEN 'high' WHEN coverage >= 70 THEN 'medium' ELSE 'low' END AS score FROM g LEFT JOIN l USING (doc_id, machine))"""
_SYM = f"y AS (SELECT DISTINCT trim(ip, {_B}) AS ip, trim(module, {_B}) AS module, trim(name, {_B}) AS name, symbol_id, scope, kind, removed_at FROM symbols)"

_TASKS = ", ".join(f"('{t}', {v})" for t, v, p in records.TASKS if p)
_REG = f"rx AS (SELECT trim(ip, {_B}) AS ip, trim(module, {_B}) AS module, unnest(registers) AS r FROM structural_wrap), rg AS (SELECT DISTINCT ip, module, trim(r.name, {_B}) AS register, trim(r.clock.signal, {_B}) AS clock, r.clock.edge AS edge, r.hold AS hold, coalesce(len(list_distinct(list_filter(list_transform(r.enables, lambda x: trim(x, {_B})), lambda x: x IS NOT NULL))), 0) AS n_enables FROM rx WHERE r.name IS NOT NULL)"
_PROJ = f"pj AS (SELECT DISTINCT trim(ip, {_B}) AS ip, trim(module, {_B}) AS module, list_sort(list_distinct(list_filter(list_transform(coalesce(registers, []), lambda x: trim(x.name, {_B})), lambda n: n IS NOT NULL))) AS registers, list_sort(list_distinct(list_filter(list_transform(coalesce(instances, []), lambda x: trim(x.module, {_B})), lambda n: n IS NOT NULL))) AS children FROM structural_wrap)"

SQL = {
    "clock_domains": f"WITH {_REG} SELECT ip, module, clock, count(*) AS n_registers, count(*) FILTER (n_enables > 0) AS n_enabled, array_to_string(list_sort(list(DISTINCT edge) FILTER (edge IS NOT NULL)), ',') AS edges FROM rg WHERE clock IS NOT NULL GROUP BY ALL",
    "register_holds": f"WITH {_REG} SELECT hold, count(*) AS n, round(100 * count(*) / sum(count(*)) OVER (), 2) AS percent FROM rg GROUP BY hold",
    "planned_records": f"WITH m AS (SELECT DISTINCT trim(ip, {_B}) AS ip, trim(module, {_B}) AS module FROM structural_wrap), t(task, version) AS (VALUES {_TASKS}) SELECT ip, module, task, version, 'r2:' || substr(sha256('kf-record' || chr(31) || 'v2' || chr(31) || task || chr(31) || version || chr(31) || 'mod1:' || substr(sha256('kf-module' || chr(31) || 'v1' || chr(31) || ip || chr(31) || module), 1, 16)), 1, 16) AS record_id FROM m, t",
    "structural_projection": f"WITH {_PROJ} SELECT ip, module, array_to_string(registers, ',') AS registers, array_to_string(children, ',') AS children FROM pj",
    "module_prompts": f"WITH {_PROJ}, l AS (SELECT ip, module, list_concat(['Module ' || module || ' of ' || ip], list_transform(registers, lambda x: 'register ' || x), list_transform(children, lambda x: 'submodule ' || x)) AS ls FROM pj), u AS (SELECT ip, module, ls, unnest(ls) AS t, generate_subscripts(ls, 1) AS k FROM l), c AS (SELECT ip, module, ls, sum(strlen(t) + 1) OVER (PARTITION BY ip, module ORDER BY k) AS used FROM u), n AS (SELECT ip, module, ls, greatest(1, count(*) FILTER (used <= 32768)) AS n FROM c GROUP BY ALL) SELECT ip, module, array_to_string(ls[1:n], chr(10)) AS prompt, len(ls) - n AS n_dropped FROM n",
    "hierarchy_edges": f"WITH {_INS}, h AS (SELECT DISTINCT trim(ip, {_B}) AS ip, trim(module, {_B}) AS child, 'resolved' AS st FROM structural_wrap) SELECT ip, parent, child, instance, coalesce(st, 'no_document') AS status FROM e LEFT JOIN h USING (ip, child)",
    "top_modules": f"WITH {_INS}, n AS (SELECT ip, parent AS module, count(*) AS n FROM e GROUP BY ALL), t AS (SELECT * FROM n WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.ip = n.ip AND e.child = n.module)), r AS (SELECT *, row_number() OVER (PARTITION BY ip ORDER BY n DESC, module) AS k, count(*) OVER (PARTITION BY ip) AS n_roots FROM t) SELECT ip, module AS top, n AS n_instances, n_roots FROM r WHERE k = 1",
    "signal_degrees": f"WITH {_DEP}, e AS (SELECT DISTINCT scope, src, dst FROM d) SELECT scope, node, CAST(sum(i) AS BIGINT) AS fan_in, CAST(sum(o) AS BIGINT) AS fan_out FROM (SELECT scope, dst AS node, 1 AS i, 0 AS o FROM e UNION ALL SELECT scope, src, 0, 1 FROM e) GROUP BY ALL",
    "fan_in_by_kind": f"WITH {_DEP} SELECT scope, dst, kind, count(DISTINCT src) AS n_sources FROM d GROUP BY ALL",
    "dependency_merge": f"WITH {_DEP} SELECT scope, src, dst, bool_and(kind IN ('data', 'control')) AS direct, bool_or(kind = 'hold') AS partial, array_to_string(list_sort(list(DISTINCT kind)), ',') AS kinds, count(*) AS n FROM d GROUP BY ALL",
    "fan_in_cones": f"WITH RECURSIVE {_DEP}, stop AS (SELECT DISTINCT scope, dst AS node FROM d WHERE role = 'register'), root AS (SELECT DISTINCT scope, dst AS node FROM d WHERE role = 'output'), c AS (SELECT scope, node AS root, node, true AS go FROM root UNION SELECT c.scope, c.root, d.src, NOT EXISTS (SELECT 1 FROM stop WHERE stop.scope = d.scope AND stop.node = d.src) FROM c JOIN d ON d.scope = c.scope AND d.dst = c.node AND d.src <> d.dst WHERE c.go), u AS (SELECT DISTINCT scope, root, node FROM c) SELECT u.scope, root, count(*) AS n_nodes, count(stop.node) AS n_registers FROM u LEFT JOIN stop ON stop.scope = u.scope AND stop.node = u.node GROUP BY ALL",
    "signal_loops": f"WITH RECURSIVE {_DEP}, e AS (SELECT DISTINCT scope, src, dst FROM d WHERE kind IN ('data', 'control')), r AS (SELECT scope, src, dst FROM e UNION SELECT r.scope, r.src, e.dst FROM r JOIN e ON e.scope = r.scope AND e.src = r.dst) SELECT a.scope, a.src AS node, min(a.dst) AS component FROM r a JOIN r b ON b.scope = a.scope AND b.src = a.dst AND b.dst = a.src GROUP BY ALL",
    "multiple_drivers": f"WITH w AS (SELECT trim(ip, {_B}) AS ip, trim(module, {_B}) AS module, unnest(instances) AS i FROM structural_wrap), c AS (SELECT ip, module, trim(i.name, {_B}) AS inst, unnest(i.connections) AS c FROM w WHERE i IS NOT NULL), x AS (SELECT DISTINCT ip, module, inst, trim(s, {_B}) AS signal FROM (SELECT ip, module, inst, unnest(c.signals) AS s FROM c WHERE c.direction = 'output') WHERE s IS NOT NULL) SELECT ip, module, signal, count(DISTINCT inst) AS n_drivers FROM x GROUP BY ALL HAVING count(DISTINCT inst) > 1",
    "fsm_transitions": f"WITH {_FSM} SELECT doc_id, machine, pos, src, dst, condition, kind, status, move FROM tr",
    "fsm_quality": f"WITH {_QUAL} SELECT * FROM q",
    "fsm_gaps": f"WITH {_QUAL} SELECT doc_id, machine, n_states, coverage FROM q ORDER BY coverage, n_states, doc_id, machine LIMIT 50",
    "fsm_encoding": f"WITH {_FSM}, v AS (SELECT doc_id, machine, list_sort(list(DISTINCT value)) AS v, count(*) AS n FROM st GROUP BY ALL HAVING count(*) = count(value) AND count(DISTINCT value) = count(*)), sv AS (SELECT doc_id, machine, state, min(value) AS value FROM st GROUP BY ALL), fl AS (SELECT t.doc_id, t.machine, bool_and(bit_count(xor(a.value, b.value)) = 1) AS gray FROM (SELECT DISTINCT doc_id, machine, src, dst FROM tr WHERE move = 'step') t JOIN sv a ON a.doc_id = t.doc_id AND a.machine = t.machine AND a.state = t.src JOIN sv b ON b.doc_id = t.doc_id AND b.machine = t.machine AND b.state = t.dst GROUP BY ALL) SELECT doc_id, machine, n, CASE WHEN n >= 3 AND coalesce(gray, false) THEN 'gray' WHEN v = range(0, n) THEN 'binary' WHEN n >= 2 AND len(list_filter(v, lambda x: bit_count(x) <> 1)) = 0 THEN 'one_hot' ELSE 'custom' END AS encoding FROM v LEFT JOIN fl USING (doc_id, machine)",
    "fsm_unreachable": f"WITH RECURSIVE {_FSM}, r AS (SELECT DISTINCT doc_id, machine, state FROM st WHERE is_reset UNION SELECT r.doc_id, r.machine, tr.dst FROM r JOIN tr ON tr.doc_id = r.doc_id AND tr.machine = r.machine AND tr.src = r.state AND move = 'step') SELECT DISTINCT doc_id, machine, state FROM st WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.doc_id = st.doc_id AND r.machine = st.machine AND r.state = st.state)",
    "fsm_shapes": f"WITH {_FSM}, s AS (SELECT doc_id, machine, state, min(pos) AS pos FROM st GROUP BY ALL), rk AS (SELECT doc_id, machine, state, row_number() OVER (PARTITION BY doc_id, machine ORDER BY pos) AS r FROM s), mv AS (SELECT tr.doc_id, tr.machine, array_to_string(list_sort(list(DISTINCT a.r || '>' || b.r)), ',') AS moves FROM tr JOIN rk a ON a.doc_id = tr.doc_id AND a.machine = tr.machine AND a.state = tr.src JOIN rk b ON b.doc_id = tr.doc_id AND b.machine = tr.machine AND b.state = tr.dst WHERE move <> 'unknown' GROUP BY ALL), c AS (SELECT doc_id, machine, count(*) AS n FROM s GROUP BY ALL), sh AS (SELECT m.doc_id, m.machine, sha256(coalesce(m.f.style, '') || chr(31) || n || chr(31) || coalesce(moves, '')) AS shape FROM m JOIN c USING (doc_id, machine) LEFT JOIN mv USING (doc_id, machine)) SELECT shape, count(*) AS n_machines, count(DISTINCT doc_id) AS n_docs FROM sh GROUP BY shape HAVING count(*) > 1",
    "fsm_numbering": f"WITH {_FSM}, k AS (SELECT *, row_number() OVER w AS k FROM st WINDOW w AS (PARTITION BY doc_id, machine ORDER BY pos)), b AS (SELECT *, last_value(CASE WHEN value IS NOT NULL THEN value - k END IGNORE NULLS) OVER (PARTITION BY doc_id, machine ORDER BY pos) AS off FROM k) SELECT doc_id, machine, pos, state, coalesce(off + k, k - 1) AS number FROM b",
    "fsm_overridden": f"WITH {_FSM}, t AS (SELECT *, max(CASE WHEN condition IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, machine, src ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS later FROM tr WHERE src IS NOT NULL) SELECT kind, count(*) AS n, count(*) FILTER (later = 1) AS n_overridden FROM t GROUP BY kind",
    "fsm_styles": f"WITH {_FSM}, n AS (SELECT f.style AS style, count(*) AS n FROM m GROUP BY ALL) SELECT style, n, round(100 * n / sum(n) OVER (), 2) AS percent FROM n",
    "register_evidence": f"WITH r AS (SELECT DISTINCT trim(ip, {_B}) AS ip, trim(module, {_B}) AS module, registers FROM structural_wrap), x AS (SELECT ip, module, least(60 * coalesce(len(list_filter(registers, lambda q: q.clock IS NOT NULL)), 0), 180) + least(40 * coalesce(len(list_filter(registers, lambda q: len(q.enables) > 0)), 0), 120) + least(30 * coalesce(len(list_filter(registers, lambda q: q.hold = 'explicit')), 0), 90) AS score FROM r) SELECT ip, module, score, CASE WHEN score >= 280 THEN 'high' WHEN score >= 160 THEN 'medium' WHEN score >= 80 THEN 'low' ELSE 'none' END AS confidence FROM x",
    "symbol_resolution": f"WITH {_SYM}, sy AS (SELECT DISTINCT ip, module, name, 1 AS k FROM y), {_DEP}, rf AS (SELECT DISTINCT trim(ip, {_B}) AS ip, trim(module, {_B}) AS module, trim(s.signal, {_B}) AS name FROM (SELECT ip, module, unnest(t.sources) AS s FROM (SELECT ip, module, unnest(targets) AS t FROM dependency_ctrl)) WHERE s.signal IS NOT NULL), g AS (SELECT ip, count(*) AS n, count(k) AS k FROM rf LEFT JOIN sy USING (ip, module, name) GROUP BY ip) SELECT ip, coalesce(n, 0) AS n_refs, coalesce(k, 0) AS n_resolved, CASE WHEN coalesce(n, 0) = 0 THEN 100.0 ELSE round(100 * k / n, 2) END AS rate FROM (SELECT DISTINCT ip FROM y) LEFT JOIN g USING (ip)",
    "scope_lookup": f"WITH {_SYM}, k AS (SELECT ip, module, name, min({{'r': CASE scope WHEN 'block' THEN 0 WHEN 'process' THEN 1 WHEN 'generate' THEN 2 ELSE 3 END, 'scope': scope, 'kind': kind}}) AS k FROM y WHERE removed_at IS NULL GROUP BY ALL) SELECT ip, module, name, k.scope AS scope, k.kind AS kind FROM k",
    "symbol_coverage": "SELECT kind, count(*) AS n_symbols, round(100 * count(width) / count(*), 2) AS known_width FROM (SELECT DISTINCT symbol_id, kind, width FROM symbols) GROUP BY kind",
    "symbol_duplicates": f"WITH {_SYM} SELECT ip, module, name, count(DISTINCT symbol_id) AS n FROM y GROUP BY ALL HAVING count(DISTINCT symbol_id) > 1",
    "order_classes": "WITH g AS (SELECT user_id, min({'ts': ts, 'e': event_id}) FILTER (event_type = 'view') AS v, min({'ts': ts, 'e': event_id}) FILTER (event_type = 'purchase') AS p FROM events GROUP BY user_id) SELECT CASE WHEN v IS NULL OR p IS NULL THEN 'unknown' WHEN v < p THEN 'view_first' ELSE 'purchase_first' END AS order_class, count(*) AS n_users FROM g GROUP BY 1",
    "event_moves": "WITH x AS (SELECT event_type, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next FROM events) SELECT event_type, next, count(*) AS n, CASE WHEN event_type = next THEN 'self' ELSE 'step' END AS move FROM x WHERE next IS NOT NULL GROUP BY ALL",
    "foreign_keys": "SELECT 'lineitem.orders' AS relation, count(*) AS n_rows FROM lineitem WHERE l_orderkey IS NOT NULL AND l_orderkey NOT IN (SELECT o_orderkey FROM orders) UNION ALL SELECT 'lineitem.part', count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part) UNION ALL SELECT 'lineitem.supplier', count(*) FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier) UNION ALL SELECT 'orders.customer', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)",
    "line_keys": "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1",
    "vocabulary": f"WITH {_FSM} SELECT 'style' AS column_name, count(*) FILTER (f.style IN ('one_process', 'two_process')) AS n_inside, count(*) FILTER (f.style NOT IN ('one_process', 'two_process')) AS n_outside, count(*) FILTER (f.style IS NULL) AS n_absent FROM m UNION ALL SELECT 'status', count(*) FILTER (f.status IN ('confirmed', 'candidate')), count(*) FILTER (f.status NOT IN ('confirmed', 'candidate')), count(*) FILTER (f.status IS NULL) FROM m UNION ALL SELECT 'quality', count(*) FILTER (f.quality IN ('high', 'medium', 'low')), count(*) FILTER (f.quality NOT IN ('high', 'medium', 'low')), count(*) FILTER (f.quality IS NULL) FROM m",
    "artifact_states": f"WITH x AS (SELECT trim(ip, {_B}) AS ip, trim(module, {_B}) AS module, max(built_at) AS a FROM structural_wrap GROUP BY ALL), o AS (SELECT trim(ip, {_B}) AS ip, trim(module, {_B}) AS module, max(built_at) AS b FROM dependency_ctrl GROUP BY ALL), j AS (SELECT ip, module, CASE WHEN b IS NULL THEN 'MISSING' WHEN a IS NULL THEN 'ORPHAN' WHEN b < a THEN 'STALE' ELSE 'CURRENT' END AS state FROM x FULL JOIN o USING (ip, module)) SELECT *, CASE WHEN state = 'CURRENT' THEN 'NONE' WHEN state IN ('STALE', 'MISSING') THEN 'REGENERATE' ELSE 'QUARANTINE' END AS action FROM j",
    "version_gate": "WITH q AS (SELECT unnest(['registry', 'schema', 'tokenizer']) AS name, unnest(['2', '2', 'sv-lex-v1']) AS required) SELECT name, required, count(*) AS n, count(*) FILTER (versions[name] IS DISTINCT FROM required) AS n_mismatched FROM dataset_records, q GROUP BY ALL",
    "table_manifest": " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows, count(DISTINCT {k}) AS n_keys FROM {t}" for t, k in (("symbols", "symbol_id"), ("documents", "doc_id"), ("fsm_ctrl", "doc_id"), ("structural_wrap", "doc_id"), ("dependency_ctrl", "doc_id"), ("record_identity", "record_id"), ("dataset_records", "record_id"), ("raw_docs", "raw_id"))),
    "priority_styles": "SELECT o_orderpriority, count(*) AS n, round(100 * count(*) / sum(count(*)) OVER (), 2) AS percent FROM orders GROUP BY 1",
    "largest_parts": "SELECT l_partkey, count(*) AS n_lines, count(DISTINCT l_suppkey) AS n_suppliers FROM lineitem GROUP BY 1 ORDER BY n_lines DESC, l_partkey LIMIT 20",
    "stream_hourly": "SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n, sum(value) AS total FROM events WHERE ts IS NOT NULL GROUP BY ALL",
    "stream_sliding": "SELECT time_bucket(INTERVAL '2 hours', ts) - o * INTERVAL '2 hours' AS start, event_type, count(*) AS n FROM events, (SELECT unnest([0, 1, 2]) AS o) WHERE ts IS NOT NULL GROUP BY ALL",
    "stream_sessions": "WITH e AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL '8 hours' THEN 0 ELSE 1 END AS first FROM events WHERE ts IS NOT NULL), g AS (SELECT user_id, ts, sum(first) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM e) SELECT user_id, min(ts) AS start, max(ts) + INTERVAL '8 hours' AS until, count(*) AS n FROM g GROUP BY user_id, k",
    "stream_moves": "WITH x AS (SELECT event_type, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next FROM events WHERE user_id IS NOT NULL AND event_type IS NOT NULL AND ts IS NOT NULL) SELECT event_type, next, count(*) AS n FROM x WHERE next IS NOT NULL GROUP BY ALL",
    "stream_once": "SELECT DISTINCT event_id, user_id, event_type FROM events",
}
