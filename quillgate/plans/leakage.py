"""Queries over splits: groups with near-duplicate edges, the gate, the manifest, classes of cross-split groups; with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import leakage as lk
from ..operators import splits
from ..sources import rtl
from ..sources.tables import Scratch, clean, table
from . import corpus


def _rows(s, d):
    return Scratch(s).save(lk.rows_of(table(s, d, "record_identity")))


def _split(s, d):
    return table(s, d, "dataset_records").select("record_id", "split")


def _edges(s, d):
    """Near-duplicate modules (0.70 and up) among those that share a body_shape."""
    e = corpus.near_duplicate_edges(s, d)
    part = lambda c, k: F.element_at(F.split(c, "/", 2), k)
    return Scratch(s).save(e.select(part("a", 1).alias("ip_a"), part("a", 2).alias("module_a"), part("b", 1).alias("ip_b"), part("b", 2).alias("module_b")))


def leakage_groups(s, d):
    """Groups of records with what joined them, near-duplicate edges included."""
    rows = _rows(s, d)
    ties = Scratch(s).save(lk.scan_edges(rows, _edges(s, d)))
    return lk.group_report(rows, Scratch(s).save(lk.groups(rows, ties)), ties)


def hard_groups(s, d):
    """Groups of records by hard identities and shapes that stand in several ips, with what joined them."""
    rows = _rows(s, d)
    ties = Scratch(s).save(lk.scan_edges(rows))
    return lk.group_report(rows, Scratch(s).save(lk.groups(rows, ties)), ties).groupBy("joined_by").agg(F.count("*").alias("n_groups"), F.sum("n_records").alias("n_records"))


def near_edge_effect(s, d):
    rows = _rows(s, d)
    return lk.effective_edges(_edges(s, d), rows, lk.groups(rows, lk.scan_edges(rows)))


def _assigned(s, d):
    return Scratch(s).save(corpus.greedy_split(s, d).select("record_id", "group_id", "split"))


def split_manifest(s, d):
    return lk.manifest(_rows(s, d), _assigned(s, d))


def leakage_gate(s, d):
    """Problems of the split the records state."""
    return lk.gate(_rows(s, d), _split(s, d))


def leakage_gate_again(s, d):
    """Problems of the split made here, against itself made again, its manifest and the near-duplicate edges: hard checks find nothing."""
    rows, a = _rows(s, d), _assigned(s, d)
    return lk.gate(rows, a, a, lk.manifest(rows, a), _edges(s, d))


def gate_status(s, d):
    return lk.status(leakage_gate(s, d))


def crossing_examples(s, d):
    """The first five sources whose records cross splits, with their first six members."""
    return lk.examples(_rows(s, d), _split(s, d), "source_rtl")


def _modules(s, d):
    r = table(s, d, "dataset_records").select("record_id", clean(F.col("module.ip")).alias("ip"), clean(F.col("module.name")).alias("module"), "split").distinct()
    return r.where("ip <> '' and module <> ''")


def _texts(s, d):
    """(record_id, text): each different RTL text once, over all tasks, under its digest; (record_id, ip, module): the modules whose records have it. Half of the records repeat a text."""
    t = corpus._rtl_rows(s, d).select("record_id", "text", F.sha2("text", 256).alias("key"))
    held = t.select("record_id", "key").join(_modules(s, d).select("record_id", "ip", "module"), "record_id").select(F.col("key").alias("record_id"), "ip", "module").distinct()
    return rtl.spread(t.select(F.col("key").alias("record_id"), "text")), held


def _prints(s, d):
    """(kind, fingerprint, ip, module): body shapes of modules and shapes of their state machines."""
    mods = _modules(s, d).select("record_id", "ip", "module")
    body = table(s, d, "record_identity").select("record_id", F.col("body_shape").alias("fingerprint")).join(mods, "record_id").select(F.lit("structural").alias("kind"), "fingerprint", "ip", "module")
    texts, held = _texts(s, d)
    x = Scratch(s).save(rtl.read_rtl(texts, "machine", "transition", "state", "output"))
    st = x.where("section = 'state'").select("record_id", F.col("target").alias("reg"), "name", "n")
    tr = x.where("section = 'transition' and kind <> 'reset'").select("record_id", F.col("name").alias("reg"), F.col("value").alias("name"), F.col("target").alias("to"), "kind", F.col("context").isNotNull().alias("guarded"))
    rank = st.groupBy("record_id", "reg").agg(F.sort_array(F.collect_set(F.struct("n", "name"))).alias("s"))
    place = lambda c: F.expr(f"array_position(transform(s, x -> x.name), {c})")
    moves = tr.join(rank, ["record_id", "reg"]).select("record_id", "reg", F.concat_ws(">", place("name"), place("`to`"), "kind", F.col("guarded").cast("string")).alias("m")).groupBy("record_id", "reg").agg(F.array_join(F.sort_array(F.collect_list("m")), ";").alias("moves"))
    outs = x.where("section = 'output'").groupBy("record_id", F.col("target").alias("reg")).agg(F.array_join(F.sort_array(F.collect_list("kind")), ";").alias("outs"))
    m = x.where("section = 'machine'").select("record_id", F.col("name").alias("reg"), F.concat_ws("|", "status", "kind", "value", F.col("n").cast("string")).alias("head"))
    shape = m.join(moves, ["record_id", "reg"], "left").join(outs, ["record_id", "reg"], "left").select("record_id", F.concat(F.lit("fsm1:"), F.substring(F.sha2(F.concat_ws("|", "head", "moves", "outs"), 256), 1, 16)).alias("fingerprint"))
    return Scratch(s).save(body.union(shape.join(held, "record_id").select(F.lit("fsm"), "fingerprint", "ip", "module")).distinct())


def fingerprint_leakage(s, d):
    return lk.fingerprint_leakage(_prints(s, d), _modules(s, d))


def cross_split_groups(s, d):
    """Modules that share a fingerprint across splits, by class of similarity."""
    texts, held = _texts(s, d)
    r = texts.select("record_id", text.renamed(F.col("text")).alias("stream")).join(held, "record_id").select("ip", "module", "stream")
    return lk.cross_split_groups(_prints(s, d), _modules(s, d).select("ip", "module", "split"), r)


def cross_split_classes(s, d):
    return cross_split_groups(s, d).groupBy("class").agg(F.count("*").alias("n_groups"), F.sum("n_members").alias("n_members"), F.max("similarity").alias("highest"))


QUERIES = {f.__name__: f for f in (leakage_groups, hard_groups, near_edge_effect, split_manifest, leakage_gate, leakage_gate_again, gate_status, crossing_examples, fingerprint_leakage, cross_split_groups, cross_split_classes)}

_B = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_ROWS = f"rw AS (SELECT DISTINCT record_id, trim(ip, {_B}) AS ip, trim(module_name, {_B}) AS module, source_rtl, module_body, normalized_ir, completion, body_shape FROM record_identity WHERE record_id IS NOT NULL), sp AS (SELECT DISTINCT record_id, split FROM dataset_records WHERE record_id IS NOT NULL AND split IS NOT NULL)"
_HELD = "hl AS (" + " UNION ALL ".join(f"SELECT record_id, ip, module, '{c}' AS kind, {c} AS value FROM rw WHERE {c} <> ''" for c in ("source_rtl", "module_body", "normalized_ir", "completion", "body_shape")) + ")"
_HARD = """hub AS (SELECT kind, value, min(record_id) AS hub FROM hl WHERE kind <> 'body_shape' GROUP BY ALL), star AS (SELECT DISTINCT record_id AS a, hub AS b FROM hl JOIN hub USING (kind, value)),
edge AS (SELECT a, b FROM star UNION SELECT b, a FROM star UNION SELECT record_id, record_id FROM rw), reach AS (SELECT a AS record_id, a AS other FROM edge UNION SELECT r.record_id, e.b FROM reach r JOIN edge e ON e.a = r.other), hg AS (SELECT record_id, min(other) AS group_id FROM reach GROUP BY record_id)"""
_GATE = f"""WITH RECURSIVE {_ROWS}, {_HELD}, {_HARD},
cr AS (SELECT kind, value, count(DISTINCT split) > 1 AS x FROM (SELECT DISTINCT record_id, kind, value FROM hl) JOIN sp USING (record_id) GROUP BY ALL),
pr AS (SELECT 'records' AS "check", 'in several splits' AS problem, count(*) AS n FROM (SELECT record_id FROM sp GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'records', 'without a split', count(DISTINCT record_id) FROM rw WHERE record_id NOT IN (SELECT record_id FROM sp)
UNION ALL SELECT 'records', 'without identities', count(DISTINCT record_id) FROM sp WHERE record_id NOT IN (SELECT record_id FROM rw)
UNION ALL SELECT 'identities', 'missing', count(DISTINCT record_id) FROM rw WHERE coalesce(ip, '') = '' OR coalesce(module, '') = '' OR coalesce(source_rtl, '') = '' OR coalesce(module_body, '') = '' OR coalesce(normalized_ir, '') = '' OR coalesce(completion, '') = '' OR coalesce(body_shape, '') = ''
UNION ALL SELECT CASE WHEN kind = 'body_shape' THEN 'soft' ELSE 'hard' END, kind || ' crosses splits', count(*) FILTER (x) FROM cr GROUP BY kind
UNION ALL SELECT 'hard', 'groups cross splits', count(*) FROM (SELECT group_id FROM hg JOIN sp USING (record_id) GROUP BY 1 HAVING count(DISTINCT split) > 1))"""
SQL = {
    "leakage_gate": f"{_GATE} SELECT * FROM pr",
    "gate_status": f"{_GATE}, z AS (SELECT count(*) FILTER (n > 0 AND \"check\" <> 'soft') AS n_problems FROM pr) SELECT CASE WHEN n_problems = 0 THEN 'PASS' ELSE 'FAIL' END AS status, n_problems FROM z",
    "split_manifest": f"WITH RECURSIVE {corpus._ASSIGN}, ms AS (SELECT record_id, min(trim(ip, {_B})) AS ip, min(trim(module_name, {_B})) AS module, min(source_rtl) AS source_rtl, min(module_body) AS module_body, min(normalized_ir) AS normalized_ir, min(completion) AS completion FROM record_identity GROUP BY 1) SELECT split, record_id, ms.ip, module, group_id, source_rtl, module_body, normalized_ir, completion FROM res JOIN ms USING (record_id)",
    "crossing_examples": f"WITH {_ROWS}, x AS (SELECT source_rtl AS value, record_id, ip || '/' || module AS m, split FROM rw JOIN sp USING (record_id) WHERE source_rtl <> ''), c AS (SELECT value, count(*) AS n_records FROM x GROUP BY value HAVING min(split) <> max(split) ORDER BY value LIMIT 5), y AS (SELECT value, n_records, m, split, row_number() OVER (PARTITION BY value ORDER BY split, m, record_id) AS k FROM x JOIN c USING (value)) SELECT value, n_records, string_agg(m || '@' || split, ' ' ORDER BY k) AS members FROM y WHERE k <= 6 GROUP BY ALL",
}
