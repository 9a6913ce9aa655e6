"""Queries over texts, identities, splits and records; with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import ident, similarity, text
from ..operators import splits, stats
from ..sources import rtl
from ..sources.tables import Scratch, clean, table


def _docs(s, d):
    return table(s, d, "documents").select("doc_id", "source", "text").where("text is not null")


def _rtl_rows(s, d):
    """(record_id, ip, module, task, text): RTL text of each record, as delivered."""
    t = F.when(F.col("input.kind") == "rtl", F.col("input.text")).otherwise(F.col("target.text"))
    return table(s, d, "dataset_records").select("record_id", F.col("module.ip").alias("ip"), F.col("module.name").alias("module"), F.col("task.id").alias("task"), t.alias("text")).where("text is not null")


def _rtl(s, d):
    """(record_id, ip, module, task, text): RTL text of each record, once."""
    return _rtl_rows(s, d).distinct()


def _records(s, d):
    return table(s, d, "dataset_records")


def exact_dup_groups(s, d):
    x = _docs(s, d).select("doc_id", "source", ident.content_id("source_rtl", text.normalize(F.col("text"))).alias("content"))
    return x.groupBy("content").agg(F.count("*").alias("n_docs"), F.countDistinct("source").alias("n_sources"), F.min("doc_id").alias("first_doc")).where("n_docs > 1")


def collapsed_dup_groups(s, d):
    x = _docs(s, d).select("doc_id", F.sha2(text.collapse(F.col("text")), 256).alias("content"))
    return x.groupBy("content").agg(F.count("*").alias("n_docs"), F.min("doc_id").alias("first_doc")).where("n_docs > 1")


def body_shape_groups(s, d):
    x = _rtl(s, d).select("record_id", "ip", F.sha2(text.body_shape(F.col("text")), 256).alias("shape"))
    return x.groupBy("shape").agg(F.count("*").alias("n_records"), F.countDistinct("ip").alias("n_ips")).where("n_records > 1")


def cross_ip_shapes(s, d):
    x = table(s, d, "record_identity").select("record_id", "ip", "body_shape").where("body_shape <> ''").distinct()
    return x.groupBy("body_shape").agg(F.countDistinct("ip").alias("n_ips"), F.count("*").alias("n_records")).where("n_ips > 1")


def record_ids(s, d):
    r = _records(s, d).select("task", "module").distinct()
    return r.select("task.id", "task.version", "module.ip", "module.name", ident.module_id(clean(F.col("module.ip")), clean(F.col("module.name"))).alias("module_digest"), ident.record_id_v2(F.col("task.id"), F.col("task.version"), ident.module_id(clean(F.col("module.ip")), clean(F.col("module.name")))).alias("record_digest"))


def canonical_records(s, d):
    r = _records(s, d).select("record_id", "split", F.col("task.id").alias("task"), F.col("task.version").alias("version")).distinct()
    line = ident.canonical_json(record_id=F.col("record_id"), split=F.col("split"), task=F.col("task"), version=F.col("version"))
    return r.select("record_id", F.sha2(line, 256).alias("line_sha256"))


def dataset_identity(s, d):
    """Per split: identity over its ordered records. The digests of a split are ordered and hashed by bucket first, so no task holds a whole split's rows."""
    r = canonical_records(s, d).join(_records(s, d).select("record_id", "split").distinct(), "record_id")
    b = r.withColumn("bucket", F.substring("line_sha256", 1, 2)).groupBy("split", "bucket").agg(F.sha2(F.array_join(F.sort_array(F.collect_list(F.concat_ws("\t", "record_id", "line_sha256"))), "\n"), 256).alias("h"), F.count("*").alias("n"))
    return b.groupBy("split").agg(F.sum("n").alias("n_records"), F.concat(F.lit("ds2:"), F.substring(F.sha2(F.array_join(F.sort_array(F.collect_list(F.concat_ws(":", "bucket", "h"))), "\n"), 256), 1, 16)).alias("identity"))


def text_stats(s, d):
    x = _docs(s, d).select(F.size(F.split("text", "\n", -1)).alias("n_lines"), F.length("text").alias("n_chars"))
    return x.agg(F.count("*").alias("n_docs"), F.min("n_lines").alias("min_lines"), F.max("n_lines").alias("max_lines"), F.round(F.avg("n_lines"), 1).alias("avg_lines"), F.max("n_chars").alias("max_chars"))


def quantiles_cut(s, d):
    return stats.nearest_index(_docs(s, d).select(F.length("text").alias("v")), "v", [50, 90, 95], False)


def quantiles_rounded(s, d):
    return stats.nearest_index(_docs(s, d).select(F.length("text").alias("v")), "v", [50, 90, 99, 100], True)


def token_counts(s, d):
    return _rtl(s, d).select("record_id", F.size(text.tokens(F.col("text"))).alias("n_tokens"))


def module_bodies(s, d):
    x = _rtl(s, d).withColumn("body", text.module_body(F.col("text"), clean(F.col("module"))))
    return x.select("record_id", F.sha2(text.collapse(F.col("body")), 256).alias("body_sha256"), F.col("body").isNull().alias("absent"))


def alpha_renamed(s, d):
    return _rtl(s, d).select("record_id", F.sha2(text.renamed(F.col("text")), 256).alias("stream_sha256"))


def _prompts(s, d):
    """(record_id, p, c): prompts with the hardware text that answers them."""
    r = _records(s, d).where("input.kind = 'prompt_v2' and target.kind = 'rtl'").select("record_id", F.col("input.text").alias("p"), F.col("target.text").alias("c"))
    return r.where("p is not null and c is not null").distinct()


def _vocabulary(prompts):
    """(record_id, canon): names of a text's modules, ports, signals, parameters, instances and pins."""
    x = rtl.read_rtl(rtl.spread(prompts.select("record_id", F.col("c").alias("text"))), "module", "port", "net", "parameter", "instance", "pin")
    names = x.select("record_id", F.explode(F.array(F.when(F.col("section") != "pin", F.col("name")), F.when(F.col("section") == "instance", F.col("target")), F.when((F.col("section") == "pin") & ~F.col("name").rlike(r"^\d+$"), F.col("name")))).alias("name"))
    return names.where("name is not null").groupBy("record_id").agg(F.collect_set("name").alias("canon"))


def _measured(s, d):
    p = Scratch(s).save(_prompts(s, d))
    pt, ct, canon = text.tokens(F.col("p")), text.tokens(F.col("c")), F.coalesce("canon", F.array().cast("array<string>"))
    x = p.join(_vocabulary(p), "record_id", "left").select("record_id", pt.alias("pt"), ct.alias("ct"), canon.alias("canon"), text.normalized(pt, canon).alias("pn"), text.normalized(ct, canon).alias("cn"))
    return Scratch(s).save(x)  # as an expression a stream would be made again for every n-gram


def prompt_overlap(s, d):
    """Share of a prompt's telling 4-grams that its completion has too, after reserved words are dropped and the module's own names are made one."""
    x = _measured(s, d)
    x = x.select("record_id", F.size("pt").alias("prompt_tokens"), F.size("ct").alias("completion_tokens"), text.telling(text.ngrams(F.col("pn"), 4)).alias("pg"), text.ngrams(F.col("cn"), 4).alias("cg"))
    x = Scratch(s).save(x)
    return x.select("record_id", "prompt_tokens", "completion_tokens", F.size("pg").alias("prompt_ngrams"), F.size(F.array_intersect("pg", "cg")).alias("shared_ngrams"), text.overlap(F.col("pg"), F.col("cg")).alias("overlap"))


def prompt_raw_overlap(s, d):
    x = Scratch(s).save(_prompts(s, d).select("record_id", text.tokens(F.col("p")).alias("pt"), text.tokens(F.col("c")).alias("ct")))
    x = Scratch(s).save(x.select("record_id", text.ngrams(F.col("pt"), 4).alias("pg"), text.ngrams(F.col("ct"), 4).alias("cg")))
    return x.select("record_id", F.size("pg").alias("prompt_ngrams"), F.size(F.array_intersect("pg", "cg")).alias("shared_ngrams"), text.overlap(F.col("pg"), F.col("cg")).alias("raw_overlap"))


def prompt_longest_run(s, d):
    """Longest run of tokens, separators left out, that a prompt shares with its completion and that holds a token outside the module's own names."""
    return _measured(s, d).select("record_id", similarity.longest_run(text.unseparated(F.col("pt")), text.unseparated(F.col("ct")), "canon").alias("longest_run"))


def prompt_status(s, d):
    """PASS where overlap and longest run keep their limits."""
    j = prompt_overlap(s, d).select("record_id", "overlap").join(prompt_longest_run(s, d), "record_id")
    return j.withColumn("status", F.when((F.col("overlap") <= text.OVERLAP_MAX) & (F.col("longest_run") <= text.RUN_MAX), "PASS").otherwise("FAIL"))


def prompt_noise(s, d):
    """Prompts that hold hardware syntax, selects, parser terms or paths."""
    p = _prompts(s, d)
    return p.select("record_id", F.col("p").rlike(text.HDL_SYNTAX).alias("syntax"), F.col("p").rlike(text.HDL_SELECT).alias("selects"), F.col("p").rlike(text.PARSER_NOISE).alias("parser_terms"), F.col("p").rlike("(?m)" + text.PROMPT_PATH).alias("paths"))


def _near(s, d):
    """Texts of modules whose records share a body_shape."""
    shape = table(s, d, "record_identity").select("record_id", F.col("body_shape").alias("fingerprint")).where("body_shape <> ''").distinct()
    x = _rtl(s, d).select("record_id", F.concat_ws("/", clean(F.col("ip")), clean(F.col("module"))).alias("key"), "text").join(shape, "record_id")
    return similarity.NearTexts(x.select("key", "fingerprint", text.renamed(F.col("text")).alias("stream")))


def near_duplicate_edges(s, d):
    """Edges between modules that represent different texts; near_duplicate_classes has their copies."""
    return _near(s, d).edges()


def near_duplicate_classes(s, d):
    """Each module with its class of copies, the module that represents it in the edges, and the number of other classes near it."""
    return _near(s, d).membership()


def near_duplicate_class_pairs(s, d):
    return _near(s, d).class_pairs()


def similarity_classes(s, d):
    """All pairs that share a body_shape by class of similarity: pairs of different texts, pairs of modules with their copies, and the least similarity."""
    return _near(s, d).tally()


def marker_counts(s, d):
    """How often each wording of uncertainty stands in the documents, without overlaps."""
    x = _docs(s, d)
    hits = F.array(*[F.struct(F.lit(m).alias("marker"), F.lit(k).alias("kind"), text.occurrences(F.col("text"), m).alias("n")) for m, k in text.MARKERS.items()])
    x = x.select("doc_id", F.explode(hits).alias("m")).groupBy("m.kind", "m.marker").agg(F.sum("m.n").alias("n"), F.count_if(F.col("m.n") > 0).alias("n_docs"))
    return x.select("kind", "marker", "n", "n_docs")


def absolute_paths(s, d):
    """Lines of the documents per source, and those that hold an absolute path."""
    x = _docs(s, d).select("source", F.explode(F.split("text", "\n", -1)).alias("l"))
    return x.groupBy("source").agg(F.count("*").alias("n_lines"), F.count_if(F.col("l").rlike(text.ABSOLUTE)).alias("n_paths"))


def id_leaks(s, d):
    """Texts of the records by field, and those that hold an id of a document layer."""
    x = _records(s, d).select("record_id", F.lit("input").alias("field"), F.col("input.text").alias("t")).union(_records(s, d).select("record_id", F.lit("target"), "target.text")).where("t is not null").distinct()
    return x.groupBy("field").agg(F.count("*").alias("n_texts"), F.count_if(F.col("t").rlike(text.ID_LEAK)).alias("n_leaks"))


def budget_lines(s, d):
    """Lines of a text that fit a budget of 600 bytes, from the top, and whether any was cut."""
    x = _docs(s, d).select("doc_id", F.transform(F.split("text", "\n", -1), lambda l: F.octet_length(l) + 1).alias("b"))
    kept = F.aggregate("b", F.struct(F.lit(0).alias("sum"), F.lit(0).alias("n"), F.lit(True).alias("go")), lambda a, v: F.struct((a["sum"] + v).alias("sum"), (a["n"] + (a["go"] & (a["sum"] + v <= 600)).cast("int")).alias("n"), (a["go"] & (a["sum"] + v <= 600)).alias("go")))
    return x.select("doc_id", F.size("b").alias("n_lines"), kept["n"].alias("kept_lines"), (kept["n"] < F.size("b")).alias("truncated"))


def _groups(s, d):
    return splits.groups(table(s, d, "record_identity"))


def identity_groups(s, d):
    return _groups(s, d)


def group_sizes(s, d):
    return _groups(s, d).groupBy("group_id").agg(F.count("*").alias("size")).groupBy("size").agg(F.count("*").alias("n_groups"))


def greedy_split(s, d):
    ids = table(s, d, "record_identity")
    return splits.assign(ids, Scratch(s).save(_groups(s, d)))


def split_summary(s, d):
    return greedy_split(s, d).groupBy("split").agg(F.count("*").alias("n_records"), F.countDistinct("group_id").alias("n_groups"), F.countDistinct("ip").alias("n_ips"))


def split_crossing(s, d):
    return splits.crossing(table(s, d, "record_identity"), _records(s, d).select("record_id", "split"))


def split_inheritance(s, d):
    """Modules by the number of splits their records stand in; one is as it should be."""
    r = _records(s, d).select(clean(F.col("module.ip")).alias("ip"), clean(F.col("module.name")).alias("module"), "split").distinct()
    return r.groupBy("ip", "module").agg(F.count("*").alias("n_splits")).groupBy("n_splits").agg(F.count("*").alias("n_modules"))


def task_breakdown(s, d):
    r = _records(s, d).select("record_id", F.col("task.id").alias("task"), "split").distinct()
    return r.groupBy("task").agg(*[F.count_if(F.col("split") == k).alias(k) for k in splits.RATIOS], F.count("*").alias("n_records"))


def task_coverage(s, d):
    """Modules by the number of tasks they have records of, out of the tasks there are."""
    r = _records(s, d).select(clean(F.col("module.ip")).alias("ip"), clean(F.col("module.name")).alias("module"), F.col("task.id").alias("task")).distinct()
    return r.groupBy("ip", "module").agg(F.count("*").alias("n_tasks")).groupBy("n_tasks").agg(F.count("*").alias("n_modules"))


def change_classes(s, d):
    """Records delivered after the middle of 2024 against those before: new, modified, unchanged by key and hash of prompt and completion."""
    r = _records(s, d).select("record_id", "ingested_at", F.sha2(F.concat_ws("\x1f", F.coalesce("input.text", F.lit("")), F.coalesce("target.text", "target.value", F.lit(""))), 256).alias("h"))
    old = r.where("ingested_at < timestamp_ntz'2024-07-01'").groupBy("record_id").agg(F.max("h").alias("old_h"))
    new = r.groupBy("record_id").agg(F.max("h").alias("h"))
    j = new.join(old, "record_id", "left")
    return j.groupBy(F.when(F.col("old_h").isNull(), "new").when(F.col("old_h") != F.col("h"), "modified").otherwise("unchanged").alias("change")).agg(F.count("*").alias("n_records"))


QUERIES = {f.__name__: f for f in (exact_dup_groups, collapsed_dup_groups, body_shape_groups, cross_ip_shapes, record_ids, canonical_records, dataset_identity, text_stats, quantiles_cut, quantiles_rounded, token_counts, module_bodies, alpha_renamed, prompt_overlap, prompt_raw_overlap, prompt_longest_run, prompt_status, prompt_noise, near_duplicate_edges, near_duplicate_classes, near_duplicate_class_pairs, similarity_classes, marker_counts, absolute_paths, id_leaks, budget_lines, identity_groups, group_sizes, greedy_split, split_summary, split_crossing, split_inheritance, task_breakdown, task_coverage, change_classes)}

_B = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_NL = "chr(10)"
_NORM = f"regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '\\r\\n?', {_NL}, 'g'), '[ \\t]+\\n', {_NL}, 'g'), '[ \\t]+\\z', ''), '\\A\\n+|\\n+\\z', '', 'g')"
_RTL = "rtl AS (SELECT DISTINCT record_id, module.ip AS ip, module.name AS module, task.id AS task, CASE WHEN input.kind = 'rtl' THEN input.text ELSE target.text END AS text FROM dataset_records)"
_BARE = "regexp_replace(regexp_replace({0}, '(?s)/\\*.*?\\*/', ' ', 'g'), '//[^\\n]*', ' ', 'g')"
# What the SQL expects is written here once more, so that a wrong constant of the code shows.
_TOKENS = "regexp_extract_all(" + _BARE + r""", '([0-9]+''[sS]?[bodhBODH][0-9a-fA-FxXzZ_?]+|''[01xXzZ]|[0-9]+(?:\.[0-9]+)?|[a-zA-Z_$][a-zA-Z0-9_$]*|<<<|>>>|===|!==|<=|>=|==|!=|&&|\|\||<<|>>|->|[^ \t\n\r\f\v])', 1)"""
_SHAPES = "regexp_extract_all(" + _BARE + r""", '([a-zA-Z_][a-zA-Z0-9_$]*|[0-9][0-9_'']*[bodhBODH]?[0-9a-fA-FxXzZ_]*|[^ \t\n\r\f\v])', 1)"""
_KW = "string_split('always always_comb always_ff always_latch and assign begin bit byte case casex casez default else end endcase endfunction endgenerate endinterface endmodule endpackage endtask enum for forever function generate genvar if import initial inout input int integer interface localparam logic modport module negedge not or output package packed parameter posedge priority reg repeat return signed struct task typedef unique unsigned while wire', ' ')"
_SHAPE_KW = "string_split('always always_comb always_ff always_latch and assign begin bit byte case casex casez default else end endcase endfunction endgenerate endmodule endtask enum for function generate genvar if initial inout input int integer localparam logic module negedge not or output packed parameter posedge reg signed struct task typedef unsigned while wire', ' ')"
_MARKS = "(VALUES ('derived','[derived]'),('unknown','[unknown]'),('candidate','(candidate)'),('unresolved','(unresolved)'),('unknown','an unknown state'),('unknown','unknown width'),('unresolved','an unresolved value'),('candidate','status candidate'),('ambiguous','status ambiguous'),('unsupported','status unsupported'),('unresolved','States: unresolved'),('unknown','a condition on'),('unknown','priority unknown'),('unknown','an unrendered value'),('unknown','an unknown condition'),('unresolved','an unresolved signal')) AS k(kind, marker)"
_PROMPT = "r AS (SELECT DISTINCT record_id, input.text AS p, target.text AS c FROM dataset_records WHERE input.kind = 'prompt_v2' AND target.kind = 'rtl' AND input.text IS NOT NULL AND target.text IS NOT NULL)"
_GRAMS = "list_distinct(list_transform(range(1, greatest(len({0}) - 2, 1)), lambda i: array_to_string({0}[i:i+3], chr(31))))"
_HELD = "r AS (SELECT DISTINCT record_id, ip, source_rtl, module_body, normalized_ir, completion, body_shape FROM record_identity), held AS (" + " UNION ALL ".join(f"SELECT record_id, ip, '{c}' AS kind, {c} AS value FROM r WHERE {c} <> ''" for c in (*splits.HARD, splits.SOFT)) + ")"
_COMP = f"""{_HELD},
wide AS (SELECT value FROM held WHERE kind = 'body_shape' GROUP BY value HAVING count(DISTINCT ip) > 1),
ties AS (SELECT * FROM held WHERE kind <> 'body_shape' OR value IN (SELECT value FROM wide)),
hub AS (SELECT kind, value, min(record_id) AS hub FROM ties GROUP BY ALL),
star AS (SELECT DISTINCT record_id AS a, hub AS b FROM ties JOIN hub USING (kind, value)),
edge AS (SELECT a, b FROM star UNION SELECT b, a FROM star UNION SELECT record_id, record_id FROM r),
reach AS (SELECT a AS record_id, a AS other FROM edge UNION SELECT r.record_id, e.b FROM reach r JOIN edge e ON e.a = r.other),
grp AS (SELECT record_id, min(other) AS group_id FROM reach GROUP BY record_id)"""
_ASSIGN = f"""{_COMP},
ips AS (SELECT record_id, min(ip) AS ip FROM record_identity GROUP BY record_id),
j AS (SELECT grp.record_id, group_id, ip FROM grp JOIN ips USING (record_id)),
mu AS (SELECT group_id, min(ip) <> max(ip) AS multi FROM j GROUP BY group_id),
jm AS (SELECT j.*, multi FROM j JOIN mu USING (group_id)),
un AS (SELECT ip, n, row_number() OVER (ORDER BY n DESC, ip) AS k FROM (SELECT ip, count(*) FILTER (NOT multi) AS n FROM jm GROUP BY ip) WHERE n > 0),
tot AS (SELECT count(*) AS n, count(*) FILTER (multi) AS m, CAST(round_even(count(*) * CAST(0.15 AS DOUBLE), 0) AS BIGINT) AS q FROM jm),
f AS (SELECT 0 AS k, CAST('' AS VARCHAR) AS ip, CAST('' AS VARCHAR) AS split, n - 2 * q - m AS a, q AS b, q AS c FROM tot
 UNION ALL SELECT un.k, un.ip, CASE WHEN a >= b AND a >= c THEN 'train' WHEN b >= c THEN 'validation' ELSE 'test' END, a - CASE WHEN a >= b AND a >= c THEN un.n ELSE 0 END, b - CASE WHEN NOT (a >= b AND a >= c) AND b >= c THEN un.n ELSE 0 END, c - CASE WHEN NOT (a >= b AND a >= c) AND NOT b >= c THEN un.n ELSE 0 END FROM f JOIN un ON un.k = f.k + 1),
res AS (SELECT record_id, jm.ip, group_id, CASE WHEN multi THEN 'train' ELSE f.split END AS split FROM jm LEFT JOIN f ON f.ip = jm.ip AND f.k > 0)"""
_LEN = "v AS (SELECT length(text) AS v FROM documents WHERE text IS NOT NULL), o AS (SELECT list_sort(list(v)) AS l, count(*) AS n FROM v)"

SQL = {
    "exact_dup_groups": f"SELECT 's1:' || substr(sha256('kf-leakage' || chr(31) || 'v1' || chr(31) || 'source_rtl' || chr(31) || {_NORM}), 1, 16) AS content, count(*) AS n_docs, count(DISTINCT source) AS n_sources, min(doc_id) AS first_doc FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
    "collapsed_dup_groups": "SELECT sha256(trim(regexp_replace(text, '\\s+', ' ', 'g'), ' ')) AS content, count(*) AS n_docs, min(doc_id) AS first_doc FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
    "body_shape_groups": f"WITH {_RTL}, t AS (SELECT record_id, ip, {_SHAPES.format('text')} AS t FROM rtl WHERE text IS NOT NULL), x AS (SELECT ip, sha256(array_to_string(list_transform(t, lambda x: CASE WHEN regexp_matches(x, '^[A-Za-z_]') AND NOT list_contains({_SHAPE_KW}, x) THEN 'ID' WHEN regexp_matches(x, '^[0-9]') THEN 'N' ELSE x END), ' ')) AS shape FROM t) SELECT shape, count(*) AS n_records, count(DISTINCT ip) AS n_ips FROM x GROUP BY shape HAVING count(*) > 1",
    "cross_ip_shapes": "SELECT body_shape, count(DISTINCT ip) AS n_ips, count(*) AS n_records FROM (SELECT DISTINCT record_id, ip, body_shape FROM record_identity WHERE body_shape <> '') GROUP BY 1 HAVING count(DISTINCT ip) > 1",
    "record_ids": f"WITH r AS (SELECT DISTINCT task, module FROM dataset_records), m AS (SELECT task.id AS id, task.version AS version, module.ip AS ip, module.name AS name, 'mod1:' || substr(sha256('kf-module' || chr(31) || 'v1' || chr(31) || trim(module.ip, {_B}) || chr(31) || trim(module.name, {_B})), 1, 16) AS module_digest FROM r) SELECT *, 'r2:' || substr(sha256('kf-record' || chr(31) || 'v2' || chr(31) || id || chr(31) || version || chr(31) || module_digest), 1, 16) AS record_digest FROM m",
    "canonical_records": """SELECT record_id, sha256('{"record_id":"' || record_id || '","split":"' || split || '","task":"' || task || '","version":' || version || '}') AS line_sha256 FROM (SELECT DISTINCT record_id, split, task.id AS task, task.version AS version FROM dataset_records)""",
    "dataset_identity": """WITH c AS (SELECT DISTINCT record_id, split, sha256('{"record_id":"' || record_id || '","split":"' || split || '","task":"' || task.id || '","version":' || task.version || '}') AS h FROM dataset_records), b AS (SELECT split, substr(h, 1, 2) AS bucket, sha256(array_to_string(list_sort(list(record_id || chr(9) || h)), chr(10))) AS hh, count(*) AS n FROM c GROUP BY ALL) SELECT split, CAST(sum(n) AS BIGINT) AS n_records, 'ds2:' || substr(sha256(array_to_string(list_sort(list(bucket || ':' || hh)), chr(10))), 1, 16) AS identity FROM b GROUP BY split""",
    "text_stats": "SELECT count(*) AS n_docs, min(n) AS min_lines, max(n) AS max_lines, round(avg(n), 1) AS avg_lines, max(c) AS max_chars FROM (SELECT len(string_split(text, chr(10))) AS n, length(text) AS c FROM documents WHERE text IS NOT NULL)",
    "quantiles_cut": f"WITH {_LEN} SELECT n, l[1] AS low, l[-1] AS high, " + ", ".join(f"l[1 + least(CAST(floor(n * {q} / 100) AS BIGINT), n - 1)] AS p{q}" for q in (50, 90, 95)) + " FROM o",
    "quantiles_rounded": f"WITH {_LEN} SELECT n, l[1] AS low, l[-1] AS high, " + ", ".join(f"l[1 + least(CAST(round_even(CAST({q} AS DOUBLE) / 100 * (n - 1), 0) AS BIGINT), n - 1)] AS p{q}" for q in (50, 90, 99, 100)) + " FROM o",
    "token_counts": f"WITH {_RTL} SELECT record_id, len({_TOKENS.format('text')}) AS n_tokens FROM rtl WHERE text IS NOT NULL",
    "alpha_renamed": f"WITH {_RTL}, t AS (SELECT record_id, {_TOKENS.format('text')} AS t FROM rtl WHERE text IS NOT NULL), n AS (SELECT record_id, t, list_filter(t, lambda x: regexp_matches(x, '^[A-Za-z_$]') AND NOT list_contains({_KW}, x)) AS i FROM t), o AS (SELECT record_id, t, list_transform(list_sort(list_transform(list_distinct(i), lambda x: {{'p': list_position(i, x), 'x': x}})), lambda q: q.x) AS names FROM n) SELECT record_id, sha256(array_to_string(list_transform(t, lambda x: CASE WHEN list_contains(names, x) THEN 'v' || (list_position(names, x) - 1) ELSE x END), ' ')) AS stream_sha256 FROM o",
    "prompt_overlap": f"""WITH {_PROMPT}, b AS (SELECT record_id, {_BARE.format("c")} AS b, {_TOKENS.format("p")} AS pt, {_TOKENS.format("c")} AS ct FROM r),
n AS (SELECT *, list_concat(list_concat(regexp_extract_all(b, '\\bmodule\\s+(\\w+)', 1), regexp_extract_all(regexp_extract(b, '(?s)module\\s+\\w+\\s*(?:#\\s*\\(.*?\\)\\s*)?\\((.*?)\\)\\s*;', 1), '(\\w+)\\s*(?:,|$)', 1)),
 list_concat(list_concat(regexp_extract_all(b, '\\b(?:reg|wire)\\s+(?:\\[[^\\]]*\\]\\s*)?(\\w+)', 1), regexp_extract_all(array_to_string(regexp_extract_all(b, '(?s)\\blocalparam\\b[^;]*;'), ' '), '(\\w+)\\s*=', 1)),
 list_concat(list_concat(regexp_extract_all(b, '(\\w+)\\s+\\w+\\s*\\(\\s*\\.', 1), regexp_extract_all(b, '(\\w+)\\s*\\(\\s*\\.', 1)), regexp_extract_all(b, '\\.(\\w+)\\s*\\(', 1)))) AS canon FROM b),
t AS (SELECT record_id, len(pt) AS prompt_tokens, len(ct) AS completion_tokens, list_transform(list_filter(pt, lambda x: NOT list_contains({_KW}, x) AND regexp_matches(x, '^[A-Za-z0-9_$'']')), lambda x: CASE WHEN list_contains(canon, x) THEN 'ID' ELSE x END) AS pn, list_transform(list_filter(ct, lambda x: NOT list_contains({_KW}, x) AND regexp_matches(x, '^[A-Za-z0-9_$'']')), lambda x: CASE WHEN list_contains(canon, x) THEN 'ID' ELSE x END) AS cn FROM n),
g AS (SELECT record_id, prompt_tokens, completion_tokens, CASE WHEN len(pn) < 4 THEN [] ELSE list_filter({_GRAMS.format("pn")}, lambda x: x <> array_to_string(['ID', 'ID', 'ID', 'ID'], chr(31))) END AS pg, CASE WHEN len(cn) < 4 THEN [] ELSE {_GRAMS.format("cn")} END AS cg FROM t)
SELECT record_id, prompt_tokens, completion_tokens, len(pg) AS prompt_ngrams, len(list_intersect(pg, cg)) AS shared_ngrams, CASE WHEN len(pg) = 0 THEN 0.0 ELSE round(len(list_intersect(pg, cg)) / len(pg), 6) END AS overlap FROM g""",
    "prompt_raw_overlap": f"""WITH {_PROMPT}, t AS (SELECT record_id, {_TOKENS.format("p")} AS pt, {_TOKENS.format("c")} AS ct FROM r), g AS (SELECT record_id, CASE WHEN len(pt) < 4 THEN [] ELSE {_GRAMS.format("pt")} END AS pg, CASE WHEN len(ct) < 4 THEN [] ELSE {_GRAMS.format("ct")} END AS cg FROM t)
SELECT record_id, len(pg) AS prompt_ngrams, len(list_intersect(pg, cg)) AS shared_ngrams, CASE WHEN len(pg) = 0 THEN 0.0 ELSE round(len(list_intersect(pg, cg)) / len(pg), 6) END AS raw_overlap FROM g""",
    "prompt_noise": f"""WITH {_PROMPT} SELECT record_id, regexp_matches(p, '<=|==|!=|&&|\\|\\||\\?|\\b(always|always_ff|always_comb|always_latch|assign|begin|endmodule|endcase|posedge|negedge)\\b') AS syntax, regexp_matches(p, '[a-zA-Z0-9_$\\]]\\[') AS selects, regexp_matches(p, '\\b(node_id|syntax_type|BufferID|SyntaxKind|SyntaxNode)\\b|\\b(offset|buffer)\\s*[:=]\\s*[0-9]') AS parser_terms, regexp_matches(p, '(?m)(^|[\\s"''=:(,])(/(home|tmp|mnt|Users|workspace|root|var)/|[A-Za-z]:\\\\)') AS paths FROM r""",
    "marker_counts": f"SELECT kind, marker, CAST(sum(n) AS BIGINT) AS n, count(*) FILTER (n > 0) AS n_docs FROM (SELECT kind, marker, (length(text) - length(replace(text, marker, ''))) // length(marker) AS n FROM documents, {_MARKS} WHERE text IS NOT NULL) GROUP BY ALL",
    "absolute_paths": "SELECT source, count(*) AS n_lines, count(*) FILTER (regexp_matches(l, '(^|[\\s\"''=:(\\[,])/(home|tmp|mnt|Users|workspace)/')) AS n_paths FROM (SELECT source, unnest(string_split(text, chr(10))) AS l FROM documents WHERE text IS NOT NULL) GROUP BY source",
    "id_leaks": "SELECT field, count(*) AS n_texts, count(*) FILTER (regexp_matches(t, '(sem1|beh1|str1|fsm1|n1|grp1|pv2):[0-9a-f]{16}')) AS n_leaks FROM (SELECT DISTINCT record_id, 'input' AS field, input.text AS t FROM dataset_records UNION SELECT DISTINCT record_id, 'target', target.text FROM dataset_records) WHERE t IS NOT NULL GROUP BY field",
    "budget_lines": "WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS l, generate_subscripts(string_split(text, chr(10)), 1) AS k FROM documents WHERE text IS NOT NULL), r AS (SELECT doc_id, sum(strlen(l) + 1) OVER (PARTITION BY doc_id ORDER BY k) AS upto FROM l) SELECT doc_id, count(*) AS n_lines, count(*) FILTER (upto <= 600) AS kept_lines, count(*) FILTER (upto <= 600) < count(*) AS truncated FROM r GROUP BY doc_id",
    "identity_groups": f"WITH RECURSIVE {_COMP} SELECT record_id, group_id FROM grp",
    "group_sizes": f"WITH RECURSIVE {_COMP} SELECT size, count(*) AS n_groups FROM (SELECT group_id, count(*) AS size FROM grp GROUP BY 1) GROUP BY 1",
    "greedy_split": f"WITH RECURSIVE {_ASSIGN} SELECT record_id, ip, group_id, split FROM res",
    "split_summary": f"WITH RECURSIVE {_ASSIGN} SELECT split, count(*) AS n_records, count(DISTINCT group_id) AS n_groups, count(DISTINCT ip) AS n_ips FROM res GROUP BY split",
    "split_crossing": f"WITH {_HELD}, s AS (SELECT DISTINCT record_id, split FROM dataset_records), v AS (SELECT kind, value, count(DISTINCT split) > 1 AS crosses FROM (SELECT DISTINCT record_id, kind, value FROM held) JOIN s USING (record_id) GROUP BY ALL) SELECT kind, count(*) AS n_values, count(*) FILTER (crosses) AS n_crossing FROM v GROUP BY kind",
    "split_inheritance": f"SELECT n_splits, count(*) AS n_modules FROM (SELECT count(DISTINCT split) AS n_splits FROM (SELECT trim(module.ip, {_B}) AS ip, trim(module.name, {_B}) AS module, split FROM dataset_records) GROUP BY ip, module) GROUP BY 1",
    "task_breakdown": "SELECT task, count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'validation') AS validation, count(*) FILTER (split = 'test') AS test, count(*) AS n_records FROM (SELECT DISTINCT record_id, task.id AS task, split FROM dataset_records) GROUP BY task",
    "task_coverage": f"SELECT n_tasks, count(*) AS n_modules FROM (SELECT trim(module.ip, {_B}) AS ip, trim(module.name, {_B}) AS module, count(DISTINCT task.id) AS n_tasks FROM dataset_records GROUP BY ALL) GROUP BY 1",
    "change_classes": "WITH r AS (SELECT record_id, ingested_at, sha256(coalesce(input.text, '') || chr(31) || coalesce(target.text, target.value, '')) AS h FROM dataset_records), o AS (SELECT record_id, max(h) AS old_h FROM r WHERE ingested_at < TIMESTAMP '2024-07-01' GROUP BY 1), n AS (SELECT record_id, max(h) AS h FROM r GROUP BY 1) SELECT CASE WHEN old_h IS NULL THEN 'new' WHEN old_h <> h THEN 'modified' ELSE 'unchanged' END AS change, count(*) AS n_records FROM n LEFT JOIN o USING (record_id) GROUP BY 1",
}
