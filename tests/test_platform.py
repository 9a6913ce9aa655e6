"""Scans, sinks, governance checks, reports, evidence, streams, table functions and the command line on small fixtures."""

import json
from datetime import datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from quillgate import __main__ as cli
from quillgate.functions import ident, udtf
from quillgate.operators import evidence, governance, reports
from quillgate.sources import rtl, scans, sinks
from quillgate.streaming import jobs


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def test_scans_of_a_tree(spark, tmp_path):
    for p, t in {"ipa/files.f": "a.sv // first\n+incdir+inc+lib/x\n-f other.f\nsub/b.v\n", "ipa/a.sv": "module a; endmodule", "ipa/sub/b.v": "x", "ipb/c.v": "\n/home/me/x", "common/d.v": "", "docs/readme.md": "", "ipa/modules/a.yaml": "", "ipa/other/b.yaml": ""}.items():
        (tmp_path / p).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / p).write_text(t)
    files = scans.tree(spark, str(tmp_path)).cache()
    assert files.count() == 8 and rows(scans.ips(files), "ip", "n_sources", "has_list") == [("ipa", 2, True), ("ipb", 1, False)]
    got = scans.contents(spark, str(tmp_path), "files.f").select(F.lit("ipa").alias("ip"), "text")
    assert rows(scans.file_lists(got), "kind", "path") == [("incdir", "inc"), ("incdir", "lib/x"), ("source", "a.sv"), ("source", "sub/b.v"), ("unsupported", "other.f")]
    assert rows(scans.canonical_modules(files), "ip", "module", "canonical") == [("ipa", "a", True), ("ipa", None, False)]
    src = scans.contents(spark, str(tmp_path), "*.v").cache()
    assert rows(scans.absolute_path_lines(src), "path", "n") == [("ipb/c.v", 2)]
    want = src.select("path", "sha256").union(spark.createDataFrame([("gone.v", "0"), ("ipa/a.sv", "1")], "path string, sha256 string"))
    assert rows(scans.verified(want, scans.contents(spark, str(tmp_path), "*v")).where("status <> 'current'"), "path", "status") == [("gone.v", "missing"), ("ipa/a.sv", "differs")]


def test_lines_are_numbered_and_checked(spark, tmp_path):
    spec = {"a": "int", "b": {"c": "string?"}, "d": ["bool"]}
    good = '{"a": 1, "b": {"c": null}, "d": [true]}'
    (tmp_path / "t.jsonl").write_text("\n".join([good, '{"a": true, "b": {"x": 1}, "d": [1]}', "{", "[]"]) + "\n")
    lines = scans.record_lines(spark, {"train": str(tmp_path / "t.jsonl")})
    assert rows(lines, "split", "line_no") == [("train", k) for k in range(1, 5)]
    p = rows(scans.shape_problems(lines, spec), "line_no", "problem")
    assert p == [(2, "$.a: not a int"), (2, "$.b.c: missing"), (2, "$.b.x: not expected"), (2, "$.d[0]: not a bool"), (3, "$: not JSON"), (4, "$: not an object")]


def test_slices_and_locations(spark):
    t = 'x // module m\nmodule m (input a); s = "module m"; /* endmodule */ // c\nendmodule tail module n; endmodule module n; endmodule module o;'
    df = spark.createDataFrame([(1, "m", t), (2, "n", t), (3, "o", t), (4, "q", t), (5, None, t), (6, "m", None)], "key int, name string, text string")
    got = {r["key"]: (r["slice"], r["problem"]) for r in scans.sliced(df).collect()}
    assert got["1"][0].startswith("module m (input a)") and got["1"][0].endswith("// c\nendmodule")
    assert [got[k][1] for k in "23456"] == ["2 declarations", "no endmodule", "0 declarations", "nothing to slice", "nothing to slice"]
    v = spark.createDataFrame([("a", '{"line": 1, "x": [{"offset": 2, "b": 1, "a": "é"}]}'), ("b", "{"), ("c", None)], "key string, value string")
    assert rows(scans.without_locations(v), "key", "value") == [("a", '{"x":[{"a":"é","b":1}]}'), ("b", None), ("c", None)]


def test_bundles(spark):
    s = "ip string, module string, version int, source_sha256 string"
    sem = spark.createDataFrame([("x", "a", 2, "s"), ("x", "b", 2, "s"), ("x", "c", 1, "s"), ("x", "d", 2, "s")], s)
    fsm = spark.createDataFrame([("x", "a", 2, "s"), ("x", "c", 2, "s"), ("x", "d", 2, "t"), (" x", "e", 2, "t")], s)
    assert rows(scans.bundles({"sem": sem, "fsm": fsm}, {"sem": 2, "fsm": 2}), "module", "problem") == [("a", None), ("b", "fsm missing"), ("c", "sem has another version"), ("d", "fsm was made from another source"), ("e", "sem missing")]


def test_sinks(spark, tmp_path):
    p = str(tmp_path / "r.json")
    assert sinks.write_json(spark, {"é": [1]}, p) and not sinks.write_json(spark, {"é": [1]}, p) and sinks.write_json(spark, {}, p)
    rec = spark.createDataFrame([(f"r{k}", k) for k in range(6)], "record_id string, v int")
    split = spark.createDataFrame([(f"r{k}", ("train", "test", "validation")[k % 3]) for k in range(6)], "record_id string, split string")
    ch = spark.createDataFrame([("r0", "new"), ("r1", "modified"), ("r2", "unchanged")], "record_id string, change string")
    assert sinks.write_dataset(rec, split, ch, str(tmp_path / "d")) == {"train": 2, "validation": 2, "test": 2, "mixed": 6, "new": 2, "old": 1}
    t = str(tmp_path / "t")
    assert sinks.copy_missing(rec, t, ["record_id"]) == 6 and sinks.copy_missing(rec.union(spark.createDataFrame([("r9", 9), ("r0", 99)], rec.schema)), t, ["record_id"]) == 1
    assert spark.read.parquet(t).where("record_id = 'r0'").first()["v"] == 0
    (tmp_path / "q").mkdir()
    (tmp_path / "q" / "f").write_text("x")
    q = lambda apply: sinks.quarantine(spark, str(tmp_path / "q"), ["f", "../t", "/etc/x", "g"], apply)
    assert q(False) == [("f", "would move"), ("../t", "refused"), ("/etc/x", "refused"), ("g", "missing")] and q(True)[0] == ("f", "moved") and (tmp_path / "q" / "quarantine" / "f").exists()
    assert "| r0 | 0 |" in sinks.report_text(rec.orderBy("record_id"), "t") and "more than 2 rows" in sinks.report_text(rec, "t", 2)


def test_artifacts_records_and_versions(spark):
    obs = spark.createDataFrame([("c/a", "fsm", "x", "m", "1", "s", False), ("c/b", "fsm", "x", "m", "9", "s", False), ("c/s", "fsm", "x", "m", "1", "old", False), ("c/o", "prompt", "x", "gone", "1", "s", False), ("c/u", None, None, None, "1", None, False), ("c/l", "fsm", "x", "m", "1", "s", True), ("h/z", "fsm", "x", "gone", "1", "s", False), ("c/n", "report", None, None, "1", None, False)], "path string, kind string, ip string, module string, sha256 string, source_sha256 string, symlink boolean")
    exp = spark.createDataFrame([(p, "1", "x", "m", "s") for p in ("c/a", "c/b", "c/s", "c/l", "c/x")], "path string, sha256 string, ip string, module string, source_sha256 string")
    got = {r["path"]: (r["state"], r["action"]) for r in governance.artifact_classes(obs, exp, ("h/",), ("c/",)).collect()}
    assert got == {"c/a": ("CURRENT", "NONE"), "c/b": ("STALE", "REGENERATE"), "c/s": ("STALE", "REGENERATE"), "c/o": ("ORPHAN", "REMOVE"), "c/u": ("UNMANAGED", "QUARANTINE"), "c/l": ("UNMANAGED", "MANUAL"), "h/z": ("HISTORICAL", "NONE"), "c/n": ("ORPHAN", "REGENERATE"), "c/x": ("STALE", "REGENERATE")}
    mods = spark.createDataFrame([("x", "m", "i", "p", "s", "r")], "ip string, module string, module_id string, source_path string, source_sha256 string, ir_sha256 string")
    base = ("x", "m", "i", 1, "p", "s", "r")
    bad = [base, (*base[:3], None, *base[4:]), (*base[:3], 0, *base[4:]), ("x", "q", *base[2:]), (*base[:2], "j", *base[3:]), (*base[:4], "/p", *base[5:]), (*base[:5], "z", "r"), (*base[:6], None), (*base[:6], "z")]
    recs = spark.createDataFrame([(f"r{k}", *b) for k, b in enumerate(bad)], "record_id string, ip string, module string, module_id string, provenance_version int, source_path string, source_sha256 string, ir_sha256 string")
    st = governance.record_states(recs, mods, 1)
    assert [x[1] for x in rows(st, "record_id", "state")] == [None, "STALE", "STALE", "ORPHAN"] + ["STALE"] * 5
    assert rows(governance.worst_state(st.withColumn("f", F.col("record_id").isin("r0", "r1")), "f"), "f", "state") == [(False, "ORPHAN"), (True, "STALE")]
    kv = lambda d: spark.createDataFrame(list(d.items()), "key string, version string")
    side = spark.createDataFrame([("p.json", {"a": "1"})], "path string, versions map<string, string>")
    assert rows(governance.compatibility({"a": "1", "b": "2"}, kv({"a": "1", "b": "2"}), kv({"a": "1", "c": "3"}), side), "place", "key", "required", "stated") == [("manifest", "b", "2", None), ("manifest", "c", None, "3"), ("p.json", "b", "2", None)]


def test_provenance_and_corpus_checks(spark):
    h = "a" * 64
    mods = spark.createDataFrame([("x", "m", "ir/m", h), ("x", "n", "ir/n", None)], "ip string, module string, ir_path string, ir_sha256 string").withColumn("module_id", ident.module_id(F.col("ip"), F.col("module")))
    src = spark.createDataFrame([("x", "m", "raw/m.v", h)], "ip string, module string, path string, sha256 string")
    rec = spark.createDataFrame([("r1", "x", "m")], "record_id string, ip string, module string")
    man = governance.provenance_manifest(mods, src, rec).cache()
    assert rows(man, "module", "n_records", "status") == [("m", 1, "complete"), ("n", 0, "no_ir")]
    files = spark.createDataFrame([("raw/m.v", "b" * 64), ("ir/m", h)], "path string, sha256 string")
    canon = spark.createDataFrame([("x", "m"), ("x", "k")], "ip string, module string")
    use = man.select("module", "module_id").where("module = 'm'").select(F.lit("r1").alias("record_id"), F.lit("x").alias("ip"), "module", "module_id", F.lit("zz").alias("source_sha256"))
    n = {r["kind"]: r["n"] for r in governance.provenance_problems(man, man.where("module = 'm'"), files, canon, use).collect()}
    assert {k for k, v in n.items() if v} == {"orphan_records", "missing_records", "unresolved_sources", "incorrect_hashes", "invalid_ir_refs", "untraceable_records", "incomplete", "nondeterministic"}
    f = lambda *x: spark.createDataFrame(list(x), "ip string, path string")
    inc = spark.createDataFrame([("x", "a.v", "lost.vh", None), ("x", "a.v", "ext.vh", None), ("x", "a.v", "b.vh", "b.vh")], "ip string, path string, name string, target string")
    ext = spark.createDataFrame([("x", "ext.vh"), ("x", "unused.vh")], "ip string, name string")
    assert rows(governance.materialization(f(("x", "a.v"), ("x", "z.v")), f(("x", "a.v")), inc, ext, f(("x", "old.v"))), "problem", "path") == [("exclusion is stale", "old.v"), ("external include unused", "unused.vh"), ("include resolves to a file not listed", "b.vh"), ("include unresolved", "lost.vh"), ("listed file missing", "z.v")]
    d = spark.createDataFrame([(1,), (1,), (2,)], "v int")
    assert rows(governance.rederived(d, spark.createDataFrame([(1,), (3,)], "v int")), "side", "n") == [("derived_only", 1), ("stored_only", 2)]
    ok = spark.createDataFrame([("PASS", 0)], "status string, n_problems int")
    assert governance.authorised(ok, d.limit(0)).first()[0] and not governance.authorised(ok, d).first()[0]


def test_reports(spark):
    a = spark.createDataFrame([("r", '{"x": {"y": 1, "z": [2]}, "w": "s"}'), ("q", "{")], "name string, value string")
    b = spark.createDataFrame([("r", '{"x": {"y": 2, "z": [2]}, "v": null}')], "name string, value string")
    fa, fb = reports.flat_keys(a), reports.flat_keys(b)
    assert rows(fa, "name", "key", "value") == [("r", "w", '"s"'), ("r", "x.y", "1"), ("r", "x.z", "[2]")]
    assert rows(reports.differences(fa, fb), "key", "expected", "found") == [("v", None, "null"), ("w", '"s"', None), ("x.y", "1", "2")]
    v = spark.createDataFrame([("t", "m.rtl.txt"), ("t", "m.short.rtl.txt"), ("t", "m.txt"), ("t", "m.short.fsm.txt")], "task string, file string")
    assert rows(reports.variants(v), "variant", "n") == [("legacy", 1), ("rtl", 1)] or rows(reports.variants(v), "variant", "n") == [("fsm", 1), ("legacy", 1), ("rtl", 2)]
    assert [r[0] for r in v.select(reports.task_of(F.col("file"))).collect()] == ["rtl_generation", "rtl_generation", "rtl_generation", "fsm_extraction"]
    t = spark.createDataFrame([("b", "x\ny", True), ("a", "1\n2", False), ("c", "1", False)], "module string, text string, top boolean")
    r = reports.text_sizes(t).first()
    assert (r["n"], r["min_lines"], r["avg_lines"], r["max_lines"], r["largest"], r["n_top"], r["n_leaf"]) == (3, 1, 1.7, 2, "a", 1, 2)
    f = spark.createDataFrame([("l", f"p{k}", str(k)) for k in range(9)], "layer string, path string, content_sha256 string")
    assert reports.tree_digests(f).first()["digest"] == reports.tree_digests(f.repartition(5).orderBy(F.desc("path"))).first()["digest"]


def test_evidence(spark):
    text = "module m (input clk, input rst, input go); localparam A = 0, B = 1; reg [1:0] state; reg [31:0] data_cnt; always_ff @(posedge clk) if (rst) state <= A; else case (state) A: if (go) state <= B; B: state <= A; endcase always @(posedge clk) data_cnt <= data_cnt + 1; endmodule"
    r = rtl.read_rtl(spark.createDataFrame([("r", text)], "record_id string, text string"), "register", "leaf", "statement", "enum", "parameter").cache()
    x = evidence.verdict(evidence.score(evidence.register_features(r))).cache()
    got = {q["name"]: q for q in x.collect()}
    assert got["state"]["verdict"] == "high" and got["state"]["confidence"] == "high" and got["data_cnt"]["verdict"] == "reject" and got["data_cnt"]["penalty"] == 3
    assert evidence.best(x).first()["name"] == "state"
    mv = spark.createDataFrame([(1, 0, "A", "B", "go"), (1, 0, "B", "A", None), (1, 0, "C", "A", "x"), (1, 0, "C", "B", "y"), (1, 0, "D", "D", "z"), (1, 0, "D", "A", "1")], "doc_id long, machine int, src string, dst string, condition string")
    assert rows(evidence.self_loops(mv), "state", "condition") == [("A", "!(go)")]
    st = spark.createDataFrame([("k", s) for s in ("A", "B", "C", "default")] + [("j", "A"), ("j", "Z")], "key string, state string")
    en = spark.createDataFrame([(k, e, o, m) for k in "kj" for e, o, ms in (("e1", 1, "AB"), ("e2", 2, "ABC"), ("e3", 3, "ABCD")) for m in ms], "key string, enum string, ord int, member string")
    assert rows(evidence.encoding_match(st, en), "key", "enum", "overlap") == [("k", "e2", 3)]


def test_streams(spark, tmp_path):
    ts = [datetime(2024, 1, 1) + timedelta(hours=h) for h in (0, 1, 2, 12, 13, 40)]
    ev = pa.table({"event_id": list(range(6)), "user_id": [1, 1, 2, 1, 2, 1], "ts": pa.array(ts, pa.timestamp("us")), "event_type": list("abaabb"), "value": [1.0] * 6})
    pq.write_table(ev, tmp_path / "events.parquet")
    s = lambda: jobs.events(spark, str(tmp_path))
    assert rows(jobs.drain(jobs.sessions(s()), "complete"), "user_id", "n") == [(1, 1), (1, 1), (1, 2), (2, 1), (2, 1)]
    assert sum(r["n"] for r in jobs.drain(jobs.sliding(s()), "complete").collect()) == 18
    assert rows(jobs.drain_updates(jobs.moves(s()), "user_id"), "user_id", "event_type", "next", "n") == [(1, "a", "b", 2), (1, "b", "a", 1), (2, "a", "b", 1)]
    base, src = str(tmp_path / "c"), tmp_path / "in"
    src.mkdir()

    def feed(name, *r):
        (src / name).write_text("\n".join(json.dumps({"k": k, "v": v}) for k, v in r))
        jobs.classify_changes(spark.readStream.schema("k string, v string").json(str(src)), base, ["k"], "v")

    feed("1.json", ("a", "x"), ("b", "y"))
    feed("2.json", ("a", "x"), ("b", "z"), ("c", "w"))
    got = spark.read.option("recursiveFileLookup", True).parquet(f"{base}/changes")
    assert rows(got, "batch", "k", "change") == [(0, "a", "new"), (0, "b", "new"), (1, "a", "unchanged"), (1, "b", "modified"), (1, "c", "new")]


def test_table_functions(spark):
    udtf.register(spark)
    assert [r["token"] for r in spark.sql("SELECT * FROM rtl_tokens('a <= b; // c') ORDER BY pos").collect()] == ["a", "<=", "b", ";"]
    assert rows(spark.sql("SELECT * FROM tree_nodes('a + b[1]')"), "node", "parent", "depth", "kind") == [(0, -1, 0, "+"), (1, 0, 1, "ref"), (2, 0, 1, "[]"), (3, 2, 2, "ref"), (4, 2, 2, "lit")]
    assert spark.sql("SELECT count(*) AS n FROM rtl_parse('module m (input a); endmodule') WHERE section = 'port'").first()["n"] == 1
    assert spark.sql("SELECT seq_ratio('a b', 'a c') AS r").first()["r"] == 0.5


def test_command_line(spark, capsys, tmp_path):
    assert cli.main(["list"]) == 0 and "p2_found" in capsys.readouterr().out
    assert cli.main(["run", "nonsense", "--data", "x"]) == 2
    d = "/root/testdata/sf0.001"
    assert cli.main(["run", "task_breakdown", "--data", d, "--out", str(tmp_path), "--format", "csv"]) == 0 and any(tmp_path.glob("task_breakdown/*.csv"))
    assert cli.main(["gate", "--data", d]) in (0, 1)


def test_prompts_are_cut_in_order(spark):
    from quillgate.operators import prompts

    s = {"Module": ["input a, 1 bit"], "Submodules": [f"u{k} is an instance of m" for k in range(5)], "Registers": [f"r{k}" for k in range(40)], "State machines": ["x"]}
    whole, left = prompts.within(s)
    assert sum(left.values()) == 47 and "[truncated" not in whole and whole.index("Registers:") < whole.index("State machines:") < whole.index("Submodules:")
    for budget in range(len(whole) - 1, 250, -7):
        text, left = prompts.within(s, budget)
        assert len(text) <= budget or left["Submodules"] == left["Registers"] == left["State machines"] == 0
        assert left["Registers"] == 40 or left["Submodules"] == 0
        if 0 < left["Registers"] < 40:
            assert f"[truncated: Registers {left['Registers']}/40 records]" in text and len(prompts.layout(s, {**left, "Registers": left["Registers"] + 1})) > budget
    t = "module m (input clk, input [3:0] a, output reg q); reg s; sub u (.x(a)); always @(posedge clk) if (a[0]) q <= s; assign y = a + 1; endmodule"
    rows = rtl.read_rtl(spark.createDataFrame([("r", t)], "record_id string, text string"), "port", "register", "assign", "machine", "transition", "instance")
    p = prompts.render(rows).cache()
    got = p.first()
    assert "- input a, 4 bits" in got["prompt"] and "- q, 1 bit, updates at posedge of clk" in got["prompt"].replace("\n", "\n") and "- u is an instance of sub" in got["prompt"] and got["n_dropped"] == 0
    bad = p.withColumn("prompt", F.concat(F.regexp_replace("prompt", "^Write", "Make"), F.lit("- always x[1] /home/me\nModule:\n[truncated: Registers 4/4 records]\n")))
    assert {r["problem"] for r in prompts.faults(bad).collect()} == {"opening", "sections", "syntax", "selects", "paths", "notices"}
    assert [r["line"] for r in prompts.invented(bad, p).collect()] == ["- always x[1] /home/me"] and prompts.invented(p, p).count() == 0


def test_machine_questions(spark):
    import pytest

    from quillgate.operators.machine_query import Machines

    t = "module m (input clk, input rst, input go, output o); localparam A = 0, B = 1, C = 2; reg [1:0] state; always @(posedge clk) if (rst) state <= A; else case (state) A: if (go) state <= B; B: state <= C; C: state <= A; endcase assign o = state == B; endmodule"
    m = Machines(rtl.read_rtl(spark.createDataFrame([("r", t), ("q", t)], "record_id string, text string"), *rtl.MACHINES).cache())
    assert m.fsms("confirmed").count() == 2 and m.fsm(record_id="r", register="state").first()["value"] == "binary"
    with pytest.raises(LookupError):
        m.fsm(register="state")
    assert m.state("B", record_id="r").first()["n"] == 1 and m.state(2, record_id="q").first()["name"] == "C"
    assert rows(m.outgoing("A").where("record_id = 'r'"), "to_state", "kind") == [("A", "implicit_hold"), ("B", "explicit")] and m.incoming("A").where("record_id = 'r'").count() == 3
    assert m.guard().first()["predicate_feasibility"] == "not_analyzed" and m.outputs().count() == 2 and m.rejected().count() == 0 and m.reachability().count() == 6 and m.actions().count() == 0 and m.couplings().count() == 0


def test_missing_includes(spark):
    from quillgate.sources import includes

    files = spark.createDataFrame([("a.v", '`include "b.vh"\n`ifdef X\n`include "ext.vh"\n`endif'), ("b.vh", '`include "lost.vh"'), ("c.v", '`include "ext.vh"')], "path string, text string")
    r = includes.resolve(includes.directives(files), files, [])
    assert rows(includes.missing(r), "path", "name", "kind") == [("a.v", "ext.vh", "conditional_external"), ("a.v", "lost.vh", "unresolved"), ("b.vh", "lost.vh", "unresolved"), ("c.v", "ext.vh", "unresolved")]
