"""Text, identity, similarity, statistics, split, graph, state machine, RTL and streaming operators on small fixtures."""

from difflib import SequenceMatcher

import random

import pytest
from pyspark.sql import functions as F

from quillgate.functions import expr, ident, similarity, text
from quillgate.operators import fsm, governance, graph, splits, stats
from quillgate.plans import corpus
from quillgate.sources import rtl


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


def test_normalize_and_comments(spark):
    assert one(spark, text.normalize(F.lit("\n\na \r\nb\t\n\n c  \n"))) == "a\nb\n\n c"
    assert one(spark, text.normalize(F.lit(""))) == "" and one(spark, text.normalize(F.lit(None).cast("string"))) is None
    assert one(spark, text.collapse(text.strip_comments(F.lit("a /* x\ny */ b // c\nd")))) == "a b d"


def test_module_body(spark):
    t = F.lit("module a_b; x endmodule module a (input c); // endmodule\n y endmodule")
    assert one(spark, text.collapse(text.module_body(t, F.lit("a")))) == "module a (input c); y endmodule"
    assert one(spark, text.module_body(t, F.lit("zz"))) is None


def test_shape_and_renaming(spark):
    t = F.lit("assign x = y[3] + x;")
    assert one(spark, text.body_shape(t)) == "assign ID = ID [ N ] + ID ;"
    assert one(spark, text.renamed(t)) == "assign v0 = v1 [ 3 ] + v0 ;"
    assert one(spark, text.renamed(F.lit(""))) == ""


def test_ngrams_and_overlap(spark):
    a = F.split(F.lit("a b c d e"), " ")
    assert len(one(spark, text.ngrams(a, 4))) == 2 and one(spark, text.ngrams(F.split(F.lit("a b"), " "), 4)) == []
    assert one(spark, text.overlap(text.ngrams(a, 4), text.ngrams(F.split(F.lit("x b c d e"), " "), 4))) == 0.5
    assert one(spark, text.overlap(F.array().cast("array<string>"), text.ngrams(a, 4))) == 0.0


def test_digests_count_nulls_as_empty(spark):
    import hashlib

    want = "mod1:" + hashlib.sha256("kf-module\x1fv1\x1fip\x1f".encode()).hexdigest()[:16]
    assert one(spark, ident.module_id(F.lit("ip"), F.lit(None).cast("string"))) == want
    assert one(spark, ident.canonical_json(b=F.lit(1), a=F.lit(None).cast("string"))) == '{"a":null,"b":1}'
    assert one(spark, ident.canonical_map(F.create_map(F.lit("z"), F.lit(1), F.lit("a"), F.lit(2)))) == '{"a":2,"z":1}'


def test_similarity(spark):
    df = spark.createDataFrame([("k1", "f", "a b c d"), ("k2", "f", "a b c x"), ("k3", "f", "q"), ("k4", "f", "a b c d"), ("k5", None, "a b c d")], "key string, fingerprint string, stream string")
    got = similarity.near_edges(df).collect()
    assert [(r["a"], r["b"], r["similarity"]) for r in got] == [("k1", "k2", 0.75)]
    run = spark.createDataFrame([(["a", "b", "c"], ["a", "b", "c"], ["a", "b", "c"]), (["a", "b", "z"], ["a", "b", "z"], ["a", "b"]), ([], [], [])], "p array<string>, c array<string>, n array<string>").select(similarity.longest_run("p", "c", "n")).collect()
    assert [r[0] for r in run] == [0, 3, 0]
    assert SequenceMatcher(None, "abcd", "abcx").ratio() == 0.75


def test_near_texts_keep_copies_and_the_best_pair(spark):
    s = "key string, fingerprint string, stream string"
    copies = [(f"c{i}", "f", "a b c d") for i in range(9)] + [("n", "f", "a b c x"), ("z", "f", "q"), ("z", None, "q"), (None, "f", "a")]
    t = similarity.NearTexts(spark.createDataFrame(copies * 2, s))
    m = {r["key"]: r for r in t.membership().collect()}
    assert len(m) == 11 and all(m[f"c{i}"]["representative"] == "c0" and m[f"c{i}"]["n_copies"] == 8 and m[f"c{i}"]["n_links"] == 1 for i in range(9))
    assert (m["n"]["n_copies"], m["n"]["n_links"], m["z"]["n_links"]) == (0, 1, 0) and len({m[f"c{i}"]["class_id"] for i in range(9)}) == 1
    several = [("a", "f", "1 2 3 4"), ("b", "f", "9 8 7 6"), ("a", "g", "p q r s"), ("b", "g", "p q r t"), ("a", "h", "p q r s t"), ("b", "h", "p q r s u")]
    for part in (several, several[::-1]):
        assert [tuple(r) for r in similarity.near_edges(spark.createDataFrame(part, s)).collect()] == [("a", "b", 0.8)]
    shared = similarity.NearTexts(spark.createDataFrame([("a", "f", "1 2 3 4"), ("b", "f", "1 2 3 4"), ("a", "f", "1 2 3 5"), ("c", "f", "1 2 3 5")], s))
    assert shared.edges().count() == 0 and [r["similarity"] for r in shared.class_pairs().collect()] == [0.75]


def test_similarity_classes_count_all_pairs(spark, tmp_path):
    ids = "record_id string, body_shape string"
    rec = "record_id string, module struct<ip: string, name: string>, task struct<id: string>, input struct<kind: string, text: string>, target struct<kind: string, text: string>"
    texts = {"a": "x <= 1 ; x <= 2 ;", "b": "x <= 1 ; x <= 2 ;", "c": "x <= 1 ; x <= 3 ;", "d": "x <= 1 ; ( [ {", "e": "* * * * * * * * * * * * * * *"}
    spark.createDataFrame([(k, "h") for k in texts] + [("f", "")], ids).write.parquet(f"{tmp_path}/record_identity.parquet")
    spark.createDataFrame([(k, ("ip", k), ("t",), ("rtl", v), None) for k, v in texts.items()] + [("f", ("ip", "f"), ("t",), ("rtl", "x"), None)], rec).write.parquet(f"{tmp_path}/dataset_records.parquet")
    got = {r["class"]: (r["n_edges"], r["n_pairs"]) for r in corpus.similarity_classes(spark, str(tmp_path)).collect()}
    assert got == {"near_duplicate": (1, 3), "structural_similarity": (2, 3), "informational": (3, 4)}
    two = [("a", "f", "1 2 3 4"), ("b", "f", "1 2 3 4"), ("a", "f", "1 2 3 5"), ("b", "f", "1 2 3 5"), ("c", "f", "1 2 3 5")]
    got = [tuple(r) for r in similarity.NearTexts(spark.createDataFrame(two, "key string, fingerprint string, stream string")).tally().collect()]
    assert got == [("near_duplicate", 1, 7, 0.75)]


@pytest.mark.parametrize("rounded", [True, False])
def test_quantiles(spark, rounded):
    v = [5, 1, 1, 9, 3, 3, 3, 8]
    df = spark.createDataFrame([(x,) for x in v] + [(None,)], "v int")
    r = stats.nearest_index(df, "v", [0, 50, 90, 100], rounded).first()
    s, n = sorted(v), len(v)
    for q in (0, 50, 90, 100):
        i = min(n - 1, int(round(q / 100 * (n - 1)))) if rounded else min(int(n * q / 100), n - 1)
        assert r[f"p{q}"] == s[i]
    e = stats.nearest_index(df.limit(0), "v", [50], rounded).first()
    assert (e["n"], e["p50"]) == (0, None)


def test_targets_and_assignment(spark):
    assert splits.targets(10) == {"train": 6, "validation": 2, "test": 2} and splits.targets(3) == {"train": 3, "validation": 0, "test": 0}
    rows = [(f"r{i:02}", ip, f"s{i}", None, "", None, None) for i, ip in enumerate(["a"] * 7 + ["b"] * 2 + ["c"] * 2)] + [("r90", "a", "lib", None, None, None, None), ("r91", "b", "lib", None, None, None, None), ("r92", None, None, None, None, None, None)]
    ids = spark.createDataFrame(rows, "record_id string, ip string, source_rtl string, module_body string, normalized_ir string, completion string, body_shape string")
    out = {r["record_id"]: r for r in splits.assign(ids, splits.groups(ids)).collect()}
    assert len(out) == 14 and out["r91"]["group_id"] == "r90" and out["r90"]["split"] == "train" and out["r00"]["split"] == "train"
    assert {out["r07"]["split"], out["r09"]["split"]} == {"validation", "test"} and out["r92"]["split"] is not None


def test_cones_stop_at_registers(spark):
    e = spark.createDataFrame([("s", a, b) for a, b in [("i", "r"), ("r", "w"), ("w", "o"), ("x", "w"), ("o", "x"), ("w", "w")]], "scope string, src string, dst string")
    n = lambda *x: spark.createDataFrame([("s", y) for y in x], "scope string, node string")
    got = sorted((r["node"], r["depth"]) for r in graph.cones(e, n("o"), n("r")).collect())
    assert got == [("o", 0), ("r", 2), ("w", 1), ("x", 2)]
    assert sorted((r["node"], r["component"]) for r in graph.strong_components(e).collect()) == [("o", "o"), ("w", "o"), ("x", "o")]
    assert {(r["node"], r["fan_in"], r["fan_out"]) for r in graph.degrees(e).collect() if r["node"] == "w"} == {("w", 3, 2)}


FSM = "doc_id long, fsms array<struct<style: string, states: array<struct<name: string, reset: boolean, value: long>>, transitions: array<struct<condition: string, from_state: string, kind: string, status: string, to_state: string>>>>"


def machine(values, moves, style="one_process"):
    return (style, [(f"S{i}", i == 0, v) for i, v in enumerate(values)], [("c", f"S{a}", "explicit", "confirmed", f"S{b}") for a, b in moves])


def test_state_machines(spark):
    ms = [machine([0, 1, 3, 2], [(0, 1), (1, 2), (2, 3)]), machine([0, 1, 2], [(0, 1), (1, 2)]), machine([1, 2, 4], [(0, 1), (1, 1)]), machine([5, None, 9, None], [(0, 1)]), machine([7, 3], [(0, 1), (1, 0)])]
    df = spark.createDataFrame([(1, ms), (1, ms), (2, None), (3, [])], FSM)
    assert {r["machine"]: r["encoding"] for r in fsm.encoding(df).collect()} == {0: "gray", 1: "binary", 2: "one_hot", 4: "custom"}
    assert [r["number"] for r in fsm.numbered(df).where("machine = 3").orderBy("pos").collect()] == [5, 6, 9, 10]
    q = {r["machine"]: r for r in fsm.quality(df).collect()}
    assert (q[0]["n_orphan"], q[0]["n_terminal"], q[0]["coverage"], q[0]["score"]) == (1, 1, 75.0, "medium") and q[2]["n_self"] == 1 and q[4]["score"] == "high"
    reach = {(r["machine"], r["state"]) for r in fsm.reachable(df).collect()}
    assert (2, "S2") not in reach and (0, "S3") in reach
    assert fsm.shapes(df).select("shape").distinct().count() == 5


def test_gates(spark):
    df = spark.createDataFrame([(1, "a", {"x": "1"}), (1, "b", {}), (None, None, None)], "k int, v string, m map<string,string>")
    assert governance.duplicate_keys(df.where("k = 1"), "k").first()["n"] == 2
    assert governance.outside(df, "v", ["a"]).collect()[0]["value"] == "b"
    assert {(r["stated"], r["n"]) for r in governance.version_mismatches(df, "m", {"x": "2"}).collect()} == {("1", 1), (None, 2)}
    p = spark.createDataFrame([(2, 0)], "k int, v int")
    assert governance.orphans(df, p, {"k": "k"}, "r").first()["n_rows"] == 2


@pytest.mark.parametrize("t,v", [("1 + 2 * 3", 7), ("-7 / 2", -4), ("-7 % 2", 1), ("8'hff", 255), ("1 / 0", None), ("'x", None), ("$clog2(9)", 4), ("1 << 300", None), ("2 > 1 ? 5 : x", 5), ("a", None), ("!0 && 3", 1)])
def test_folding(t, v):
    assert expr.fold(expr.read(t)) == v


def test_wording():
    assert expr.wording(expr.read("!(a && b[2] == 3)")) == "a is 0 or element 2 of b is not 3"
    assert expr.depth(expr.read("{a, b + 1}")) == 3 and expr.size(expr.read("a")) == 1


def test_rtl_reader(spark):
    t = """// module no; endmodule
module top #(parameter W = 2) (input clk, input rst_n, input [3:0] d, output reg [1:0] q, output y);
  localparam IDLE = 1'd0, RUN = 1'd1; reg st; wire w = d[0];
  always @(posedge clk or negedge rst_n) if (!rst_n) st <= IDLE; else case (st)
    IDLE: if (d) st <= RUN; RUN: st <= IDLE; endcase
  child u0 (.a(clk), .b({d, w})); assign y = w & ~d[1];
endmodule"""
    got = [r for r in rtl.sections(t)]
    by = lambda s: [r for r in got if r["section"] == s]
    assert [r["name"] for r in by("port")] == ["clk", "rst_n", "d", "q", "y"] and by("instance")[0]["target"] == "child"
    assert {(r["value"], r["target"]) for r in by("transition") if r["kind"] == "explicit"} == {("RUN", "IDLE"), ("IDLE", "RUN")}
    assert by("register")[0]["reset"] == "rst_n" and [r["name"] for r in by("parameter")] == ["W", "IDLE", "RUN"] and by("pin")[1]["value"] == "{d, w}"
    df = spark.createDataFrame([("r", t), ("n", None), ("e", ""), ("b", "module x (")], "record_id string, text string")
    assert {r["record_id"] for r in rtl.read_rtl(df).collect()} == {"r"}


def test_strong_components_of_small_and_large_scopes(spark, monkeypatch):
    rnd = random.Random(2)
    e = [(s, f"n{rnd.randrange(24):02}", f"n{rnd.randrange(24):02}") for s in ("p", "q") for _ in range(34)] + [("r", "a", "a"), ("r", "a", "b"), (None, "a", "b"), ("r", None, "b")]
    df = spark.createDataFrame(e, "scope string, src string, dst string")
    got = sorted(map(tuple, graph.strong_components(df).select("scope", "node", "component").collect()))
    reach = {(s, a, b) for s, a, b in e if s and a and b}
    while True:
        more = reach | {(s, a, d) for s, a, b in reach for t, c, d in reach if s == t and b == c}
        if more == reach:
            break
        reach = more
    want = sorted({(s, a, min(y for t, x, y in reach if t == s and x == a and (s, y, a) in reach)) for s, a, b in reach if (s, b, a) in reach})
    assert got == want
    monkeypatch.setattr(graph, "SCOPE_EDGES", 30)
    assert sorted(map(tuple, graph.strong_components(df).select("scope", "node", "component").collect())) == want
