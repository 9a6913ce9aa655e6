"""Groups and what joined them against a scan, the gate on planted faults, classes of cross-split groups, and the token metric."""

import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from quillgate.functions import similarity, text
from quillgate.operators import leakage as lk
from quillgate.operators.splits import HARD, SOFT

ID = "record_id string, ip string, module_name string, source_rtl string, module_body string, normalized_ir string, completion string, body_shape string, extra int"


def scan(rows, edges):
    """Groups and joining kinds by a union-find that walks records, then edges, in order."""
    parent = {r[0]: r[0] for r in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    joined = []

    def tie(a, b, why):
        a, b = sorted((find(a), find(b)))
        if a != b:
            parent[b] = a
            joined.append((a, why))

    ips = {}
    for r in rows:
        ips.setdefault(r[7], set()).add(r[1])
    first = {}
    for r in sorted(rows):
        for k, c in enumerate((*HARD, SOFT)):
            v = r[3 + k]
            if not v or c == SOFT and len(ips[v]) < 2:
                continue
            if (c, v) in first:
                tie(r[0], first[c, v], "hard" if c in HARD else c)
            else:
                first[c, v] = r[0]
    of = {}
    for r in sorted(rows):
        of.setdefault((r[1], r[2]), []).append(r[0])
    for a, b in sorted(tuple(sorted(e)) for e in edges):
        if a in of and b in of:
            chain = of[a] + of[b]
            for x, y in zip(chain, chain[1:]):
                tie(x, y, "near_duplicate")
    why = {}
    for root, kind in joined:
        why.setdefault(find(root), set()).add(kind)
    groups = {}
    for r in rows:
        groups.setdefault(find(r[0]), []).append(r[0])
    return {g: (len(m), ",".join(sorted(why.get(g, ())))) for g, m in groups.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_and_joining_kinds_follow_the_scan(spark, seed):
    rnd = random.Random(seed)
    pick = lambda n, c: f"{c}:{rnd.randrange(n)}" if rnd.random() < 0.7 else rnd.choice([None, ""])
    rows = [(f"r{i:03}", rnd.choice("xyz"), f"m{rnd.randrange(40)}", pick(60, "s"), pick(60, "m"), pick(70, "n"), pick(70, "c"), f"h{rnd.randrange(50)}", 0) for i in range(90)]
    edges = {tuple(sorted(((rnd.choice("xyz"), f"m{rnd.randrange(45)}"), (rnd.choice("xyz"), f"m{rnd.randrange(45)}")))) for _ in range(25)}
    df = spark.createDataFrame(rows + rows[:3], ID)
    e = spark.createDataFrame([(*b, *a) for a, b in edges if a != b], "ip_a string, module_a string, ip_b string, module_b string")
    r = lk.rows_of(df).cache()
    ties = lk.scan_edges(r, e).cache()
    got = {x["group_id"]: (x["n_records"], x["joined_by"]) for x in lk.group_report(r, lk.groups(r, ties), ties).collect()}
    assert got == scan(rows, [x for x in edges if x[0] != x[1]])


def test_groups_of_nothing(spark):
    r = lk.rows_of(spark.createDataFrame([], ID))
    ties = lk.scan_edges(r)
    assert lk.group_report(r, lk.groups(r, ties), ties).count() == 0 and lk.gate(r, spark.createDataFrame([], "record_id string, split string")).where("n > 0").count() == 0


def test_gate_finds_planted_faults(spark):
    full = lambda i, ip="x", mod=None, **k: (f"r{i}", ip, mod or f"m{i}", *[k.get(c, f"{c}{i}") for c in (*HARD, SOFT)], 0)
    rows = [full(1, source_rtl="s"), full(2, source_rtl="s"), full(3, body_shape="h"), full(4, body_shape="h", ip="y"), full(5, completion=None), full(6)]
    df = lk.rows_of(spark.createDataFrame(rows, ID)).cache()
    split = spark.createDataFrame([("r1", "train"), ("r2", "test"), ("r3", "train"), ("r4", "test"), ("r5", "train"), ("r9", "train"), ("r3", "test"), ("r1", "train")], "record_id string, split string")
    edges = spark.createDataFrame([("x", "m1", "x", "m2"), ("x", "m1", "x", "gone"), ("x", "m5", "x", "m1")], "ip_a string, module_a string, ip_b string, module_b string")
    again = spark.createDataFrame([("r1", "train"), ("r2", "train")], "record_id string, split string")
    listed = lk.manifest(df, spark.createDataFrame([("r1", "g", "train"), ("r2", "g", "train")], "record_id string, group_id string, split string")).withColumn("completion", F.lit("other"))
    n = {(r["check"], r["problem"]): r["n"] for r in lk.gate(df, split, again, listed, edges).collect()}
    assert n["records", "in several splits"] == 1 and n["records", "without a split"] == 1 and n["records", "without identities"] == 1 and n["identities", "missing"] == 1
    assert n["hard", "source_rtl crosses splits"] == 2 and n["soft", "body_shape crosses splits"] == 1 and n["hard", "groups cross splits"] >= 1
    assert n["near_duplicate", "edges cross splits"] == 1 and n["near_duplicate", "edges name modules without records"] == 1
    assert n["determinism", "records differ from the assignment made again"] >= 4 and n["manifest", "records differ from the manifest"] >= 4 and n["manifest", "identities differ from the manifest"] == 2
    assert lk.status(lk.gate(df, split)).first()["status"] == "FAIL"
    clean = lk.rows_of(spark.createDataFrame([full(1), full(2)], ID))
    assert lk.status(lk.gate(clean, spark.createDataFrame([("r1", "train"), ("r2", "test")], "record_id string, split string"))).first()["status"] == "PASS"
    e = lk.effective_edges(edges, df, lk.groups(df, lk.scan_edges(df))).collect()
    assert sorted((r["module_b"], r["effective"], r["known"]) for r in e) == [("x/gone", False, False), ("x/m1", True, True), ("x/m2", False, True)]
    x = lk.examples(df, split, "source_rtl").first()
    assert x["members"] == "x/m2@test x/m1@train" and x["n_records"] == 2


def test_cross_split_groups_score_the_closest_pair(spark):
    prints = spark.createDataFrame([("structural", "f1", "x", "a"), ("structural", "f1", "y", "b"), ("structural", "f1", "y", "c"), ("fsm", "f2", "x", "a"), ("fsm", "f2", "y", "b"), ("fsm", "f2", "y", "c"), ("fsm", "f3", "x", "d"), ("fsm", "f3", "x", "e"), ("fsm", "f4", "x", "a"), ("fsm", "f4", "q", "gone"), ("fsm", None, "x", "a")], "kind string, fingerprint string, ip string, module string")
    split = spark.createDataFrame([("x", "a", "r1", "train"), ("y", "b", "r2", "test"), ("y", "c", "r3", "train"), ("x", "d", "r4", "train"), ("x", "e", "r5", "train")], "ip string, module string, record_id string, split string")
    streams = spark.createDataFrame([("x", "a", "v0 = v1 ; v2"), ("y", "b", "v0 = v1 ; v3"), ("y", "c", "zzz")], "ip string, module string, stream string")
    got = lk.cross_split_groups(prints, split, streams).collect()
    assert [(r["n_members"], r["splits"], r["sources"], r["similarity"], r["class"]) for r in got] == [(3, "test,train", "fsm,structural", 0.8, "near_duplicate")]
    f = {r["kind"]: tuple(r)[1:] for r in lk.fingerprint_leakage(prints, split).collect()}
    assert f["structural"] == (1, 1, 1, 3) and f["fsm"] == (3, 3, 1, 3)


def _near(rnd, base, changes):
    out = list(base)
    for _ in range(changes):
        out[rnd.randrange(len(out))] = f"v{rnd.randrange(30)}"
    return " ".join(out)


@pytest.mark.parametrize("seed", range(6))
def test_closest_is_that_of_all_pairs(seed, monkeypatch):
    rnd = random.Random(seed)
    base = [rnd.choice([";", "=", "(", ")", f"v{rnd.randrange(30)}"]) for _ in range(120)]
    rows = [(f"m{rnd.randrange(70):02}", rnd.choice([None, "", "test", "train", "test,train"]), _near(rnd, base[: rnd.randrange(1, 121)], rnd.randrange(60))) for _ in range(60)] + [("m98", "test", ""), ("m99", "train", "v0")]
    ratio = lambda a, b: SequenceMatcher(None, a[2].split(" "), b[2].split(" "), autojunk=False).ratio()
    pairs = lambda xs, ys: [ratio(*sorted((a, b), key=lambda r: r[0])) for a in xs for b in ys if a[0] != b[0] and a[1] != b[1]]
    n, plain = [0], similarity.ratio
    monkeypatch.setattr(similarity, "ratio", lambda a, b: (n.__setitem__(0, n[0] + 1), plain(a, b))[1])
    monkeypatch.setattr(similarity, "PACKED_BITS", 1000)
    assert similarity.closest(rows) == max(all_pairs := pairs(rows, rows))
    assert n[0] < len(all_pairs) / 8
    assert similarity.closest(rows[:20], rows[20:]) == max(pairs(rows[:20], rows[20:]))
    assert similarity.closest([r for r in rows if r[1] == "test"]) is None
    for a, b in zip(rows, rows[1:]):
        assert plain(a[2].split(" "), b[2].split(" ")) == ratio(a, b)


def test_closest_by_group_over_blocks(spark):
    rnd = random.Random(7)
    base = [f"v{rnd.randrange(30)}" for _ in range(40)]
    rows = [(g, f"m{k:02}", rnd.choice(["test", "train", None]), _near(rnd, base, 25)) for g, n in (("a", 40), ("b", 3), ("c", 11)) for k in range(n)] + [("d", "m1", "test", "x"), ("d", "m2", "test", "x")]
    df = spark.createDataFrame(rows, "group_id string, name string, mark string, text string")
    want = {g: similarity.closest([r[1:] for r in rows if r[0] == g]) for g in "abc"}
    for block in (4, 256):
        assert {r[0]: r[1] for r in similarity.closest_by_group(df, 4, block).collect()} == want


def test_copies_across_splits_need_no_comparison(spark, monkeypatch):
    """A hot fingerprint: 500 different texts and one copy in another split."""
    rnd = random.Random(3)
    base = [f"v{rnd.randrange(60)}" for _ in range(300)]
    names = [f"m{k:03}" for k in range(500)]
    streams = [("x", m, _near(rnd, base, 200)) for m in names]
    streams.append(("y", "copy", streams[0][2]))
    prints = spark.createDataFrame([("fsm", "f", i, m) for i, m, _ in streams], "kind string, fingerprint string, ip string, module string")
    split = spark.createDataFrame([(i, m, "r", "test" if m == "copy" or k % 2 else "train") for k, (i, m, _) in enumerate(streams)], "ip string, module string, record_id string, split string")
    given, plain = [], similarity.closest_by_group
    monkeypatch.setattr(similarity, "closest_by_group", lambda df, *a: (given.append(df.count()), plain(df, *a))[1])
    got = lk.cross_split_groups(prints, split, spark.createDataFrame(streams, "ip string, module string, stream string")).collect()
    assert [(r["n_members"], r["splits"], r["similarity"], r["class"]) for r in got] == [(501, "test,train", 1.0, "near_duplicate")] and given == [0]


def test_each_text_is_read_once(spark, tmp_path):
    from quillgate.plans import leakage as plan

    rec = lambda i, m, t: (i, ("x", m), "train", ("rtl", t), ("none", None))
    spark.createDataFrame([rec("r1", "a", "module a; endmodule"), rec("r2", "a", "module a; endmodule"), rec("r3", "b", "module a; endmodule"), rec("r4", "b", "module b; endmodule")], "record_id string, module struct<ip: string, name: string>, split string, input struct<kind: string, text: string>, target struct<kind: string, text: string>").selectExpr("record_id", "module", "split", "input", "target", "named_struct('id', '1') as task").write.parquet(f"{tmp_path}/dataset_records.parquet")
    texts, held = plan._texts(spark, str(tmp_path))
    assert texts.count() == 2 and sorted(tuple(r)[1:] for r in held.collect()) == [("x", "a"), ("x", "b"), ("x", "b")]


def _fsm(n):
    arms = " ".join(f"2'd{k}: if (go) st <= 2'd{(k + 1) % n};" for k in range(n))
    return f"module m (input clk, input rst, input go, output o); reg [1:0] st; assign o = st == 2'd1; always @(posedge clk) if (rst) st <= 2'd0; else case (st) {arms} default: st <= 2'd0; endcase endmodule"


def test_classes_of_a_record_with_several_texts(spark, tmp_path):
    """Machines have the shape of their own text: states of another text under the same record aren't theirs."""
    from quillgate.plans import leakage as plan

    rec = lambda i, m, split, t: (i, ("x", m), split, ("rtl", t), ("none", None))
    rows = [rec("r1", "a", "train", _fsm(2)), rec("r1", "a", "train", _fsm(3)), rec("r2", "b", "test", _fsm(2)), rec("r3", "c", "train", _fsm(4)), rec("r4", "d", "test", _fsm(3)), rec("r5", "d", "test", _fsm(3))]
    spark.createDataFrame(rows, "record_id string, module struct<ip: string, name: string>, split string, input struct<kind: string, text: string>, target struct<kind: string, text: string>").selectExpr("*", "named_struct('id', '1') as task").write.parquet(f"{tmp_path}/dataset_records.parquet")
    spark.createDataFrame([("r1", "h1"), ("r2", "h2")], "record_id string, body_shape string").write.parquet(f"{tmp_path}/record_identity.parquet")
    got = plan.cross_split_classes(spark, str(tmp_path)).collect()
    assert sum(r["n_groups"] for r in got) == 2 and sum(r["n_members"] for r in got) == 4 and max(r["highest"] for r in got) == 1.0


def test_guards_are_read_once_for_each_register(monkeypatch):
    from quillgate.rtl import machines
    from quillgate.sources.rtl import sections

    seen, plain = [], machines.Extractor._entry
    monkeypatch.setattr(machines.Extractor, "_entry", lambda self, g, r: (seen.append((g, r)), plain(self, g, r))[1])
    assert sum(r["section"] == "transition" for r in sections(_fsm(3), {"transition"})) > 3
    assert len(seen) == len(set(seen)) > 3


def test_edge_of_the_limit(spark):
    """0.70 is an edge, 0.6999994 isn't."""
    df = spark.createDataFrame([(0.70,), (0.6999994,), (0.3,), (0.29,)], "s double")
    assert [r[0] for r in df.select(similarity.similarity_class(F.round("s", 6))).collect()] == ["near_duplicate", "structural_similarity", "structural_similarity", "informational"]


def test_token_metric(spark):
    p = "The register cnt is loaded with 4'd3 when go rises; cnt clears when rst falls, then busy falls."
    c = "module m (input go); reg cnt; // go rises\n assign y = 4'd3 + 1.5 <<< 2 === x; endmodule"
    df = spark.createDataFrame([(p, c, ["cnt", "go", "m"]), ("", "", [])], "p string, c string, canon array<string>")
    r = df.select(text.tokens(F.col("c")).alias("t"), text.normalized(text.tokens(F.col("c")), F.col("canon")).alias("n"), text.telling(text.ngrams(F.array(*[F.lit("ID")] * 5), 4)).alias("none")).collect()
    assert r[0]["t"] == ["module", "m", "(", "input", "go", ")", ";", "reg", "cnt", ";", "assign", "y", "=", "4'd3", "+", "1.5", "<<<", "2", "===", "x", ";", "endmodule"]
    assert r[0]["n"] == ["ID", "ID", "ID", "y", "4'd3", "1.5", "2", "x"] and r[0]["none"] == [] and r[1]["n"] == []
    s = spark.createDataFrame([("input wire [3:0] a_1; // x\n b <= 12'hF_F + c;",)], "t string").select(text.body_shape(F.col("t"))).first()[0]
    assert s == "input wire [ N : N ] ID ; ID < = N + ID ;"
    n = spark.createDataFrame([("\n\n a  \t\r\nb \r c \n\n",)], "t string").select(text.normalize(F.col("t"))).first()[0]
    assert n == " a\nb\n c"
    run = spark.createDataFrame([(["a", "b", "c", "d"], ["x", "b", "c", "d", "y"], ["b", "c", "d"]), (["a", "b", "c"], ["b", "c", "a"], ["a", "b"])], "p array<string>, c array<string>, k array<string>")
    assert [r[0] for r in run.select(similarity.longest_run("p", "c", "k")).collect()] == [0, 2]
    a = spark.createDataFrame([("x [/home/me",), ("raw/tmp/x",), ("/mnt/d",), ("=/Users/x",)], "t string").where(F.col("t").rlike(text.ABSOLUTE)).count()
    assert a == 3
