"""Core operators of problems 2, 4 and 5, components and joins: fixtures with dirty rows, ties, loops, empty tables and clashing columns."""

import json
import random

import pytest
from pyspark.sql import functions as F

from quillgate.operators import components, hierarchy, nested, references, skew
from quillgate.plans import general

EDGE = "ip string, parent string, child string, instance string"


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def closure(edges):
    out = {}
    for ip, a, b in edges:
        out.setdefault((ip, a), set()).add((ip, b))
    res = set()
    for a in out:
        seen, todo = set(), [a]
        while todo:
            for y in out.get(todo.pop(), ()):
                if y not in seen:
                    seen.add(y)
                    todo.append(y)
        res |= {(a[0], a[1], y[1]) for y in seen}
    return sorted(res)


def test_descendants_against_brute_force(spark):
    rnd = random.Random(3)
    e = [("x", f"m{rnd.randrange(40)}", f"m{rnd.randrange(40)}") for _ in range(45)] + [("y", f"n{i}", f"n{i + 1}") for i in range(25)] + [("y", "n3", "leaf")] * 3
    df = spark.createDataFrame([(*r, "i") for r in e], EDGE)
    assert rows(hierarchy.descendants(df), "ip", "ancestor", "descendant") == closure(e)


def test_descendants_of_nothing_and_nulls(spark):
    df = spark.createDataFrame([("x", None, "b", "i"), (None, "a", "b", "i"), ("x", "a", None, "i")], EDGE)
    assert hierarchy.descendants(df).count() == 0
    assert hierarchy.descendants(df.limit(0)).count() == 0


def test_paths_loops_and_shared_children(spark):
    df = spark.createDataFrame([("x", "top", "a", "u0"), ("x", "top", "a", "u1"), ("x", "a", "lib", None), ("x", "p", "q", "l"), ("x", "q", "p", "l"), ("x", "top", "q", "z")], EDGE)
    got = rows(hierarchy.instance_paths(df), "module", "path", "depth", "closes_loop")
    assert ("lib", "top/u0/?", 2, False) in got and ("lib", "top/u1/?", 2, False) in got
    assert ("q", "top/z/l/l", 3, True) in got
    rep = {r["module"]: r for r in hierarchy.modules_report(df).collect()}
    assert rep["lib"]["n_paths"] == 2 and rep["top"]["n_below"] == 4 and rep["p"]["on_loop"] and rep["p"]["reached"]
    lonely = spark.createDataFrame([("x", "p", "q", "l"), ("x", "q", "p", "l")], EDGE)
    assert all(r["on_loop"] and not r["reached"] and r["path"] is None for r in hierarchy.modules_report(lonely).collect())


def test_modules_report_against_all_paths(spark, monkeypatch):
    """Shortest paths and counts level by level agree with walking every path; levels are compacted on the way."""
    monkeypatch.setattr(hierarchy.Levels, "COMPACT", 2)
    rnd = random.Random(11)
    e = sorted({("x", f"m{a:02}", f"m{a + rnd.randrange(1, 5):02}", f"u{k % 4}{'-' * (k % 3)}") for k in range(60) for a in [rnd.randrange(12)]}) + [("x", "m07", "m05", "back")]
    df = spark.createDataFrame(e, EDGE)
    paths = [r for r in hierarchy.instance_paths(df).collect() if not r["closes_loop"]]
    best = {}
    for r in paths:
        best[r["module"]] = min(best.get(r["module"], (99,)), (r["depth"], r["path"].split("/")))
    got = {r["module"]: r for r in hierarchy.modules_report(df).collect()}
    assert {m: (r["depth"], r["path"].split("/")) for m, r in got.items() if r["reached"]} == best
    tree = hierarchy.modules_report(df.where("instance <> 'back'")).collect()
    free = hierarchy.instance_paths(df.where("instance <> 'back'")).groupBy("module").count().collect()
    assert {r["module"]: int(r["n_paths"]) for r in tree} == {r["module"]: r["count"] for r in free}


def test_modules_without_instances_have_a_row(spark, tmp_path):
    s = "doc_id long, ip string, module string, instances array<struct<name: string, module: string>>"
    docs = [(1, "x", "top", [("u", "leaf")]), (2, "x", "leaf", []), (3, " x ", "alone", None), (4, "x", "empty", []), (5, "y", "leaf", [None]), (6, "x", "self", [("u", "self")]), (7, "x", None, []), (8, "", "m", [])]
    spark.createDataFrame(docs + docs[2:4], s).write.parquet(f"{tmp_path}/structural_wrap.parquet")
    got = set(rows(general.p2_modules(spark, str(tmp_path)), "ip", "module", "root", "path", "depth", "n_paths", "n_below", "on_loop", "reached"))
    assert got == {("x", "top", "top", "top", 0, 1, 1, False, True), ("x", "leaf", "top", "top/u", 1, 1, 0, False, True), ("x", "self", None, None, None, 0, 1, True, False)} | {(i, m, m, m, 0, 1, 0, False, True) for i, m in (("x", "alone"), ("x", "empty"), ("y", "leaf"))}


def test_instance_edges_clean(spark):
    s = "doc_id long, ip string, module string, extra int, instances array<struct<name: string, module: string>>"
    df = spark.createDataFrame([(1, " x ", "a\t", 0, [(" u ", " b "), (None, "c"), ("v", None), None]), (1, "x", "a", 1, [("u", "b")]), (2, "x", "d", 0, None), (3, "x", "e", 0, [])], s)
    assert sorted(rows(hierarchy.instance_edges(df), "ip", "parent", "child")) == [("x", "a", "b"), ("x", "a", "c")]


def brute_components(edges):
    p = {}

    def find(x):
        p.setdefault(x, x)
        while p[x] != x:
            x = p[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        p[b] = a
    return sorted((x, find(x)) for x in p)


@pytest.mark.parametrize("limit", [10**9, 1, 0])
def test_components_against_union_find(spark, limit, monkeypatch):
    if limit < 2:
        monkeypatch.setattr(components, "ONE_TASK", 0)  # rounds over the cluster
    if not limit:  # every key hot
        monkeypatch.setattr(skew, "LEAST", 0)
        monkeypatch.setattr(skew, "SHARE", 10)
    rnd = random.Random(5)
    e = [(f"{rnd.randrange(90):03}", f"{rnd.randrange(90):03}") for _ in range(60)] + [("900", f"{k}") for k in range(901, 960)] + [(f"{k}", f"{k + 1}") for k in range(700, 730)] + [("5x", "5x")]
    df = spark.createDataFrame([(*r, 1) for r in e] + [(None, "a", 1), ("b", None, 1)], "src string, dst string, n int")
    assert rows(components.connected_components(df), "node", "component") == brute_components(e)


def test_components_of_nothing(spark):
    df = spark.createDataFrame([], "src long, dst long")
    assert components.connected_components(df).count() == 0
    assert components.connected_components(spark.createDataFrame([(4, 4), (4, 4)], "src long, dst long")).collect() == [(4, 4)]


def test_hub_edges_hot_key(spark):
    held = spark.range(3000).select(F.col("id").cast("string").alias("n"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    e = components.hub_edges(held, "n", "k")
    assert e.count() == 3000 and e.where("dst = '0'").count() == 1000
    assert components.hub_edges(held.withColumn("k", F.lit(None).cast("string")), "n", "k").count() == 0


# nested records

GOOD = {"module": "m", "fsms": [{"states": [{"name": "A"}, None, {"name": "B\"\\é"}], "transitions": {"from": "A", "to": None}}, {"states": "[{\"name\": \"C\"}]", "transitions": None}], "instances": None}


def flat(spark, payloads, *kinds):
    df = spark.createDataFrame([(i, p, 0) for i, p in enumerate(payloads)], "raw_id long, payload string, name int")
    return nested.flatten_payloads(df, *kinds).collect()


def test_shapes_of_lists_and_envelopes(spark):
    texts = [json.dumps(GOOD), json.dumps([GOOD]), json.dumps({"document": GOOD, "schema": 1}), "﻿" + json.dumps(GOOD, indent=2), json.dumps({"document": json.dumps(GOOD)})]
    got = flat(spark, texts, "state", "transition")
    for i in range(len(texts)):
        mine = sorted((r["item_kind"], r["pos1"], r["pos2"], r["pos3"], r["name"]) for r in got if r["raw_id"] == i)
        assert mine == [("state", 0, 0, -1, "A"), ("state", 0, 2, -1, "B\"\\é"), ("state", 1, 0, -1, "C"), ("transition", 0, 0, -1, None)], i


def test_repeats_and_escaped_keys(spark):
    p = '{"fs\\u006ds": [{"states": [{"n\\u0061me": "A"}]}]}'
    df = spark.createDataFrame([(1, p, 0), (1, p, 1), (2, '{"box": {"fsms": [{"states": ["S"]}]}}', 0)], "raw_id long, payload string, n int")
    assert rows(nested.flatten_payloads(df, "state"), "raw_id", "pos1", "pos2", "name") == [(1, 0, 0, "A")]
    assert rows(nested.flatten_payloads(df, "state", envelopes=("document", "box")), "raw_id", "name") == [(1, "A"), (2, "S")]


def test_not_whole_payloads_give_nothing(spark):
    whole = json.dumps({"fsms": [{"states": [{"name": "A", "value": 1.5e3}]}]})
    bad = [whole[:k] for k in range(len(whole))] + [whole + "}", whole + " x", whole.replace(":", ";", 1), whole.replace("1500.0", "01"), whole.replace('"A"', '"A\n"'), whole.replace('"A"', r'"\q"'), whole.replace("]", "}", 1), None, "", " ", "null", "7", '"x"', "[]", whole.replace("[", "[,", 1), whole.replace("{", '{"a" 1,', 1)]
    assert flat(spark, bad) == []
    assert len(flat(spark, [whole], "state")) == 1


def test_signals_and_links(spark):
    p = {"instances": {"name": "u", "module": "c", "connections": [{"port": "p", "signals": "clk"}, {"port": "q", "signals": ["a", None, "b"]}, {"port": "r"}]}}
    got = flat(spark, [json.dumps(p)])
    assert sorted((r["pos1"], r["pos2"], r["pos3"], r["signal"]) for r in got if r["item_kind"] == "signal") == [(0, 0, 0, "clk"), (0, 1, 0, "a"), (0, 1, 2, "b")]
    assert sorted((r["pos2"], r["port"]) for r in got if r["item_kind"] == "connection") == [(0, "p"), (1, "q"), (2, "r")]


def test_index_agrees_with_a_parser_on_random_json():
    rnd = random.Random(1)

    def value(d):
        k = rnd.randrange(7 if d < 4 else 4)
        return [lambda: rnd.randrange(-5, 10**6), lambda: rnd.choice(["", "a\\", 'q"', " é", "[x", "{"]), lambda: rnd.choice([True, False, None, 1.25e-7]), lambda: "k" * rnd.randrange(5), lambda: [value(d + 1) for _ in range(rnd.randrange(4))], lambda: {f"k{i}": value(d + 1) for i in range(rnd.randrange(4))}, lambda: {"x": value(d + 1)}][k]()

    docs, ok = [], []
    for _ in range(400):
        t = json.dumps(value(0), ensure_ascii=rnd.random() < 0.5, indent=rnd.choice([None, 1]))
        if rnd.random() < 0.5 and t:
            i = rnd.randrange(len(t))
            t = t[:i] + rnd.choice(["", "}", '"', ",", "\\", "x"]) + t[i + 1 :]
        docs.append(t.encode())
        try:
            json.loads(t, parse_constant=lambda _: 1 / 0)
            ok.append(True)
        except (ValueError, ZeroDivisionError):
            ok.append(False)
    assert (nested.Index(docs).root >= 0).tolist() == ok


# references


def test_match_semantics(spark):
    refs = spark.createDataFrame([(1, "a", "x"), (2, "a", None), (3, "q", None), (4, None, None), (5, "a", "y"), (5, "a", "y")], "id int, k1 string, k2 string")
    t = spark.createDataFrame([("a", "x", 9), ("b", None, 9)], "k1 string, t2 string, id int")
    keys = {"k1": "k1", "k2": "t2"}
    ids = lambda m: sorted(r["id"] for r in references.orphan_references(refs, keys, t, m).collect())
    assert ids("simple") == [5, 5]
    assert ids("partial") == [3, 5, 5]
    assert ids("full") == [2, 3, 5, 5]
    assert sorted(r["id"] for r in references.orphan_references(refs, keys, t.limit(0), "partial").collect()) == [1, 2, 3, 5, 5]
    assert references.orphan_references(refs.limit(0), keys, t).count() == 0
    with pytest.raises(ValueError):
        references.orphan_references(refs, keys, t, "other")


def test_life_spans(spark):
    s = "k string, f timestamp, u timestamp"
    from datetime import datetime as D

    t = spark.createDataFrame([("a", D(2024, 1, 1), D(2024, 2, 1)), ("a", D(2024, 3, 1), None)], s)
    r = spark.createDataFrame([("a", D(2024, 1, 1)), ("a", D(2024, 2, 1)), ("a", D(2024, 3, 1)), ("a", D(2023, 1, 1)), ("a", None)], "k string, at timestamp")
    got = references.orphan_references(r, {"k": "k"}, t, "partial", "at", ("f", "u")).collect()
    assert sorted(str(x["at"]) for x in got) == ["2023-01-01 00:00:00", "2024-02-01 00:00:00", "None"]


def test_partial_masks_meet_merged_life_spans(spark, monkeypatch):
    from datetime import datetime as D
    from datetime import timedelta

    rnd = random.Random(7)
    t0 = D(2024, 1, 1)
    day = lambda n: t0 + timedelta(days=n)
    spans = [(rnd.choice(["hot", "hot", "b", "c"]), f"k{rnd.randrange(4)}", day(a), None if rnd.random() < 0.02 else day(a + rnd.randrange(0, 25))) for a in [rnd.randrange(500) for _ in range(120)]] + [("d", "k1", None, None)]
    refs = [(rnd.choice(["hot", "b", "c", "d", "q"]), rnd.choice([None, "k1", "k2"]), day(rnd.randrange(520))) for _ in range(300)]
    alive = lambda r: any(s[0] == r[0] and r[1] in (None, s[1]) and s[2] and s[2] <= r[2] and (s[3] is None or s[3] > r[2]) for s in spans)
    want = sorted(map(str, [r for r in refs if not alive(r)]))
    t, r = spark.createDataFrame(spans, "a string, b string, f timestamp_ntz, u timestamp_ntz"), spark.createDataFrame(refs, "a string, b string, at timestamp_ntz")
    for few in (references.FEW, 0):
        monkeypatch.setattr(references, "FEW", few)
        got = references.orphan_references(r, {"a": "a", "b": "b"}, t, "partial", "at", ("f", "u")).collect()
        assert sorted(str(tuple(x)) for x in got) == want


def test_state_references_dirty(spark):
    s = "doc_id long, built_at timestamp, fsms array<struct<states: array<struct<name: string>>, transitions: array<struct<from_state: string, to_state: string>>>>"
    df = spark.createDataFrame([(1, None, [([("A",), (None,), None], [(" A ", "B"), (None, "*none"), ("  *x", ""), None]), None, (None, [("Q", "A")])]), (2, None, None), (3, None, [])], s)
    got = rows(references.orphan_references(references.state_references(df), {"doc_id": "doc_id", "machine": "machine", "ref_name": "name"}, references.machine_states(df)), "doc_id", "machine", "field_name", "ref_name")
    assert got == [(1, 0, "to_state", ""), (1, 0, "to_state", "B"), (1, 2, "from_state", "Q"), (1, 2, "to_state", "A")]
