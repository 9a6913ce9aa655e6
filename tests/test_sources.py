"""Sinks, tolerant reading, includes and records."""

from datetime import datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import types as T

from quillgate.operators import records
from quillgate.plans import design
from quillgate.sources import includes, sinks


def test_lines_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("é", None, {"z": 1, "a": 2}, (2, [("x", None)]))], "b string, a int, m map<string,int>, s struct<y: int, c: array<struct<q: string, p: int>>>")
    line = df.select(sinks.canonical_line(df).alias("v")).first()["v"]
    assert line == '{"a":null,"b":"é","m":{"a":2,"z":1},"s":{"c":[{"p":null,"q":"x"}],"y":2}}'
    sinks.write_lines(df.select("a", "b"), str(tmp_path / "x"))
    with open(tmp_path / "x" / "bad.txt", "w") as f:
        f.write('{"a":1,"b":"x","c":2}\n{"a":\n{"b":"k","a":3}\n')
    got = sinks.read_lines(spark, str(tmp_path / "x"), T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])).collect()
    assert sorted((r["a"], r["b"]) for r in got if r["_corrupt"] is None and r["a"]) == [(3, "k")] and sum(r["_corrupt"] is not None for r in got) == 2


def test_publish_swaps_and_recovers(spark, tmp_path):
    p = str(tmp_path / "t")
    assert sinks.publish(spark.range(3), p) == 3 and sinks.publish(spark.range(5), p) == 5
    assert spark.read.parquet(p).count() == 5
    (tmp_path / "t").rename(tmp_path / "t.previous")
    assert sinks.publish(spark.range(2), p) == 2 and sorted(x.name for x in tmp_path.iterdir()) == ["t"]


def test_includes(spark):
    files = spark.createDataFrame([("a/x.v", '`endif\n`include "y.vh"\n`ifdef Q\n `include "inc.vh"\n`endif\n`include "far.vh"\n`include "none.vh"'), ("a/y.vh", '`include "x.v"'), ("lib/inc.vh", ""), ("b/inc.vh", ""), ("z/far.vh", ""), ("n", None)], "path string, text string")
    d = includes.directives(files)
    r = {(x["path"], x["name"]): (x["target"], x["conditional"]) for x in includes.resolve(d, files, ["lib"]).collect()}
    assert r == {("a/x.v", "y.vh"): ("a/y.vh", False), ("a/x.v", "inc.vh"): ("lib/inc.vh", True), ("a/x.v", "far.vh"): ("z/far.vh", False), ("a/x.v", "none.vh"): (None, False), ("a/y.vh", "x.v"): ("a/x.v", False)}
    c = {(x["path"], x["includes"]) for x in includes.closure(includes.resolve(d, files, ["lib"])).collect()}
    assert ("a/y.vh", "z/far.vh") in c and ("a/x.v", "a/x.v") in c


def test_prompts_within_budget(spark):
    df = spark.createDataFrame([("i", "m", ["r1", "r2"], ["c"])], "ip string, module string, registers array<string>, children array<string>")
    full = records.prompts(df, 10**6).first()
    assert full["prompt"] == "Module m of i\nregister r1\nregister r2\nsubmodule c" and full["n_dropped"] == 0
    assert records.prompts(df, 30).first()["prompt"] == "Module m of i\nregister r1" and records.prompts(df, 1).first()["n_dropped"] == 3


def test_drained_stream_counts_every_event(spark, tmp_path):
    ts = [datetime(2024, 1, 1) + timedelta(minutes=7 * i) for i in range(100)]
    kinds = ["a" if i % 3 else "b" for i in range(100)]
    events = pa.table({"event_id": list(range(100)), "ts": pa.array(ts, pa.timestamp("us")), "event_type": kinds, "value": [float(i) for i in range(100)]})
    pq.write_table(events, tmp_path / "events.parquet")
    want = {}
    for i in range(100):
        key = ts[i].replace(minute=0), kinds[i]
        n, total = want.get(key, (0, 0.0))
        want[key] = n + 1, total + i
    assert {(r["hour"], r["event_type"]): (r["n"], r["total"]) for r in design.stream_hourly(spark, str(tmp_path)).collect()} == want
    pq.write_table(events.slice(0, 0), tmp_path / "events.parquet")
    assert design.stream_hourly(spark, str(tmp_path)).count() == 0
