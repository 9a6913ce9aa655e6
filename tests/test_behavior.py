"""Coverage lattice, latches, roles."""

import json

import pytest
from pyspark.sql import functions as F

from quillgate.operators import behavior as b

A, P = {"assign": "x"}, {"assign": "x", "part": True}


@pytest.mark.parametrize(
    "tree,level",
    [
        (None, "none"),
        (A, "full"),
        (P, "partial"),
        ({"assign": "y"}, "none"),
        ({"block": [P, A]}, "full"),
        ({"if": [A, A], "else": True}, "full"),
        ({"if": [A]}, "partial"),
        ({"if": [A, {"opaque": True}], "else": True}, "unknown"),
        ({"case": [A, A]}, "conditional"),
        ({"case": [A, P], "default": True}, "partial"),
        ({"case": [A, A], "default": True}, "full"),
        ({"loop": A}, "unknown"),
        ({"block": [A, {"if": [P]}]}, "full"),
    ],
)
def test_coverage(tree, level):
    assert b.LEVELS[b.coverage(tree, "x")] == level


def test_columns(spark):
    df = spark.createDataFrame([(json.dumps({"case": [A]}), "x", "always", 0), ("{", "x", "always_ff", 1), (None, "x", None, 0)], "t string, n string, k string, e int")
    got = df.select(b.coverage_level("t", "n").alias("l"), b.process_role(F.col("k"), F.col("e")).alias("r"), "k").collect()
    assert [r["l"] for r in got] == ["conditional", None, "none" if got[2]["l"] else None] and [r["r"] for r in got] == ["combinational", "sequential", "unknown"]
    s = spark.createDataFrame([("full", "always"), ("partial", "always"), ("full", "always_latch")], "l string, k string").select(b.latch_status(F.col("l"), F.col("k")).alias("s")).collect()
    assert [r["s"] for r in s] == ["none", "inferred", "explicit"]
