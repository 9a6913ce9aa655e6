"""Joins that survive hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot when it holds more than 1/SHARE of the rows; there can be at most SHARE such keys, so broadcasting them is bounded by construction.
SHARE, LEAST = 400, 20_000


def attach_by_key(left: DataFrame, right: DataFrame, key: str, value: str, count: str, total: int) -> DataFrame:
    """``left`` with ``value`` of the row of ``right`` that has the same ``key``; keys of ``right`` are unique and ``count`` holds each key's rows in a table of ``total`` rows.

    Rows of hot keys meet a broadcast of at most SHARE rows and are never shuffled; the rest takes a shuffle join. Rows without a partner are dropped (inner). Nulls in ``key`` match nothing.
    """
    limit = max(LEAST, total // SHARE)
    hot = right.where(F.col(count) > limit).select(F.col(key).alias("_hk"), F.col(value).alias("_hv"))
    cold = right.where(F.col(count) <= limit).select(key, value)
    if total <= LEAST:
        return left.join(right.select(key, value), key)
    marked = left.join(F.broadcast(hot), F.col(key) == F.col("_hk"), "left")
    return marked.where("_hk is not null").withColumn(value, F.col("_hv")).drop("_hk", "_hv").unionByName(
        marked.where("_hk is null").drop("_hk", "_hv").join(cold, key)
    )


def salted_join(left: DataFrame, right: DataFrame, on: list[str], total: int) -> DataFrame:
    """Inner equi-join of ``left`` (``total`` rows, saved: it is read twice) with ``right`` in which a hot key of ``left`` is cut over several tasks.

    A key with more than 1/SHARE of left's rows gets one salt per such share; its left rows are dealt to the salts by their hash and right's rows of the key
    are repeated once per salt, so right grows by SHARE keys' rows at most. Keys that aren't hot are joined as they are. Columns of left mustn't be maps.
    """
    if total <= LEAST:
        return left.join(right, on)
    limit = max(LEAST, total // SHARE)
    hot = left.groupBy(*on).agg(F.count("*").alias("_n")).where(F.col("_n") > limit).select(*on, F.ceil(F.col("_n") / limit).cast("int").alias("_k"))
    salt = F.pmod(F.xxhash64(*left.columns), F.col("_k")).cast("int")
    a = left.join(F.broadcast(hot), on, "left").withColumn("_salt", F.coalesce(salt, F.lit(0))).drop("_k")
    b = right.join(F.broadcast(hot), on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_k"), F.lit(1)) - 1))).drop("_k")
    return a.join(b, [*on, "_salt"]).drop("_salt")
