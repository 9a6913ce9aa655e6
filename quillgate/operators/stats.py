"""Reports: two definitions of quantiles, histograms, coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def by_value(df: DataFrame, value: str) -> DataFrame:
    """(value, n, upto): distinct values with their count and the number of rows up to them. The running sum is taken over distinct values only.

    Nulls are left out. The window runs over one row per distinct value: a bounded domain (lengths, counts) stays small however many rows there are.
    """
    n = df.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("value")).agg(F.count("*").alias("n"))
    return n.withColumn("upto", F.sum("n").over(Window.orderBy("value").rowsBetween(Window.unboundedPreceding, 0)))


def nearest_index(df: DataFrame, value: str, percents: list[int], rounded: bool) -> DataFrame:
    """One row with n, low, high and p<q> for each percent: the sorted value at index min(n*q/100, n-1) cut to an integer or, if ``rounded``, at index
    q/100*(n-1) rounded half to even. No row is gathered: the index is looked up in the cumulated counts. An empty table gives nulls and n = 0."""
    c = by_value(df, value)
    total = c.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))

    def index(q: int) -> Column:
        t = F.col("total")
        return F.least(F.bround(F.lit(q) / 100 * (t - 1), 0), t - 1) if rounded else F.least(F.floor(t * q / 100), t - 1)

    j = c.join(F.broadcast(total))
    return j.agg(F.coalesce(F.max("total"), F.lit(0)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high"), *[F.min(F.when(F.col("upto") > index(q), F.col("value"))).alias(f"p{q}") for q in percents])


def histogram(df: DataFrame, *by: str) -> DataFrame:
    """Rows per value and their percentage with two decimals; null is a value."""
    n = df.groupBy(*by).agg(F.count("*").alias("n"))
    return n.withColumn("percent", F.round(100 * F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(1))), 2))


def coverage(known: Column, total: Column, empty: float | None) -> Column:
    """100 * known / total with two decimals; ``empty`` where the total is 0 (definitions differ: 100, 0 or null)."""
    return F.when(total == 0, F.lit(empty).cast("double")).otherwise(F.round(100 * known / total, 2))
