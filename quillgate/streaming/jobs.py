"""Structured Streaming forms of the incremental operators; each run drains what is there and ends."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from ..sources.tables import scratch_root


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a stream of files; the schema is the table's."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))


def drain(stream: DataFrame, mode: str = "append") -> DataFrame:
    """The result of a stream over all input there is, written to the shared folder once (its checkpoint beside it).

    In append mode an aggregate by windows has only those the watermark closed; complete mode has all, the last batch's table is the result.
    """
    spark = stream.sparkSession
    base = f"{scratch_root(spark)}/stream-{uuid.uuid4().hex}"
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{base}/state").trigger(availableNow=True)
    last: list[str] = []
    if mode == "complete":  # the file sink appends only

        def keep(df: DataFrame, batch: int) -> None:
            df.write.mode("overwrite").parquet(f"{base}/out-{batch}")
            last[:] = [f"{base}/out-{batch}"]

        writer = writer.foreachBatch(keep)
    else:
        last.append(f"{base}/out")
        writer = writer.format("parquet").option("path", last[0])
    q = writer.start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(*last) if last else spark.createDataFrame([], stream.schema)


def hourly(stream: DataFrame) -> DataFrame:
    """Events per hour and type. The watermark closes windows two hours after the last event seen; a drained input takes complete mode, which has the open ones too."""
    return stream.withWatermark("ts", "2 hours").groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").cast("timestamp_ntz").alias("hour"), "event_type", "n", "total")


def once(stream: DataFrame) -> DataFrame:
    """Each event_id once; repeats that arrive within a day are dropped."""
    return stream.withWatermark("ts", "1 day").dropDuplicatesWithinWatermark(["event_id"]).select("event_id", "user_id", "event_type")


def sliding(stream: DataFrame) -> DataFrame:
    """Events of each type in windows of six hours that start every two."""
    return stream.withWatermark("ts", "6 hours").groupBy(F.window("ts", "6 hours", "2 hours").alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").cast("timestamp_ntz").alias("start"), "event_type", "n")


def sessions(stream: DataFrame, gap: str = "8 hours") -> DataFrame:
    """Sessions of each user: events less than ``gap`` apart."""
    return stream.withWatermark("ts", gap).groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n")).select("user_id", F.col("w.start").cast("timestamp_ntz").alias("start"), F.col("w.end").cast("timestamp_ntz").alias("until"), "n")


_MOVES = "user_id long, event_type string, next string, n long"
_HELD = "last string, at timestamp, id long, moves map<string, long>"


def _advance(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    """A user's moves so far: the state holds the last event and a count for each pair of kinds, as many as there are kinds squared."""
    last, at, ident, moves = state.get if state.exists else (None, None, None, {})
    moves = dict(moves)
    for pdf in frames:
        for row in pdf.sort_values(["ts", "event_id"]).itertuples(index=False):
            if last is not None:
                k = f"{last}\x1f{row.event_type}"
                moves[k] = moves.get(k, 0) + 1
            last, at, ident = row.event_type, row.ts.to_pydatetime(), int(row.event_id)
    state.update((last, at, ident, moves))
    rows = [(key[0], *k.split("\x1f"), n) for k, n in moves.items()]
    yield pd.DataFrame(rows, columns=["user_id", "event_type", "next", "n"])


def moves(stream: DataFrame) -> DataFrame:
    """Moves between consecutive events of each user, as a state machine per user. Every batch gives the totals so far of the users it touched; events of a user
    must arrive in order from batch to batch (inside a batch they are sorted)."""
    return stream.select("user_id", "event_type", "ts", "event_id").where("user_id is not null and event_type is not null and ts is not null").groupBy("user_id").applyInPandasWithState(_advance, _MOVES, _HELD, "update", GroupStateTimeout.NoTimeout)


def drain_updates(stream: DataFrame, key: str) -> DataFrame:
    """The last output of each key of a stream in update mode over all input there is."""
    spark = stream.sparkSession
    base = f"{scratch_root(spark)}/stream-{uuid.uuid4().hex}"

    def keep(df: DataFrame, batch: int) -> None:
        df.withColumn("_batch", F.lit(batch)).write.mode("overwrite").parquet(f"{base}/out/batch-{batch:09d}")

    q = stream.writeStream.outputMode("update").option("checkpointLocation", f"{base}/state").trigger(availableNow=True).foreachBatch(keep).start()
    q.awaitTermination()
    try:
        got = spark.read.option("recursiveFileLookup", True).parquet(f"{base}/out")
    except Exception:  # noqa: BLE001  nothing came
        return spark.createDataFrame([], stream.schema)
    newest = got.groupBy(key).agg(F.max("_batch").alias("_batch"))
    return got.join(newest, [key, "_batch"]).drop("_batch")


def classify_changes(stream: DataFrame, path: str, key: list[str], content: str) -> None:
    """Keep a table of ``path`` with (key..., digest, change, batch) up to date: rows of a batch are new, modified or unchanged against the last digest of their key.

    Every batch joins the latest digests and writes its own folder, so a batch that is run again writes the same folder. Of a key's rows in one batch the one with the greatest
    digest counts. Keys that disappear are not reported.
    """
    spark = stream.sparkSession

    def keep(df: DataFrame, batch: int) -> None:
        now = df.select(*key, F.sha2(F.col(content), 256).alias("digest")).groupBy(*key).agg(F.max("digest").alias("digest"))
        try:
            old = spark.read.option("recursiveFileLookup", True).parquet(f"{path}/changes").where(F.col("batch") < batch)
            last = old.groupBy(*key).agg(F.max_by("digest", "batch").alias("before"))
            j = now.join(last, key, "left")
        except Exception:  # noqa: BLE001  the first batch
            j = now.withColumn("before", F.lit(None).cast("string"))
        change = F.when(F.col("before").isNull(), "new").when(F.col("before") != F.col("digest"), "modified").otherwise("unchanged")
        j.select(*key, "digest", change.alias("change"), F.lit(batch).cast("long").alias("batch")).write.mode("overwrite").parquet(f"{path}/changes/batch-{batch:09d}")

    stream.writeStream.option("checkpointLocation", f"{path}/state").trigger(availableNow=True).foreachBatch(keep).start().awaitTermination()
