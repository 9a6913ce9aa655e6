"""Problem 7: mixing sources to target weights."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import Scratch, clean

#: Ranks of a public byte-level BPE vocabulary; read by the driver, which sends it along with the job to workers that don't have the path.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How that vocabulary splits text before merging (fixed value).
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SEED = 20

_encoders: dict[str, object] = {}
_sent: set[tuple[str, str]] = set()


def encoder(path: str):
    if path not in _encoders:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encoders[path] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encoders[path]


def source_name(col):
    """A source as mix_weights writes it: lower case, without blanks around, other separators as underscores."""
    return F.regexp_replace(F.lower(clean(col)), r"[^\p{L}\p{N}]+", "_")


def token_sizes(documents: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, source, n_tokens). A null text has 0 tokens. Whole texts are counted."""

    context = documents.sparkSession.sparkContext
    if (context.applicationId, tokenizer) not in _sent:
        _sent.add((context.applicationId, tokenizer))
        context.addFile(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer if os.path.exists(tokenizer) else SparkFiles.get(os.path.basename(tokenizer)))
        for b in batches:
            n = [len(enc.encode_ordinary(t)) if t else 0 for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("source"), pa.array(n, pa.int64())], names=["doc_id", "source", "n_tokens"])

    return documents.select("doc_id", source_name(F.col("source")).alias("source"), "text").where("doc_id is not null").mapInArrow(run, "doc_id long, source string, n_tokens long")


def rates(totals: dict[str, int], weights: dict[str, tuple[float, float]], total: float | None = None) -> dict[str, float]:
    """Copies per document of each source. Shares are taken of the sources that have tokens; the size of the mix is the largest for which no source needs more
    than its cap (or ``total`` tokens, if smaller)."""
    live = {s: w for s, w in weights.items() if w[0] > 0 and w[1] > 0 and totals.get(s, 0) > 0}
    whole = sum(w[0] for w in live.values())
    if not live:
        return dict.fromkeys(weights, 0.0)
    size = min(totals[s] * cap * whole / share for s, (share, cap) in live.items())
    size = min(size, total) if total else size
    return {s: min(weights[s][1], size * weights[s][0] / whole / totals[s]) if s in live else 0.0 for s in weights}


class Mix:
    """The mix of one corpus; token sizes are counted once."""

    def __init__(self, documents: DataFrame, weights: DataFrame, tokenizer: str = TOKENIZER, total: float | None = None, seed: int = SEED):
        self.spark = documents.sparkSession
        self.seed = seed
        self.sizes = Scratch(self.spark).save(token_sizes(documents, tokenizer))
        table = weights.select(source_name(F.col("source")).alias("source"), F.col("target_share").cast("double").alias("share"), F.col("max_repeats").cast("double").alias("cap")).where("source is not null")
        self.weights = {r["source"]: (r["share"] or 0.0, r["cap"] or 0.0) for r in table.groupBy("source").agg(F.max("share").alias("share"), F.max("cap").alias("cap")).limit(10_001).collect()}
        if len(self.weights) > 10_000:
            raise ValueError("more than 10,000 sources have a weight; they don't fit the driver")
        listed = self.spark.createDataFrame([(s,) for s in self.weights], "listed string")
        self.by_source = self.sizes.join(F.broadcast(listed), F.col("source") == F.col("listed"), "left").groupBy("listed").agg(F.sum("n_tokens").alias("n_tokens"), F.count("*").alias("n_docs"))
        self.have = {r["listed"]: (r["n_tokens"], r["n_docs"]) for r in self.by_source.collect()}
        self.rates = rates({s: n for s, (n, _) in self.have.items() if s}, self.weights, total)

    def records(self) -> DataFrame:
        """(doc_id, source, copy, n_tokens): each document floor(rate) times, once more with the probability of the fraction; the draw is a hash of seed and
        doc_id, so a rerun or another partitioning gives the same mix. Documents without tokens or without a listed source are not in it. No shuffle."""
        r = F.broadcast(self.spark.createDataFrame(list(self.rates.items()), "source string, rate double"))
        draw = F.pmod(F.xxhash64(F.lit(self.seed), "doc_id"), F.lit(1 << 52)) / F.lit(float(1 << 52))
        n = (F.floor("rate") + (draw < F.col("rate") - F.floor("rate")).cast("long")).cast("int")
        return self.sizes.where("n_tokens > 0").join(r, "source").withColumn("n", n).where("n > 0").select("doc_id", "source", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy"), "n_tokens")

    def report(self) -> DataFrame:
        """Per listed source: target share, cap, documents and tokens there are, rate, tokens in the mix, actual share. Sources outside the list are one row
        with a null source and no share."""
        mixed = {x["source"]: x["n"] for x in self.records().groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()}
        whole = sum(mixed.values()) or 1
        rows = [(s, share, int(cap), self.have.get(s, (0, 0))[1], self.have.get(s, (0, 0))[0], self.rates[s], mixed.get(s, 0), mixed.get(s, 0) / whole) for s, (share, cap) in self.weights.items()]
        if None in self.have:
            rows.append((None, 0.0, 0, self.have[None][1], self.have[None][0], 0.0, 0, 0.0))
        return self.spark.createDataFrame(rows, "source string, target_share double, max_repeats int, n_docs long, n_tokens long, rate double, mixed_tokens long, actual_share double")
