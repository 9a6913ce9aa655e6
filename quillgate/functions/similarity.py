"""Sequence similarity of token streams, with exact upper bounds that prune before Python is entered."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from difflib import SequenceMatcher
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.skew import salted_join
from ..sources.tables import Scratch

#: Similarity classes (fixed values): near duplicate, structural, informational.
NEAR, STRUCTURAL = 0.70, 0.30
#: Bits of the texts that are compared with one in a step: enough to make a step worth its call, and the bitmaps of all tokens stay small.
PACKED_BITS = 1 << 14
#: Pairs of tokens of two texts up to which they are compared by a table.
MOST_CELLS = 1 << 22


def length_bound(a: Column, b: Column) -> Column:
    """The ratio can't be more than this: by the lengths of two token arrays."""
    return F.when(F.size(a) + F.size(b) == 0, F.lit(1.0)).otherwise(2 * F.least(F.size(a), F.size(b)) / (F.size(a) + F.size(b)))


def similarity_class(r: Column) -> Column:
    return F.when(r >= NEAR, "near_duplicate").when(r >= STRUCTURAL, "structural_similarity").otherwise("informational")


@F.pandas_udf(T.DoubleType())
def seq_ratio(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """2M/T over matching blocks of two texts of tokens joined by blanks; the order of the arguments matters. Equal texts are 1 without a comparison."""
    for a, b in batches:
        yield pd.Series([1.0 if x == y else SequenceMatcher(None, x.split(" "), y.split(" "), autojunk=False).ratio() for x, y in zip(a, b)])


def _packs(texts: list[list[str]]) -> Iterator[tuple[int, int]]:
    """Ranges of texts that are packed together."""
    first, bits = 0, 0
    for k, t in enumerate(texts):
        if bits and bits + len(t) > PACKED_BITS:
            yield first, k
            first, bits = k, 0
        bits += len(t) + 8
    yield first, len(texts)


def common_tokens(texts: list[list[str]], others: list[list[str]], until: list[int]) -> Iterator[tuple[int, int, int]]:
    """(k, l, tokens in the longest common subsequence) of texts[k] and others[l] for all k < until[l], which mustn't fall with l.

    Bit-parallel, and many texts at once: their bits stand side by side in one number, with a gap after each that takes the carry.
    """
    for first, end in _packs(texts):
        masks: dict[str, int] = {}
        at, spans, ones = 0, [], []
        raised: dict[str, list[int]] = {}
        for t in texts[first:end]:
            for p, x in enumerate(t):
                raised.setdefault(x, []).append(at + p)
            wide = len(t) // 8 + 1  # bytes; one bit at least is left over
            spans.append((at // 8, wide, len(t)))
            ones.append(((1 << len(t)) - 1) << at)
            at += 8 * wide
        for x, places in raised.items():
            b = bytearray(places[-1] // 8 + 1)
            for p in places:
                b[p >> 3] |= 1 << (p & 7)
            masks[x] = int.from_bytes(b, "little")
        full = [0]
        for o in ones:
            full.append(full[-1] | o)
        for l, other in enumerate(others):
            n = min(until[l], end) - first
            if n <= 0:
                continue
            v = every = full[n]
            for x in other:
                if m := masks.get(x):
                    u = v & m
                    v = ((v + u) | (v - u)) & every
            b = v.to_bytes(at // 8, "little")
            for k, (o, wide, length) in enumerate(spans[:n]):
                yield first + k, l, length - int.from_bytes(b[o : o + wide], "little").bit_count()


def ratio(a: list[str], b: list[str]) -> float:
    """SequenceMatcher's ratio without junk. The lengths of all runs stand in a table, so the longest block of each part is one search; very long texts are left to SequenceMatcher."""
    if len(a) * len(b) > MOST_CELLS:
        return SequenceMatcher(None, a, b, autojunk=False).ratio()
    ids: dict[str, int] = {}
    x, y = (np.array([ids.setdefault(t, len(ids)) for t in z], dtype=np.int32) for z in (a, b))
    same = x[:, None] == y[None, :]
    runs = same.astype(np.int16 if min(len(a), len(b)) < 1 << 15 else np.int32)
    for i in range(1, len(a)):
        runs[i, 1:] += runs[i - 1, :-1] * same[i, 1:]
    found, todo = 0, [(0, len(a), 0, len(b))]
    while todo:
        alo, ahi, blo, bhi = todo.pop()
        part = runs[alo:ahi, blo:bhi]
        i, j = divmod(int(part.argmax()), bhi - blo)
        n = int(part[i, j])
        if n > min(i, j) + 1:  # it begins outside: all runs as they are inside
            part = np.minimum(part, np.minimum(np.arange(1, ahi - alo + 1)[:, None], np.arange(1, bhi - blo + 1)[None, :]))
            i, j = divmod(int(part.argmax()), bhi - blo)
            n = int(part[i, j])
        if n:
            found += n
            i, j = alo + i + 1, blo + j + 1  # the block's end
            if i - n > alo and j - n > blo:
                todo.append((alo, i - n, blo, j - n))
            if i < ahi and j < bhi:
                todo.append((i, ahi, j, bhi))
    return 2.0 * found / (len(a) + len(b))


def closest(left: list[tuple[str, str | None, str]], right: list[tuple[str, str | None, str]] | None = None) -> float | None:
    """Largest ratio, as seq_ratio has it, of two texts of different names and marks: of the left, or if a right is given one of each; None if there are none. Texts are (name, mark, text).

    The text with the lesser name comes first. Matching blocks are a common subsequence, so pairs are compared in the order of that bound, until no other can be larger.
    """
    mark = lambda r: (r[1] is not None, r[1] or "")
    sides = [(sorted(x, key=mark), sorted(y, key=mark)) for x, y in ([(left, left)] if right is None else [(left, right), (right, left)])]
    bounds = []
    for s, (x, y) in enumerate(sides):
        marks = [mark(r) for r in x]
        tx, ty = [r[2].split(" ") for r in x], [r[2].split(" ") for r in y]
        for k, l, n in common_tokens(tx, ty, [bisect_left(marks, mark(r)) for r in y]):
            if x[k][0] != y[l][0]:
                bounds.append((2.0 * n / (len(tx[k]) + len(ty[l])), s, k, l))
    best = None
    for bound, s, k, l in sorted(bounds, reverse=True):
        if best is not None and bound <= best:
            break
        a, b = sorted((sides[s][0][k], sides[s][1][l]), key=lambda r: r[0])
        r = 1.0 if a[2] == b[2] else ratio(a[2].split(" "), b[2].split(" "))
        best = r if best is None else max(best, r)
    return best


def closest_by_group(texts: DataFrame, parts: int, block: int = 256) -> DataFrame:
    """(group_id, similarity): the closest two texts of different names and marks of each group that has such. texts: (group_id, name, mark, text), saved: it is read twice.

    Texts of a group are dealt to blocks of about ``block``, and each pair of blocks is searched by itself, so a large group is cut over several tasks.
    """
    n = texts.groupBy("group_id").agg(F.ceil(F.count("*") / block).cast("int").alias("n"))
    own = F.pmod(F.xxhash64("name"), F.col("n")).cast("int")
    dealt = texts.join(n, "group_id").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    keys = ["group_id", "x", "y"]
    dealt = dealt.select("group_id", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), (F.col("own") <= F.col("other")).alias("left"), "name", "mark", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for b in batches:
                yield from zip(*(c.to_pylist() for c in b.columns))

        for (group, x, y), held in groupby(rows(), key=lambda r: r[:3]):
            sides: tuple[list, list] = ([], [])
            for r in held:
                sides[not r[3]].append(r[4:])
            if (best := closest(*sides[: 1 + (x != y)])) is not None:
                yield pa.RecordBatch.from_pydict({"group_id": [group], "similarity": [best]})

    return dealt.repartition(parts, *keys).sortWithinPartitions(*keys).mapInArrow(run, "group_id string, similarity double").groupBy("group_id").agg(F.max("similarity").alias("similarity"))


@F.pandas_udf(T.IntegerType())
def longest_run(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Longest matching block of two token arrays that holds at least one token outside the canonical vocabulary. Separators are to be left out before."""
    for p, c, canon in batches:
        out = []
        for x, y, names in zip(p, c, canon):
            x, y, names = list(x), list(y), set(names)
            blocks = SequenceMatcher(None, x, y, autojunk=False).get_matching_blocks()
            out.append(max((m.size for m in blocks if any(t not in names for t in x[m.a : m.a + m.size])), default=0))
        yield pd.Series(out, dtype="int32")


class NearTexts:
    """Pairs of texts that share a fingerprint. texts: (key, fingerprint, stream); null keys, fingerprints and streams tie nothing.

    Copies, texts with the same fingerprint and stream, are one class, and its least key represents it: a group of copies costs one row of ``members`` per key
    and no pairs. ``members`` and the pairs of classes together say what all pairs of keys would.
    """

    def __init__(self, texts: DataFrame):
        self.scratch = s = Scratch(texts.sparkSession)
        x = texts.where("key is not null and fingerprint is not null and stream is not null")
        self.members = s.save(x.select("key", F.sha2(F.to_json(F.struct("fingerprint", "stream")), 256).alias("class_id"), "fingerprint", "stream").distinct())
        self.classes, self.seen = s.counted(self.members.groupBy("class_id").agg(F.min("key").alias("key"), F.count("*").alias("n_keys"), F.first("fingerprint").alias("fingerprint"), F.first("stream").alias("stream")))

    def class_pairs(self, least: float = NEAR) -> DataFrame:
        """(class_a, class_b, a, b, similarity) of different classes that agree by ``least`` or more; a <= b are their representatives, in the order of the comparison.

        Pairs whose lengths rule the limit out never reach Python; a fingerprint under many texts is cut over several tasks. Classes with the same representative (a key with several texts) are compared too, as their
        other members differ.
        """
        side = lambda k: self.classes.select("fingerprint", F.col("class_id").alias(f"class_{k}"), F.col("key").alias(k), F.col("stream").alias(f"s{k}"))
        p = salted_join(side("a"), side("b"), ["fingerprint"], self.seen["n"]).where("a < b or a = b and class_a < class_b").where(F.round(length_bound(F.split("sa", " "), F.split("sb", " ")), 6) >= least)
        return p.withColumn("similarity", F.round(seq_ratio("sa", "sb"), 6)).where(F.col("similarity") >= least).select("class_a", "class_b", "a", "b", "similarity")

    def edges(self, least: float = NEAR) -> DataFrame:
        """(a, b, similarity) with a < b: pairs of different representatives; the largest similarity if they meet in several classes."""
        return self.class_pairs(least).where("a < b").groupBy("a", "b").agg(F.max("similarity").alias("similarity"))

    def membership(self, least: float = NEAR) -> DataFrame:
        """(key, class_id, representative, n_copies, n_links): one row per key and class; the other keys in its class and the other classes near it."""
        n = self.class_pairs(least).select(F.explode(F.array("class_a", "class_b")).alias("class_id")).groupBy("class_id").agg(F.count("*").alias("n_links"))
        c = self.classes.select("class_id", F.col("key").alias("representative"), (F.col("n_keys") - 1).alias("n_copies")).join(n, "class_id", "left")
        return self.members.select("key", "class_id").join(c, "class_id").select("key", "class_id", "representative", "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links"))

    def tally(self) -> DataFrame:
        """(class, n_edges, n_pairs, least): classes of similarity over all pairs that share a fingerprint.

        n_edges are pairs of different classes of copies, n_pairs the pairs of keys they stand for, with those inside a class (similarity 1). A key in both
        classes of a pair is no pair with itself; two keys that meet in several classes count in each.
        """
        m = self.members.select("key", "class_id")
        several = m.join(m.groupBy("key").count().where("count > 1").select("key"), "key")
        common = several.select("key", F.col("class_id").alias("class_a")).join(several.select("key", F.col("class_id").alias("class_b")), "key").where("class_a <> class_b").groupBy("class_a", "class_b").agg(F.count("*").alias("both"))
        n = self.classes.select("class_id", "n_keys")
        p = self.class_pairs(0.0).join(n.select(F.col("class_id").alias("class_a"), F.col("n_keys").alias("na")), "class_a").join(n.select(F.col("class_id").alias("class_b"), F.col("n_keys").alias("nb")), "class_b").join(common, ["class_a", "class_b"], "left")
        both = F.coalesce("both", F.lit(0))
        other = p.select("similarity", F.lit(1).alias("edge"), (F.col("na") * F.col("nb") - both * (both + 1) / 2).cast("long").alias("pairs"))
        same = n.where("n_keys > 1").select(F.lit(1.0).alias("similarity"), F.lit(0).alias("edge"), (F.col("n_keys") * (F.col("n_keys") - 1) / 2).cast("long").alias("pairs"))
        return other.union(same).groupBy(similarity_class(F.col("similarity")).alias("class")).agg(F.sum("edge").alias("n_edges"), F.sum("pairs").alias("n_pairs"), F.min("similarity").alias("least"))


def near_edges(texts: DataFrame, least: float = NEAR) -> DataFrame:
    """(a, b, similarity) with a < b of texts that share a fingerprint and agree by ``least`` or more, copies left to NearTexts.membership."""
    return NearTexts(texts).edges(least)
