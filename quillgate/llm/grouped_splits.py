"""Problem 1: splits that keep related records together, by grouped iterative stratification."""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.components import connected_components, hub_edges
from ..sources.tables import Scratch, clean

IDENTITIES = ("source_rtl", "module_body", "normalized_ir", "completion")
SPLITS, RATIOS = ("train", "validation", "test"), (0.7, 0.15, 0.15)
#: The different label vectors of components with several labels may have CELLS entries in all (checked); classes are ranked inside BUCKETS hash buckets.
CELLS, BUCKETS = 1_000_000, 256


def present(col):
    """An identity that says something: null, blank, or a prefix followed by zeros only are absent (null)."""
    c = clean(col)
    return F.when(~c.rlike(r"^([^:]*:)?0*$"), c)


def group_edges(records: DataFrame, reports: DataFrame) -> DataFrame:
    """(src, dst): ties between record_ids. A record is listed by a loop on itself, so records without a tie appear too.

    Ties: a present value of one of IDENTITIES, the same (ip, module_name), or modules in one entry of cross_split_fingerprints of any report run (the entry
    counts even if its fingerprint is null; modules without records tie nothing). body_shape ties nothing. Null or empty module names and ips tie nothing.
    """
    r = records.select("record_id", *[present(F.col(c)).alias(c) for c in IDENTITIES], clean(F.col("ip")).alias("ip"), clean(F.col("module_name")).alias("module_name")).where("record_id is not null").distinct()
    module = F.when((F.col("ip") != "") & (F.col("module_name") != ""), F.concat_ws("/", "ip", "module_name"))
    held = r.select("record_id", F.explode(F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).alias("value")) for c in IDENTITIES], F.struct(F.lit("module").alias("kind"), module.alias("value")))).alias("x")).select("record_id", "x.kind", "x.value").where("value is not null")
    hubs = r.withColumn("module", module).where("module is not null").groupBy("module").agg(F.min("record_id").alias("record_id"))
    entries = reports.select("cross_split_fingerprints").select(F.explode("cross_split_fingerprints").alias("f")).select(F.col("f.modules").alias("modules")).where("modules is not null").distinct()
    entries = entries.select(F.sha2(F.to_json(F.struct("modules")), 256).alias("value"), F.explode("modules").alias("m"))
    parts = F.split("m", "/", 2)
    entries = entries.select(F.lit("entry").alias("kind"), "value", F.concat_ws("/", clean(parts[0]), clean(parts[1])).alias("module")).distinct()
    held = held.union(entries.join(hubs, "module").select("record_id", "kind", "value"))
    return hub_edges(held, "record_id", "kind", "value").union(r.select(F.col("record_id").alias("src"), F.col("record_id").alias("dst")))


def record_groups(records: DataFrame, reports: DataFrame) -> DataFrame:
    """(record_id, group_id) of all records; group_id is the least record_id of the group."""
    return connected_components(group_edges(records, reports)).select(F.col("node").alias("record_id"), F.col("component").alias("group_id"))


def tied_records(groups: DataFrame) -> DataFrame:
    """The rows of groups with two records or more. The member that gives a group its name need not be counted: any other member proves the tie."""
    others = groups.where("record_id <> group_id")
    return others.union(others.select(F.col("group_id").alias("record_id"), "group_id").distinct())


def _pour(needs: list[float], size: int, n: int, room: list[float] | None = None, weight: int | None = None) -> list[int]:
    """How many of n equal items each split gets if each item goes to the split with the largest need left (ties: the most room left, then the earlier split).

    An item takes ``size`` off the need of its split and ``weight`` (size, if not given) off its room.
    """
    lo, hi = min(needs) - size * n - size, max(needs)
    for _ in range(80):
        mid = (lo + hi) / 2
        taken = sum(max(0, -int(-(d - mid) // size)) for d in needs)
        lo, hi = (mid, hi) if taken > n else (lo, mid)
    got = [max(0, -int(-(d - hi) // size)) for d in needs]
    left = [d - g * size for d, g in zip(needs, got)]
    weight = size if weight is None else weight
    free = [r - g * weight for r, g in zip(room or [0.0] * len(needs), got)]
    for _ in range(n - sum(got)):
        k = max(range(len(left)), key=lambda i: (round(left[i], 6), round(free[i], 6), -i))
        got[k] += 1
        left[k] -= size
        free[k] -= weight
    return got


def _fill(needs: list[float], amount: float) -> list[float]:
    """What each split gets if an amount is poured, as a fluid, into the largest needs first."""
    top = sorted(needs, reverse=True)
    for k in range(len(top), 0, -1):
        level = (sum(top[:k]) - amount) / k
        if level <= top[k - 1]:
            return [max(0.0, d - level) for d in needs]
    return [0.0] * len(needs)


def place(classes: list[tuple[str, dict[str, int], int]], totals: dict[str, int], ratios=RATIOS) -> dict[str, list[int]]:
    """How many components of each class go to each split; a class is (name, label vector of several labels, number of components).

    totals: the records of each label, those of components with this label only included. Repeats: take the label with the fewest records outstanding, place its
    components of several labels, largest first, each into the split that needs the label most (ties: the most room left, then the earlier split); the components
    that have this label only follow. The latter change nothing but the room for later labels, so they are poured elsewhere (``_pours``) and count here by
    their number only. Equal components are poured at once, which gives what one by one gives.
    """
    k = len(ratios)
    need = {lab: [t * r for r in ratios] for lab, t in totals.items()}
    room = [sum(totals.values()) * r for r in ratios]
    out, minor = dict(totals), dict(totals)
    at = defaultdict(list)
    for c in classes:
        for lab, n in c[1].items():
            at[lab].append(c)
            minor[lab] -= n * c[2]
    where: dict[str, list[int]] = {}
    queue = [(n, lab) for lab, n in out.items()]
    heapq.heapify(queue)
    done = set()
    while queue:
        n, lab = heapq.heappop(queue)
        if lab in done or n != out[lab]:
            continue
        done.add(lab)
        for name, vector, count in sorted((c for c in at[lab] if c[0] not in where), key=lambda c: (-sum(c[1].values()), c[0])):
            weight = sum(vector.values())
            got = where[name] = _pour(need[lab], vector[lab], count, room, weight)
            for x, m in vector.items():
                need[x] = [d - g * m for d, g in zip(need[x], got)]
                out[x] -= m * count
                if x not in done:
                    heapq.heappush(queue, (out[x], x))
            room = [r - g * weight for r, g in zip(room, got)]
        room = [r - x for r, x in zip(room, _fill(need[lab], minor[lab]))]
    return where


def _pours(ratios):
    """Cuts of the components with one label: rows (bucket, total, label, size, n, h0, h1, ...) in the order bucket, total, label, size from the largest; h: records of the label that components of several labels brought to each split.

    Every label is poured for itself, the rarest first; a bucket carries the room its labels have left so far, for ties.
    """
    k = len(ratios)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = lab = None
        need, room = [0.0] * k, [0.0] * k
        for b in batches:
            labels, sizes, cuts = [], [], [[] for _ in range(k)]
            for r in b.to_pylist():
                if r["bucket"] != at:
                    at, lab, room = r["bucket"], None, [0.0] * k
                if r["label"] != lab:
                    lab = r["label"]
                    need = [r["total"] * x - r[f"h{j}"] for j, x in enumerate(ratios)]
                    room = [x + y for x, y in zip(room, need)]
                got, seen = _pour(need, r["size"], r["n"], room), 0
                need = [x - g * r["size"] for x, g in zip(need, got)]
                room = [x - g * r["size"] for x, g in zip(room, got)]
                labels.append(lab)
                sizes.append(r["size"])
                for j, g in enumerate(got):
                    seen += g
                    cuts[j].append(seen)
            yield pa.RecordBatch.from_arrays([pa.array(labels, pa.string()), pa.array(sizes, pa.int64())] + [pa.array(c, pa.int64()) for c in cuts], names=["label", "size"] + [f"c{j}" for j in range(k)])

    return run


def grouped_splits(records: DataFrame, groups: DataFrame, label: str = "ip", splits=SPLITS, ratios=RATIOS) -> DataFrame:
    """(record_id, group_id, split): every record once, whole groups, shares near ``ratios`` overall and per label.

    Label vectors are summed per group in two steps (group and label, then group), so no group is gathered; a vector has as many entries as there are labels at
    most. Groups with equal vectors are one class. The rule is the same at every size: labels from the rarest outstanding on; groups of several labels first,
    largest first, then those of one label (``place``). Classes of several labels are placed on the driver, by their vectors and counts only: their number
    grows with the kinds of vectors, not with the rows, and more than CELLS entries are refused. Classes of one label never leave the executors: each label is
    poured on its own (``_pours``). The groups of a class are told apart by their rank in BUCKETS hash buckets plus the buckets' offsets: a class that holds a
    third of all records is never one task. Null labels are a label of their own. A record_id delivered twice counts once, under its least label.
    """
    spark: SparkSession = records.sparkSession
    scratch = Scratch(spark)
    k = len(splits)
    lab = records.select("record_id", F.coalesce(clean(F.col(label)), F.lit("")).alias("label")).where("record_id is not null").groupBy("record_id").agg(F.min("label").alias("label"))
    cells = scratch.save(groups.join(lab, "record_id").groupBy("group_id", "label").agg(F.count("*").alias("n")))
    totals = scratch.save(cells.groupBy("label").agg(F.sum("n").alias("total")))
    vectors = cells.groupBy("group_id").agg(F.sort_array(F.collect_list(F.struct("label", "n"))).alias("v"))
    one = F.size("v") == 1
    name = F.when(one, F.concat_ws("|", F.lit("one"), F.col("v")[0]["n"].cast("string"), F.col("v")[0]["label"])).otherwise(F.concat(F.lit("several|"), F.sha2(F.to_json("v"), 256)))
    bucket = F.pmod(F.xxhash64("group_id"), F.lit(BUCKETS)).cast("int")
    comps = scratch.save(vectors.select("group_id", "v", name.alias("cls"), bucket.alias("bucket")))
    tally = scratch.save(comps.groupBy("cls", "bucket").agg(F.count("*").alias("n"), F.first("v").alias("v")))
    classes = scratch.save(tally.groupBy("cls").agg(F.sum("n").alias("n"), F.first("v").alias("v")))
    several, held = scratch.counted(classes.where(~one), cells=F.sum(F.size("v")))
    if (held["cells"] or 0) > CELLS:
        raise ValueError(f"the label vectors of groups with several labels have {held['cells']} entries, more than {CELLS}")
    kinds = [(r["cls"], {x["label"]: x["n"] for x in r["v"]}, r["n"]) for r in several.toLocalIterator()]
    of = {r["label"]: r["total"] for r in totals.join(several.select(F.explode("v.label").alias("label")).distinct(), "label").toLocalIterator()}
    where = place(kinds, of, ratios)
    brought = {x: [0] * k for x in of}
    for c, v, _ in kinds:
        for x, m in v.items():
            brought[x] = [b + g * m for b, g in zip(brought[x], where[c])]
    heads = spark.createDataFrame([(x, *b) for x, b in brought.items()], "label string, " + ", ".join(f"h{j} long" for j in range(k)))
    single = classes.where(one).select("cls", "n", F.col("v")[0]["label"].alias("label"), F.col("v")[0]["n"].alias("size"))
    poured = single.join(totals, "label").join(heads, "label", "left").select(F.pmod(F.xxhash64("label"), F.lit(BUCKETS)).cast("int").alias("bucket"), "total", "label", "size", "n", *[F.coalesce(f"h{j}", F.lit(0)).alias(f"h{j}") for j in range(k)])
    poured = poured.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "bucket").sortWithinPartitions("bucket", "total", "label", F.desc("size"))
    cut = poured.mapInArrow(_pours(ratios), "label string, size long, " + ", ".join(f"c{j} long" for j in range(k)))
    cut = single.join(cut, ["label", "size"]).select("cls", *[f"c{j}" for j in range(k)])
    upto = [(c, *[sum(g[: j + 1]) for j in range(k)]) for c, g in where.items()]
    cut = cut.union(spark.createDataFrame(upto, "cls string, " + ", ".join(f"c{j} long" for j in range(k))))
    before = tally.withColumn("offset", F.sum("n").over(Window.partitionBy("cls").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))).select("cls", "bucket", F.coalesce("offset", F.lit(0)).alias("offset")).join(cut, "cls")
    ranked = comps.select("group_id", "cls", "bucket").withColumn("rk", F.row_number().over(Window.partitionBy("cls", "bucket").orderBy(F.xxhash64("group_id", F.lit(7)), "group_id"))).join(before, ["cls", "bucket"])
    pick = F.lit(splits[-1])
    for j in range(k - 2, -1, -1):
        pick = F.when(F.col("offset") + F.col("rk") <= F.col(f"c{j}"), splits[j]).otherwise(pick)
    chosen = scratch.save(ranked.select("group_id", pick.alias("split")))
    return groups.join(chosen, "group_id").select("record_id", "group_id", "split")
