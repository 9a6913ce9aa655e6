"""Leakage between splits: groups with near-duplicate edges, what joined them, the gate over a finished split, and classes of cross-split groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ident, similarity
from ..sources.tables import Scratch, clean, spread_parts
from .components import connected_components
from .skew import attach_by_key, salted_join
from .splits import HARD, SOFT, crossing

NEAR = "near_duplicate"


def rows_of(identities: DataFrame) -> DataFrame:
    """(record_id, ip, module, identities...), each once; blanks around names of modules don't count."""
    return identities.where("record_id is not null").select("record_id", clean(F.col("ip")).alias("ip"), clean(F.col("module_name")).alias("module"), *HARD, SOFT).distinct()


def scan_edges(rows: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """(a, b, w, kind): ties in the order a scan meets them. rows: rows_of; edges: (ip_a, module_a, ip_b, module_b), near-duplicate modules.

    Records come by id, their identities in the order HARD, SOFT (SOFT only where its value stands in several ips); each is tied to the first record with that
    value. Near-duplicate edges follow in their order and chain all records of both modules. w orders all ties; no two ties that matter have the same.
    """
    kinds = F.array(*[F.struct(F.lit(k).alias("k"), F.lit("hard" if c in HARD else c).alias("kind"), F.lit(c).alias("column"), F.col(c).alias("value")) for k, c in enumerate((*HARD, SOFT))])
    scratch = Scratch(rows.sparkSession)
    held, seen = scratch.counted(rows.select("record_id", "ip", F.explode(kinds).alias("x")).select("record_id", "ip", "x.*").where("value <> ''").withColumn("key", F.sha2(F.concat_ws("\x1f", "column", "value"), 256)))
    hubs = held.groupBy("key").agg(F.min("record_id").alias("hub"), F.count("*").alias("n"), (F.min("ip") != F.max("ip")).alias("wide"), F.min("kind").alias("kind"))
    hubs = scratch.save(hubs.where((F.col("kind") != SOFT) | F.col("wide")).select("key", "hub", "n"))
    tied = attach_by_key(held.select("record_id", "k", "kind", "key"), hubs, "key", "hub", "n", seen["n"]).where("record_id <> hub")
    weight = lambda phase, x, y, k: F.struct(F.lit(phase).alias("phase"), x.alias("x"), y.alias("y"), k.alias("k"))
    out = tied.select(F.col("record_id").alias("a"), F.col("hub").alias("b"), weight(0, F.col("record_id"), F.lit(""), F.col("k")).alias("w"), "kind")
    if edges is None:
        return out
    name = lambda s: F.concat_ws("/", f"ip_{s}", f"module_{s}")
    e = edges.select(F.least(name("a"), name("b")).alias("x"), F.greatest(name("a"), name("b")).alias("y")).where("x <> y").distinct()
    mine = rows.where("module is not null").select(F.concat_ws("/", "ip", "module").alias("m"), "record_id").distinct()
    side = e.select("x", "y", F.col("x").alias("m"), F.lit(0).alias("s")).union(e.select("x", "y", "y", F.lit(1))).join(mine, "m")
    both = side.groupBy("x", "y").agg(F.countDistinct("s").alias("n")).where("n = 2").select("x", "y")
    w = Window.partitionBy("x", "y").orderBy("s", "record_id")
    chain = side.join(both, ["x", "y"]).select("x", "y", "record_id", F.lead("record_id").over(w).alias("next"), F.row_number().over(w).alias("k")).where("next is not null")
    return out.union(chain.select(F.col("record_id").alias("a"), F.col("next").alias("b"), weight(1, F.col("x"), F.col("y"), F.col("k")).alias("w"), F.lit(NEAR).alias("kind")))


def groups(rows: DataFrame, ties: DataFrame) -> DataFrame:
    """(record_id, group_id) of all rows; group_id is the least record_id."""
    loops = rows.select(F.col("record_id").alias("src"), F.col("record_id").alias("dst")).distinct()
    return connected_components(ties.select(F.col("a").alias("src"), F.col("b").alias("dst")).union(loops)).select(F.col("node").alias("record_id"), F.col("component").alias("group_id"))


def joining_kinds(ties: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, kind): for one record of each merge, the kind of tie that first united its two parts in scan order.

    Those are the ties of the minimum spanning forest under the order w. It is built by rounds in which every component takes its least tie outwards, so the
    number of rounds is the logarithm of the longest chain, and no component is gathered in one task.
    """
    scratch = Scratch(ties.sparkSession)
    now, seen = scratch.counted(ties.where("a <> b").select("a", "b", "w", "kind", F.col("a").alias("node")))
    found = None
    for _ in range(max_rounds):
        if not seen["n"]:
            return found if found is not None else now.select("node", "kind")
        ends = now.select(F.col("a").alias("c"), "a", "b", "w", "kind", "node").union(now.select(F.col("b").alias("c"), "a", "b", "w", "kind", "node"))
        best = scratch.save(ends.groupBy("c").agg(F.min(F.struct("w", "kind", "a", "b", "node")).alias("m")).select("m.*").distinct())
        got = best.select("node", "kind")
        found = got if found is None else found.union(got)
        comp = scratch.save(connected_components(best, "a", "b").select(F.col("node").alias("x"), F.col("component").alias("y")))
        moved = salted_join(now, comp.select(F.col("x").alias("a"), F.col("y").alias("ca")), ["a"], seen["n"])
        moved = scratch.save(moved)
        moved = salted_join(moved, comp.select(F.col("x").alias("b"), F.col("y").alias("cb")), ["b"], seen["n"]).where("ca <> cb")
        now, seen = scratch.counted(moved.select(F.col("ca").alias("a"), F.col("cb").alias("b"), "w", "kind", "node"))
    raise RuntimeError(f"the forest did not settle in {max_rounds} rounds")


def group_report(rows: DataFrame, grouped: DataFrame, ties: DataFrame) -> DataFrame:
    """(group_id, n_records, n_ips, n_modules, joined_by): joined_by lists the kinds of tie that united parts of the group, sorted."""
    kinds = joining_kinds(ties).join(grouped.withColumnRenamed("record_id", "node"), "node").groupBy("group_id").agg(F.array_join(F.sort_array(F.collect_set("kind")), ",").alias("joined_by"))
    size = grouped.join(rows, "record_id").groupBy("group_id").agg(F.countDistinct("record_id").alias("n_records"), F.countDistinct("ip").alias("n_ips"), F.countDistinct("ip", "module").alias("n_modules"))
    return size.join(kinds, "group_id", "left").select("group_id", "n_records", "n_ips", "n_modules", F.coalesce("joined_by", F.lit("")).alias("joined_by"))


def effective_edges(edges: DataFrame, rows: DataFrame, plain: DataFrame) -> DataFrame:
    """(module_a, module_b, effective, known): whether a near-duplicate edge joins groups that are apart without it. plain: groups without such edges."""
    first = rows.where("module is not null").groupBy(F.concat_ws("/", "ip", "module").alias("m")).agg(F.min("record_id").alias("record_id")).join(plain, "record_id").select("m", "group_id")
    e = edges.select(F.concat_ws("/", "ip_a", "module_a").alias("module_a"), F.concat_ws("/", "ip_b", "module_b").alias("module_b")).distinct()
    j = e.join(first.select(F.col("m").alias("module_a"), F.col("group_id").alias("ga")), "module_a", "left").join(first.select(F.col("m").alias("module_b"), F.col("group_id").alias("gb")), "module_b", "left")
    return j.select("module_a", "module_b", F.coalesce(F.col("ga") != F.col("gb"), F.lit(False)).alias("effective"), (F.col("ga").isNotNull() & F.col("gb").isNotNull()).alias("known"))


def manifest(rows: DataFrame, assigned: DataFrame) -> DataFrame:
    """(split, record_id, ip, module, group_id, identities...): what a split manifest lists. assigned: (record_id, group_id, split)."""
    least = rows.groupBy("record_id").agg(*[F.min(c).alias(c) for c in ("ip", "module", *HARD)])
    return assigned.select("record_id", "group_id", "split").join(least, "record_id").select("split", "record_id", "ip", "module", "group_id", *HARD)


def gate(rows: DataFrame, split: DataFrame, expected: DataFrame | None = None, listed: DataFrame | None = None, edges: DataFrame | None = None) -> DataFrame:
    """(check, problem, n): everything wrong with a finished split; PASS where n is 0 throughout. split: (record_id, split), as delivered.

    Checks: records in several splits, records without a split, missing identities, values of each identity that cross splits (hard ones are problems, soft ones
    are reported), groups of hard identities that cross, near-duplicate edges that cross or name modules without records, and, if given, against ``expected``
    (the assignment made again) and ``listed`` (the manifest).
    """
    s = split.select("record_id", "split").where("record_id is not null and split is not null").distinct()
    out = []
    row = lambda df, check, problem: df.agg(F.count("*").alias("n")).select(F.lit(check).alias("check"), F.lit(problem).alias("problem"), "n")
    out.append(row(s.groupBy("record_id").agg(F.count("*").alias("k")).where("k > 1"), "records", "in several splits"))
    out.append(row(rows.select("record_id").distinct().join(s, "record_id", "left_anti"), "records", "without a split"))
    out.append(row(s.select("record_id").distinct().join(rows, "record_id", "left_anti"), "records", "without identities"))
    absent = F.lit(False)
    for c in ("ip", "module", *HARD, SOFT):
        absent = absent | F.col(c).isNull() | (F.col(c) == "")
    out.append(row(rows.where(absent).select("record_id").distinct(), "identities", "missing"))
    x = crossing(rows, s)
    out.append(x.select(F.when(F.col("kind") == SOFT, "soft").otherwise("hard").alias("check"), F.concat("kind", F.lit(" crosses splits")).alias("problem"), F.col("n_crossing").alias("n")))
    hard = groups(rows, scan_edges(rows).where("kind = 'hard'"))
    out.append(row(hard.join(s, "record_id").groupBy("group_id").agg((F.min("split") != F.max("split")).alias("x")).where("x"), "hard", "groups cross splits"))
    if edges is not None:
        in_split = rows.join(s, "record_id").groupBy(F.concat_ws("/", "ip", "module").alias("m")).agg(F.min("split").alias("lo"), F.max("split").alias("hi"))
        e = edges.select(F.concat_ws("/", "ip_a", "module_a").alias("a"), F.concat_ws("/", "ip_b", "module_b").alias("b")).distinct()
        j = e.join(in_split.select(F.col("m").alias("a"), F.col("lo").alias("la"), F.col("hi").alias("ha")), "a", "left").join(in_split.select(F.col("m").alias("b"), F.col("lo").alias("lb"), F.col("hi").alias("hb")), "b", "left")
        out.append(row(j.where("la is null or lb is null"), "near_duplicate", "edges name modules without records"))
        out.append(row(j.where("la is not null and lb is not null and (la <> hb or lb <> ha or la <> ha)"), "near_duplicate", "edges cross splits"))
    if expected is not None:
        out.append(row(s.join(expected.select("record_id", F.col("split").alias("again")), "record_id", "left").where("not (split <=> again)"), "determinism", "records differ from the assignment made again"))
    if listed is not None:
        l = listed.select("record_id", F.col("split").alias("stated"), *[F.col(c).alias(f"_{c}") for c in HARD])
        f = s.join(l, "record_id", "full_outer")
        out.append(row(f.where("not (split <=> stated)"), "manifest", "records differ from the manifest"))
        least = rows.groupBy("record_id").agg(*[F.min(c).alias(c) for c in HARD])
        differs = F.lit(False)
        for c in HARD:
            differs = differs | ~F.col(c).eqNullSafe(F.col(f"_{c}"))
        out.append(row(l.join(least, "record_id").where(differs), "manifest", "identities differ from the manifest"))
    total = out[0]
    for o in out[1:]:
        total = total.union(o)
    return total


def status(problems: DataFrame) -> DataFrame:
    """(status, n_problems): soft findings don't fail the gate."""
    return problems.where("check <> 'soft'").agg(F.count_if(F.col("n") > 0).alias("n_problems")).select(F.when(F.col("n_problems") == 0, "PASS").otherwise("FAIL").alias("status"), "n_problems")


def examples(rows: DataFrame, split: DataFrame, kind: str, most: int = 5, members: int = 6) -> DataFrame:
    """(value, n_records, members): the first ``most`` values of an identity that cross splits, each with its first members as ip/module@split. A report, limited by what it is."""
    x = rows.where(F.col(kind) != "").select(F.col(kind).alias("value"), "record_id", F.concat_ws("/", "ip", "module").alias("m")).join(split.select("record_id", "split").distinct(), "record_id")
    cross = x.groupBy("value").agg(F.min("split").alias("lo"), F.max("split").alias("hi"), F.count("*").alias("n_records")).where("lo <> hi").orderBy("value").limit(most).select("value", "n_records")
    y = x.join(F.broadcast(cross), "value").withColumn("k", F.row_number().over(Window.partitionBy("value").orderBy("split", "m", "record_id"))).where(F.col("k") <= members)
    return y.groupBy("value", "n_records").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("k", F.concat_ws("@", "m", "split").alias("t")))), lambda z: z["t"]), " ").alias("members"))


def fingerprint_leakage(prints: DataFrame, split: DataFrame) -> DataFrame:
    """(kind, fingerprints, shared, cross_split, dependent): per kind of fingerprint how many there are, are shared by modules, stand in several splits, and how
    many records depend on those. prints: (kind, fingerprint, ip, module); split: (ip, module, record_id, split)."""
    p = prints.where("fingerprint is not null and fingerprint <> ''").distinct()
    m = split.groupBy("ip", "module").agg(F.min("split").alias("lo"), F.max("split").alias("hi"), F.countDistinct("record_id").alias("n"))
    g = p.join(m, ["ip", "module"], "left").groupBy("kind", "fingerprint").agg(F.count("*").alias("mods"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    return g.groupBy("kind").agg(F.count("*").alias("fingerprints"), F.count_if(F.col("mods") > 1).alias("shared"), F.count_if(F.col("lo") != F.col("hi")).alias("cross_split"), F.coalesce(F.sum(F.when(F.col("lo") != F.col("hi"), F.col("n"))), F.lit(0)).alias("dependent"))


def cross_split_groups(prints: DataFrame, split: DataFrame, streams: DataFrame) -> DataFrame:
    """(group_id, n_members, splits, sources, similarity, class): groups of modules that share a fingerprint and stand in several splits, merged where their members
    are the same; the score is the largest similarity of two members whose sets of splits differ, 0 if there is none.

    prints: (kind, fingerprint, ip, module); split: (ip, module, split); streams: (ip, module, stream) of renamed tokens. Members with equal streams and splits are
    compared once; members that only copy one another across splits score 1. A member without a text counts as an empty text. A group with copies in different sets
    of splits needs no comparison; in others only pairs that could be the closest are compared (similarity.closest).
    """
    scratch = Scratch(prints.sparkSession)
    where = split.groupBy("ip", "module").agg(F.array_join(F.sort_array(F.collect_set("split")), ",").alias("splits"))
    p = prints.where("fingerprint is not null and fingerprint <> ''").select("kind", "fingerprint", "ip", "module").distinct().join(where, ["ip", "module"], "left").withColumn("m", F.concat_ws("/", "ip", "module"))
    live = p.groupBy("kind", "fingerprint").agg(F.size(F.array_distinct(F.flatten(F.collect_set(F.split("splits", ","))))).alias("k"), ident.members_digest("grp1", F.col("m")).alias("group_id")).where("k > 1").select("kind", "fingerprint", "group_id")
    g = scratch.save(p.join(live, ["kind", "fingerprint"]))
    text = streams.groupBy("ip", "module").agg(F.min("stream").alias("stream"))
    c = g.select("group_id", "ip", "module", "m", "splits").distinct().join(text, ["ip", "module"], "left").groupBy("group_id", "splits", F.coalesce("stream", F.lit("")).alias("stream")).agg(F.min("m").alias("m"))
    c = scratch.save(c)
    same = c.groupBy("group_id", "stream").agg(F.min("m").alias("lo"), F.max("m").alias("hi")).where("lo <> hi").select("group_id").distinct()
    rest = scratch.save(c.join(same, "group_id", "left_anti").select("group_id", F.col("m").alias("name"), F.col("splits").alias("mark"), F.col("stream").alias("text")))
    score = similarity.closest_by_group(rest, spread_parts(prints.sparkSession)).select("group_id", F.round("similarity", 6).alias("similarity")).union(same.select("group_id", F.lit(1.0)))
    about = g.groupBy("group_id").agg(F.countDistinct("m").alias("n_members"), F.array_join(F.sort_array(F.array_distinct(F.flatten(F.collect_set(F.split("splits", ","))))), ",").alias("splits"), F.array_join(F.sort_array(F.collect_set("kind")), ",").alias("sources"))
    j = about.join(score, "group_id", "left").withColumn("similarity", F.coalesce("similarity", F.lit(0.0)))
    return j.select("group_id", "n_members", "splits", "sources", "similarity", similarity.similarity_class(F.col("similarity")).alias("class"))
