"""Queries of problems 1, 3, 6, 7 and 8, with SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources.tables import clean, table
from . import cross_split as x
from . import eval_leaks as lk
from . import grouped_splits as g
from . import mixing
from . import text_quality as q


def _groups(s, d):
    return g.record_groups(table(s, d, "record_identity"), table(s, d, "validator"))


def p1_found(s, d):
    return g.tied_records(_groups(s, d))


def p1_splits(s, d):
    from ..sources.tables import Scratch

    return g.grouped_splits(table(s, d, "record_identity"), Scratch(s).save(_groups(s, d)))


def p1_report(s, d):
    """Records and shares per ip and split."""
    ids = table(s, d, "record_identity").select("record_id", clean(F.col("ip")).alias("ip")).groupBy("record_id").agg(F.min("ip").alias("ip"))
    n = p1_splits(s, d).join(ids, "record_id").groupBy("ip", "split").agg(F.count("*").alias("n_records"))
    tot = n.groupBy("ip").agg(F.sum("n_records").alias("all"))
    return n.join(tot, "ip").select("ip", "split", "n_records", F.round(F.col("n_records") / F.col("all"), 6).alias("share"))


def p3_found(s, d):
    return x.CrossSplit(table(s, d, "dataset_records")).pairs()


def p3_classes(s, d):
    return x.CrossSplit(table(s, d, "dataset_records")).membership()


def p3_class_pairs(s, d):
    return x.CrossSplit(table(s, d, "dataset_records")).class_pairs()


def p3_coverage(s, d):
    return x.CrossSplit(table(s, d, "dataset_records")).coverage()


def p3_report(s, d):
    return x.overlap_report(table(s, d, "dataset_records"), table(s, d, "validator"))


def _p6(s, d):
    return table(s, d, "documents"), table(s, d, "eval_items")


def p6_found(s, d):
    return lk.eval_leaks(*_p6(s, d)).select("doc_id", "item_id").distinct()


def p6_passages(s, d):
    return lk.eval_leaks(*_p6(s, d))


def p6_report(s, d):
    return lk.leak_report(*_p6(s, d))


def p7_mix(s, d):
    return mixing.Mix(table(s, d, "documents"), table(s, d, "mix_weights")).records()


def p7_report(s, d):
    return mixing.Mix(table(s, d, "documents"), table(s, d, "mix_weights")).report()


def p8_found(s, d):
    return q.Quality(table(s, d, "documents")).found()


def p8_stats(s, d):
    return q.Quality(table(s, d, "documents")).table()


QUERIES = {"p8_found": p8_found, "p8_stats": p8_stats, "p6_found": p6_found, "p6_passages": p6_passages, "p6_report": p6_report, "p7_mix": p7_mix, "p7_report": p7_report, "p3_found": p3_found, "p3_classes": p3_classes, "p3_class_pairs": p3_class_pairs, "p3_coverage": p3_coverage, "p3_report": p3_report, "p1_found": p1_found, "p1_splits": p1_splits, "p1_report": p1_report}

_B = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_PRESENT = "SELECT DISTINCT record_id, '{0}' AS kind, trim({0}, " + _B + ") AS value FROM record_identity WHERE {0} IS NOT NULL AND NOT regexp_full_match(trim({0}, " + _B + "), '([^:]*:)?0*')"
SQL = {
    "p1_found": f"""WITH RECURSIVE
md AS (SELECT DISTINCT record_id, trim(ip, {_B}) || '/' || trim(module_name, {_B}) AS module FROM record_identity WHERE trim(ip, {_B}) <> '' AND trim(module_name, {_B}) <> ''),
en AS (SELECT row_number() OVER () AS k, x.modules AS modules FROM (SELECT unnest(cross_split_fingerprints) AS x FROM validator) WHERE x.modules IS NOT NULL),
em AS (SELECT k, unnest(modules) AS m FROM en),
ek AS (SELECT DISTINCT k, trim(split_part(m, '/', 1), {_B}) || '/' || trim(substr(m, strpos(m, '/') + 1), {_B}) AS module FROM em WHERE m IS NOT NULL),
held AS ({" UNION ALL ".join(_PRESENT.format(c) for c in g.IDENTITIES)} UNION ALL SELECT record_id, 'module', module FROM md UNION ALL SELECT record_id, 'entry', CAST(k AS VARCHAR) FROM ek JOIN md USING (module)),
hub AS (SELECT kind, value, min(record_id) AS hub FROM held GROUP BY ALL),
star AS (SELECT DISTINCT record_id AS a, hub AS b FROM held JOIN hub USING (kind, value) WHERE record_id <> hub),
edge AS (SELECT a, b FROM star UNION SELECT b, a FROM star),
reach AS (SELECT a AS record_id, a AS other FROM edge UNION SELECT r.record_id, e.b FROM reach r JOIN edge e ON e.a = r.other)
SELECT record_id, min(other) AS group_id FROM reach GROUP BY record_id""",
}
