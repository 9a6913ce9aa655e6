"""Gates as problem rows: keys, vocabularies, freshness, versions, manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, *key: str) -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def orphans(child: DataFrame, parent: DataFrame, on: dict[str, str], name: str) -> DataFrame:
    """(relation, n_rows): rows of child without a parent; null keys are no references."""
    c = child.where(" and ".join(f"{k} is not null" for k in on))
    cond = F.lit(True)
    p = parent.select(*[F.col(v).alias("_" + v) for v in on.values()]).distinct()
    for k, v in on.items():
        cond = cond & (F.col(k) == F.col("_" + v))
    return c.join(p, cond, "left_anti").agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("relation"), "n_rows")


def outside(df: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    """(column_name, value, n): values outside a vocabulary; null is outside none."""
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(allowed)).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n")).select(F.lit(column).alias("column_name"), "value", "n")


def artifact_state(expected_at: Column, observed_at: Column) -> Column:
    """CURRENT, STALE (made before what it depends on), MISSING, ORPHAN."""
    return F.when(observed_at.isNull(), "MISSING").when(expected_at.isNull(), "ORPHAN").when(observed_at < expected_at, "STALE").otherwise("CURRENT")


def remediation(state: Column) -> Column:
    return F.when(state == "CURRENT", "NONE").when(state.isin("STALE", "MISSING"), "REGENERATE").otherwise("QUARANTINE")


def manifest(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """(table_name, n_rows, n_keys) per table; one aggregate each, no row leaves the executors."""
    out = None
    for name, (df, key) in tables.items():
        row = df.select(*key).groupBy(*key).agg(F.count("*").alias("c")).agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n_rows"), F.count("*").alias("n_keys")).select(F.lit(name).alias("table_name"), "n_rows", "n_keys")
        out = row if out is None else out.union(row)
    return out


def version_mismatches(df: DataFrame, versions: str, required: dict[str, str]) -> DataFrame:
    """(name, required, stated, n): rows whose map states another version than required, or none (null)."""
    need = F.explode(F.create_map(*[x for k, v in required.items() for x in (F.lit(k), F.lit(v))])).alias("name", "required")
    r = df.select(versions, need).select("name", "required", F.element_at(F.col(versions), F.col("name")).alias("stated"))
    return r.where(~F.col("stated").eqNullSafe(F.col("required"))).groupBy("name", "required", "stated").agg(F.count("*").alias("n"))


def tally(df: DataFrame, key: str, checks: dict[str, Column]) -> DataFrame:
    """(problem, n, n_checked): keys for which a check is true, one row per check; a repeated key counts once."""
    rows = df.select(key, F.explode(F.array(*[F.struct(F.lit(p).alias("problem"), F.coalesce(c, F.lit(False)).alias("bad")) for p, c in checks.items()])).alias("x")).select(key, "x.*")
    return rows.groupBy("problem", key).agg(F.max("bad").alias("bad")).groupBy("problem").agg(F.count_if("bad").alias("n"), F.count("*").alias("n_checked"))


#: States of artifacts and kinds that a pipeline makes again (fixed values).
STATES = ("CURRENT", "STALE", "ORPHAN", "HISTORICAL", "UNMANAGED")
PIPELINE_KINDS = ("normalized_ir", "semantic_ir", "behavior", "structural", "fsm", "manifest", "dataset", "report")


def artifact_classes(observed: DataFrame, expected: DataFrame, historical: tuple[str, ...] = (), managed: tuple[str, ...] = ("",)) -> DataFrame:
    """(path, kind, state, reason, action): every artifact by an ordered list of decisions.

    observed: (path, kind, ip, module, sha256, source_sha256, symlink); expected: (path, sha256, ip, module, source_sha256) of what the modules there are should
    have. HISTORICAL: under a historical prefix; UNMANAGED: a link, or no kind; ORPHAN: its module isn't expected at all, or the path isn't; STALE: made from
    another source, or other bytes than expected; CURRENT else. Expected paths that aren't there are STALE with reason missing.
    """
    e = expected.select("path", F.col("sha256").alias("want"), F.col("source_sha256").alias("want_source"), F.lit(True).alias("planned")).distinct()
    mods = expected.select("ip", "module").where("ip is not null and module is not null").distinct().withColumn("alive", F.lit(True))
    j = observed.join(e, "path", "full_outer").join(mods, ["ip", "module"], "left")
    old = F.lit(False)
    for p in historical:
        old = old | F.col("path").startswith(p)
    say = lambda state, reason: F.struct(F.lit(state).alias("state"), F.lit(reason).cast("string").alias("reason"))
    decision = (
        F.when(F.col("sha256").isNull(), say("STALE", "missing"))
        .when(old, say("HISTORICAL", "kept"))
        .when(F.coalesce("symlink", F.lit(False)), say("UNMANAGED", "symlink"))
        .when(F.col("kind").isNull(), say("UNMANAGED", "unknown kind"))
        .when(F.col("module").isNotNull() & F.col("alive").isNull(), say("ORPHAN", "module is gone"))
        .when(F.col("planned").isNull(), say("ORPHAN", "nothing expects it"))
        .when(F.col("want_source").isNotNull() & ~F.col("source_sha256").eqNullSafe(F.col("want_source")), say("STALE", "source changed"))
        .when(F.col("want").isNotNull() & (F.col("sha256") != F.col("want")), say("STALE", "content differs"))
        .otherwise(say("CURRENT", None))
    )
    cleanable = F.lit(False)
    for p in managed:
        cleanable = cleanable | F.col("path").startswith(p)
    x = j.select("path", "kind", F.coalesce("symlink", F.lit(False)).alias("symlink"), decision.alias("d")).select("path", "kind", "symlink", "d.state", "d.reason")
    action = F.when(F.col("state").isin("CURRENT", "HISTORICAL"), "NONE").when(F.col("symlink"), "MANUAL").when(~cleanable, "REGENERATE").when(F.col("state") == "UNMANAGED", "QUARANTINE").when(F.col("kind").isin(*PIPELINE_KINDS) | F.col("kind").isNull() | ((F.col("kind") == "prompt") & (F.col("state") == "STALE")), "REGENERATE").otherwise("REMOVE")
    return x.select("path", "kind", "state", "reason", action.alias("action"))


def record_states(records: DataFrame, modules: DataFrame, version: int) -> DataFrame:
    """(record_id, state, reason) of dataset records against the modules there are; null state is current.

    records: (record_id, ip, module, module_id, provenance_version, source_path, source_sha256, ir_sha256); modules: (ip, module, module_id, source_path, source_sha256, ir_sha256).
    """
    m = modules.select("ip", "module", *[F.col(c).alias(f"_{c}") for c in ("module_id", "source_path", "source_sha256", "ir_sha256")]).withColumn("_there", F.lit(True))
    j = records.join(m, ["ip", "module"], "left")
    say = lambda state, reason: F.struct(F.lit(state).alias("state"), F.lit(reason).alias("reason"))
    d = (
        F.when(F.col("provenance_version").isNull(), say("STALE", "no provenance"))
        .when(F.col("provenance_version") != version, say("STALE", "obsolete provenance version"))
        .when(F.col("_there").isNull(), say("ORPHAN", "module isn't canonical"))
        .when(~F.col("module_id").eqNullSafe(F.col("_module_id")), say("STALE", "module identity invalid"))
        .when(F.col("source_path").isNull() | F.col("source_path").startswith("/"), say("STALE", "source path missing or not portable"))
        .when(~F.col("source_sha256").eqNullSafe(F.col("_source_sha256")) | (F.col("source_path") != F.col("_source_path")), say("STALE", "source identity isn't current"))
        .when(F.col("ir_sha256").isNull(), say("STALE", "IR reference missing"))
        .when(F.col("ir_sha256") != F.col("_ir_sha256"), say("STALE", "IR isn't current"))
    )
    return j.select("record_id", d.alias("d")).select("record_id", "d.state", "d.reason")


def worst_state(states: DataFrame, *by: str) -> DataFrame:
    """(by..., state): ORPHAN if any record is, else STALE if any is, else CURRENT."""
    return states.groupBy(*by).agg(F.when(F.max(F.coalesce(F.col("state") == "ORPHAN", F.lit(False))), "ORPHAN").when(F.max(F.coalesce(F.col("state") == "STALE", F.lit(False))), "STALE").otherwise("CURRENT").alias("state"))


def compatibility(required: dict[str, str], declared: DataFrame, found: DataFrame, sidecars: DataFrame | None = None) -> DataFrame:
    """(place, key, required, stated): versions that differ from those required, what layers declare, a manifest records and side files state; missing is null.
    declared, found: (key, version); sidecars: (path, versions map)."""
    spark = declared.sparkSession
    need = spark.createDataFrame(list(required.items()), "key string, required string")
    out = None
    for place, df in (("declared", declared), ("manifest", found)):
        x = need.join(df.select("key", F.col("version").alias("stated")), "key", "full_outer").where("not (required <=> stated)").select(F.lit(place).alias("place"), "key", "required", "stated")
        out = x if out is None else out.union(x)
    if sidecars is not None:
        x = sidecars.join(F.broadcast(need)).select(F.col("path").alias("place"), "key", "required", F.try_element_at("versions", F.col("key")).alias("stated"))  # as many rows as versions
        out = out.union(x.where("not (required <=> stated)"))
    return out


def provenance_manifest(modules: DataFrame, sources: DataFrame, records: DataFrame) -> DataFrame:
    """One row per module: its id, its sources with digests, its IR, its records, and whether it is complete. modules: (ip, module, module_id, ir_path, ir_sha256);
    sources: (ip, module, path, sha256); records: (ip, module, record_id)."""
    s = sources.groupBy("ip", "module").agg(F.sort_array(F.collect_set(F.struct("path", "sha256"))).alias("sources"))
    r = records.groupBy("ip", "module").agg(F.countDistinct("record_id").alias("n_records"))
    j = modules.join(s, ["ip", "module"], "left").join(r, ["ip", "module"], "left")
    whole = F.coalesce(F.size("sources"), F.lit(0)) > 0
    return j.select("ip", "module", "module_id", "ir_path", "ir_sha256", "sources", F.coalesce("n_records", F.lit(0)).alias("n_records"), F.when(F.col("ir_sha256").isNull(), "no_ir").when(~whole, "no_source").otherwise("complete").alias("status"))


def provenance_problems(manifest: DataFrame, rebuilt: DataFrame, files: DataFrame, canonical: DataFrame, records: DataFrame) -> DataFrame:
    """(kind, n): what is wrong with a stored provenance manifest. files: (path, sha256) as they are; canonical: (ip, module); rebuilt: the manifest made again;
    records: (record_id, ip, module, module_id, source_sha256)."""
    row = lambda df, kind: df.agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n")
    from ..functions import ident

    out = [row(manifest.groupBy("ip", "module").agg(F.count("*").alias("k")).where("k > 1"), "duplicate_entries"), row(manifest.groupBy("module_id").agg(F.countDistinct("ip", "module").alias("k")).where("k > 1"), "duplicate_identities")]
    out.append(row(manifest.where("module_id is null"), "missing_identity"))
    out.append(row(manifest.where(F.col("module_id") != ident.module_id(F.col("ip"), F.col("module"))), "invalid_identity"))
    out.append(row(manifest.join(canonical, ["ip", "module"], "left_anti"), "orphan_records"))
    out.append(row(canonical.join(manifest, ["ip", "module"], "left_anti"), "missing_records"))
    src = manifest.select("ip", "module", F.explode_outer("sources").alias("s")).select("ip", "module", "s.path", "s.sha256")
    out.append(row(src.where("path is null or startswith(path, '/')"), "unresolved_sources"))
    out.append(row(src.where("path is not null and not coalesce(sha256 rlike '^[0-9a-f]{64}$', false)"), "invalid_hashes"))
    seen = src.where("path is not null").join(files.select("path", F.col("sha256").alias("now")), "path", "left")
    out.append(row(seen.where("now is null and not startswith(path, '/')"), "missing_sources"))
    out.append(row(seen.where("now is not null and now <> sha256"), "incorrect_hashes"))
    ir = manifest.join(files.select(F.col("path").alias("ir_path"), F.col("sha256").alias("now")), "ir_path", "left")
    out.append(row(ir.where("now is null or not (now <=> ir_sha256)"), "invalid_ir_refs"))
    r = records.join(manifest.select("ip", "module", F.col("module_id").alias("mid"), F.expr("transform(sources, s -> s.sha256)").alias("digests")), ["ip", "module"], "left")
    out.append(row(r.where("mid is null or not (module_id <=> mid) or not coalesce(array_contains(digests, source_sha256), false)"), "untraceable_records"))
    out.append(row(manifest.where("status <> 'complete'"), "incomplete"))
    cols = ["ip", "module", "module_id", "ir_sha256", "n_records", "status"]
    out.append(row(manifest.select(*cols).exceptAll(rebuilt.select(*cols)).union(rebuilt.select(*cols).exceptAll(manifest.select(*cols))), "nondeterministic"))
    total = out[0]
    for o in out[1:]:
        total = total.union(o)
    return total


def materialization(listed: DataFrame, present: DataFrame, includes: DataFrame, external: DataFrame, exclusions: DataFrame) -> DataFrame:
    """(problem, ip, path): what keeps a corpus from being laid out. listed, present, exclusions: (ip, path); includes: (ip, path, name, target); external: (ip, name)."""
    say = lambda df, p, c="path": df.select(F.lit(p).alias("problem"), "ip", F.col(c).alias("path"))
    out = say(listed.join(present, ["ip", "path"], "left_anti"), "listed file missing")
    lost = includes.where("target is null").join(external, ["ip", "name"], "left_anti")
    out = out.union(say(lost, "include unresolved", "name"))
    outside = includes.where("target is not null").select("ip", F.col("target").alias("path")).distinct().join(listed, ["ip", "path"], "left_anti")
    out = out.union(say(outside, "include resolves to a file not listed"))
    out = out.union(say(exclusions.join(present, ["ip", "path"], "left_anti"), "exclusion is stale"))
    return out.union(say(external.join(includes.select("ip", "name"), ["ip", "name"], "left_anti"), "external include unused", "name"))


def rederived(stored: DataFrame, again: DataFrame) -> DataFrame:
    """(side, n): rows that are stored and not derived again, and the other way round; repeats count."""
    cols = stored.columns
    a, b = stored.select(*cols), again.select(*cols)
    return a.exceptAll(b).agg(F.count("*").alias("n")).select(F.lit("stored_only").alias("side"), "n").union(b.exceptAll(a).agg(F.count("*").alias("n")).select(F.lit("derived_only"), "n"))


def authorised(gate_status: DataFrame, near_groups: DataFrame) -> DataFrame:
    """(authorised): whether records may be built: the gate passed and no near-duplicate group is left."""
    n = near_groups.agg(F.count("*").alias("n"))
    return gate_status.select("status").limit(1).join(n).select(((F.col("status") == "PASS") & (F.col("n") == 0)).alias("authorised"))


def inside(df: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    """(column_name, n_inside, n_outside, n_absent): values of a column against a vocabulary."""
    c = F.col(column)
    return df.agg(F.count_if(c.isin(allowed)).alias("n_inside"), F.count_if(~c.isin(allowed)).alias("n_outside"), F.count_if(c.isNull()).alias("n_absent")).select(F.lit(column).alias("column_name"), "n_inside", "n_outside", "n_absent")


def version_counts(df: DataFrame, versions: str, required: dict[str, str]) -> DataFrame:
    """(name, required, n, n_mismatched): rows whose map states another version than required, or none, beside all rows."""
    need = F.explode(F.create_map(*[x for k, v in required.items() for x in (F.lit(k), F.lit(v))])).alias("name", "required")
    r = df.select(versions, need).select("name", "required", F.try_element_at(F.col(versions), F.col("name")).alias("stated"))
    return r.groupBy("name", "required").agg(F.count("*").alias("n"), F.count_if(~F.col("stated").eqNullSafe(F.col("required"))).alias("n_mismatched"))
