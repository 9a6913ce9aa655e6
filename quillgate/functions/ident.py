"""Content-derived identities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEP = "\x1f"


def digest(prefix: str, *parts: Column | str) -> Column:
    """prefix:first 16 hex digits of the SHA-256 of the parts joined by U+001F; a null part counts as empty. Strings are taken as literals."""
    cols = [F.coalesce(p if isinstance(p, Column) else F.lit(p), F.lit("")) for p in parts]
    return F.concat(F.lit(prefix + ":"), F.substring(F.sha2(F.concat_ws(SEP, *cols), 256), 1, 16))


def module_id(ip: Column, module: Column) -> Column:
    return digest("mod1", "kf-module", "v1", ip, module)


def record_id_v1(ip: Column, module: Column, task: Column, variant: Column) -> Column:
    return digest("r1", "kf-record", "v1", ip, module, task, variant)


def record_id_v2(task: Column, version: Column, module: Column) -> Column:
    return digest("r2", "kf-record", "v2", task, version.cast("string"), module)


def content_id(kind: str, content: Column) -> Column:
    """Identity of a content of one kind (source_rtl, module_body, ...); null stays null."""
    return F.when(content.isNotNull(), digest(kind[0] + "1", "kf-leakage", "v1", kind, content))


def members_digest(prefix: str, member: Column) -> Column:
    """Aggregate: identity of a set of members, whatever their order."""
    return F.concat(F.lit(prefix + ":"), F.substring(F.sha2(F.array_join(F.sort_array(F.collect_set(member)), SEP), 256), 1, 16))


def canonical_map(m: Column) -> Column:
    """A map as JSON with sorted keys."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(m))), {"ignoreNullFields": "false"})


def canonical_json(**fields: Column) -> Column:
    """A flat object as JSON with sorted keys, nulls kept."""
    return F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]), {"ignoreNullFields": "false"})
