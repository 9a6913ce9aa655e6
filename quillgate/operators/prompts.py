"""Prompts of modules from section rows: six sections of plain sentences, cut to a budget of bytes by a fixed order of sections, and what a prompt must keep to."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..sources.tables import Scratch

#: Sections in their order; those that are cut, first to last; the budget, the opening and the notice of a cut (fixed values).
SECTIONS = ("Module", "Clocks and resets", "Registers", "Combinational logic", "State machines", "Submodules")
CUT = ("Submodules", "Combinational logic", "Registers", "State machines")
BUDGET = 32768
NOTICE = "[truncated: {section} {emitted}/{total} records]"
NOTICE_RE = r"^\[truncated: (Submodules|Combinational logic|Registers|State machines) (\d+)/(\d+) records\]$"
PREAMBLE = "Write synthesizable Verilog/SystemVerilog RTL for the hardware module specified below. The specification describes behavior and structure, not source code."


def layout(sections: dict[str, list[str]], left: dict[str, int] | None = None) -> str:
    """The text of a prompt; ``left``: how many records of a section stay, a notice stands for the rest. Sections without records aren't named."""
    out = [PREAMBLE]
    for s in SECTIONS:
        lines = sections.get(s) or []
        if not lines:
            continue
        n = len(lines) if left is None else left.get(s, len(lines))
        out += ["", f"{s}:"] + [f"- {x}" for x in lines[:n]]
        if n < len(lines):
            out.append(NOTICE.format(section=s, emitted=n, total=len(lines)))
    return "\n".join(out) + "\n"


def within(sections: dict[str, list[str]], budget: int = BUDGET) -> tuple[str, dict[str, int]]:
    """The prompt within the budget and how many records of each section stay. While it is too long the last record of the first section of CUT that has any goes; the
    notice counts too. Module, clocks and resets are never cut, so a prompt of those alone may be longer. As a prompt only gets shorter with every record but the
    first of a section, whose notice is added, the number that stays is searched by halves."""
    left = {s: len(sections.get(s) or []) for s in SECTIONS}
    size = lambda: len(layout(sections, left).encode())
    if size() <= budget:
        return layout(sections, left), left
    for s in CUT:
        whole = left[s]
        if not whole:
            continue
        left[s] = 0
        if size() > budget:
            continue
        low, high = 0, whole - 1
        while low < high:
            left[s] = mid = (low + high + 1) // 2
            low, high = (mid, high) if size() <= budget else (low, mid - 1)
        left[s] = low
        break
    return layout(sections, left), left


def sentences(rows: DataFrame) -> DataFrame:
    """(record_id, module, section, ord, line) of section rows (read_rtl: port, process, register, assign, machine, transition, instance)."""
    bits = lambda w: F.when(w.isNull(), "unknown width").when(w == "1", "1 bit").otherwise(F.concat(w, F.lit(" bits")))
    pick = lambda kind, section, order, line: rows.where(F.col("section") == kind).select("record_id", "module", F.lit(section).alias("s"), order.cast("string").alias("ord"), line.alias("line"))
    out = pick("port", "Module", F.concat(F.when(F.col("kind") == "input", "1").otherwise("2"), "name"), F.concat("kind", F.lit(" "), "name", F.lit(", "), bits(F.col("width"))))
    clocks = rows.where("section = 'register'").select("record_id", "module", F.explode(F.array(F.concat(F.lit("clock "), "clock", F.lit(", "), "edge"), F.concat(F.lit("reset "), "reset", F.lit(", "), "kind", F.lit(", "), F.regexp_replace("context", "_", " ")))).alias("line")).where("line is not null").distinct()
    out = out.union(clocks.select("record_id", "module", F.lit("Clocks and resets"), "line", "line"))
    enables = F.array_join(F.from_json("detail", "array<string>"), ", ")
    hold = F.when(F.col("status") == "none", "").otherwise(F.concat(F.lit("; holds its value ("), "status", F.lit(")")))
    out = out.union(pick("register", "Registers", F.col("name"), F.concat("name", F.lit(", "), bits(F.col("width")), F.lit(", updates at "), "edge", F.lit(" of "), "clock", F.when(enables != "", F.concat(F.lit(" when enabled by "), enables)).otherwise(""), hold)))
    out = out.union(rows.where("section = 'assign' and kind in ('continuous', 'declaration')").select("record_id", "module", F.lit("Combinational logic"), "name", F.concat("name", F.lit(" depends on "), F.coalesce(F.nullif(F.array_join(F.array_sort(F.array_distinct(F.regexp_extract_all("value", F.lit(r"\b([A-Za-z_]\w*)\b"), F.lit(1)))), ", "), F.lit("")), F.lit("no signal")))))
    out = out.union(pick("machine", "State machines", F.col("name"), F.concat(F.lit("state register "), "name", F.lit(", "), "n", F.lit(" states, "), "value", F.lit(" encoding, status "), "status")))
    move = F.concat(F.lit("in "), F.when(F.col("value") == "*unknown", "an unknown state").otherwise(F.col("value")), F.lit(" go to "), F.when(F.col("target") == "*unknown", "an unknown state").otherwise(F.col("target")), F.coalesce(F.concat(F.lit(" when "), "context"), F.lit("")))
    out = out.union(rows.where("section = 'transition' and kind not in ('reset', 'implicit_hold') and value <> '*none'").select("record_id", "module", F.lit("State machines"), F.concat("name", F.lit(" "), F.lpad(F.coalesce(F.col("n").cast("string"), F.lit("")), 6, "0"), "value", "target"), move))
    return out.union(pick("instance", "Submodules", F.col("name"), F.concat("name", F.lit(" is an instance of "), "target"))).toDF("record_id", "module", "section", "ord", "line").where("line is not null").distinct()


def render(rows: DataFrame, budget: int = BUDGET) -> DataFrame:
    """(record_id, module, prompt, n_bytes, n_records, n_dropped): one prompt per module of the rows."""
    rows = Scratch(rows.sparkSession).save(rows)  # every section reads them
    x = sentences(rows).groupBy("record_id", "module").agg(F.sort_array(F.collect_list(F.struct("section", "ord", "line"))).alias("ls"))
    schema = pa.schema([("record_id", pa.string()), ("module", pa.string()), ("prompt", pa.string()), ("n_bytes", pa.int64()), ("n_records", pa.int64()), ("n_dropped", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r, m, ls in zip(*(b.column(c).to_pylist() for c in ("record_id", "module", "ls"))):
                sections: dict[str, list[str]] = {}
                for x in ls:
                    sections.setdefault(x["section"], []).append(x["line"])
                prompt, left = within(sections, budget)
                out.append((r, m, prompt, len(prompt.encode()), len(ls), len(ls) - sum(left.values())))
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], f.type) for k, f in enumerate(schema)], schema=schema)

    return x.mapInArrow(run, "record_id string, module string, prompt string, n_bytes long, n_records long, n_dropped long")


def faults(prompts: DataFrame, budget: int = BUDGET) -> DataFrame:
    """(record_id, module, problem) of prompts that break a rule: opening, order of sections, size, syntax of the hardware language, paths, ids; uncut texts longer than
    the budget, and notices that count wrong."""
    named = F.regexp_extract_all("prompt", F.lit("(?m)^(" + "|".join(SECTIONS) + "):$"), F.lit(1))
    want = F.filter(F.array(*[F.lit(s) for s in SECTIONS]), lambda s: F.array_contains(named, s))
    checks = {
        "opening": ~F.col("prompt").startswith(PREAMBLE), "sections": named != want, "size": F.octet_length("prompt") > budget, "syntax": F.col("prompt").rlike(text.HDL_SYNTAX), "selects": F.col("prompt").rlike(r"[A-Za-z0-9_$\]]\["),
        "paths": F.col("prompt").rlike("(?m)" + text.PROMPT_PATH), "ids": F.col("prompt").rlike(text.ID_LEAK), "parser terms": F.col("prompt").rlike(text.PARSER_NOISE),
        "notices": F.exists(F.regexp_extract_all("prompt", F.lit("(?m)" + NOTICE_RE), F.lit(0)), lambda n: F.regexp_extract(n, r" (\d+)/", 1).cast("int") >= F.regexp_extract(n, r"/(\d+) ", 1).cast("int")),
    }
    x = prompts.select("record_id", "module", F.explode(F.array(*[F.when(c, F.lit(k)) for k, c in checks.items()])).alias("problem"))
    return x.where("problem is not null")


def invented(prompts: DataFrame, again: DataFrame) -> DataFrame:
    """(record_id, module, line): lines of prompts that the sections made again don't have, notices apart: facts that nothing supports."""
    split = lambda df: df.select("record_id", "module", F.explode(F.split("prompt", "\n")).alias("line")).where(F.col("line").startswith("- ")).distinct()
    return split(prompts).join(split(again), ["record_id", "module", "line"], "left_anti")


