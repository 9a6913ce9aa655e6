"""Scans of a data tree: files, sources by ip, file lists, canonical modules, record files; as DataFrames with paths relative to the root."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text
from .tables import clean


def tree(spark: SparkSession, root: str, pattern: str = ".*") -> DataFrame:
    """(path, n_bytes, symlink) of all files below a folder whose path matches; parts that begin with a dot aren't listed. The driver lists names; contents aren't read."""
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(root.rstrip("/"))
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    top = fs.makeQualified(base).toUri().getPath()
    found, rows = fs.listFiles(base, True), []
    while found.hasNext():
        f = found.next()
        path = f.getPath().toUri().getPath()[len(top) + 1 :]
        if not any(part.startswith(".") for part in path.split("/")):
            rows.append((path, f.getLen(), f.isSymlink()))
    return spark.createDataFrame(rows, "path string, n_bytes long, symlink boolean").where(F.col("path").rlike(f"^(?:{pattern})$"))


def _quoted(s: str) -> str:
    return "".join("\\" + c if c in r"\.[]{}()*+?^$|" else c for c in s)


def contents(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """(path, text, sha256) of the files that match; text is null where it isn't UTF-8. A file is read whole."""
    base = root.rstrip("/")
    x = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(base)
    good = F.when(F.is_valid_utf8(F.col("content").cast("string")), F.col("content").cast("string"))
    return x.select(F.regexp_replace(F.regexp_replace("path", "^file:/*", "/"), "^" + _quoted(base) + "/", "").alias("path"), good.alias("text"), F.sha2("content", 256).alias("sha256"))


def ips(files: DataFrame) -> DataFrame:
    """(ip, n_sources, has_list) of a tree of sources (path): a folder with files.f or a .v or .sv below it; folders that begin with a dot, and common, are none.
    Sources that lie in the root itself make one ip named '.'."""
    top = F.when(F.col("path").contains("/"), F.regexp_extract("path", "^([^/]+)/", 1)).otherwise(F.lit("."))
    source, listed = F.col("path").rlike(r"\.s?v$"), F.col("path").rlike(r"^([^/]+/)?files\.f$")
    x = files.select(top.alias("ip"), source.alias("s"), listed.alias("l")).where("(ip = '.' or not startswith(ip, '.')) and ip <> 'common'")
    return x.groupBy("ip").agg(F.count_if("s").alias("n_sources"), F.max("l").alias("has_list")).where("n_sources > 0 or has_list")


def file_lists(lists: DataFrame) -> DataFrame:
    """(ip, ord, kind, path) of file lists (ip, text): sources, include folders (+incdir+a+b gives one row each), unsupported nested lists (-f). Comments don't count."""
    lines = lists.select("ip", F.posexplode(F.split(F.regexp_replace("text", r"(?m)(//|#).*$", ""), r"\s+")).alias("ord", "w")).where("w <> ''")
    inc = lines.where("startswith(w, '+incdir+')").select("ip", "ord", F.explode(F.split(F.expr("substr(w, 9)"), r"\+")).alias("path")).where("path <> ''").select("ip", "ord", F.lit("incdir").alias("kind"), "path")
    w = Window.partitionBy("ip").orderBy("ord")
    rest = lines.withColumn("before", F.lag("w").over(w)).where("not startswith(w, '+')")
    nested = rest.where("before in ('-f', '-F')").select("ip", "ord", F.lit("unsupported").alias("kind"), F.col("w").alias("path"))
    plain = rest.where("not coalesce(before in ('-f', '-F'), false) and not startswith(w, '-')").select("ip", "ord", F.lit("source").alias("kind"), F.col("w").alias("path"))
    return plain.union(inc).union(nested)


def canonical_modules(files: DataFrame) -> DataFrame:
    """(ip, module, path, canonical): <ip>/modules/<module>.yaml is canonical, every other .yaml isn't (and names no module)."""
    x = files.where(F.col("path").rlike(r"\.ya?ml$"))
    fits = F.col("path").rlike(r"^[^/]+/modules/[^/]+\.yaml$")
    return x.select(F.regexp_extract("path", "^([^/]+)/", 1).alias("ip"), F.when(fits, F.regexp_extract("path", r"([^/]+)\.yaml$", 1)).alias("module"), "path", fits.alias("canonical"))


def record_lines(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """(split, line_no, line) of line files by split, from 1. Lines are numbered inside their read block and by the blocks before it, so no task holds a file."""
    out = None
    for split, path in paths.items():
        x = spark.read.text(path).select(F.lit(split).alias("split"), F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("id"), F.col("value").alias("line"))
        out = x if out is None else out.union(x)
    size = out.groupBy("split", "f", "b").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    before = size.withColumn("before", F.coalesce(F.sum("n").over(Window.partitionBy("split", "f").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("split", "f", "b", "first", "before")
    return out.join(F.broadcast(before), ["split", "f", "b"]).select("split", (F.col("before") + F.col("id") - F.col("first") + 1).alias("line_no"), "line")


def verified(expected: DataFrame, found: DataFrame) -> DataFrame:
    """(path, status, text) of files that are expected with a digest: current, differs or missing; only current ones have their text."""
    j = expected.select("path", F.col("sha256").alias("want")).join(found.select("path", "text", "sha256"), "path", "left")
    status = F.when(F.col("sha256").isNull(), "missing").when(F.col("sha256") != F.col("want"), "differs").otherwise("current")
    return j.select("path", status.alias("status"), F.when(status == "current", F.col("text")).alias("text"))


def bundles(layers: dict[str, DataFrame], versions: dict[str, int]) -> DataFrame:
    """Modules with the documents of all layers, and what is wrong with the others. layers: name -> (ip, module, version, sha256, source_sha256).

    (ip, module, problem): problem is null for a whole bundle: every layer there, of the version required, made from one source.
    """
    base = None
    for n, df in layers.items():
        x = df.select(clean(F.col("ip")).alias("ip"), clean(F.col("module")).alias("module"), F.col("version").alias(f"v_{n}"), F.col("source_sha256").alias(f"s_{n}")).distinct()
        base = x if base is None else base.join(x, ["ip", "module"], "full_outer")
    problem: Column = F.lit(None).cast("string")
    for n in layers:
        problem = F.coalesce(problem, F.when(F.col(f"v_{n}").isNull(), f"{n} missing").when(F.col(f"v_{n}") != versions[n], f"{n} has another version"))
    first = next(iter(layers))
    for n in layers:
        problem = F.coalesce(problem, F.when(~F.col(f"s_{n}").eqNullSafe(F.col(f"s_{first}")), f"{n} was made from another source"))
    return base.select("ip", "module", problem.alias("problem"))


def without_locations(values: DataFrame, keys: tuple[str, ...] = ("node_id", "source_file", "buffer", "offset", "line", "column", "is_top", "identity_version")) -> DataFrame:
    """values (key, value: JSON) with the members that tell a place dropped at every depth, as canonical JSON; null where it can't be read."""
    import json

    import pyarrow as pa

    gone = frozenset(keys)

    def strip(x):
        if isinstance(x, dict):
            return {k: strip(v) for k, v in x.items() if k not in gone}
        return [strip(v) for v in x] if isinstance(x, list) else x

    def run(batches):
        for b in batches:
            out = []
            for v in b.column("value").to_pylist():
                try:
                    out.append(json.dumps(strip(json.loads(v)), sort_keys=True, separators=(",", ":"), ensure_ascii=False))
                except (TypeError, ValueError):
                    out.append(None)
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.array(out, pa.string())], names=["key", "value"])

    return values.select(F.col("key").cast("string").alias("key"), "value").mapInArrow(run, "key string, value string")


def shape_problems(lines: DataFrame, spec: dict) -> DataFrame:
    """(split, line_no, problem): lines of JSON whose keys or types differ from ``spec``, at every level; never fails on a line. spec: nested objects; "string", "int",
    "bool", "number", "any"; a list of one spec; a trailing ? allows null. A bool is no int. A line has its first problems only, one for each place."""
    import json

    import pyarrow as pa

    def check(v, want, at: str):
        if isinstance(want, str) and want.endswith("?"):
            if v is None:
                return
            want = want[:-1]
        if isinstance(want, dict):
            if not isinstance(v, dict):
                yield f"{at}: not an object"
                return
            for k in sorted(set(want) - set(v)):
                yield f"{at}.{k}: missing"
            for k in sorted(set(v) - set(want)):
                yield f"{at}.{k}: not expected"
            for k in sorted(set(v) & set(want)):
                yield from check(v[k], want[k], f"{at}.{k}")
        elif isinstance(want, list):
            if not isinstance(v, list):
                yield f"{at}: not a list"
                return
            for i, x in enumerate(v):
                yield from check(x, want[0], f"{at}[{i}]")
        elif want != "any":
            fits = {"string": isinstance(v, str), "bool": isinstance(v, bool), "int": isinstance(v, int) and not isinstance(v, bool), "number": isinstance(v, (int, float)) and not isinstance(v, bool)}[want]
            if not fits:
                yield f"{at}: not a {want}"

    def run(batches):
        for b in batches:
            rows = []
            for s, n, line in zip(*(b.column(c).to_pylist() for c in ("split", "line_no", "line"))):
                try:
                    rows += [(s, n, p) for p in check(json.loads(line), spec, "$")]
                except (TypeError, ValueError, RecursionError):
                    rows.append((s, n, "$: not JSON"))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.string())], names=["split", "line_no", "problem"])

    return lines.select("split", F.col("line_no").cast("long").alias("line_no"), "line").mapInArrow(run, "split string, line_no long, problem string")


def sliced(texts: DataFrame) -> DataFrame:
    """texts (key, name, text) with ``slice``: the original text, comments and all, of the one module of that name, from module to endmodule, and ``problem`` where
    there isn't exactly one. Comments and strings hide what stands in them."""
    import re

    import pyarrow as pa

    noise = re.compile(r'"(?:\\.|[^"\\\n])*"|//[^\n]*|/\*.*?(?:\*/|\Z)', re.S)

    def cut(name: str | None, t: str | None) -> tuple[str | None, str | None]:
        if name is None or t is None:
            return None, "nothing to slice"
        bare = noise.sub(lambda m: re.sub(r"[^\n]", " ", m.group()), t)
        starts = [m.start() for m in re.finditer(r"\bmodule\s+" + re.escape(name) + r"\b", bare)]
        if len(starts) != 1:
            return None, f"{len(starts)} declarations"
        end = re.search(r"\bendmodule\b", bare[starts[0] :])
        return (t[starts[0] : starts[0] + end.end()], None) if end else (None, "no endmodule")

    def run(batches):
        for b in batches:
            got = [cut(n, t) for n, t in zip(b.column("name").to_pylist(), b.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("key"), b.column("name"), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.string())], names=["key", "name", "slice", "problem"])

    return texts.select(F.col("key").cast("string").alias("key"), "name", "text").mapInArrow(run, "key string, name string, slice string, problem string")


def absolute_path_lines(contents_: DataFrame) -> DataFrame:
    """(path, line, n) of lines that hold an absolute path of a host."""
    x = contents_.where("text is not null").select("path", F.posexplode(F.split("text", "\n", -1)).alias("n", "l"))
    return x.where(F.col("l").rlike(text.ABSOLUTE)).select("path", (F.col("n") + 1).alias("n"), F.col("l").alias("line"))
