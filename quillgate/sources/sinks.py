"""Sinks: canonical JSON lines, CSV, staged publishing; and the tolerant reader of such lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def canonical_line(df: DataFrame) -> Column:
    """A row as JSON: keys in order at every level of structs and maps, nulls kept, no blanks."""

    def ordered(col: Column, kind: T.DataType) -> Column:
        if isinstance(kind, T.StructType):
            return F.when(col.isNotNull(), F.struct(*[ordered(col[f.name], f.dataType).alias(f.name) for f in sorted(kind.fields, key=lambda f: f.name)]))
        if isinstance(kind, T.ArrayType):
            return F.transform(col, lambda x: ordered(x, kind.elementType))
        if isinstance(kind, T.MapType):
            return F.map_from_entries(F.array_sort(F.map_entries(col)))
        return col

    return F.to_json(F.struct(*[ordered(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in sorted(df.schema.fields, key=lambda f: f.name)]), {"ignoreNullFields": "false"})


def write_lines(df: DataFrame, path: str) -> None:
    df.select(canonical_line(df).alias("value")).write.mode("overwrite").text(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Lines with the schema given; a line that can't be read, or has other top-level keys than the schema, has its text in ``_corrupt`` and nulls elsewhere."""
    raw = spark.read.text(path)
    full = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    got = raw.select("value", F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}).alias("r"), F.json_object_keys("value").alias("k"))
    fits = F.col("r._corrupt").isNull() & (F.sort_array("k") == F.array(*[F.lit(n) for n in sorted(schema.fieldNames())]))
    ok = F.coalesce(fits, F.lit(False))
    return got.select(*[F.when(ok, F.col(f"r.{n}")).alias(n) for n in schema.fieldNames()], F.when(~ok, F.col("value")).alias("_corrupt"))


def publish(df: DataFrame, path: str) -> int:
    """Write beside ``path``, read back and compare the count, then swap the folders; returns the rows. A crash leaves the old or the new folder whole, and the
    next call first puts an old folder back that was moved away without its successor arriving."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    P = jvm.org.apache.hadoop.fs.Path
    now, new, old = P(path), P(path + ".staged"), P(path + ".previous")
    fs = now.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(now) and fs.exists(old):
        fs.rename(old, now)
    fs.delete(new, True)
    df.write.parquet(path + ".staged")
    n = spark.read.parquet(path + ".staged").count()
    if n != df.count():
        raise RuntimeError(f"{path}: {n} staged rows differ from the result's; nothing was published")
    fs.delete(old, True)
    if fs.exists(now):
        fs.rename(now, old)
    fs.rename(new, now)
    fs.delete(old, True)
    return n


def write_json(spark: SparkSession, value, path: str) -> bool:
    """An object as one JSON file, indented by 2 with a line end; written only if its bytes differ from what is there. Returns whether it was written."""
    import json

    data = bytearray((json.dumps(value, indent=2, ensure_ascii=False) + "\n").encode())
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(p):
        row = spark.read.format("binaryFile").load(path).select("content").first()
        if row is not None and bytes(row["content"]) == bytes(data):
            return False
    out = fs.create(p, True)
    out.write(data)
    out.close()
    return True


def write_dataset(records: DataFrame, split: DataFrame, changes: DataFrame, folder: str) -> dict[str, int]:
    """The six line files of a dataset (train, validation, test, mixed, new, old) as folders of canonical lines, ordered by record_id, and how many each has.

    records: any columns with record_id; split: (record_id, split); changes: (record_id, change). mixed is all records; new are new and modified ones, old unchanged.
    """
    j = records.join(split, "record_id").join(changes, "record_id", "left")
    parts = {k: j.where(F.col("split") == k) for k in ("train", "validation", "test")} | {"mixed": j, "new": j.where("change in ('new', 'modified')"), "old": j.where("change = 'unchanged'")}
    out = {}
    for name, df in parts.items():
        df = df.drop("split", "change").orderBy("record_id")
        df.select(canonical_line(df).alias("value")).write.mode("overwrite").text(f"{folder}/{name}.jsonl")
        out[name] = records.sparkSession.read.text(f"{folder}/{name}.jsonl").count()
    return out


def copy_missing(source: DataFrame, target: str, key: list[str]) -> int:
    """Append to a table of ``target`` the rows whose key isn't there; what is there is never overwritten. Returns the rows added."""
    spark = source.sparkSession
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(target)
    there = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
    new = source.dropDuplicates(key)
    if there:
        new = new.join(spark.read.parquet(target).select(*key), key, "left_anti")
    from .tables import Scratch

    new, seen = Scratch(spark).counted(new)
    if seen["n"] or not there:
        new.write.mode("append").parquet(target)
    return seen["n"]


def quarantine(spark: SparkSession, root: str, paths: list[str], apply: bool = False) -> list[tuple[str, str]]:
    """Move files below ``root`` to root/quarantine; (path, what happens or happened) of each. Paths that are absolute, climb out or don't exist are refused; nothing is
    moved without ``apply``."""
    jvm = spark.sparkContext._jvm
    P = jvm.org.apache.hadoop.fs.Path
    fs = P(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = []
    for path in paths:
        if path.startswith("/") or ".." in path.split("/") or not path:
            out.append((path, "refused"))
            continue
        src, dst = P(f"{root}/{path}"), P(f"{root}/quarantine/{path}")
        if not fs.exists(src):
            out.append((path, "missing"))
        elif not apply:
            out.append((path, "would move"))
        else:
            fs.mkdirs(dst.getParent())
            out.append((path, "moved" if fs.rename(src, dst) else "refused"))
    return out


def report_text(rows: DataFrame, title: str, most: int = 1000) -> str:
    """A small report as Markdown; ``most`` rows are shown and the rest counted."""
    got = rows.limit(most + 1).collect()
    lines = [f"## {title}", "", "| " + " | ".join(rows.columns) + " |", "|" + "---|" * len(rows.columns)]
    lines += ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in got[:most]]
    return "\n".join(lines + ([f"more than {most} rows"] if len(got) > most else [])) + "\n"
