"""Table access and the shared scratch space every iterative operator writes to."""

from __future__ import annotations

import atexit
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: What counts as a blank around a name (fixed values).
BLANKS = " \t\n\r\x0b\x0c   "

_registered: set[str] = set()
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, wherever they start: the driver serves it to the executors, once per application."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        _shipped.add(app)
        package = Path(__file__).resolve().parents[1]
        if package.is_dir():  # else it was imported from a file that was shipped already
            target = Path(tempfile.mkdtemp(prefix="quillgate-")) / "quillgate_package.zip"
            with zipfile.ZipFile(target, "w") as z:
                for f in sorted(package.rglob("*.py")):
                    z.write(f, f.relative_to(package.parent))
            spark.sparkContext.addPyFile(str(target))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def clean(col):
    """A name without blanks around it; letter case is kept."""
    return F.trim(col, F.lit(BLANKS))


def delivered_once(df: DataFrame, *cols: str) -> DataFrame:
    """Rows without repeats; a repeat differs at most in ``ingested_at``. ``cols``: the columns kept (all others are pruned from the scan)."""
    return df.select(*cols).distinct()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session, or one of our own on a local master only."""
    base = spark.conf.get("spark.checkpoint.dir", None) or _own.get(spark.sparkContext.applicationId)
    if not base:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="quillgate-")
        _own[spark.sparkContext.applicationId] = base
    return base


_own: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """This application's folder in the shared folder, removed when Python ends."""
    root = f"{shared_dir(spark)}/quillgate-{spark.sparkContext.applicationId}"
    if root not in _registered:
        _registered.add(root)
        atexit.register(_delete, spark, root)
    return root


def _delete(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # noqa: BLE001  the session may be gone; the folder belongs to this application only
        pass


def spread_parts(spark: SparkSession) -> int:
    """As many tasks as a shuffle has or as there are cores: for work that costs far more than its few bytes suggest, so small tables mustn't end up in one task."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Tables written to the shared folder. They cut lineage like checkpoint() and survive lost executors; ``drop`` frees what a later table replaced.

    tidy: the shuffle files of a write are removed with its end; else they stay until the driver happens to collect its garbage.
    """

    def __init__(self, spark: SparkSession, *, tidy: bool = False):
        ship(spark)
        self.spark, self.tidy = spark, tidy
        self.saved: dict[int, tuple[str, DataFrame]] = {}  # holds the frames, so an id means one frame only

    def save(self, df: DataFrame, *, coalesce: int | None = None, by: str | None = None) -> DataFrame:
        """The table, written; ``by``: its last column, each value of which gets a folder of its own."""
        path = f"{scratch_root(self.spark)}/{uuid.uuid4().hex}"
        before = self.spark.conf.get(_TIDY, None)
        if self.tidy:
            self.spark.conf.set(_TIDY, "true")
        try:
            (df.coalesce(coalesce) if coalesce else df).write.parquet(path, partitionBy=by)
        finally:
            if self.tidy:
                self.spark.conf.set(_TIDY, before) if before is not None else self.spark.conf.unset(_TIDY)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.saved[id(out)] = path, out
        return out

    def counted(self, df: DataFrame, *, by: str | None = None, **sums) -> tuple[DataFrame, dict]:
        """The saved table and, from the same pass, its row count ``n`` and the aggregates named in ``sums``."""
        seen = Observation()
        out = self.save(df.observe(seen, F.count(F.lit(1)).alias("n"), *[c.alias(k) for k, c in sums.items()]), by=by)
        return out, seen.get

    def drop(self, *frames: DataFrame | None) -> None:
        for f in frames:
            if f is not None and (held := self.saved.pop(id(f), None)):
                _delete(self.spark, held[0])
