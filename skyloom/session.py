"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def build_session(master: str = "local[*]", app: str = "skyloom", **conf: str) -> SparkSession:
    """A session with the settings the library counts on: UTC, AQE, case-sensitive names are left to the caller."""
    builder = SparkSession.builder.master(master).appName(app)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    return builder.config(map=defaults | conf).getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``. Where that is unset, a temporary one on a single machine, else RuntimeError."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        current = sc._jsc.sc().getCheckpointDir()
        if not current.isDefined() and not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = current.get() if current.isDefined() else tempfile.mkdtemp(prefix="skyloom-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def _file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path as Hadoop has it."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def read_note(spark: SparkSession, path: str) -> str | None:
    """A small text file in any of Hadoop's file systems; None if it isn't there."""
    fs, at = _file_system(spark, path)
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_note(spark: SparkSession, path: str, text: str) -> None:
    fs, at = _file_system(spark, path)
    stream = fs.create(at, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


#: Spark's setting by which a plan's shuffle files are deleted as it ends.
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What is built and run within deletes its shuffle files as it ends, not only when the driver happens to collect its garbage.

    A frame built within should run once: run again, it computes its shuffles anew.
    """
    before = spark.conf.get(FREED, None)
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREED)
        else:
            spark.conf.set(FREED, before)


class Scratch:
    """Tables written once to the shared folder, so that a lost executor costs no recomputation.

    ``keep`` writes and reads back a frame; ``drop`` deletes those that no later plan reads, ``clear`` all of them. What is left is
    deleted when the application ends.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.base = f"{scratch_root(spark)}/skyloom/{label}-{uuid.uuid4().hex}"
        self.n = 0
        fs, at = _file_system(spark, self.base)
        fs.mkdirs(at)
        fs.deleteOnExit(at)

    def keep(self, df: DataFrame, **metrics: Column) -> DataFrame:
        """``df`` as written. Its number of rows, and further aggregates asked for, are counted while writing: see ``seen``."""
        self.n += 1
        path = f"{self.base}/{self.n}"
        counted = Observation()
        with shuffles_freed(self.spark):
            df.observe(counted, F.count(F.lit(1)).alias("rows"), *[m.alias(n) for n, m in metrics.items()]).write.parquet(path)
        kept = self.spark.read.schema(df.schema).parquet(path)
        kept._scratch_path, kept._seen = path, counted.get
        return kept

    def drop(self, *frames: DataFrame) -> None:
        for df in frames:
            fs, at = _file_system(self.spark, df._scratch_path)
            fs.delete(at, True)

    def clear(self) -> None:
        fs, at = _file_system(self.spark, self.base)
        fs.delete(at, True)


def seen(kept: DataFrame, metric: str = "rows"):
    """What was counted while a kept frame was written; 0 rows means that it is empty."""
    return kept._seen[metric]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
