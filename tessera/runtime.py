"""Session helpers: shared scratch tables, shipping the package to executors."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_PACKAGE = Path(__file__).resolve().parent
_shipped: set[str] = set()
_local_roots: dict[str, str] = {}
_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes of rows that go to Python at once, where the session sets no bound of its own; Spark's is 64 MB.
BATCH_BYTES = 4 << 20


def ship_package(spark: SparkSession) -> None:
    """Give executors this package once a session, so that Python stages need no install there.

    Batches are held several times over on either side (vectors that double, lists of texts), so they are kept small.
    """
    if spark.conf.get(_BATCH, None) is None:
        spark.conf.set(_BATCH, BATCH_BYTES)
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    target = os.path.join(os.path.realpath(tempfile.mkdtemp()), f"{_PACKAGE.name}.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(_PACKAGE.rglob("*.py")):
            z.write(p, p.relative_to(_PACKAGE.parent))
    sc.addPyFile(target)
    _shipped.add(sc.applicationId)


def shared_root(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a temporary one only where it is unset in local mode."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if sc.applicationId not in _local_roots:
        _local_roots[sc.applicationId] = "file://" + os.path.realpath(tempfile.mkdtemp(prefix="shared-"))
    return _local_roots[sc.applicationId]


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


class Scratch:
    """Tables of one job in the shared folder. They cut lineage and survive lost executors.

    ``keep`` writes and reads back; ``drop`` removes what later steps no longer need. With
    ``free_shuffles``, the shuffle files of a table go as soon as it is written.
    """

    def __init__(self, spark: SparkSession, name: str, free_shuffles: bool = False):
        self.spark = spark
        self.free_shuffles = free_shuffles
        self.path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
        self._n = 0

    def folder(self, name: str) -> str:
        self._n += 1
        return f"{self.path}/{self._n:03d}-{name}"

    def mkdirs(self, path: str) -> str:
        fs, p = _fs(self.spark, path)
        fs.mkdirs(p)
        return path

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = self.folder(name)
        before = self.spark.conf.get(_FREE, "false")
        if self.free_shuffles:
            self.spark.conf.set(_FREE, "true")
        try:
            df.write.parquet(path)
        finally:
            if self.free_shuffles:
                self.spark.conf.set(_FREE, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *frames) -> None:
        for x in frames:
            path = x if isinstance(x, str) else getattr(x, "_scratch_path", None)
            if path:
                fs, p = _fs(self.spark, path)
                fs.delete(p, True)


def spread(df: DataFrame) -> DataFrame:
    """The rows as they are, or dealt over the session's cores if they lie in fewer partitions (a small or unsplittable input)."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
