"""Session helpers shared by all operators: tables, stage tables and partition counts."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession

_STAGE_DIRS: list[tuple[SparkSession, str]] = []


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, wherever they were started; once per context."""
    sc = spark.sparkContext
    if getattr(sc, "_talespan_shipped", False):
        return
    package = Path(__file__).parent
    tmp = tempfile.mkdtemp(prefix="talespan-")  # the driver serves the file from here as long as it lives
    atexit.register(shutil.rmtree, tmp, True)
    copy = Path(tmp, "root", package.name)
    shutil.copytree(package, copy, ignore=shutil.ignore_patterns("__pycache__"))
    sc.addPyFile(shutil.make_archive(str(Path(tmp, package.name)), "zip", copy.parent))
    sc._talespan_shipped = True


def share_file(spark: SparkSession, path: str) -> str:
    """Send a driver's file (a vocabulary, a few MB) to the workers, once per context; they open
    it by :func:`local_file`."""
    sc = spark.sparkContext
    sent = sc.__dict__.setdefault("_talespan_files", set())
    if path not in sent and os.path.exists(path):
        sc.addFile(path)
        sent.add(path)
    return path


def local_file(path: str) -> str:
    """In a worker: where a shared file lies, else the path itself."""
    own = SparkFiles.get(os.path.basename(path))
    return own if os.path.exists(own) else path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` of a data directory."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for stage tables and checkpoints.

    A cluster names it in ``spark.checkpoint.dir``. Only where that is unset (local tests)
    is a temporary folder made and set.
    """
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if where:
        return where
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    where = "file://" + tempfile.mkdtemp(prefix="talespan-stage-")
    spark.conf.set("spark.checkpoint.dir", where)
    spark.sparkContext.setCheckpointDir(where)
    return where


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def stage_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; its files are removed when the interpreter ends."""
    path = f"{checkpoint_dir(spark)}/talespan/{name}-{uuid.uuid4().hex}"
    _STAGE_DIRS.append((spark, path))
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a parquet stage table in the shared folder and read it back.

    Cuts the lineage, so costly Python stages run once however often the result is used, and
    a lost executor re-reads files instead of recomputing. The folder is removed when the
    interpreter ends, or earlier by :func:`release`.
    """
    spark = df.sparkSession
    path = stage_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(df: DataFrame) -> None:
    """Delete the files of a stage table that nothing reads any more; other tables are left."""
    files = df.inputFiles()
    for entry in list(_STAGE_DIRS):
        name = os.path.basename(entry[1])
        if any(f"/{name}/" in f for f in files[:1]):
            _delete(*entry)
            _STAGE_DIRS.remove(entry)


@atexit.register
def _release_all() -> None:
    for spark, path in _STAGE_DIRS:
        try:
            _delete(spark, path)
        except Exception:  # the session may be gone already
            pass


def shuffle_partitions(spark: SparkSession) -> int:
    """The session's shuffle partition count, at least its parallelism."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Repartition a scan that has fewer splits than the session has cores.

    At scale a scan has far more splits than cores and is returned as it is; only small
    single-file inputs, which a CPU-heavy Python stage would run in one task, are spread.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)
