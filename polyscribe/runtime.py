"""What a session needs: the package on its executors, and tables in the folder that driver and executors share."""

from __future__ import annotations

import gc
import re
import tempfile
import time
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()
_scratch: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once a Spark application, so that none of them has to have it installed."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    here = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="polyscribe-")) / "polyscribe_package.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(here.rglob("*.py")):
            out.write(path, Path(here.name) / path.relative_to(here))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or on a local master one of our own where it is unset."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that the driver and all executors share (master {master})")
        path = f"file://{tempfile.mkdtemp(prefix='polyscribe-shared-')}"
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def scratch_dir(spark: SparkSession) -> str:
    """This application's folder in the shared one; what is left in it goes when the driver ends."""
    root = f"{shared_dir(spark)}/polyscribe/{spark.sparkContext.applicationId}"
    if root not in _scratch:
        at, files = _file_system(spark, root)
        files.mkdirs(at)
        files.deleteOnExit(at)
        _scratch.add(root)
    return root


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: lineage ends in files that outlive executors."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._polyscribe_path = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete materialised tables that nothing lazily read any more depends on."""
    for df in frames:
        path = getattr(df, "_polyscribe_path", None)
        if path:
            at, files = _file_system(df.sparkSession, path)
            files.delete(at, True)


def forget_shuffles(spark: SparkSession) -> None:
    """Let the context's cleaner delete the shuffle files of queries that nothing refers to any more.

    They would stay on the executors' disks until the driver's heap happens to be collected. The first collection
    finds what Python has let go of since, the second what that held.
    """
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.3)
