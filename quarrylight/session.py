"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from py4j.protocol import Py4JError
from pyspark.sql import SparkSession

# One BLAS thread per Python worker: parallelism comes from Spark tasks.
_SINGLE_THREADED_BLAS = ("OMP_NUM_THREADS", "OPENBLAS_NUM_THREADS", "MKL_NUM_THREADS")


def build_session(app_name: str = "quarrylight", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings these jobs are written for."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
        "spark.sql.execution.arrow.maxBytesPerBatch": "67108864",
        "spark.ui.enabled": "false",
    }
    for name in _SINGLE_THREADED_BLAS:
        defaults[f"spark.executorEnv.{name}"] = "1"
        if master and master.startswith("local"):
            os.environ.setdefault(name, "1")
    defaults.update(conf)
    for key, value in defaults.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parent
        archive = os.path.join(tempfile.mkdtemp(prefix="quarrylight-"), package.name)
        context.addPyFile(shutil.make_archive(archive, "zip", package.parent, package.name))
        _shipped.add(context.applicationId)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for cut lineage and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may
    do without, since its tasks share the driver's disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        root = os.path.join(tempfile.gettempdir(), "quarrylight-checkpoints")
        spark.conf.set("spark.checkpoint.dir", root)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to the end."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def complete_tables(spark: SparkSession, path: str) -> list[str]:
    """The names of the tables below a folder that were written to the end, in order."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return []
    names = sorted(s.getPath().getName() for s in system.listStatus(folder) if s.isDirectory())
    return [name for name in names if is_complete(spark, f"{path}/{name}")]


_scratch: set[str] = set()


def _remove(jvm, conf, path: str) -> None:
    """Delete a folder of the shared file system, if the JVM is still there."""
    try:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(conf).delete(folder, True)
    except (Py4JError, OSError):
        pass


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table below the shared folder that nothing reads any more."""
    context = spark.sparkContext
    _remove(context._jvm, context._jsc.hadoopConfiguration(), path)


# Deletes the shuffle files of a query once its result is there.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def short_lived_shuffles(spark: SparkSession) -> Iterator[None]:
    """Frames made and collected inside leave no shuffle files; others go when the driver collects garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder.

    Frames are read when they are used, so what an application has written there stays
    until the driver ends, and goes then.
    """
    context = spark.sparkContext
    base = f"{checkpoint_root(spark).rstrip('/')}/scratch-{context.applicationId}"
    if base not in _scratch:
        _scratch.add(base)
        atexit.register(_remove, context._jvm, context._jsc.hadoopConfiguration(), base)
    return f"{base}/{name}-{uuid.uuid4().hex}"
