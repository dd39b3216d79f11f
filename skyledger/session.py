"""Session settings and the shared scratch folder."""

from __future__ import annotations

import contextlib
import contextvars
import functools
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.errors import PySparkAttributeError
from pyspark.sql import DataFrame, SparkSession

#: Jobs that are submitted side by side; the cluster's slots are shared by all of them.
JOBS = 8

#: Recipes of wide tables that are built side by side. What the driver holds of each, from planning to
#: generated code, is tens of megabytes, whatever the table holds; and each fills a cluster by itself if it is large.
BUILDS = 3

#: Tables up to these sizes are broadcast: as estimated from compressed files, and as measured.
ESTIMATED_BROADCAST = "256k"
MEASURED_BROADCAST = "10m"


def tune(spark: SparkSession) -> SparkSession:
    """Runtime settings that only change how plans run.

    HotSpot never compiles a method above 8,000 bytes of bytecode. Wide parsing
    projections exceed that as one fused method, so let Spark split them instead.

    Before a run Spark knows a table by the size of its compressed files, and counts the
    columns it reads as if all were equally wide: two columns of a wide catalog that has
    little else count for a hundredth of what the driver would hold. So few joins
    are made broadcasts by that size; adaptive execution makes the others so by the
    bytes that a shuffle has measured.
    """
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", ESTIMATED_BROADCAST)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", MEASURED_BROADCAST)
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    return spark


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_writing, _lock = [0], threading.Lock()


@contextlib.contextmanager
def freeing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes that begin in here remove their shuffle files as they end.

    Otherwise the files stay until the driver happens to collect its garbage, and a run of many
    steps holds the shuffles of all of them. Only for writes, which are planned and run once; the
    setting is the session's, so it stays until the last of several writes side by side is done.
    """
    with _lock:
        _writing[0] += 1
        if _writing[0] == 1:
            _writing[1:] = [spark.conf.get(_CLEANUP, None)]
        spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        with _lock:
            _writing[0] -= 1
            if not _writing[0] and _writing[1] is None:
                spark.conf.unset(_CLEANUP)
            elif not _writing[0]:
                spark.conf.set(_CLEANUP, _writing[1])


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session or its context.

    Only a local master, which is one process, may fall back to a folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("Set spark.checkpoint.dir to a folder that all executors share")
    return _local_dir()


@functools.cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="skyledger-")


def side_by_side[T](spark: SparkSession, tasks: Iterable[Callable[[], T]], jobs: int = JOBS) -> list[T]:
    """Results of tasks that each run jobs of their own and need nothing from each other.

    Small jobs leave most of a cluster idle, and their planning takes longer than they do.
    The first error is raised once the tasks that have begun are done; the others never begin.
    """
    with ThreadPoolExecutor(jobs) as pool:
        futures = [pool.submit(contextvars.copy_context().run, inheritable_thread_target(spark)(task)) for task in tasks]
        try:
            return [future.result() for future in futures]
        except BaseException:
            pool.shutdown(wait=False, cancel_futures=True)
            raise


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    path = f"{shared_dir(spark).rstrip('/')}/skyledger/{name}-{uuid.uuid4().hex}"
    passing = _passing.get()
    if passing is not None:
        passing.append(path)
    return path


_passing: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("passing", default=None)


@contextlib.contextmanager
def passing_scratch(spark: SparkSession) -> Iterator[None]:
    """Scratch tables made in here, by tasks side by side too, are removed at the end.

    So what is made of them must be written in here. Removing goes through Hadoop's file system in
    the JVM; where there is none, they are left for the cluster's own clean-up.
    """
    paths: list[str] = []
    outer = _passing.set(paths)
    try:
        yield
    finally:
        _passing.reset(outer)
        with contextlib.suppress(PySparkAttributeError):
            jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
            for path in paths:
                place = jvm.org.apache.hadoop.fs.Path(path)
                place.getFileSystem(conf).delete(place, True)


def materialised(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write to the shared folder and read back: cuts lineage and fixes the rows.

    The files survive the loss of executors, and both readers of the result see
    the same partitions, which generated row numbers rely on.
    """
    path = scratch(df.sparkSession, name)
    with freeing_shuffles(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
