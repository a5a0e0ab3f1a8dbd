"""Spark session defaults and tables kept between the steps of a job."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

_fallback: dict[str, str] = {}
#: By thread: the staged tables of each job that it runs.
_jobs: dict[int, list[list[str]]] = {}


def local_session(cpus: int = 8, name: str = "lateline", **settings: str) -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName(name)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.parquet.compression.codec", "zstd")
    )
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a session on one machine that names none, such as a test, gets a temporary
    folder of its own; on a cluster a missing setting is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if context.applicationId not in _fallback:
        folder = tempfile.mkdtemp(prefix="lateline-")
        context.setCheckpointDir(folder)
        _fallback[context.applicationId] = folder
    return _fallback[context.applicationId]


def stage(df: DataFrame, label: str, lasting: bool = False) -> DataFrame:
    """Write the rows as a Parquet table in the shared folder and read them back.

    A ``lasting`` table stays when the innermost ``job`` ends that it is written in.

    The result has no lineage beyond the files, so it survives lost executors,
    and later readers still prune columns and skip row groups.
    """
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    jobs = _jobs.get(threading.get_ident(), [])
    for paths in jobs[:-1] if lasting else jobs:
        paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def job(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that ``stage`` writes inside, when the job ends. What it returns must not read them."""
    paths: list[str] = []
    own = _jobs.setdefault(threading.get_ident(), [])
    own.append(paths)
    try:
        yield
    finally:
        own.remove(paths)
        java = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        for path in paths:
            there = java(path)
            there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(there, True)


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """Keep rows in memory or on disk while several small jobs read them."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def together(*tasks: Callable[[], object], most: int | None = None, spark: SparkSession | None = None) -> list:
    """Run independent steps at once, ``most`` at a time if given, so that their jobs share the executors.

    A step that runs others together names its session, as only the main thread has an active one.
    """
    if len(tasks) < 2 or most == 1:
        return [task() for task in tasks]
    inherit = inheritable_thread_target(spark or SparkSession.getActiveSession())
    own = _jobs.get(threading.get_ident(), [])

    def within(task: Callable[[], object]) -> object:
        _jobs[threading.get_ident()] = list(own)
        return task()

    with ThreadPoolExecutor(min(len(tasks), most or len(tasks))) as pool:
        return [done.result() for done in [pool.submit(inherit(within), task) for task in tasks]]
