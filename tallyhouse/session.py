"""Session settings and the shared folder that intermediate tables go to."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import AbstractContextManager, contextmanager
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

# Rows that a task sorts before a shuffle take several times their size in Parquet: such tasks read this part of a split.
SMALL_SPLIT = 4
# Of written tables: some seven tenths of what Spark's default needs.
COMPRESSION = {"compression": "zstd"}

_local_folders: dict[str, str] = {}
_held_lock, _held_users, _held_before = threading.Lock(), Counter(), {}


def build_session(app_name: str = "tallyhouse", **settings: str) -> SparkSession:
    """Session with the settings the engine is written for.

    AQE sizes the shuffles, splits skewed joins and picks broadcast joins from
    measured sizes. Anything passed in ``settings`` wins.
    """
    chosen = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
        # Recording the Python call site of every column doubles the time to build a plan.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    chosen.update(settings)
    builder = SparkSession.builder.appName(app_name)
    for name, value in chosen.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def sizing(input_bytes: int) -> dict[str, str]:
    """Shuffle settings for an input of this size.

    AQE can merge shuffle partitions but not add any, so it has to start from
    enough of them. Partitions grow from 128 MB to 2 GB with the input (sorts and
    aggregations spill beyond memory), so that 100 TB start from some fifty thousand: the
    driver keeps a size for every pair of a map and a reduce task.
    """
    partition = min(2 << 30, max(128 << 20, input_bytes // 10_000))
    return {
        "spark.sql.shuffle.partitions": str(max(8, -(-input_bytes // partition))),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(min(partition, 256 << 20)),
        "spark.sql.files.maxPartitionBytes": str(min(partition, 1 << 30)),
    }


@contextmanager
def _held(spark: SparkSession, name: str, chosen: Callable[[], str]) -> Iterator[None]:
    """Inside, the setting ``name`` is what ``chosen`` gives; it is put back at the end. Jobs may be nested and run together in threads."""
    held = (id(spark._jsparkSession), name)
    with _held_lock:
        if not _held_users[held]:
            _held_before[held] = spark.conf.get(name, None)
            spark.conf.set(name, chosen())
        _held_users[held] += 1
    try:
        yield
    finally:
        with _held_lock:
            _held_users[held] -= 1
            if not _held_users[held]:
                before = _held_before.pop(held)
                spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def small_splits(spark: SparkSession) -> AbstractContextManager[None]:
    """Inside, scans of ``spark`` read splits of a quarter of the session's size.

    For jobs that run inside and aggregate whole rows before a shuffle, which Spark sorts in memory: the task that
    has a quarter of the rows keeps them there.
    """
    name = "spark.sql.files.maxPartitionBytes"
    return _held(spark, name, lambda: str(max(1, _bytes(spark.conf.get(name)) // SMALL_SPLIT)))


def brief_shuffles(spark: SparkSession) -> AbstractContextManager[None]:
    """Inside, the shuffle files of a job go when it ends, instead of when the driver happens to collect its garbage.

    For jobs that write a table: what reads the table needs none of them. A frame that is computed again shuffles again.
    """
    return _held(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", lambda: "true")


def _bytes(size: str) -> int:
    """A size setting such as ``134217728b`` or ``16m`` in bytes."""
    number, unit = re.fullmatch(r"(\d+)\s*([bkmgtp]?)b?", size.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit if unit and unit != "b" else " ")


def measured_bytes(spark: SparkSession, path: str) -> int:
    """Size of all files below ``path``, from the listing alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session without the setting gets a temporary folder; a cluster
    without it is an error, because a driver-local path would lose the tables.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="tallyhouse-")
    return _local_folders[app]


def scratch_folder(spark: SparkSession) -> str:
    """Where this application's intermediate tables go, below the shared folder."""
    return f"{shared_folder(spark)}/tallyhouse/{spark.sparkContext.applicationId}"


def new_folder(spark: SparkSession, label: str) -> str:
    """Unused path among this application's intermediate tables."""
    return f"{scratch_folder(spark)}/{label}-{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession) -> bool:
    """Remove this application's intermediate tables, once nothing reads them any more; false if there were none.

    Frames that read them, as those a run returns, cannot be read afterwards; written tables and reports stay.
    """
    return _remove(spark, scratch_folder(spark))


def _remove(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.exists(folder) and files.delete(folder, True)


def materialise(df: DataFrame, label: str, **options: int) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage with data that outlives executors, keeps column pruning and
    filter pushdown for the readers, and fixes rows whose recomputation could differ.
    ``options`` are the writer's.
    """
    path = new_folder(df.sparkSession, label)
    with brief_shuffles(df.sparkSession):
        df.write.options(**COMPRESSION | options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Relay:
    """Steps of a long job written one after the other, each as :func:`materialise` does; a step's table goes when the next is there.

    So at no time are there more shuffle files than one step needs. The last table goes at :meth:`end`.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.label, self._path = spark, label, None

    def step(self, df: DataFrame) -> DataFrame:
        """``df``, which may read the step before and nothing older, as written."""
        path = new_folder(self.spark, self.label)
        with brief_shuffles(self.spark):
            df.write.options(**COMPRESSION).parquet(path)
        self.end()
        self._path = path
        return self.spark.read.schema(df.schema).parquet(path)

    def end(self) -> None:
        if self._path:
            _remove(self.spark, self._path)
            self._path = None


def together(**jobs: Callable[[], Any]) -> dict[str, Any]:
    """Run independent jobs at the same time, so small ones do not leave the cluster idle.

    The first failure is raised after all jobs have ended.
    """
    with ThreadPoolExecutor(max_workers=max(1, len(jobs))) as pool:
        running = {name: pool.submit(job) for name, job in jobs.items()}
    return {name: job.result() for name, job in running.items()}
