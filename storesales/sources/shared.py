"""Tables written to the folder that all executors share."""

from __future__ import annotations

import contextlib
import contextvars
import logging
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

logger = logging.getLogger(__name__)

CHECKPOINT_DIR = "spark.checkpoint.dir"

# The file in a folder of versions that names the current one.
POINTER = "_current"

# Independent jobs submitted at a time, so that small ones use what a large one leaves idle.
JOBS_AT_ONCE = 8

Key = TypeVar("Key")
Result = TypeVar("Result")

# Paths that the innermost scratch scope removes; without one they stay until the session's end.
_scope: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("scratch", default=None)

# Application -> paths made outside of any scope.
_session_paths: dict[str, list[str]] = {}


def concurrently(
    spark: SparkSession, make: Callable[[Key], Result], keys: Iterable[Key]
) -> dict[Key, Result]:
    """``make`` of each key, each running its Spark jobs from a thread of its own."""
    with ThreadPoolExecutor(JOBS_AT_ONCE) as pool:
        # Wrapped one by one: each thread needs its own copy of the local properties and of the scope.
        started = {
            key: pool.submit(contextvars.copy_context().run, inheritable_thread_target(spark)(make), key)
            for key in keys
        }
        return {key: job.result() for key, job in started.items()}


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; a local session without one gets a temporary folder and a warning."""
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="storesales-")
    logger.warning("%s is not set; this local session writes to %s", CHECKPOINT_DIR, folder)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other table has."""
    path = f"{shared_dir(spark)}/storesales/{label}-{uuid.uuid4().hex}"
    held = _scope.get()
    if held is None:
        held = _session_paths.setdefault(spark.sparkContext.applicationId, [])
    held.append(path)
    return path


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Paths made inside are removed at the end; what is returned must not read them any more."""
    held: list[str] = []
    token = _scope.set(held)
    try:
        yield
    finally:
        _scope.reset(token)
        for path in held:
            remove(spark, path)


def remove_session_tables(spark: SparkSession) -> None:
    """Remove what this application has written outside of any scratch scope."""
    for path in _session_paths.pop(spark.sparkContext.applicationId, []):
        remove(spark, path)


def _on_file_system(spark: SparkSession, path: str) -> tuple:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _on_file_system(spark, path)
    return files.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a table or folder of any file system Spark knows; nothing happens if it is absent."""
    files, place = _on_file_system(spark, path)
    files.delete(place, True)


def current(spark: SparkSession, folder: str) -> list[str]:
    """The folders that ``publish`` has made the current one of ``folder`` and the one before; empty if there is none."""
    files, place = _on_file_system(spark, f"{folder}/{POINTER}")
    if not files.exists(place):
        return []
    lines = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(files.open(place), "UTF-8"))
    try:
        return [f"{folder}/{name}" for name in iter(lines.readLine, None)]
    finally:
        lines.close()


def publish(spark: SparkSession, folder: str, name: str) -> None:
    """Make ``name``, a finished folder in ``folder``, the current one, by one rename.

    Until then readers find the one before, whole; afterwards this one, whole.
    The one before stays for readers that have begun with it, an older one goes.
    """
    before = [path.rpartition("/")[2] for path in current(spark, folder)]
    aside = f"{folder}/{POINTER}-{uuid.uuid4().hex}"
    files, place = _on_file_system(spark, aside)
    out = files.create(place, True)
    try:
        out.write(bytearray("\n".join([name, *before[:1]]), "utf-8"))
    finally:
        out.close()
    _replace(spark, aside, f"{folder}/{POINTER}")
    for old in before[1:]:
        remove(spark, f"{folder}/{old}")


def _replace(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file over another one at once."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    kind = getattr(hadoop, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.OVERWRITE
    place = hadoop.Path(source)
    found = hadoop.FileContext.getFileContext(place.toUri(), spark._jsc.hadoopConfiguration())
    found.rename(place, hadoop.Path(target), options)


def version(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and change times of the files at ``path``; empty if it is absent."""
    files, place = _on_file_system(spark, path)
    if not files.exists(place):
        return ()
    found = files.listStatus(place)
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in found))


def checkpoint(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as Parquet at ``path`` and return the table read back from there."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage of ``df`` with a table of its own in the shared folder."""
    return checkpoint(df, new_path(df.sparkSession, label))
