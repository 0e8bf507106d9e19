"""Folders that every executor can reach."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

_SETTINGS = ("spark.checkpoint.dir", "spark.sql.warehouse.dir")

# Files of a trial write: enough for every executor to write some.
_LEAST_TRIED = 16

_seen: set[tuple[str, str]] = set()


def shared_folder(spark: SparkSession, seen_by_all: Callable[[SparkSession, str], bool] | None = None) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``, else the session's warehouse.

    A folder of one machine is refused unless the master is local, or ``seen_by_all`` says that it is a mount
    that all machines have. Which one that is, the cluster's file system settings decide: a path
    without a scheme lies in the default file system.
    """
    folder = next(filter(None, (spark.conf.get(setting, None) for setting in _SETTINGS)), None)
    if not folder:
        raise RuntimeError(f"set {_SETTINGS[0]} to a folder that all executors can reach")
    scheme, found, _ = folder.partition(":")
    if not found or "/" in scheme:
        default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
        scheme = default.partition(":")[0]
    of_one = scheme == "file" and not spark.sparkContext.master.startswith("local")
    if of_one and not (seen_by_all and seen_by_all(spark, folder)):
        raise RuntimeError(f"{folder} is a folder of one machine; set {_SETTINGS[0]} to one that all executors can reach")
    return folder.rstrip("/")


def seen_by_all(spark: SparkSession, folder: str) -> bool:
    """Whether the driver and all executors find in ``folder`` what any of them wrote: a small trial, once per session."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _seen:
        trial, n = _made(spark, folder, "trial"), max(_LEAST_TRIED, 4 * spark.sparkContext.defaultParallelism)
        try:
            # Files of machines that do not share the folder are missing from the driver's listing, or for those that read them.
            spark.range(0, n, 1, n).write.parquet(f"{trial}/data")
            if spark.read.schema("id long").parquet(f"{trial}/data").count() != n:
                return False
        except (PySparkException, Py4JJavaError):
            return False
        finally:
            delete_folder(spark, trial)
        _seen.add(key)
    return True


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing has used yet.

    It lies in a folder of its own, which is deleted when the session's JVM ends. On a cluster, a folder
    without a file system of its own, such as a network mount, is used if :func:`seen_by_all`.
    """
    return f"{_made(spark, shared_folder(spark, seen_by_all), label)}/data"


def _made(spark: SparkSession, parent: str, label: str) -> str:
    folder = f"{parent.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder of :func:`fresh_folder` that no frame reads any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
