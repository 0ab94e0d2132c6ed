"""Where intermediate tables go, and how they go away."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which the driver and all executors share.

    A local session without one gets a temporary folder of its own; on a cluster
    that would be a different disk on each machine, so there it is an error.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not folder:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("Set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="cloakframe-")
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _at(spark, path)
    return files.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder and all below it, if it exists."""
    files, place = _at(spark, path)
    files.delete(place, True)


def qualified(spark: SparkSession, path: str) -> str:
    """A path without a scheme as the default file system's full one."""
    files, place = _at(spark, path)
    return files.makeQualified(place).toString()


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; none if it does not exist."""
    files, place = _at(spark, path)
    return sorted(f.getPath().getName() for f in files.listStatus(place)) if files.exists(place) else []


def move(spark: SparkSession, old: str, new: str) -> None:
    """Renames a folder; ``new`` must not exist."""
    files, place = _at(spark, old)
    target = spark._jvm.org.apache.hadoop.fs.Path(new)
    files.mkdirs(target.getParent())
    if not files.rename(place, target):
        raise OSError(f"cannot move {old} to {new}")
