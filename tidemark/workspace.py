"""Shared folders for tables that jobs write and read back, and small file-system helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder every executor can reach, below the cluster's checkpoint folder.

    A machine-local folder is used only when none is configured and the session
    runs on a single machine, as in tests. The folder is deleted when the driver ends.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="tidemark-")
    folder = f"{root.rstrip('/')}/tidemark-{purpose}-{uuid.uuid4().hex}"
    jpath, fs = _path_and_fs(spark, folder)
    fs.mkdirs(jpath)
    fs.deleteOnExit(jpath)
    return f"{folder}/data"


def folder_tag(folder: str) -> str:
    """The unique part of a ``shared_folder``'s name, for names in the catalog."""
    return folder.rsplit("-", 1)[-1].partition("/")[0]


def publish(spark: SparkSession, staged: str, path: str) -> None:
    """Put the finished folder ``staged`` in the place of ``path``."""
    source, fs = _path_and_fs(spark, staged)
    target, _ = _path_and_fs(spark, path)
    if fs.exists(target):
        fs.delete(target, True)
    if not fs.rename(source, target):
        raise OSError(f"cannot move {staged} to {path}")


def discard(spark: SparkSession, path: str) -> None:
    jpath, fs = _path_and_fs(spark, path)
    fs.delete(jpath, True)


def staging_folder(path: str) -> str:
    """A new folder next to ``path``, hidden from readers of the folder around both."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_staged-{name}-{uuid.uuid4().hex}"


def _path_and_fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    jpath, fs = _path_and_fs(spark, path)
    return bool(fs.exists(jpath))


def qualified_path(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as Spark reports it for files read from it."""
    jpath, fs = _path_and_fs(spark, path.rstrip("/"))
    return jpath.makeQualified(fs.getUri(), fs.getWorkingDirectory()).toString()


def is_file(spark: SparkSession, path: str) -> bool:
    jpath, fs = _path_and_fs(spark, path)
    return bool(fs.exists(jpath)) and bool(fs.getFileStatus(jpath).isFile())


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``; empty when it does not exist."""
    jpath, fs = _path_and_fs(spark, path)
    if not fs.exists(jpath):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(jpath))


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a Spark job finished writing the folder (its success marker is there)."""
    return path_exists(spark, f"{path.rstrip('/')}/_SUCCESS")
