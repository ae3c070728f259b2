"""Shared folders for intermediate tables and files."""

from __future__ import annotations

import os
import tempfile
import uuid

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``; a temporary one only where that is unset and the master is local."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = _LOCAL.setdefault(spark.sparkContext.applicationId, "") or "file://" + tempfile.mkdtemp(prefix="lakewright-")
        _LOCAL[spark.sparkContext.applicationId] = base
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet and read it again, so that later steps don't repeat its plan."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI, for files that tasks write or read by themselves; a plain path is local."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)


def publish_file(spark: SparkSession, temporary: str, target: str) -> bool:
    """Give a finished file its name; False, and the file is dropped, if the name is taken.  Of several writers one wins.

    A local file is linked to its name, which fails if that is there.
    Elsewhere the file is renamed by Hadoop's file system, which must refuse a
    rename onto a file that is there, as HDFS does; stores that copy instead of
    renaming don't.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.getScheme() == "file":
        old, new = (file_system(str(fs.makeQualified(path(p)).toUri()))[1] for p in (temporary, target))
        try:
            os.link(old, new)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(old)
    if fs.exists(path(target)) or not fs.rename(path(temporary), path(target)):
        fs.delete(path(temporary), False)
        return False
    return True
