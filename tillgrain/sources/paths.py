"""File operations on whatever file system a path belongs to."""

from __future__ import annotations

import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path, or a pattern of paths, matches anything."""
    files, target = _resolve(spark, path)
    return bool(files.globStatus(target))


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none if there is no such folder."""
    files, target = _resolve(spark, path)
    return [s.getPath().getName() for s in files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(target, "*")) or ()]


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Put a small file in place, whole and at once; False if there is one already.

    Of several writers exactly one succeeds: a hard link on local disks and a rename that does not
    overwrite elsewhere, which file systems such as HDFS do in one step.
    """
    files, target = _resolve(spark, path)
    files.mkdirs(target.getParent())
    _, aside = _resolve(spark, f"{path}.{uuid.uuid4().hex}.new")
    stream = files.create(aside, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    try:
        if files.getScheme() == "file":
            os.link(aside.toUri().getPath(), target.toUri().getPath())
        else:
            context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
            options = spark._jvm.org.apache.hadoop.fs.Options.Rename
            flags = spark.sparkContext._gateway.new_array(options, 1)
            flags[0] = options.NONE
            context.rename(aside, target, flags)
        return True
    except (FileExistsError, Py4JJavaError):
        if files.exists(target):
            return False
        raise
    finally:
        files.delete(aside, False)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The content of a small file; None if it is missing."""
    files, target = _resolve(spark, path)
    if not files.exists(target):
        return None
    stream = files.open(target)
    try:
        size = files.getFileStatus(target).getLen()
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream, size)).decode()
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    files, target = _resolve(spark, path)
    files.delete(target, True)


def replace(spark: SparkSession, source: str, target: str) -> None:
    """Put ``source`` in the place of ``target``; the old content goes only after that.

    A reader sees the old or the new folder, or for a moment none, but never a mixture.
    """
    files, new = _resolve(spark, source)
    _, place = _resolve(spark, target)
    _, aside = _resolve(spark, f"{target}.replaced")
    files.mkdirs(place.getParent())
    files.delete(aside, True)
    if files.exists(place) and not files.rename(place, aside):
        raise OSError(f"Could not move {target} aside.")
    if not files.rename(new, place):
        files.rename(aside, place)
        raise OSError(f"Could not move {source} to {target}.")
    files.delete(aside, True)
