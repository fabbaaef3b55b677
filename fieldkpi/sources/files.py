"""Small files beside tables, through the file system that a path names.

Everything here is about names and short texts; rows are read and written by Spark.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    own = jvm.org.apache.hadoop.fs.Path(path)
    return own.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), own


def exists(spark: SparkSession, path: str) -> bool:
    system, own = _path(spark, path)
    return system.exists(own)


def delete(spark: SparkSession, path: str) -> None:
    """Take away a file or a folder; one that is not there is no error."""
    system, own = _path(spark, path)
    system.delete(own, True)


def names(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder, in order; none if there is no such folder."""
    system, own = _path(spark, folder)
    return sorted(s.getPath().getName() for s in system.listStatus(own)) if system.exists(own) else []


def read(spark: SparkSession, path: str) -> str:
    """The text of a short file."""
    return spark.read.text(path, wholetext=True).first()[0]


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file that is not there yet, whole or not at all; False if it is there.

    The text is written under another name and then put in its place by a rename that does not
    overwrite, which a shared file system decides for one of several writers.  On a local disk a
    hard link does the same.
    """
    system, own = _path(spark, path)
    jvm = spark.sparkContext._jvm
    folder = own.getParent()
    spare = jvm.org.apache.hadoop.fs.Path(folder, f".{uuid.uuid4().hex}")
    out = system.create(spare)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if system.getUri().getScheme() == "file":
            disk = jvm.java.nio.file.FileSystems.getDefault()
            parts = spark.sparkContext._gateway.new_array(jvm.java.lang.String, 0)
            here, there = (disk.getPath(p.toUri().getPath(), parts) for p in (spare, own))
            jvm.java.nio.file.Files.createLink(there, here)
        else:
            rename = jvm.org.apache.hadoop.fs.Options.Rename
            options = spark.sparkContext._gateway.new_array(rename, 1)
            options[0] = rename.NONE
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(own.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(spare, own, options)
    except Exception as error:
        cause = getattr(error, "java_exception", None)
        if cause is None or "AlreadyExists" not in cause.getClass().getName():
            raise
        return False
    finally:
        system.delete(spare, False)
    return True
