"""Folders for tables that operators write."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder that every executor can reach, as the session names it.

    Only a local-mode session without the setting gets a temporary folder.
    """
    folder = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING, None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="fieldkpi-")
    spark.conf.set(_SETTING, folder)
    return folder


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
