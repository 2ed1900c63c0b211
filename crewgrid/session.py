"""Sessions with the settings that the engine's results rest on."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Give the package to the session's Python workers, once a context, so that they need no path to it."""
    sc = spark.sparkContext
    if getattr(sc, "_crewgrid_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    at = tempfile.mkdtemp(prefix="crewgrid-package-")
    atexit.register(shutil.rmtree, at, ignore_errors=True)
    sc.addPyFile(shutil.make_archive(f"{at}/crewgrid", "zip", root, "crewgrid"))
    sc._crewgrid_shipped = True


def session(master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """UTC, ANSI and adaptive execution; the cluster's own settings are kept for all else."""
    builder = SparkSession.builder.appName("crewgrid")
    if master:
        builder = builder.master(master)
    settings = {"spark.sql.session.timeZone": "UTC", "spark.sql.ansi.enabled": "true", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.python.filterPushdown.enabled": "true"} | conf
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in settings.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
