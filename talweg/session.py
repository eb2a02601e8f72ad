"""Session helpers shared by the tests, the bench and the entry module."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

_PACKAGE_ROOT = os.path.dirname(os.path.abspath(__file__))
_SHIPPED = "talweg.package.shipped"


def local_session(cpus: str = "8", app: str = "talweg") -> SparkSession:
    """A local session for development; a cluster brings its own configuration."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", os.environ.get("TALWEG_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per application."""
    if spark.conf.get(_SHIPPED, "") == spark.sparkContext.applicationId:
        return
    folder = tempfile.mkdtemp(prefix="spark-talweg-")
    archive = shutil.make_archive(
        os.path.join(folder, "talweg"), "zip", os.path.dirname(_PACKAGE_ROOT), "talweg"
    )
    spark.sparkContext.addPyFile(archive)
    spark.conf.set(_SHIPPED, spark.sparkContext.applicationId)
