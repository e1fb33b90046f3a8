"""The Spark session of the tests and tools."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_spark() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("tidewick")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tidewick-"))
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "8g")
             .config("spark.sql.codegen.cache.maxEntries", "2000")
             # Call-site capture walks the Python stack for every Column; wide panels have thousands.
             .config("spark.python.sql.dataFrameDebugging.enabled", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark
