"""Session settings used by tests and the benchmark on one machine; a cluster brings its own."""

import os

from pyspark.sql import SparkSession


def local_session(cores="8", app="ledgerloom", scratch=None):
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("LEDGERLOOM_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
    )
    if scratch:  # else intermediate tables go under the warehouse
        builder = builder.config("spark.checkpoint.dir", scratch)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
