"""Session settings the jobs rely on.

On a cluster the session comes from the submitter; ``tune`` only sets runtime
options.  ``local_session`` is for tests and the bench.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.timeType.enabled": "true",
    # call-site capture costs two driver round trips per column expression
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = 8, shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("sitelens")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        # a few megabytes should still use all cores of one machine
        .config("spark.sql.files.openCostInBytes", "262144")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "256k")
    )
    for key, value in {**RUNTIME, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
