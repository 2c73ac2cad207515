"""Session settings the engine is tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Read once when Python starts a session: without it every column expression also records its
# call site in the JVM, and building the wide plans takes seconds.
STARTUP_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}

SETTINGS = {
    # Sizes are fitted while running: shuffle partitions are merged or split to the advisory
    # size, skewed join partitions are cut, gathered months come out in files of that size.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}

# The JVM does not compile methods beyond 8000 bytes of bytecode. One stage over some
# twenty dirty columns is larger than that and would run interpreted; with this limit
# Spark generates it in several smaller methods instead.
HUGE_METHOD = ("spark.sql.codegen.hugeMethodLimit", 8000)


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Add all settings to a session that is still to be started."""
    for key, value in {**STARTUP_SETTINGS, **SETTINGS, HUGE_METHOD[0]: str(HUGE_METHOD[1])}.items():
        builder = builder.config(key, value)
    return builder


def compile_wide_stages(spark: SparkSession) -> SparkSession:
    """Lower the method limit of a running session to what the JVM compiles, and return the session.

    The library does so wherever it builds a wide stage, so any session will do.
    """
    key, limit = HUGE_METHOD
    if int(spark.conf.get(key)) > limit:
        spark.conf.set(key, str(limit))
    return spark


def join_on_buckets(spark: SparkSession) -> None:
    """Let joins on several keys use tables bucketed by one of them.

    Equal values of all keys have equal values of that one, so they are in the same bucket. Spark
    asks for all keys by default, as it fears skew; heavy keys are dealt into cells here.
    """
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
