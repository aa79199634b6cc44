"""Session settings the plans are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# HotSpot never compiles methods above 8,000 bytes of bytecode. Past that size, separate operators
# (whose projections Spark splits into small methods) are faster than one fused, interpreted
# method: the wide shot projection runs at about twice the speed.
JIT_METHOD_LIMIT = "8000"


def tune(spark: SparkSession) -> SparkSession:
    """Runtime settings only; sizes and partition counts stay the cluster's."""
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", JIT_METHOD_LIMIT)
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark
