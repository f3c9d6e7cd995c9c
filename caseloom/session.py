"""Session settings the jobs rely on for speed; none of them changes a result."""

from __future__ import annotations

from pyspark.sql import SparkSession

RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split the partitions of a hot key even where that costs one more shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The JVM never compiles methods beyond 8000 bytes. Cleaning a row takes many
    # expressions; fused into one method they would be interpreted for every row.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A task that writes a table by sheet keeps a file open for each instead of sorting its
    # rows by sheet first; beyond this many it sorts the rest.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
}


def tune(spark: SparkSession) -> SparkSession:
    for name, value in RUNTIME_CONF.items():
        spark.conf.set(name, value)
    return spark
