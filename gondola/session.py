"""Session settings the jobs expect."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Runtime settings only; everything static (memory, master, executors) belongs to spark-submit.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # Row counts, sizes and skew are only known at run time: AQE picks broadcast or shuffle joins
    # from measured sizes, splits skewed join partitions and merges small shuffle partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # percentile_approx and collect_set keep object buffers; with the default of 128 groups per task
    # they would sort every row first. Buffers of ordinary products are small.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "4096",
    # The cleaning projections make methods that the JIT compiler would leave interpreted; plans with
    # such methods run faster as separate operators.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A stored scan is partitioned by a few files; so many writers at once spare a sort of its rows.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made by the caller."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark
