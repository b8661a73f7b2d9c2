"""Session settings that the plans in this package rely on at scale."""

from __future__ import annotations


from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # split hot keys in joins even when that costs a further exchange above the join
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # latest-per-key windows keep one row per key and task before the exchange
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
}


# An exchange is dealt into many small parts, which are then joined up to a size in bytes. So
# what a task sorts or hashes after it stays as it is when the input grows. Shuffled rows are
# compressed, many times over where columns repeat, hence the modest size.
PARTS, PART_COUNT = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", 512
PART_SIZE, PART_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes", 4 << 20

# The JVM never compiles a method of more than 8,000 bytes. A stage whose generated code has one
# would be interpreted, so Spark is to evaluate such a stage operator by operator.
METHOD_SIZE, METHOD_BYTES = "spark.sql.codegen.hugeMethodLimit", 8000

# Rows that lie together by some of the columns of a join are joined where they are.
TOGETHER = "spark.sql.requireAllClusterKeysForCoPartition"
# Yet what a union brings together is exchanged, or one stage, and each of its tasks, would hold all
# that lies below the union.
UNITED = "spark.sql.unionOutputPartitioning"

_KEPT = "riskfeatures.kept."  # what the session had before


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings; partition counts and memory stay the cluster's."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    for key in (PARTS, PART_SIZE, METHOD_SIZE, TOGETHER, UNITED):
        kept = spark.conf.get(_KEPT + key, None)
        if kept is not None:
            spark.conf.set(key, kept) if kept else spark.conf.unset(key)
            spark.conf.unset(_KEPT + key)
    return spark


def tune_finely(spark: SparkSession) -> SparkSession:
    """`tune`, exchanges in parts of a bounded size, and code that the JVM compiles. Until the
    next `tune`."""
    tune(spark)
    parts = max(PART_COUNT, int(spark.conf.get("spark.sql.shuffle.partitions")))
    for key, value in ((PARTS, parts), (PART_SIZE, PART_BYTES), (METHOD_SIZE, METHOD_BYTES)):
        _put(spark, key, str(value))
    return spark


def tune_together(spark: SparkSession) -> SparkSession:
    """`tune_finely`, and rows that were dealt by company stay so in joins on company and more."""
    tune_finely(spark)
    for key in (TOGETHER, UNITED):
        _put(spark, key, "false")
    return spark


def _put(spark: SparkSession, key: str, value: str) -> None:
    spark.conf.set(_KEPT + key, spark.conf.get(key, None) or "")
    spark.conf.set(key, value)
