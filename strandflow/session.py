"""Session settings for large runs."""

from pyspark.sql import SparkSession

# Adaptive execution does the sizing: start with many shuffle partitions, let
# it merge small ones and split skewed join partitions.
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.files.maxPartitionBytes": "256MB",
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
}


def configured(builder: SparkSession.Builder, total_cores: int) -> SparkSession.Builder:
    """Builder with the settings above and four shuffle partitions per core."""
    for key, value in CLUSTER_SETTINGS.items():
        builder = builder.config(key, value)
    return builder.config("spark.sql.shuffle.partitions", str(4 * total_cores))
