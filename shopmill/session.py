"""Session settings sized from the input, for jobs that read far more than a laptop holds."""

from __future__ import annotations

import math

from pyspark.sql import SparkSession

TARGET_BYTES = 128 * 1024**2
SCAN_BYTES = 512 * 1024**2


def settings(input_bytes: int, cores: int, spread: float = 1.5) -> dict[str, str]:
    """Spark settings for a job over ``input_bytes`` on ``cores`` task slots.

    Shuffle partitions are one per 128 MB of input times ``spread`` (rows grow when decompressed), at least
    one per core, without a ceiling: a partition stays as small at any input. Scans read more per
    task the more there is, up to 512 MB, which keeps the number of map outputs down.
    Adaptive execution merges what turns out small and splits what turns out skewed, also where
    that costs an extra shuffle.
    """
    partitions = max(cores, math.ceil(input_bytes * spread / TARGET_BYTES))
    scan = min(SCAN_BYTES, max(TARGET_BYTES, input_bytes // (20 * cores)))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(scan),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_BYTES),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.session.timeZone": "UTC",
    }


def start(builder: SparkSession.Builder, input_bytes: int, cores: int) -> SparkSession:
    """A session with those settings on top of what the builder already names."""
    for key, value in settings(input_bytes, cores).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
