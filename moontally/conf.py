"""Session settings the plans count on at scale.  Pass them to the session builder.

    for key, value in conf_for(input_bytes).items():
        builder = builder.config(key, value)
"""

from __future__ import annotations

TARGET_PARTITION_BYTES = 128 << 20


def conf_for(input_bytes: int, least: int = 200) -> dict[str, str]:
    """Settings for a job that reads ``input_bytes`` in all; ``least`` reduce partitions to start from.

    Adaptive execution starts from enough reduce partitions that none outgrows its
    target size and merges the small ones of later, collapsed stages.  It also decides
    every broadcast from measured sizes and splits skewed join partitions.
    """
    partitions = max(least, -(-input_bytes // TARGET_PARTITION_BYTES))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_PARTITION_BYTES),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.autoBroadcastJoinThreshold": str(20 << 20),
        "spark.sql.files.maxPartitionBytes": str(TARGET_PARTITION_BYTES),
        "spark.sql.session.timeZone": "UTC",
    }
