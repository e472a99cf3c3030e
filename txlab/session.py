"""Session settings the work is written for.

On a cluster also set ``spark.checkpoint.dir`` to a shared folder, and
``spark.sql.shuffle.partitions`` to about the largest shuffle's bytes / 128 MB:
adaptive execution merges what turns out small, but does not add partitions.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key's join partition even where a later step must shuffle again for it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    # Batches of long texts for Python workers; an executor holds several at once.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    # Call sites of every column cost driver time only.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configured(builder: SparkSession.Builder) -> SparkSession.Builder:
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return builder
