"""Intermediate tables in the shared checkpoint folder.

A staged table cuts lineage on storage that outlives any executor, is read
with column pruning by each later step, and has an exact size, from which
Spark chooses to broadcast it or not.

Staged tables stay until ``drop_staged`` is called: a DataFrame that reads them
may still be run. Call it when a job's result is written.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
_FOLDER = "txlab"
_TABLES = "txlab_staged_"


def staging_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; where none is set, one in the warehouse, if this is a local session.

    On a cluster the default warehouse is a folder of one machine, so an unset
    checkpoint folder is an error there.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if not configured:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        configured = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/checkpoints"
        spark.conf.set(CHECKPOINT_DIR, configured)
    return configured.rstrip("/")


def _application_path(spark: SparkSession) -> str:
    return f"{staging_dir(spark)}/{_FOLDER}/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession) -> str:
    return f"{_application_path(spark)}/{uuid.uuid4().hex}"


def stage(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write ``df`` once and return a scan of the written table; ``zstd`` takes less disk and more time."""
    spark = df.sparkSession
    path = new_path(spark)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def stage_in_buckets(df: DataFrame, buckets: int, *columns: str) -> DataFrame:
    """Write ``df`` in buckets by ``columns``: joins, groups and windows on them read it without a shuffle."""
    spark = df.sparkSession
    name = f"{_TABLES}{uuid.uuid4().hex}"
    writer = df.write.option("path", new_path(spark)).option("compression", "zstd")
    writer.bucketBy(buckets, *columns).saveAsTable(name, format="parquet")
    return spark.table(name)


def drop_staged(spark: SparkSession) -> None:
    """Delete every table that this application has staged."""
    for table in spark.catalog.listTables(pattern=f"{_TABLES}*"):
        spark.sql(f"DROP TABLE IF EXISTS {table.name}")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_application_path(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
