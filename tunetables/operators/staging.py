"""Written tables that cut lineage, in the folder the session names."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session, else a folder in its warehouse:
    both are places that every executor reads."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staged"


def stage_path(spark: SparkSession, label: str) -> str:
    return f"{checkpoint_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write once, read back: later uses and lost executors re-read the files."""
    path = stage_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Rows of a scan with fewer partitions than cores dealt out to all of them,
    ahead of work that is heavy per row. Such a scan is small: larger tables have
    more partitions, however few their files, and pass through unshuffled."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
