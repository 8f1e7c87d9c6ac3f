"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "verdictlake", master: str | None = None,
                  shuffle_partitions: int | None = None, checkpoint_dir: str | None = None) -> SparkSession:
    """A session with the settings the operators are planned for.

    ``shuffle_partitions`` stays unset on a cluster, where the deployment sizes
    it; AQE coalesces small partitions and splits skewed join partitions.
    ``checkpoint_dir`` is for local sessions; a cluster brings its own.
    """
    builder = (SparkSession.builder.appName(app_name)
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.sql.execution.arrow.pyspark.enabled", "true")
               .config("spark.ui.enabled", "false"))
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, or, where
    it is unset, a folder below the warehouse, which a cluster shares as well."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return configured or os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "_work")


def work_path(spark: SparkSession, purpose: str) -> str:
    """A new path for one run of one job below the shared folder."""
    return os.path.join(shared_folder(spark), f"{purpose}-{uuid.uuid4().hex}")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a table in the shared folder, computed once for all its readers;
    it outlives lost executors and cuts the lineage."""
    path = work_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
