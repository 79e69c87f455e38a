"""Written intermediate tables in the cluster's shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; in local mode a temporary folder where it is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="spark-pitpanel-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back, so later plans start from the table.

    The table survives lost executors, and readers still prune its columns.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
